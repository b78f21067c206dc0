"""Quality rules as a learned decision list, in Spark expressions only.

Statistics of every whole text are array functions in its own row (no
shuffle, no Python).  A decision list is learned from labelled documents
by sequential covering: each rule is a conjunction of threshold tests
grown greedily for the gain in information, pruned on held-back rows, and
kept while it is precise enough; covered rows leave the pool.  The list
becomes one ordered ``CASE WHEN``; documents that no rule rejects are kept.

Fitting reads at most ``max_rows`` labelled documents (hash-chosen, a
documented bound for the classifier) and only their numbers reach the
driver; the statistics and the verdict cover every document.

Defined cases: a null text has no words and fails the base rule; documents
without a label are not used for fitting, of repeated labels the smallest
quality counts; with no usable label the list is empty and only the base
rule decides; equal gains go to the earlier feature and lower threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import apart, renamed_back

_WS = "\t\n\x0b\x0c\r "
_WORDS = r"[\x20\x09-\x0D]+"
_SYMBOLS = "#*$%&|<>"
#: so many repeated windows are looked up one by one
_FEW = 16
#: base statistics, then the ratios that the rules test
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["repeat_share", "symbol_share", "dup_line_share", "mean_word", "upper_share", "digit_share",
          "stop_share", "bang_share", "bare_line_share"]


#: working columns of ``add_statistics``
_STEPS = ["_t", "_w", "_h", "_s", "_d", "_o", "_p", "_lines", "_q"]


def add_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the columns ``BASE`` and ``RATIOS`` for ``text``.  Input columns
    of these names give way; all others stay, whatever their names.

    Words of a 3-word window that occurs again are counted by sorting the
    windows' hashes within the row; only rows with many repeated windows sort
    their positions too.
    """
    df, text, back = apart(df.drop(*(c for c in [*BASE, *RATIOS] if c != text)), _STEPS, text)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    # one projection per step: a step's arrays are columns of the next
    d = df.withColumn("_t", body)
    d = d.withColumn("_w", F.filter(F.split("_t", _WORDS), lambda w: w != ""))
    d = d.withColumn("n_words", F.size("_w").cast("bigint"))
    d = d.withColumn("_h", F.when(F.size("_w") < 3, F.array().cast("array<bigint>")).otherwise(
        F.expr("zip_with(zip_with(slice(_w, 1, size(_w) - 2), slice(_w, 2, size(_w) - 2), (a, b) -> xxhash64(a, b)), slice(_w, 3, size(_w) - 2), (a, b) -> xxhash64(a, b))")))
    d = d.withColumn("_s", F.sort_array("_h"))
    d = d.withColumn("_d", F.expr("""array_distinct(filter(zip_with(slice(_s, 1, greatest(size(_s) - 1, 0)), slice(_s, 2, greatest(size(_s) - 1, 0)),
        (a, b) -> if(a = b, a, null)), x -> x is not null))"""))
    # positions of the windows that occur again: looked up among a few hashes,
    # or for many by sorting (hash, position) and comparing neighbours
    d = d.withColumn("_o", F.when(F.size("_d") > _FEW, F.expr("array_sort(transform(_h, (h, i) -> struct(h, i)))")))
    d = d.withColumn("_p", F.expr(f"""case when size(_d) = 0 then null
        when size(_d) <= {_FEW} then filter(transform(_h, (h, i) -> if(array_contains(_d, h), i, null)), x -> x is not null)
        else array_sort(filter(zip_with(_o, zip_with(array_append(slice(_o, 2, size(_o)), null), array_prepend(slice(_o, 1, size(_o) - 1), null),
            (n, q) -> struct(n, q)), (p, o) -> if(p.h = o.n.h or p.h = o.q.h, p.i, null)), x -> x is not null)) end"""))
    d = d.withColumn("n_repeat_words", F.when(F.size("_d") > 0, F.expr(
        "aggregate(zip_with(_p, slice(_p, 2, size(_p)), (a, b) -> if(b is null, 3, least(3, b - a))), 0L, (s, x) -> s + x)")).otherwise(F.lit(0)).cast("bigint"))
    d = d.withColumn("_lines", F.filter(F.split("_t", "\n"), lambda x: F.trim(x, F.lit(_WS)) != ""))
    # the characters that are counted, alone: counting them again is cheap
    d = d.withColumn("_q", F.regexp_replace("_t", "[^A-Z0-9.!?#*$%&|<>]+", ""))
    count = lambda chars: F.length("_q") - F.length(F.translate("_q", chars, ""))
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.size("_lines"), F.lit(1)).cast("double")
    d = d.withColumns({
        "word_chars": F.length(F.array_join("_w", "")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
    })
    d = d.withColumns({
        "n_symbols": count(_SYMBOLS).cast("bigint"),
        "repeat_share": F.col("n_repeat_words") / n,
        "dup_line_share": F.col("n_dup_lines") / lines,
        "mean_word": F.col("word_chars") / n,
        "upper_share": count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars,
        "digit_share": count("0123456789") / chars,
        "stop_share": count(".") / n,
        "bang_share": count("!?") / n,
        "bare_line_share": F.size(F.filter("_lines", lambda x: ~F.substring(F.rtrim(x, F.lit(_WS)), -1, 1).isin(".", "!", "?"))) / lines,
    })
    d = d.withColumn("symbol_share", F.col("n_symbols") / chars)
    # through a generator of one row: filters on the statistics stay above it,
    # where they would otherwise be moved down with a copy of every expression
    return renamed_back(d.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array(F.struct(*BASE, *RATIOS)))), back)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    at: float

    def column(self) -> Column:
        return F.col(self.feature) > self.at if self.above else F.col(self.feature) <= self.at

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.at if self.above else row[self.feature] <= self.at

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.at:.6g}"


@dataclass(frozen=True)
class Rule:
    """Documents for which all tests hold are rejected."""

    tests: tuple[Test, ...]

    def column(self) -> Column:
        out = F.lit(True)
        for t in self.tests:
            out = out & t.column()
        return out

    def covers(self, row: dict) -> bool:
        return all(t.holds(row) for t in self.tests)

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests))


def _counts(rows: list[dict]) -> tuple[int, int]:
    bad = sum(r["bad"] for r in rows)
    return bad, len(rows) - bad


def _grow(rows: list[dict], features: list[str], longest: int) -> list[Test]:
    """Add the test with the largest information gain until only bad rows are
    covered, no test gains, or the rule is long enough.  Thresholds lie midway
    between neighbouring values."""
    tests: list[Test] = []
    while len(tests) < longest:
        bad, good = _counts(rows)
        if not bad or not good:
            break
        before, best, pick = math.log2(bad / (bad + good)), 1e-9, None
        for f in features:
            b = g = 0
            ordered = sorted((r[f], r["bad"]) for r in rows)
            for (v, y), (v2, _) in zip(ordered, ordered[1:]):
                b, g = b + y, g + 1 - y
                if v2 > v:
                    for above, p, n in ((False, b, g), (True, bad - b, good - g)):
                        gain = p * (math.log2(p / (p + n)) - before) if p else 0.0
                        if gain > best:
                            best, pick = gain, Test(f, above, (v + v2) / 2)
        if pick is None:
            break
        tests.append(pick)
        rows = [r for r in rows if pick.holds(r)]
    return tests


def _worth(tests: list[Test], rows: list[dict]) -> float:
    """(bad - good) / covered on the rows held back for pruning."""
    bad, good = _counts([r for r in rows if all(t.holds(r) for t in tests)])
    return (bad - good) / (bad + good) if bad + good else -1.0


def learn(rows: list[dict], features: list[str], longest: int = 3, most_rules: int = 12, precision: float = 0.98, least: int = 5) -> list[Rule]:
    """Sequential covering over rows of features, ``bad`` (0/1) and ``fold``
    (0, 1: grow, 2: prune).  A rule stays if at least ``least`` rows that are
    still uncovered fall under it and ``precision`` of all rows it covers
    are bad."""
    rules: list[Rule] = []
    left = rows
    while len(rules) < most_rules:
        tests = _grow([r for r in left if r["fold"] < 2], features, longest)
        if not tests:
            break
        held = [r for r in left if r["fold"] == 2]
        while len(tests) > 1 and _worth(tests[:-1], held) >= _worth(tests, held):
            tests = tests[:-1]
        rule = Rule(tuple(tests))
        bad, good = _counts([r for r in rows if rule.covers(r)])
        new = sum(r["bad"] for r in left if rule.covers(r))
        if new < least or bad < precision * (bad + good):
            break
        rules.append(rule)
        left = [r for r in left if not rule.covers(r)]
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        max_rows: int = 8000, **kw) -> list[Rule]:
    """Rules from labelled documents (label 0: bad).  The labelled ids with the
    smallest hashes, ``max_rows`` at most, are broadcast to find their texts;
    rows of the base rule are left to it."""
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_col).alias("_k"))
             .agg((F.min(label) == 0).cast("int").alias("bad"))
             .orderBy(F.xxhash64("_k"), "_k").limit(max_rows))
    few = docs.select(F.col(id_col).alias("_k"), F.col(text).alias("_text")).join(F.broadcast(marks), "_k")
    rows = (add_statistics(few, "_text").where(~base_failed())
            .select(*RATIOS, "bad", F.pmod(F.xxhash64("_k", F.lit("fold")), F.lit(3)).alias("fold"), F.xxhash64("_k").alias("_o")).collect())
    rows = sorted((r.asDict() for r in rows), key=lambda r: (r["_o"], *(r[f] for f in RATIOS)))
    return learn(rows, RATIOS, **kw)


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects the document, 0 for the base
    rule, null for a document to keep: one ordered conditional."""
    out = F.when(base_failed(), F.lit(0))
    for k, r in enumerate(rules, 1):
        out = out.when(r.column(), F.lit(k))
    return out


def judge(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """``docs`` with the base statistics, ``base_failed``, ``rule`` and ``kept``;
    input columns of these names, and of the names in ``RATIOS``, give way."""
    docs = docs.drop("base_failed", "rule", "kept")
    d = add_statistics(docs, text).withColumn("rule", verdict(rules)).withColumn("base_failed", base_failed())
    return d.withColumn("kept", F.col("rule").isNull()).drop(*RATIOS)


def keep_good(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The documents that neither the base rule nor a learned one rejects."""
    d = add_statistics(docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text")), "_text")
    return d.where(verdict(rules).isNull()).select("_row.*")
