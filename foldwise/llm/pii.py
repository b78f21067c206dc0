"""Personal data by weak supervision, in Spark expressions only.

Base spans (email, ip, card, phone) come from fixed patterns with checks.
Further candidates (opaque strings, identity numbers, local phone numbers,
person names) are judged by labelers that vote +1, 0 or -1: their format,
gazetteers of cue words before them, how their characters mix, what stands
around them, and checksums.  Expectation-maximisation over the counts of
vote patterns estimates each labeler's reliability and a posterior for
every pattern; a logistic classifier trained on those posteriors, with
kind and shape as further features, decides each candidate.

All text work is regular expressions and array functions inside the row
(no shuffle, no Python).  The driver sees one count for each combination
of votes, kind and shape (a bounded number), never a text.

Defined cases: a null text is empty; offsets are code points, the end
exclusive; a failing base match is dropped and not tried again; a further
span that a base span covers whole is not added, one that reaches beyond it
stands beside it; repeated rows are judged
alike; without any candidate the classifier adds nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import apart, renamed_back

#: the base kinds in their order; possessive forms of the given patterns, which
#: match the same text without backtracking.  An email starts where its run of
#: characters does, or at the end of the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?=[0-9])(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: further kinds, after the base ones
FURTHER = ["local_phone", "person", "secret", "ssn"]
#: given names and titles, cue words (fixed values, public knowledge)
NAMES = ("James|Mary|John|Linda|Robert|Anna|Michael|Maria|David|Laura|Thomas|Julia|Peter|Sophie|Hans|Klaus|Karl|Heike|Pierre|Marie|"
         "Jean|Claire|Carlos|Carmen|Juan|Elena|Jose|Lucia")
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra"
CUES = {
    "secret": "token|key|secret|password|passwd|pwd|apikey|api_key|bearer|auth|credential|schlüssel|passwort|clé|clave|contraseña",
    "local_phone": "phone|tel|call|fax|mobile|telefon|téléphone|teléfono",
    "ssn": "ssn|social|security|tax|identity|id",
    "person": "name|contact|dear|by|from|author|von|par|por",
}
_CANDIDATE = (rf"(?<![A-Za-z0-9_])[A-Za-z0-9_]{{16,}}+|(?<![0-9-])[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9-])"
              rf"|(?<![0-9+])\(?[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}(?![0-9])"
              rf"|\b(?:{TITLES})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?|\b(?:{NAMES}) \p{{Lu}}\p{{L}}+")
#: columns of votes, and of a candidate's shape
VOTES = ["v_format", "v_cue", "v_mix", "v_around", "v_check"]
_BLOCK = 256


def _spans(matched: str, regex_: str, text: str = "_t") -> Column:
    """(start, end, m) of the matches in the array column ``matched``: lengths of
    matches and of what is split off between them, summed in blocks so that
    thousands of matches stay cheap."""
    lit = regex_.replace("\\", "\\\\").replace("'", "\\'")
    lens = f"zip_with({matched}, slice(split({text}, '{lit}', -1), 1, size({matched})), (m, g) -> length(m) + length(g))"
    # the arrays are bound once, as lambda variables, and not per element
    total = f"""flatten(transform(array({lens}), ls -> flatten(transform(
        array(transform(sequence(0, int((size(ls) - 1) div {_BLOCK})), b -> aggregate(slice(ls, b * {_BLOCK} + 1, {_BLOCK}), 0, (s, x) -> s + x))),
        bs -> transform(sequence(0, size(ls) - 1), i -> aggregate(slice(bs, 1, int(i div {_BLOCK})), 0, (s, x) -> s + x)
            + aggregate(slice(ls, int(i div {_BLOCK}) * {_BLOCK} + 1, i % {_BLOCK} + 1), 0, (s, x) -> s + x))))))"""
    return F.expr(f"""case when size({matched}) = 0 then cast(array() as array<struct<start:int,end:int,m:string>>)
        else zip_with({total}, {matched}, (e, m) -> named_struct('start', e - length(m), 'end', e, 'm', m)) end""")


def _luhn(digits: str) -> str:
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + if(i % 2 = 1, int(substr({digits}, -i, 1)),
        int((2 * int(substr({digits}, -i, 1))) % 10 + (2 * int(substr({digits}, -i, 1))) div 10))) % 10 = 0"""


def _passes(kind: str) -> str:
    digits = "regexp_replace(x.m, '[^0-9]', '')"
    return {
        "email": "true",
        "ip": f"x.m rlike '^{_BYTE}([.]{_BYTE}){{3}}$'",
        "card": f"case when length({digits}) between 12 and 19 then {_luhn(digits)} else false end",
        "phone": f"length({digits}) between 9 and 15",
    }[kind]


#: working columns of this module
_STEPS = ["_t", "_digit", *(f"{p}{k}" for k in BASE for p in ("_m_", "_s_")), "_found", "_mc", "_cs", "_c", "_all"]


def base_spans(df: DataFrame, text: str = "text", out: str = "base") -> DataFrame:
    """``df`` with ``out``: array of (start, end, kind) of the base kinds, by
    start, then kind as listed.  An input column ``out`` gives way; all others
    stay, whatever their names."""
    df, text, back = apart(df, _STEPS, text)
    d = df.withColumn("_t", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    none = F.array().cast("array<string>")
    has_digit = F.col("_t").rlike("[0-9]")
    d = d.withColumn("_digit", has_digit)
    for k, r in BASE.items():
        may = F.instr("_t", "@") > 0 if k == "email" else F.col("_digit")
        d = d.withColumn(f"_m_{k}", F.when(may, F.regexp_extract_all("_t", F.lit(r), F.lit(0))).otherwise(none))
    for i, (k, r) in enumerate(BASE.items()):
        d = d.withColumn(f"_s_{k}", _spans(f"_m_{k}", r))
        d = d.withColumn(f"_s_{k}", F.expr(f"transform(filter(_s_{k}, x -> {_passes(k)}), x -> named_struct('start', x.start, 'rank', {i}, 'end', x.end, 'kind', '{k}'))"))
    every = F.array_sort(F.concat(*[F.col(f"_s_{k}") for k in BASE]))
    found = F.transform(every, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind")))
    d = d.withColumn("_found", found).select(*[F.col(f"`{c}`") for c in df.columns if c != out], F.inline(F.array(F.struct(F.col("_found").alias(out)))))
    return renamed_back(d, back)


def _candidates(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``_c``: the further candidates, each with votes and shape."""
    d = df.withColumn("_t", F.coalesce(F.col(f"`{text}`"), F.lit("")))
    d = d.withColumn("_mc", F.regexp_extract_all("_t", F.lit(_CANDIDATE), F.lit(0)))
    d = d.withColumn("_cs", _spans("_mc", _CANDIDATE))
    # strings of letters alone are words
    d = d.withColumn("_cs", F.expr("filter(_cs, x -> not (x.m rlike '^[A-Za-z_]+$'))"))
    kind = """case when x.m rlike '^[0-9]{3}-[0-9]{2}-[0-9]{4}$' then 'ssn' when x.m rlike '^[(]?[0-9]{3}[)]?[ .-]' then 'local_phone'
        when x.m rlike ' ' then 'person' else 'secret' end"""
    d = d.withColumn("_cs", F.expr(f"""transform(_cs, x -> named_struct('start', x.start, 'end', x.end, 'm', x.m, 'kind', {kind},
        'left', substring(_t, greatest(x.start - 39, 1), least(40, x.start)), 'right', substring(_t, x.end + 1, 12)))"""))
    cue = "case x.kind " + " ".join(f"when '{k}' then if(lower(x.left) rlike '(?:{c})[^a-z]', 1, 0)" for k, c in CUES.items()) + " end"
    votes = {
        "v_format": """case x.kind when 'secret' then if(x.m rlike '^(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:sk|ghp|AKIA)[A-Za-z0-9_]+)$', 1, -1)
            when 'ssn' then if(x.m rlike '^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$', 1, -1)
            when 'local_phone' then if(x.m rlike '^[(][0-9]{3}[)]|^([0-9]{3})([ .-])[0-9]{3}\\\\2[0-9]{4}$', 1, -1) else 0 end""",
        "v_cue": cue,
        "v_mix": f"""case x.kind when 'secret' then if(x.m rlike '[0-9].*[A-Za-z].*[0-9]' and not (x.m rlike '(.)\\\\1\\\\1\\\\1'), 1, -1)
            when 'person' then if(x.m rlike '^(?:{NAMES}) ', 1, 0) else if(x.m rlike '([0-9])\\\\1\\\\1\\\\1', -1, 0) end""",
        "v_around": """case when x.left rlike '[=:][ "\\']*$' then 1 when x.left rlike '[0-9.,/-]$' or x.right rlike '^[/0-9-]' then -1 else 0 end""",
        "v_check": f"""case when x.kind = 'secret' and x.m rlike '^[0-9]{{16,19}}$' then if({_luhn('x.m')}, 1, -1)
            when x.kind = 'person' and x.m rlike '^(?:{TITLES})' then 1 else 0 end""",
    }
    shape = "least(length(x.m) div 12, 4)"
    digits = "least(4 * length(regexp_replace(x.m, '[^0-9]', '')) div length(x.m), 3)"
    fields = ", ".join(f"'{k}', int({v})" for k, v in votes.items())
    return d.withColumn("_c", F.expr(f"""transform(_cs, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind, {fields},
        'len', int({shape}), 'dig', int({digits})))"""))


@dataclass
class Model:
    """Reliabilities of the labelers, and the classifier's weights by
    ``feature=value``; a candidate is personal data if they sum above 0."""

    reliability: dict = field(default_factory=dict)
    weights: dict = field(default_factory=dict)


def estimate(cells: list[tuple[tuple[int, ...], str, float]], rounds: int = 50) -> tuple[list[float], dict]:
    """Expectation-maximisation over (votes, kind, count): for every labeler the
    chance that its vote is right and the chance that it votes at all, per
    class; the posterior of every (votes, kind).  Starts from the majority."""
    post = {}
    for v, k, _ in cells:
        s = sum(v)
        post[v, k] = 0.85 if s > 0 else 0.15 if s < 0 else 0.35
    like = {}
    for _ in range(rounds):
        total = {0: 1e-9, 1: 1e-9}
        prior = {}
        like = {}
        for v, k, n in cells:
            p = post[v, k]
            a, b = prior.get(k, (1.0, 1.0))
            prior[k] = a + n * p, b + n * (1 - p)
            for c, w in ((1, n * p), (0, n * (1 - p))):
                total[c] += w
                for j, x in enumerate(v):
                    like[j, x, c] = like.get((j, x, c), 0.0) + w
        new = {}
        for v, k, _ in cells:
            a, b = prior[k]
            z = math.log(a) - math.log(b)
            for j, x in enumerate(v):
                z += math.log((like[j, x, 1] + 0.5) / (total[1] + 1.5)) - math.log((like[j, x, 0] + 0.5) / (total[0] + 1.5))
            new[v, k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
        if max((abs(new[x] - post[x]) for x in new), default=0) < 1e-6:
            post = new
            break
        post = new
    n_labelers = len(cells[0][0]) if cells else 0
    right = []
    for j in range(n_labelers):
        good = sum(n * (post[v, k] if v[j] > 0 else 1 - post[v, k]) for v, k, n in cells if v[j])
        voted = sum(n for v, k, n in cells if v[j])
        right.append(good / voted if voted else 0.5)
    return right, post


def _logistic(rows: list[tuple[list[str], float, float]], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> dict:
    """Weights of a logistic classifier on (features, target, count) rows."""
    w: dict[str, float] = {}
    square: dict[str, float] = {}
    total = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        grad: dict[str, float] = {}
        for fs, y, n in rows:
            z = sum(w.get(f, 0.0) for f in fs)
            g = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - y)
            for f in fs:
                grad[f] = grad.get(f, 0.0) + g
        for f, g in grad.items():
            g += decay * w.get(f, 0.0)
            square[f] = square.get(f, 1e-12) + g * g
            w[f] = w.get(f, 0.0) - rate * g / math.sqrt(square[f])
    return w


_FEATURES = ["kind", *VOTES, "len", "dig"]


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Labeler reliabilities and classifier from all candidates of all documents."""
    each = _candidates(docs.select(F.col(text).alias("_text")), "_text").select(F.inline("_c"))
    rows = each.groupBy(*_FEATURES).agg(F.count(F.lit(1)).alias("n")).orderBy(*_FEATURES).collect()
    cells: dict = {}
    for r in rows:
        key = tuple(r[v] for v in VOTES), r.kind
        cells[key] = cells.get(key, 0) + r.n
    right, post = estimate([(v, k, n) for (v, k), n in cells.items()])
    w = _logistic([([f"{f}={r[f]}" for f in _FEATURES] + ["bias"], post[tuple(r[v] for v in VOTES), r.kind], r.n) for r in rows])
    return Model(dict(zip(VOTES, right)), w)


def _decision(model: Model) -> str:
    parts = [f"{model.weights.get('bias', 0.0)!r}D"]
    for f in _FEATURES:
        values = {k.split("=", 1)[1]: w for k, w in sorted(model.weights.items()) if k.startswith(f"{f}=")}
        if values:
            parts.append(f"case string(x.{f}) " + " ".join(f"when '{v}' then {w!r}D" for v, w in values.items()) + " else 0D end")
    return " + ".join(parts) + " > 0"


def find(docs: DataFrame, model: Model, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with ``base`` and ``out``: arrays of (start, end, kind); ``out`` has
    the base spans and the candidates the classifier accepts.  Input columns of
    these two names give way; all others stay, whatever their names."""
    docs, text, back = apart(docs, _STEPS, text)
    d = _candidates(base_spans(docs, text, "base"), text)
    keep = f"filter(_c, x -> {_decision(model)} and not exists(base, b -> b.start <= x.start and x.end <= b.end))" if model.weights else "slice(_c, 1, 0)"
    order = "case x.kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate([*BASE, *FURTHER])) + " end"
    every = F.expr(f"""transform(array_sort(transform(concat(base, transform({keep}, x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind))),
        x -> named_struct('start', x.start, 'rank', {order}, 'end', x.end, 'kind', x.kind))),
        x -> named_struct('start', x.start, 'end', x.end, 'kind', x.kind))""")
    cols = [F.col(f"`{c}`") for c in docs.columns if c not in ("base", out)]
    return renamed_back(d.withColumn("_all", every).select(*cols, F.inline(F.array(F.struct("base", F.col("_all").alias(out))))), back)


def joined(spans: str) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in angle
    brackets; overlapping spans become one, named after the first.  Texts
    without spans, and nulls, stay as they are."""
    d = find(docs.withColumn("_row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])).select("_row", F.col(f"`{text}`").alias("_text")), model, "_text", "_spans")
    # runs of overlapping spans as (start, end, kind)
    merged = """aggregate(_spans, cast(array() as array<struct<start:int,end:int,kind:string>>), (a, x) ->
        if(size(a) > 0 and x.start < element_at(a, -1).end,
           array_append(slice(a, 1, size(a) - 1), named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end), 'kind', element_at(a, -1).kind)),
           array_append(a, x)))"""
    d = d.withColumn("_runs", F.when(F.size("_spans") > 0, F.expr(merged)))
    new = F.expr("""concat(array_join(zip_with(_runs, array_prepend(slice(_runs, 1, size(_runs) - 1), named_struct('start', 0, 'end', 0, 'kind', '')),
        (x, p) -> concat(substring(_text, p.end + 1, x.start - p.end), '<', x.kind, '>')), ''), substring(_text, element_at(_runs, -1).end + 1, length(_text)))""")
    fixed = F.when(F.size("_spans") > 0, new).otherwise(F.col("_text"))
    return d.select("_row", fixed.alias("_new")).select(*[(F.col("_new") if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])


def digests() -> list:
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return [*map(count, BASE), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")]
