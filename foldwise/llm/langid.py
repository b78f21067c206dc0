"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public
vocabulary.  The probability of a word is the sum over all ways of
cutting it into pieces, computed by the forward algorithm; a text's
log-likelihood is the sum over its words, and the posterior over the
languages gives the prediction and its score.  Piece probabilities are
trained by expectation-maximisation on word counts.

Words are the runs of letters (with combining marks) of the lower-cased
text, as UTF-8 after a blank; words of more than ``PART`` bytes are scored
in parts of that size.  Training reads at most about ``rows_per_lang``
hash-chosen documents of each language (a documented bound for fitting the
classifier); prediction reads every whole text.

Defined cases: a null text or one without a letter is ``und`` with score
0; with no labelled training document everything is ``und``; repeated rows
are predicted alike; of equal posteriors the smallest language wins.
"""

from __future__ import annotations

import base64
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import written

WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: longest piece and longest scored part of a word, in bytes
PIECE, PART = 12, 32
#: strings whose likelihoods a worker keeps
_CACHE = 400_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> dict[bytes, int]:
    """Pieces of at most ``PIECE`` bytes, numbered; every single byte is one."""
    out: dict[bytes, int] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                b = base64.b64decode(line.split()[0])
                if len(b) <= PIECE:
                    out.setdefault(b, len(out))
    for i in range(256):
        out.setdefault(bytes([i]), len(out))
    return out


def parts(token: str) -> list[bytes]:
    """The scored byte strings of a lower-cased white-space token."""
    out = []
    for w in WORD.findall(token):
        b = b" " + w.encode()
        out.extend(b[i:i + PART] for i in range(0, len(b), PART))
    return out


def lattices(words: list[bytes], path: str) -> Iterator[tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]]:
    """Words of equal length together: their indices, and for every span the
    piece numbers (-1: no such piece)."""
    get = vocabulary(path).get
    by_len = defaultdict(list)
    for k, w in enumerate(words):
        by_len[len(w)].append(k)
    for n, ks in by_len.items():
        spans = [(i, j) for j in range(1, n + 1) for i in range(max(0, j - PIECE), j)]
        for at in range(0, len(ks), 20_000):
            some = ks[at:at + 20_000]
            ids = np.array([[get(words[k][i:j], -1) for i, j in spans] for k in some], np.int32)
            yield np.array(some), {s: ids[:, c] for c, s in enumerate(spans)}


def forward(spans: dict, probs: np.ndarray) -> list[np.ndarray]:
    """For every prefix the summed probability of its segmentations (rows: words,
    columns: languages).  The last row of ``probs`` is 0, for missing pieces."""
    n, rows = max(j for _, j in spans), len(next(iter(spans.values())))
    alpha = [np.ones((rows, probs.shape[1]))] + [np.zeros((rows, probs.shape[1])) for _ in range(n)]
    for (i, j), ids in spans.items():
        alpha[j] += alpha[i] * probs[ids]
    return alpha


def backward(spans: dict, probs: np.ndarray) -> list[np.ndarray]:
    n, rows = max(j for _, j in spans), len(next(iter(spans.values())))
    beta = [np.zeros((rows, probs.shape[1])) for _ in range(n)] + [np.ones((rows, probs.shape[1]))]
    for (i, j), ids in sorted(spans.items(), reverse=True):
        beta[i] += probs[ids] * beta[j]
    return beta


def expected(words: list[bytes], counts: np.ndarray, probs: np.ndarray, path: str) -> np.ndarray:
    """Expected number of uses of each piece in the counted words (one language)."""
    out = np.zeros(len(probs))
    for ks, spans in lattices(words, path):
        alpha, beta = forward(spans, probs), backward(spans, probs)
        scale = counts[ks] / alpha[-1][:, 0]
        for (i, j), ids in spans.items():
            out += np.bincount(ids % len(probs), scale * alpha[i][:, 0] * probs[ids, 0] * beta[j][:, 0], len(probs))
    return out[:-1]


def loglik(words: list[bytes], probs: np.ndarray, path: str) -> np.ndarray:
    """Natural-log probability of every word in every language."""
    out = np.zeros((len(words), probs.shape[1]))
    for ks, spans in lattices(words, path):
        out[ks] = np.log(forward(spans, probs)[-1])
    return out


def _matrix(langs: list[str], weight: dict[str, dict[int, float]], size: int, smooth: float) -> np.ndarray:
    probs = np.zeros((size + 1, len(langs)))
    for k, lang in enumerate(langs):
        col = np.full(size, smooth)
        for p, v in weight.get(lang, {}).items():
            col[p] += v
        probs[:size, k] = col / col.sum()
    return probs


class Model:
    """Languages, their log priors, and the matrix of piece probabilities."""

    def __init__(self, langs: list[str], prior: np.ndarray, probs: np.ndarray, path: str):
        self.langs, self.prior, self.probs, self.path = langs, prior, probs, path


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", rows_per_lang: int = 2000,
          rounds: int = 3, smooth: float = 0.01, path: str | None = None) -> Model:
    """Piece probabilities per language.  ``rows_per_lang`` bounds the documents
    of a language that are read, chosen by a hash of the id.  The driver gets
    one number per piece and language."""
    path = path or default_path()
    size = len(vocabulary(path))
    d = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"), F.col(lang).alias("_lang")).where("_lang is not null and _text is not null")
    share = {r["_lang"]: r["n"] for r in d.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(share)
    if not langs:
        return Model([], np.zeros(0), np.zeros((size + 1, 0)), path)
    pick = F.pmod(F.xxhash64(F.coalesce(F.col("_id").cast("string"), F.col("_text"))), F.lit(1 << 30))
    keep = F.lit(False)
    for g in langs:
        keep = keep | ((F.col("_lang") == g) & (pick < int(min(1.0, rows_per_lang / share[g]) * (1 << 30))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = defaultdict(Counter)

        def emit():
            for g, c in seen.items():
                words = Counter()
                for t, n in c.items():
                    for w in parts(t):
                        words[w] += n
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(words), pa.string()), pa.array(list(words), pa.binary()),
                                                  pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])
            seen.clear()

        for b in batches:
            for t, g in zip(b.column("_text").to_pylist(), b.column("_lang").to_pylist()):
                seen[g].update(t.lower().split())
                if sum(map(len, seen.values())) > 300_000:
                    yield from emit()
        yield from emit()

    words = written(d.where(keep).select("_text", "_lang").mapInArrow(count, "lang string, word binary, n bigint")
                    .groupBy("lang", "word").agg(F.sum("n").alias("n")), "langid-words")
    probs = _matrix(langs, {}, size, 1.0)
    for _ in range(rounds):
        probs = _round(words, langs, probs, path, smooth)
    n = np.array([share[g] for g in langs], float)
    return Model(langs, np.log(n / n.sum()), probs, path)


def _round(words: DataFrame, langs: list[str], probs: np.ndarray, path: str, smooth: float) -> np.ndarray:
    """One round of expectation-maximisation over all counted words."""
    sent = words.sparkSession.sparkContext.broadcast(probs)
    place = {g: k for k, g in enumerate(langs)}

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            lang, word, n = np.array(b.column("lang").to_pylist(), object), b.column("word").to_pylist(), b.column("n").to_numpy()
            for g in set(lang):
                k = np.flatnonzero(lang == g)
                e = expected([word[i] for i in k], n[k], sent.value[:, place[g]:place[g] + 1], path)
                total[g] = total.get(g, 0) + e
        for g, e in total.items():
            used = np.flatnonzero(e)
            yield pa.RecordBatch.from_arrays([pa.array([g] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(e[used])], ["lang", "piece", "v"])

    rows = words.mapInArrow(step, "lang string, piece int, v double").groupBy("lang", "piece").agg(F.sum("v").alias("v")).toArrow()
    weight: dict[str, dict[int, float]] = defaultdict(dict)
    for g, p, v in zip(*(rows.column(c).to_pylist() for c in ("lang", "piece", "v"))):
        weight[g][p] = v
    return _matrix(langs, weight, len(probs) - 1, smooth)


class Scorer(dict):
    """White-space token -> row of ``rows``: its log-likelihood per language,
    and its number of words in the last column."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.new = model, []
        self.rows = np.zeros((0, len(model.langs) + 1))

    def __missing__(self, token: str) -> int:
        self[token] = k = len(self)
        self.new.append(token)
        return k

    def settle(self) -> None:
        if not self.new:
            return
        split = [parts(t) for t in self.new]
        words = list({w for p in split for w in p})
        ll = loglik(words, self.model.probs, self.model.path)
        at = {w: k for k, w in enumerate(words)}
        rows = np.zeros((len(split), self.rows.shape[1]))
        for k, p in enumerate(split):
            for w in p:
                rows[k, :-1] += ll[at[w]]
            rows[k, -1] = len(p)
        self.rows, self.new = np.concatenate([self.rows, rows]), []

    def predict(self, texts: list) -> tuple[list[str], list[float]]:
        if len(self) > _CACHE:
            self.clear()
            self.rows = self.rows[:0]
        ids = [np.fromiter(map(self.__getitem__, toks), np.int64, len(toks)) for toks in ((t or "").lower().split() for t in texts)]
        self.settle()
        langs, out, score = self.model.langs, [], []
        for k in ids:
            total = self.rows[k].sum(axis=0) if len(k) else np.zeros(len(langs) + 1)
            if not langs or not total[-1]:
                out.append("und")
                score.append(0.0)
                continue
            ll = total[:-1] + self.model.prior
            p = np.exp(ll - ll.max())
            best = int(ll.argmax())
            out.append(langs[best])
            score.append(float(p[best] / p.sum()))
        return out, score


def predict(docs: DataFrame, model: Model, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """``docs`` with the predicted language and its posterior; no shuffle."""
    from pyspark.sql import types as T

    sent = docs.sparkSession.sparkContext.broadcast(model)
    base = docs.drop(lang_out, score_out)
    schema = T.StructType(base.schema.fields + [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from foldwise.llm.bpe import slices
        scorer = Scorer(sent.value)
        for b in batches:
            for part in slices(b, text):
                lang, score = scorer.predict(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], schema.names)

    return base.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id"):
    """Whether the document is kept out of the training: crc32 of the id's text
    leaves 0 when divided by 5 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
