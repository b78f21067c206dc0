"""MinHash near-duplicates with BagMinHash signatures.

A document is the bag of its five-word shingles (white-space words, A-Z
lower-cased; all words are one shingle if there are fewer).  Its signature
has ``BANDS * ROWS`` components.  Every unit of a shingle's weight carries
a Poisson process of points in time, dealt to the components at random;
weights are discretised to whole units and the processes of [0, 1),
[1, 2), [2, 4), [4, 8) ... are generated one interval at a time, a point of the
last one counting only if it lies below the weight.  A component's value
is its earliest point, so two documents agree in it with the probability
of their weighted Jaccard similarity.  Processes stop once they are past
the time at which all components of the document have a point.

Documents that share a band are candidates.  They form families (connected
by bands; a bucket adds one link per member, not one per pair).  Within a
family all multiset overlaps are computed exactly, tile against tile, as
sparse products in a task; a task returns a spanning forest of the links
it found, never its pairs.  Links of similarity 0.8 or more make classes.

Exact copies (same words in the same order) are one node throughout.  A
pair of similarity 0.8 shares a band with probability 1 - 1e-4, one of
0.85 with 1 - 5e-8; whether candidates are linked is never estimated.

Defined cases: documents without words (null, empty) are a class each;
a class's id is its smallest document id (nulls aside; null if all are);
documents that share an id keep a row each; ties do not occur, as the
smallest id decides; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.bpe import slices
from foldwise.llm.common import with_key, written
from foldwise.llm.graph import components

SHINGLE, SIMILAR = 5, 0.8
ROWS, BANDS = 9, 64
#: members and bytes of text of a tile
TILE, TILE_BYTES = 128, 2 << 20
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2, _ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_CACHE = 400_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """Word -> its number, with the 64-bit hashes by number."""

    def __init__(self):
        super().__init__()
        self.hash, self.new = np.zeros(0, np.uint64), []

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        self.new.append(xxhash.xxh64_intdigest(word))
        return k

    def read(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in a row, and the number of words of each text."""
        if len(self) > _CACHE:
            self.clear()
            self.hash = self.hash[:0]
        ids, size = [], []
        for t in texts:
            w = t.encode().translate(_LOWER).split() if t else []
            ids.extend(map(self.__getitem__, w))
            size.append(len(w))
        if self.new:
            self.hash = np.concatenate([self.hash, np.array(self.new, np.uint64)])
            self.new = []
        return self.hash[np.fromiter(ids, np.int64, len(ids))], np.array(size, np.int64)


def bags(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle hash, weight) of all texts, by document, then hash."""
    n = len(words)
    h = np.zeros(n, np.uint64)
    start = np.cumsum(size) - size
    left = np.repeat(start + size, size) - np.arange(n)  # words from here to the text's end
    for k in range(SHINGLE):
        there = np.flatnonzero(left > k)
        h[there] = _mix(h[there] * _ODD + words[there + k] + np.uint64(k + 1))
    first = np.zeros(n, bool)
    first[start[size > 0]] = True
    at = np.flatnonzero((left >= SHINGLE) | (first & (left < SHINGLE)))
    doc = np.repeat(np.arange(len(size)), size)[at]
    h = h[at]
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])])) if len(h) else np.zeros(0, np.int64)
    return doc[new], h[new], np.diff(np.append(new, len(h)))


def signatures(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, docs: int, m: int = ROWS * BANDS) -> np.ndarray:
    """One row of ``m`` component values per document (0 for those without words)."""
    total = np.bincount(doc, weight, docs)
    value = np.zeros(docs * m, np.uint64)
    until = np.zeros(docs)
    has = total > 0
    until[has] = (np.log(m) + 6) / total[has]
    todo = np.flatnonzero(has)
    while len(todo):
        pick = np.isin(doc, todo) if len(todo) < has.sum() else slice(None)
        d, e, w = doc[pick], h[pick], weight[pick]
        best = np.full(docs * m, np.inf)
        low, wide, level = 0, 1, 0
        while len(d):
            state, t, who = _mix(e + np.array([level + 1], np.uint64) * _ODD), np.zeros(len(d)), np.arange(len(d))
            while len(who):
                state = _mix(state + _ODD)
                t = t - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / (m * wide)
                on = t <= until[d[who]]
                state, t, who = state[on], t[on], who[on]
                other = _mix(state ^ _M2)
                key = d[who] * m + ((other >> np.uint64(40)) % np.uint64(m)).astype(np.int64)
                if wide > 1 or level:
                    inside = low + (other & np.uint64(0xFFFFFF)).astype(np.float64) * (wide / 2.0 ** 24) < w[who]
                    k, tt, ss = key[inside], t[inside], state[inside]
                else:
                    k, tt, ss = key, t, state
                np.minimum.at(best, k, tt)
                won = best[k] == tt
                value[k[won]] = ss[won]
            low, wide, level = (1, 1, 1) if level == 0 else (low + wide, low + wide, level + 1)
            more = w > low
            d, e, w = d[more], e[more], w[more]
        short = ~np.isfinite(best.reshape(docs, m)).all(axis=1)
        todo = todo[short[todo]]
        until[todo] *= 2
    return value.reshape(docs, m)


def band_hashes(values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(values), BANDS), np.uint64)
    out += np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD
    for r in range(ROWS):
        out = _mix(out + values[:, r::ROWS][:, :BANDS])
    return out


def _signed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, _text, _key, _bands, _rid): one row per document; the key (16 bytes) is
    that of its word sequence, null without words."""
    frame = with_key(docs, id_col, text)
    schema = T.StructType(frame.schema.fields + [T.StructField("_key", T.BinaryType()), T.StructField("_bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Words()
        for b in batches:
            for part in slices(b, "_text", 6 << 20):
                words, size = seen.read(part.column("_text").to_pylist())
                doc, h, w = bags(words, size)
                bands = band_hashes(signatures(doc, h, w, len(size))).view(np.int64)
                end = np.cumsum(size)
                keys = [xxhash.xxh3_128_digest(words[e - n:e].tobytes()) if n else None for e, n in zip(end, size)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary()), lists], schema.names)

    return written(frame.mapInArrow(run, schema).withColumn("_rid", F.monotonically_increasing_id()), "neardup-signed")


def overlaps(entries: list[np.ndarray]) -> np.ndarray:
    """Sizes of the pairwise intersections of sets of hashes, as sparse products
    in blocks of columns."""
    n = len(entries)
    out = np.zeros((n, n), np.float32)
    row = np.repeat(np.arange(n), [len(e) for e in entries])
    values = np.concatenate(entries) if n else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    col = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]])) if len(values) else values
    many = np.bincount(col)[col] > 1 if len(values) else np.zeros(0, bool)
    row, col = row[many], col[many]
    col = np.cumsum(np.concatenate([[0], col[1:] != col[:-1]])) if len(col) else col
    wide = 2048
    for c in range(0, int(col[-1]) + 1 if len(col) else 0, wide):
        i, j = np.searchsorted(col, [c, c + wide])
        x = np.zeros((n, wide), np.float32)
        x[row[i:j], col[i:j] - c] = 1
        out += x @ x.T
    return out


def expanded(words: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """Every text's bag as a set: the k-th copy of a shingle has a hash of its own."""
    doc, h, w = bags(words, size)
    d, e = np.repeat(doc, w), np.repeat(h, w)
    nth = np.arange(len(e)) - np.repeat(np.cumsum(w) - w, w)
    e = _mix(e + nth.astype(np.uint64) * _ODD)
    return np.split(e, np.cumsum(np.bincount(d, minlength=len(size)))[:-1]) if len(size) else []


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links in a symmetric boolean matrix."""
    out, open_ = [], np.ones(len(linked), bool)
    for s in range(len(linked)):
        if open_[s]:
            open_[s] = False
            stack = [s]
            while stack:
                i = stack.pop()
                for j in np.flatnonzero(linked[i] & open_):
                    open_[j] = False
                    out.append((i, int(j)))
                    stack.append(int(j))
    return out


def similar(texts: list, words: Words | None = None) -> np.ndarray:
    """Matrix of the exact weighted Jaccard similarities of all pairs of texts
    (0 on the diagonal)."""
    sets = expanded(*(words if words is not None else Words()).read(texts))
    both, n = overlaps(sets).astype(np.float64), np.array([len(s) for s in sets], np.float64)
    np.fill_diagonal(both, 0)
    union = n[:, None] + n[None, :] - both
    return both / np.maximum(union, 1)


def _links(tiles: DataFrame) -> DataFrame:
    """(a, b) links from rows (g, i, j, t, node, text) that lie together by (g, i, j)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, key, rows = Words(), None, []

        def solve():
            tile = np.array([r[0] for r in rows])
            sim = similar([r[2] for r in rows], seen)
            linked = sim >= SIMILAR - 1e-12
            if key[1] != key[2]:  # within a tile another task has them
                linked &= tile[:, None] != tile[None, :]
            return [(rows[i][1], rows[j][1]) for i, j in forest(linked)]

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

        for b in batches:
            out = []
            for g, i, j, t, node, text in zip(*(b.column(c).to_pylist() for c in ("g", "i", "j", "t", "node", "text"))):
                if (g, i, j) != key:
                    if rows:
                        out += solve()
                    key, rows = (g, i, j), []
                rows.append((t, node, text))
            yield batch(out)
        if rows:
            yield batch(solve())

    return tiles.mapInArrow(run, "a bigint, b bigint")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``class_id``, and ``representative``: true for
    one document of each class (the smallest id; of rows that share it one)."""
    signed = _signed(docs, id_col, text)
    # of exact copies the row with the smallest id stands for all, of equal ids the first row
    first = F.struct(F.col("_id").isNull().alias("no"), F.col("_id").alias("id"), F.col("_rid").alias("node"))
    copies = written(signed.where("_key is not null").groupBy("_key").agg(F.min(first).alias("f"))
                     .select("_key", F.col("f.node").alias("node"), F.col("f.id").alias("least")), "neardup-copies")
    reps = signed.select(F.col("_rid").alias("node"), "_bands").join(copies.select("node"), "node")
    members = written(reps, "neardup-reps").select("node", F.explode("_bands").alias("band"))
    shared = members.groupBy("band").agg(F.min("node").alias("p"), F.max("node").alias("q")).where("p <> q").select("band", "p")
    near = members.join(shared, "band").where("node <> p").select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    family = components(near, "neardup-family")
    found = (family.join(signed.select(F.col("_rid").alias("node"), F.col("_text").alias("text")), "node")
             .select("node", F.col("root").alias("g"), "text"))
    found = written(found, "neardup-found")
    sizes = found.groupBy("g").agg(F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum(F.length("text")) / TILE_BYTES)).cast("int").alias("tiles"))
    dealt = found.join(sizes, "g").withColumn("t", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    tiles = (dealt.withColumn("u", F.explode(F.expr("sequence(0, tiles - 1)")))
             .select("g", F.least("t", "u").alias("i"), F.greatest("t", "u").alias("j"), "t", "node", "text"))
    links = _links(tiles.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j"))
    root = components(links, "neardup-class")
    least = copies.join(root, "node", "left").select("_key", "node", "least", F.coalesce("root", "node").alias("root"))
    head = least.groupBy("root").agg(F.min("least").alias("class_id"), F.min_by("node", F.struct(F.col("least").isNull(), "least", "node")).alias("first"))
    label = least.join(head, "root").select("_key", "class_id", F.when(F.col("first") == F.col("node"), F.col("node")).alias("_first"))
    out = signed.select("_id", "_key", "_rid").join(label, "_key", "left")
    return out.select(F.col("_id").alias(id_col), F.when(F.col("_key").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
                      (F.col("_key").isNull() | (F.coalesce(F.col("_first"), F.lit(-1)) == F.col("_rid"))).alias("representative"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without those that repeat another: of every class the row
    with the smallest id stays (of rows that share id and text, one)."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "neardup-rows")
    keep = classes(rows.select("_row", F.col(f"`{text}`").alias("_t"), F.col(f"`{id_col}`").alias("_i")).select(
        F.struct(F.col("_i").isNull().alias("no"), "_i", "_row").alias("_i"), "_t"), "_i", "_t").where("representative").select(F.col("_i._row").alias("_row"))
    return rows.join(keep, "_row", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


#: DuckDB text for the query's rows: exact links between all pairs, then classes
ORACLE = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x20\x09-\x0D]+') as ws from documents),
g as (select doc_id, array_to_string(ws[o : least(o + 4, len(ws))], ' ') as s from w, unnest(range(1, greatest(len(ws) - 4, least(len(ws), 1)) + 1)) as t(o)),
c as (select doc_id, s, count(*) as n from g group by doc_id, s),
z as (select doc_id, sum(n) as n from c group by doc_id),
i as (select a.doc_id as x, b.doc_id as y, sum(least(a.n, b.n)) as inter from c a join c b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (select x, y from i join z p on p.doc_id = x join z q on q.doc_id = y where inter >= 0.8 * (p.n + q.n - inter)),
r as (select doc_id as x, doc_id as y from documents union select r.x, l.y from r join l on l.x = r.y)
select x as doc_id, min(y) as class_id, x = min(y) as representative from r group by x
"""
