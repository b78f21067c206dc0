"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line with its line break.  It is cut into pieces where a
rolling hash of the last ``WINDOW`` bytes hits a mask, so a piece's borders
follow from the bytes around them and an edit moves only the borders near
it.  A section ends with a blank line, or with a paragraph whose own bytes
hash to a multiple of ``SECTION``.  Every node's digest is a hash of its
children's digests, the root's of all.

The fingerprint is the tree as text::

    root;piece,piece|piece;piece|...       ; sections  | paragraphs  , pieces

with root and pieces as ``digest:code points``.  Equal texts have equal roots;
for others only branches that differ are opened: ``likeness`` is the share
of code points in pieces that both have, ``changes`` the spans that differ.

Null texts are empty texts; the empty text has a root and no sections.
Columns other than id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import sha256_hex, with_key, written

#: bytes that a cut looks at, and the least length of a piece that it ends
WINDOW = 16
#: a position in so many is a cut
PIECE = 64
#: no piece is longer (runs of one character have no cuts of their own)
LONGEST = 1024
#: a paragraph in so many ends its section
SECTION = 16

_GEAR = np.random.default_rng(20240501).integers(0, 2 ** 32, 256, dtype=np.uint64).astype(np.uint32)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _rolling(b: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW bytes at every position, by doubling."""
    h, reach = _GEAR[b], 1
    while reach < WINDOW:
        more = h.copy()
        more[reach:] += h[:-reach] << np.uint32(reach)
        h, reach = more, 2 * reach
    return h


def pieces(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the pieces, their lengths in code points, and which of them
    end a paragraph."""
    b = np.frombuffer(data, np.uint8)
    starts_char = (b & 0xC0) != 0x80
    ends = np.append(np.flatnonzero(b == 10) + 1, len(b))
    if len(ends) > 1 and ends[-2] == len(b):
        ends = ends[:-1]
    cut = np.flatnonzero(_rolling(b) < 2 ** 32 // PIECE) + 1
    cut = cut[cut < len(b)]
    cut = cut[starts_char[cut]]
    place = np.searchsorted(ends, cut, "left")
    begin = np.append(0, ends[:-1])[place]
    cut = cut[(cut - begin >= WINDOW) & (cut < ends[place])]
    every = np.union1d(cut, ends)
    gaps = np.diff(every, prepend=0)
    if (gaps > LONGEST).any():
        more = [p for e, g in zip(every[gaps > LONGEST], gaps[gaps > LONGEST]) for p in range(int(e - g) + LONGEST, int(e), LONGEST)]
        more = np.array(more)
        while len(low := np.flatnonzero(~starts_char[more])):
            more[low] -= 1
        every = np.union1d(every, more)
    chars = np.append(0, np.cumsum(starts_char))[every]
    return every, np.diff(chars, prepend=0), np.isin(every, ends, assume_unique=True)


def fingerprint(text: str | None) -> str:
    """The tree of one text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    sections, paragraphs, shown, nodes, upper, top = [], [], [], [], [], []
    if data:
        at = 0
        for end, chars, last in zip(*(x.tolist() for x in pieces(data))):
            node = _digest(data[at:end])
            nodes.append(node)
            shown.append(f"{node.hex()[:12]}:{chars}")
            at = end
            if last:
                node = _digest(b"p" + b"".join(nodes))
                upper.append(node)
                paragraphs.append(",".join(shown))
                blank, shown, nodes = len(shown) == 1 and chars == 1 and data[end - 1] == 10, [], []
                if blank or node[0] % SECTION == 0:
                    top.append(_digest(b"s" + b"".join(upper)))
                    sections.append("|".join(paragraphs))
                    upper, paragraphs = [], []
        if paragraphs:
            top.append(_digest(b"s" + b"".join(upper)))
            sections.append("|".join(paragraphs))
    return ";".join([f"{_digest(b'r' + b''.join(top)).hex()}:{len(text)}", *sections])


def _weight(branch: str) -> int:
    return sum(int(p[p.index(":") + 1:]) for p in branch.replace(";", ",").replace("|", ",").split(",")) if branch else 0


def _less(branches: list[str], taken: Counter) -> list[str]:
    """``branches`` without those that were matched."""
    taken, rest = dict(taken), []
    for s in branches:
        if taken.get(s, 0):
            taken[s] -= 1
        else:
            rest.append(s)
    return rest


def likeness(a: str, b: str) -> float:
    """Share of code points in common pieces (0 to 1), repeated pieces counted
    as often as both have them; 1 exactly if the roots are equal."""
    (ra, _, ta), (rb, _, tb) = a.partition(";"), b.partition(";")
    if ra == rb:
        return 1.0
    if not ta or not tb:
        return 0.0
    total = _weight(ra) + _weight(rb)
    common, left, right = 0, [ta], [tb]
    for mark in ";|,":
        left, right = [p for s in left for p in s.split(mark)], [p for s in right for p in s.split(mark)]
        if both := set(left).intersection(right):
            x, y = Counter(s for s in left if s in both), Counter(s for s in right if s in both)
            same = x & y
            common += sum(n * _weight(p) for p, n in same.items())
            left, right = _less(left, same), _less(right, same)
    return min(2 * common / total, 1 - 2.0 ** -53)


def _gaps(a: list[str], b: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of ``a`` and ``b`` between branches that both have: equal ends
    first, then branches found once in each, in the longest common order."""
    lo = 0
    while lo < min(len(a), len(b)) and a[lo] == b[lo]:
        lo += 1
    hi = 0
    while hi < min(len(a), len(b)) - lo and a[-1 - hi] == b[-1 - hi]:
        hi += 1
    ia, jb = len(a) - hi, len(b) - hi
    once_a, once_b = Counter(a[lo:ia]), Counter(b[lo:jb])
    where = {s: j for j, s in enumerate(b[lo:jb], lo) if once_b[s] == 1}
    tails, chain, back = [], [], {}
    for i in range(lo, ia):
        j = where.get(a[i]) if once_a[a[i]] == 1 else None
        if j is None:
            continue
        k = bisect_left(tails, j)
        back[j] = (i, chain[k - 1] if k else None)
        tails[k:k + 1], chain[k:k + 1] = [j], [j]
    anchors, j = [(ia, jb)], chain[-1] if chain else None
    while j is not None:
        anchors.append((back[j][0], j))
        j = back[j][1]
    i0, j0 = lo, lo
    for i, j in reversed(anchors):
        if i > i0 or j > j0:
            yield i0, i, j0, j
        i0, j0 = i + 1, j + 1


def changes(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Spans (code points, end exclusive) of the first text and of the second
    that differ, found by opening only branches that differ."""
    (ra, _, ta), (rb, _, tb) = a.partition(";"), b.partition(";")
    if ra == rb:
        return []

    def opened(x: str, y: str, x0: int, y0: int, marks: str):
        p, q = x.split(marks[0]) if x else [], y.split(marks[0]) if y else []
        px, qy = [x0], [y0]
        for s in p:
            px.append(px[-1] + _weight(s))
        for s in q:
            qy.append(qy[-1] + _weight(s))
        for i0, i1, j0, j1 in _gaps(p, q):
            if len(marks) > 1 and i0 < i1 and j0 < j1:
                yield from opened(marks[1].join(p[i0:i1]), marks[1].join(q[j0:j1]), px[i0], qy[j0], marks[1:])
            else:
                yield px[i0], px[i1], qy[j0], qy[j1]

    return list(opened(ta, tb, 0, 0, ";|,"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, fingerprint)`` of every document; rows stay where they are."""
    keyed = with_key(docs, id_col, text_col)
    schema = T.StructType([keyed.schema["_id"], T.StructField("n_chars", T.LongType()), T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(map(len, texts), pa.int64()), pa.array(map(fingerprint, texts), pa.string())],
                                             ["_id", "n_chars", "fingerprint"])

    return keyed.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


_RESULT = [("n_chars", T.LongType(), pa.int64()), ("edited_sha256", T.StringType(), pa.string()), ("fingerprint", T.StringType(), pa.string()),
           ("edited_fingerprint", T.StringType(), pa.string()), ("near_edited", T.DoubleType(), pa.float64()), ("near_next", T.DoubleType(), pa.float64())]


def _edit(text: str, tree: str, after: str, next_tree: str) -> tuple:
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    edited_tree = fingerprint(edited)
    return len(text), sha256_hex(edited.encode("utf-8", "surrogatepass")), tree, edited_tree, likeness(tree, edited_tree), likeness(tree, next_tree)


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's fingerprint, that of its edited text (the last half of
    its code points replaced by the first as many of the next document's) and
    both likenesses.  Next is ascending id, nulls first, repeated ids by a hash
    of their text, and after the last the first.

    Rows are dealt by ranges of the id and read in order, one text held beside
    the current one.  What crosses a border between ranges (the first and the
    last text of each) meets in a join of two rows a range.
    """
    order = [F.col("_id").asc_nulls_first(), F.col("_h")]
    keyed = with_key(docs, id_col, text_col).withColumn("_text", F.coalesce("_text", F.lit(""))).withColumn("_h", F.xxhash64("_text"))
    id_field = keyed.schema["_id"]
    schema = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("_kind", T.IntegerType()), id_field, T.StructField("_text", T.StringType()),
                           *[T.StructField(n, t) for n, t, _ in _RESULT]])
    none = (None,) * len(_RESULT)

    def run(batches):
        from pyspark import TaskContext
        part, held = TaskContext.get().partitionId(), None
        for b in batches:
            out = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tree = fingerprint(text)
                out.append((part, 1, key, text, *none) if held is None else (part, 0, held[0], None, *_edit(held[1], held[2], text, tree)))
                held = (key, text, tree)
            yield _batch(out, b.schema.field(0).type)
        if held is not None:
            yield _batch([(part, 2, held[0], held[1], *none)], id_type)

    id_type = _arrow_type(id_field.dataType)
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order, "_text").select("_id", "_text")
    # both trees of a document share branches: stored side by side, they compress as one
    found = ordered.mapInArrow(run, schema).withColumn("_both", F.concat_ws("\n", "fingerprint", "edited_fingerprint")).drop("fingerprint", "edited_fingerprint")
    rows = written(found, "fingerprints", "zstd")
    rows = (rows.withColumn("fingerprint", F.when(F.col("_kind") == 0, F.substring_index("_both", "\n", 1)))
            .withColumn("edited_fingerprint", F.when(F.col("_kind") == 0, F.substring_index("_both", "\n", -1))))
    # part numbers only, bounded by the tasks of one stage
    parts = sorted(r[0] for r in rows.where("_kind = 1").select("_part").collect())
    follow = docs.sparkSession.createDataFrame([(p, parts[(k + 1) % len(parts)]) for k, p in enumerate(parts)], "_part int, _next int")
    first = rows.where("_kind = 1").select(F.col("_part").alias("_next"), F.col("_text").alias("_after"))
    border = rows.where("_kind = 2").select("_part", "_id", "_text").join(follow, "_part").join(first, "_next").select("_id", "_text", "_after")
    result = T.StructType([id_field, *[T.StructField(n, t) for n, t, _ in _RESULT]])

    def meet(batches):
        for b in batches:
            out = [_edit(t, fingerprint(t), a, fingerprint(a)) for t, a in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in out], t) for k, (_, _, t) in enumerate(_RESULT)]],
                                             ["_id", *[n for n, _, _ in _RESULT]])

    inner = rows.where("_kind = 0").select("_id", *[n for n, _, _ in _RESULT])
    return inner.unionByName(border.mapInArrow(meet, result)).withColumnRenamed("_id", id_col)


def _arrow_type(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(t)


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), id_type, pa.string(), *[t for _, _, t in _RESULT]]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      ["_part", "_kind", "_id", "_text", *[n for n, _, _ in _RESULT]])
