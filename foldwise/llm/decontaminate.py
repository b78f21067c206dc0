"""Benchmark decontamination with suffix arrays over the training texts.

Each Arrow batch of documents is one shard.  Its words become ids of the
benchmark's vocabulary (0: a word no item has), documents are joined with
a 0 between them, and a suffix array is built by prefix doubling to the
depth of the longest item.  Runs of known words shorter than the shortest
window cannot hold a match and get no entries.  Every suffix of every item
is then binary-searched: all places of its first ``window`` words are
found exactly, and the neighbours of its insertion point give its longest
verbatim match in the shard, with document and word offset.

No shuffle of documents: they stay where they are read.  The benchmark is
taken in blocks of at most ``block_bytes`` of text, each broadcast by itself,
and the documents pass through one search after the other; each adds to the
marks of the one before it.  The driver holds one block at a time, and after
``CHAIN`` blocks the marks are written down, so neither a task nor a plan
grows with the benchmark.  A block grows with its words, not with the square
of an item.

Equal windows of a block are searched once, whatever the number of items
that share them; a document's words are marked once per window, and items
are listed per document from its distinct windows.

Defined cases: a null or word-less text has no words and is clean; a null
or word-less item has no windows; a null item id counts as the empty
string; items that share an id are one item; repeated documents are each
judged alike; empty tables give empty results, and with an empty benchmark
every document is clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.common import with_key, written

#: bytes to words: A-Z become a-z, what is no word character becomes a blank
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text, A-Z lower-cased."""
    return text.encode().translate(_TABLE).split() if text else []


#: blocks that are searched one after the other before the marks are written
CHAIN = 4


class Block:
    """The suffixes of some benchmark items, ready to be searched for.

    ``first`` holds one suffix of every distinct window; ``of`` and ``at`` list
    the suffixes that begin with it (``of[at[w]:at[w + 1]]``)."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.names: list[str] = []
        seqs, owner = [], []
        for name, text in items:
            if seq := [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]:
                seqs.append(seq)
                owner.append(len(self.names))
                self.names.append(name)
        self.depth = max(map(len, seqs), default=0)
        self.least = min([window, *map(len, seqs)])
        # the words of all items once, and per suffix that begins a window: where it
        # begins there, its words, the window's length, the item, the word offset in it
        length = np.array([len(s) for s in seqs], np.int64)
        self.ids = np.fromiter((i for s in seqs for i in s), np.int32, int(length.sum()))
        n = np.maximum(1, length - window + 1)
        of = np.repeat(np.arange(len(seqs)), n)
        self.offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        self.begin = (np.cumsum(length) - length)[of] + self.offset
        self.full = length[of] - self.offset
        self.size = np.minimum(window, length)[of]
        self.item = np.array(owner, np.int64)[of]
        group = self._group(window)
        self.of = np.argsort(group, kind="stable")
        self.at = np.flatnonzero(np.diff(np.concatenate([[-1], group[self.of], [-1]])))
        self.first = self.of[self.at[:-1]]

    def _group(self, window: int) -> np.ndarray:
        """Number of each suffix's window among the distinct ones, word by word."""
        group = self.size.copy()
        for d in range(min(window, self.depth)):
            inside = d < self.size
            word = np.where(inside, self.ids[np.where(inside, self.begin + d, 0)], 0)
            group = np.unique(group * (len(self.vocab) + 1) + word, return_inverse=True)[1]
        return group

    @property
    def query(self) -> Iterator[np.ndarray]:
        """The words of every suffix."""
        return (self.ids[b:b + f] for b, f in zip(self.begin, self.full))


def suffix_array(a: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``a`` in the order of what starts there, compared over
    ``depth`` entries (0 beyond the end); prefix doubling."""
    n = len(a)
    rank = a.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    done = 1
    while done < depth:
        after = np.zeros(n, np.int64)
        after[:n - done] = rank[done:] + 1
        key = rank * (int(after.max(initial=0)) + 1) + after
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], sorted_key[1:] != sorted_key[:-1]]))
        done *= 2
        if n and rank[order[-1]] == n - 1:
            break
    return order


def _compare(a: np.ndarray, at: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign of (``a`` from ``at`` on) - (``ids`` from ``begin`` on) over ``size``
    entries each, and the number of leading entries that agree."""
    sign, same = np.zeros(len(at), np.int8), np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    for d in range(int(size.max(initial=0))):
        live = live[size[live] > d]
        if not len(live):
            break
        pos = at[live] + d
        have = np.where(pos < len(a), a[np.minimum(pos, len(a) - 1)], 0)
        want = ids[begin[live] + d]
        sign[live] = np.sign(have - want)
        live = live[have == want]
        same[live] += 1
    return sign, same


def search(a: np.ndarray, order: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray, upper: bool) -> np.ndarray:
    """First place in ``order`` whose suffix is not below (``upper``: is above)
    the first ``size`` words of each query."""
    lo, hi = np.zeros(len(begin), np.int64), np.full(len(begin), len(order), np.int64)
    while len(open_ := np.flatnonzero(lo < hi)):
        mid = (lo[open_] + hi[open_]) // 2
        sign, _ = _compare(a, order[mid], ids, begin[open_], size[open_])
        below = sign <= 0 if upper else sign < 0
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]
    return lo


class Shard:
    """Some documents as ids of a block's vocabulary, with their suffix array."""

    def __init__(self, texts: list, block: Block):
        get = block.vocab.get
        self.starts, ids = [], []
        for t in texts:
            self.starts.append(len(ids))
            ids.extend([get(w, 0) for w in words_of(t)])
            ids.append(0)
        self.starts = np.array(self.starts, np.int64)
        self.words = np.diff(np.append(self.starts, len(ids))) - 1
        self.length = len(ids)
        full = np.array(ids, np.int32)
        # keep the runs of known words that are long enough, a 0 after each
        edge = np.flatnonzero(np.diff(np.concatenate([[0], (full != 0).astype(np.int8), [0]])))
        begin, end = edge[::2], edge[1::2]
        long = end - begin >= max(1, block.least)
        begin, end = begin[long], end[long]
        sizes = end - begin + 1
        base = np.cumsum(sizes) - sizes
        self.place = np.arange(int(sizes.sum())) + np.repeat(begin - base, sizes)
        self.a = full[self.place] if len(self.place) else np.zeros(0, np.int32)
        self.order = suffix_array(self.a, block.depth)

    def doc_of(self, place: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, place, side="right") - 1

    def occurrences(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, window) of every occurrence of every distinct window, and
        no more: items that share a window do not multiply it."""
        begin, size = block.begin[block.first], block.size[block.first]
        lo = search(self.a, self.order, block.ids, begin, size, False)
        hi = search(self.a, self.order, block.ids, begin, size, True)
        n = hi - lo
        q = np.repeat(np.arange(len(n)), n)
        at = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
        return self.place[self.order[at]], size[q], q

    def windows(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, length, item) of every occurrence of every item's windows."""
        place, size, w = self.occurrences(block)
        n = np.diff(block.at)[w]
        suffix = block.of[np.arange(int(n.sum())) + np.repeat(block.at[w] - (np.cumsum(n) - n), n)]
        return np.repeat(place, n), np.repeat(size, n), block.item[suffix]

    def matches(self, block: Block, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, ...]]:
        """(item, its word offset, length, place) of every verbatim match of at least
        a window that can be extended to neither side, some places at a time:
        occurrences of an item's next windows at the next places are one match."""
        place, _, w = self.occurrences(block)
        order = np.argsort(place, kind="stable")
        place, w = place[order], w[order]
        n = np.diff(block.at)[w]
        total = np.cumsum(n)
        # no match reaches over a place where no window begins
        ends = np.append(np.flatnonzero(np.diff(place) > 1) + 1, len(place))
        i = 0
        while i < len(place):
            j = max(int(np.searchsorted(total, total[i] + most)), i + 1)
            j = int(ends[np.searchsorted(ends, j)])
            k, m = w[i:j], n[i:j]
            suffix = block.of[np.arange(int(m.sum())) + np.repeat(block.at[k] - (np.cumsum(m) - m), m)]
            at, size = np.repeat(place[i:j], m), block.size[suffix]
            item, start = block.begin[suffix] - block.offset[suffix], block.offset[suffix]
            by = np.lexsort((at, at - start, item))
            at, size, item, start, suffix = at[by], size[by], item[by], start[by], suffix[by]
            new = np.concatenate([[True], (item[1:] != item[:-1]) | (at[1:] - start[1:] != at[:-1] - start[:-1]) | (at[1:] != at[:-1] + 1)])
            run = np.flatnonzero(new)
            yield block.item[suffix[run]], start[run], size[run] + np.diff(np.append(run, len(at))) - 1, at[run]
            i = j

    def longest(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(length, place) of the longest verbatim match of every query suffix."""
        full = block.full
        at = search(self.a, self.order, block.ids, block.begin, full, False)
        best, place = np.zeros(len(full), np.int64), np.zeros(len(full), np.int64)
        for step in (0, -1):
            k = np.flatnonzero((at + step >= 0) & (at + step < len(self.order)))
            pos = self.order[at[k] + step]
            _, same = _compare(self.a, pos, block.ids, block.begin[k], full[k])
            more = same > best[k]
            best[k[more]], place[k[more]] = same[more], self.place[pos[more]]
        return best, place


def blocks(benchmark: DataFrame, window: int, item_id: str, text: str, block_bytes: int) -> Iterator[Block]:
    """The benchmark as search blocks, one at a time in the driver."""
    rows = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("i"), F.col(f"`{text}`").alias("t"))
    part, size = [], 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        n = len((r.t or "").encode())
        if part and size + n > block_bytes:
            yield Block(part, window)
            part, size = [], 0
        part.append((r.i, r.t))
        size += n
    if part:
        yield Block(part, window)


def _batches(batches, most: int = 16 << 20):
    from foldwise.llm.bpe import slices
    for b in batches:
        yield from slices(b, "_text", most)


def _marked(frame: DataFrame, blocks_: Iterator[Block]) -> DataFrame:
    """``frame`` (with ``_text``) after a search for every block, one after the
    other: ``_hits``, the bits of the hit words (null: none), ``_items``."""
    spark = frame.sparkSession
    frame = frame.withColumn("_hits", F.lit(None).cast("binary")).withColumn("_items", F.lit(None).cast("array<string>"))

    def mark(sent):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = sent.value
            every = max(1, len(block.first))
            for b in _batches(parts):
                shard = Shard(b.column("_text").to_pylist(), block)
                place, size, window = shard.occurrences(block)
                cover = np.zeros(shard.length + 1, np.int64)
                np.add.at(cover, place, 1)
                np.add.at(cover, place + size, -1)
                hit = np.cumsum(cover) > 0
                pairs = np.unique(shard.doc_of(place) * every + window)
                doc = pairs // every
                edge = np.flatnonzero(np.diff(np.concatenate([[-1], doc, [-1]]))) if len(doc) else np.zeros(1, np.int64)
                found: dict[int, set] = {}
                for x, y in zip(edge[:-1], edge[1:]):
                    mine = [block.item[block.of[block.at[k]:block.at[k + 1]]] for k in pairs[x:y] % every]
                    found[int(doc[x])] = {block.names[i] for i in np.unique(np.concatenate(mine))}
                hits, items = b.column("_hits").to_pylist(), b.column("_items").to_pylist()
                for d, got in found.items():
                    s = shard.starts[d]
                    bits = np.packbits(hit[s:s + shard.words[d]])
                    if hits[d] is not None:
                        bits |= np.frombuffer(hits[d], np.uint8)
                    hits[d], items[d] = bits.tobytes(), sorted(got | set(items[d] or ()))
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], pa.array(hits, pa.binary()), pa.array(items, pa.list_(pa.string()))], b.schema.names)
        return run

    for k, block in enumerate(blocks_):
        if k and k % CHAIN == 0:
            frame = written(frame, "benchmark-marks")
        frame = frame.mapInArrow(mark(spark.sparkContext.broadcast(block)), frame.schema)
    return frame


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text: str = "text", item_id: str = "item_id", item_text: str = "text",
                  block_bytes: int = 16 << 20) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (sorted distinct ids of the items with
    occurring windows), ``contaminated``."""
    frame = _marked(with_key(docs, id_col, text), blocks(benchmark, window, item_id, item_text, block_bytes))

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _batches(parts):
            n_words = [len(words_of(t)) for t in b.column("_text").to_pylist()]
            hits = b.column("_hits").to_pylist()
            n_hit = [0 if h is None else int(np.unpackbits(np.frombuffer(h, np.uint8)).sum()) for h in hits]
            items = [x or [] for x in b.column("_items").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string()))],
                ["_id", "n_words", "n_hit", "items"])

    id_type = frame.schema["_id"].dataType.simpleString()
    out = frame.mapInArrow(count, f"_id {id_type}, n_words bigint, n_hit bigint, items array<string>")
    return out.select(F.col("_id").alias(id_col), "n_words", "n_hit", "items", (F.col("n_hit") > 0).alias("contaminated"))


def _found(frame: DataFrame, blocks_: Iterator[Block], find, schema: str) -> DataFrame:
    """What ``find`` returns for every block, together."""
    spark, out = frame.sparkSession, None
    for k, block in enumerate(blocks_):
        part = frame.mapInArrow(find(spark.sparkContext.broadcast(block)), schema)
        out = part if out is None else out.unionByName(part)
        if k % CHAIN == CHAIN - 1:
            out = written(out, "benchmark-matches")
    return spark.createDataFrame([], schema) if out is None else out


def matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
            text: str = "text", item_id: str = "item_id", item_text: str = "text",
            block_bytes: int = 16 << 20) -> DataFrame:
    """Every verbatim match of at least a window (or a whole shorter item) that can
    be extended to neither side: ``item_id``, ``item_word`` (offset in the item),
    ``length`` in words, the document's id, ``doc_word``.  Items with one id are
    listed by themselves; repeated documents and items have rows of their own."""
    frame = with_key(docs, id_col, text)
    id_type = frame.schema["_id"].dataType.simpleString()
    schema = f"item_id string, item_word bigint, length bigint, _id {id_type}, doc_word bigint"

    def find(sent):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for b in _batches(parts):
                shard = Shard(b.column("_text").to_pylist(), block)
                for item, start, length, place in shard.matches(block):
                    doc = shard.doc_of(place)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block.names[i] for i in item], pa.string()), pa.array(start), pa.array(length),
                         b.column("_id").take(pa.array(doc)), pa.array(place - shard.starts[doc])],
                        ["item_id", "item_word", "length", "_id", "doc_word"])
        return run

    found = _found(frame, blocks(benchmark, window, item_id, item_text, block_bytes), find, schema)
    return found.select("item_id", "item_word", "length", F.col("_id").alias(id_col), "doc_word")


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
                    text: str = "text", item_id: str = "item_id", item_text: str = "text",
                    block_bytes: int = 16 << 20) -> DataFrame:
    """For every item suffix that begins a window: the longest verbatim match of
    at least a window in each document shard, the longest over all of them kept
    (``item_id``, ``item_word``, ``length``, the document's id, ``doc_word``); ties
    go to the smallest id, then offset, among the shards' candidates.  Suffixes
    without a match of that length have no row."""
    frame = with_key(docs, id_col, text)
    id_type = frame.schema["_id"].dataType.simpleString()
    schema = f"item_id string, item_word bigint, length bigint, _id {id_type}, doc_word bigint"

    def find(sent):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = sent.value
            for b in _batches(parts):
                shard = Shard(b.column("_text").to_pylist(), block)
                length, place = shard.longest(block)
                k = np.flatnonzero(length >= block.size)
                doc = shard.doc_of(place[k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block.names[i] for i in block.item[k]], pa.string()), pa.array(block.offset[k]), pa.array(length[k]),
                     b.column("_id").take(pa.array(doc)), pa.array(place[k] - shard.starts[doc] if len(k) else np.zeros(0, np.int64))],
                    ["item_id", "item_word", "length", "_id", "doc_word"])
        return run

    found = _found(frame, blocks(benchmark, window, item_id, item_text, block_bytes), find, schema)
    best = F.min(F.struct((-F.col("length")).alias("l"), "_id", "doc_word"))
    return (found.groupBy("item_id", "item_word").agg(best.alias("b"))
            .select("item_id", "item_word", (-F.col("b.l")).alias("length"), F.col("b._id").alias(id_col), F.col("b.doc_word").alias("doc_word")))


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id",
                        item_text: str = "text", block_bytes: int = 16 << 20) -> DataFrame:
    """The documents without any hit, all their columns; each row by itself, in
    the same pass, so there is no join."""
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text}`").alias("_text"))
    marked = _marked(frame, blocks(benchmark, window, item_id, item_text, block_bytes))
    return marked.where("_hits is null").select("_row.*")


def digests() -> list:
    return [F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256")]


#: DuckDB text for the query's rows
ORACLE = r"""
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
b as (select coalesce(cast(item_id as varchar), '') as item_id, ws from
      (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from benchmark) where len(ws) > 0),
win as (select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[o : o + least(len(ws), 10) - 1], ' ') as g
        from b, unnest(range(1, greatest(1, len(ws) - 9) + 1)) as t(o)),
sizes as (select distinct n from win),
g as (select doc_id, o, n, array_to_string(ws[o : o + n - 1], ' ') as g from w, sizes, unnest(range(1, len(ws) - n + 2)) as t(o)),
hit as (select g.doc_id, g.o, g.n, win.item_id from g join win using (g, n)),
pos as (select distinct doc_id, unnest(range(o, o + n)) as p from hit),
h as (select doc_id, count(*) as n_hit from pos group by doc_id),
i as (select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items from (select distinct doc_id, item_id from hit) group by doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from w left join h using (doc_id) left join i using (doc_id)
"""
