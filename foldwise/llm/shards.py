"""Training-order materialisation of token ids in fixed-stride binary shards.

Every document is encoded (byte-level BPE), an end id follows it, and the
stream of each encoding task is cut into sequences of ``length`` ids; only
a task's last one is padded.  That pass writes the sequences with their
place in it, and the tasks' totals then number them from 0 on.  The
numbering is on disk before it is used, so a retried task or a resumed
run finds the same one.  A keyed Feistel permutation with cycle walking
maps each number to its slot in the training order, a bijection on
0 .. n-1 that needs no sort and no table.  Rows go to partitions by
ranges of slots, the only shuffle of the ids, and are written as binary
files of ``per_shard`` slots; a slot is one fixed stride: its length as
little-endian uint32, then ``length`` ids as little-endian uint16 (uint32
for larger vocabularies), padded with the end id.  A reader finds slot s
at byte ``(s mod per_shard) * stride`` of shard ``s div per_shard`` and
can resume at any slot.

A shard is written under a name of its attempt and renamed when it is
whole; a lost executor's shard is written again with the same bytes.  The
manifest is written last.

Defined cases: a null or empty text has no ids and no end id; repeated
rows, also of one id, are encoded one by one; an id may be null; with no
sequence there are no shards, only the manifest.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwise.llm import bpe
from foldwise.llm.common import scratch, sha256_hex, written

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Order:
    """Keyed permutation of 0 .. n-1: a Feistel network over the smallest even
    number of bits that holds n, walked until the value is below n."""

    def __init__(self, n: int, key: int, rounds: int = 6):
        self.n, self.half = n, max(1, (max(1, n - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * _ODD + np.array([key & (1 << 64) - 1], np.uint64))

    def _walk(self, x: np.ndarray, keys, back: bool) -> np.ndarray:
        h = np.uint64(self.half)
        left, right = x >> h, x & self.mask
        for k in keys:
            if back:
                left, right = right ^ (_mix(left + k) & self.mask), left
            else:
                left, right = right, left ^ (_mix(right + k) & self.mask)
        return left << h | right

    def _run(self, x, keys, back: bool) -> np.ndarray:
        x = np.asarray(x, np.uint64).copy()
        todo = np.arange(len(x))
        while len(todo):
            x[todo] = self._walk(x[todo], keys, back)
            todo = todo[x[todo] >= np.uint64(self.n)]
        return x.astype(np.int64)

    def slot(self, index) -> np.ndarray:
        return self._run(index, self.keys, False)

    def index(self, slot) -> np.ndarray:
        return self._run(slot, self.keys[::-1], True)


def _filesystem(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@lru_cache(maxsize=2)
def _tokenizer(path: str, pattern: str):
    """The public library's encoder, whose compiled merging suits plain encoding."""
    import tiktoken
    return tiktoken.Encoding("shards", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


#: characters without a break from which the linear encoder is used
_LONG = 5000


def _unbroken(text: str) -> bool:
    """Whether ``_LONG`` characters in a row are all white space or all not.  Such a
    run holds one of the blocks of half its length whole, and few blocks are of one
    kind: the runs are measured only then."""
    half = _LONG // 2
    if all(_SPACE.search(text, k, k + half) and _INK.search(text, k, k + half) for k in range(0, len(text) - half + 1, half)):
        return False
    return max(map(len, text.split()), default=_LONG) >= _LONG or max(map(len, _GAP.findall(text)), default=0) >= _LONG


def _ids(text: str | None, path: str, pattern: str) -> np.ndarray:
    if not text:
        return np.zeros(0, np.uint32)
    if len(text) > _LONG and _unbroken(text):
        return np.array(bpe.encoder(path, pattern).encode(text), np.uint32)
    return np.array(_tokenizer(path, pattern).encode_ordinary(text), np.uint32)


_GAP, _SPACE, _INK = re.compile(r"\s{64,}"), re.compile(r"\s"), re.compile(r"\S")


def _encoded(docs: DataFrame, length: int, kind: str, end: int, path: str, pattern: str) -> DataFrame:
    """(_part, _at, _ids, _docs): the sequences of every encoding task in order, each
    with the documents that start in it (id, place); written."""
    id_type = docs.schema["_id"].dataType.simpleString()
    shape = f"_part bigint, _at bigint, _ids binary, _docs array<struct<id:{id_type},place:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_id, at, rest, waiting, id_kind = TaskContext.get().partitionId(), 0, np.zeros(0, kind), [], None

        def rows(stream: np.ndarray, starts: list) -> pa.RecordBatch:
            """Sequences of the stream; ``starts`` has (id, offset) in order."""
            nonlocal at
            n = -(-len(stream) // length)
            ids = [stream[k * length:(k + 1) * length].tobytes() for k in range(n)]
            inside = [[] for _ in range(n)]
            for i, o in starts:
                inside[o // length].append({"id": i, "place": o % length})
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, part_id, np.int64)), pa.array(np.arange(at, at + n)), pa.array(ids, pa.binary()),
                 pa.array(inside, pa.list_(pa.struct([("id", id_kind), ("place", pa.int32())])))], ["_part", "_at", "_ids", "_docs"])
            at += n
            return out

        for b in batches:
            id_kind = b.schema.field("_id").type
            for part in bpe.slices(b, "_text"):
                pieces, size = [rest], len(rest)
                for i, t in zip(part.column("_id").to_pylist(), part.column("_text").to_pylist()):
                    ids = _ids(t, path, pattern)
                    if len(ids):
                        waiting.append((i, size))
                        pieces += [ids.astype(kind), np.array([end], kind)]
                        size += len(ids) + 1
                stream = np.concatenate(pieces)
                whole = size // length * length
                yield rows(stream[:whole], [x for x in waiting if x[1] < whole])
                rest, waiting = stream[whole:], [(i, o - whole) for i, o in waiting if o >= whole]
        if len(rest):
            yield rows(rest, waiting)

    return written(docs.mapInArrow(run, shape), "order-ids", compression="zstd")


def _numbered(encoded: DataFrame) -> DataFrame:
    """``encoded`` with ``_number``, the sequence's number.  One row per task that
    encoded is broadcast."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offset = (encoded.groupBy("_part").agg(F.count(F.lit(1)).alias("s"))
              .select("_part", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_off")))
    return encoded.join(F.broadcast(offset), "_part").withColumn("_number", F.col("_off") + F.col("_at"))


def materialise(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", length: int = 512,
                per_shard: int = 2048, key: int = 20240229, end: int = 50256, vocab: str | None = None, pattern: str | None = None) -> dict:
    """Write the shards below ``path`` (a new shared folder by default) and return
    the manifest, which is also written there as ``manifest.json``."""
    spark = docs.sparkSession
    path, vocab, pattern = path or scratch(spark, "shards"), vocab or bpe.default_path(), pattern or bpe.default_pattern()
    wide = 2 if max(end, *bpe.token_bytes(vocab)) < 1 << 16 else 4
    encoded = _encoded(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), length, "<u2" if wide == 2 else "<u4", end, vocab, pattern)
    n = encoded.count()
    manifest = {"path": path, "n_sequences": n, "length": length, "stride": 4 + wide * length, "id_bytes": wide, "per_shard": per_shard,
                "shards": -(-n // per_shard), "key": key, "end": end, "ids": encoded.inputFiles()[0].rsplit("/", 1)[0] if n else None}
    if n:
        _write(_numbered(encoded).select("_number", "_ids"), manifest)
    fs, root = _filesystem(path)
    fs.create_dir(root, recursive=True)
    with fs.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def documents_of(spark: SparkSession, manifest: dict, id_col: str = "doc_id") -> DataFrame:
    """(id, sequence, place) where every document with ids starts; its ids go on
    to the end id, over the sequences that follow by number."""
    rows = _numbered(spark.read.parquet(manifest["ids"])).select("_number", F.explode("_docs").alias("d"))
    return rows.select(F.col("d.id").alias(id_col), F.col("_number").alias("sequence"), F.col("d.place").alias("place"))


def _write(rows: DataFrame, manifest: dict) -> None:
    length, per_shard, stride, wide, end, path = (manifest[k] for k in ("length", "per_shard", "stride", "id_bytes", "end", "path"))
    order = Order(manifest["n_sequences"], manifest["key"])
    kind = "<u2" if wide == 2 else "<u4"

    def count(shard: int) -> int:
        return min(per_shard, manifest["n_sequences"] - shard * per_shard)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records as they will lie in the shards, those of a batch that go to one
        shard together and compressed."""
        for b in batches:
            slot, ids = order.slot(b.column("_number").to_numpy()), b.column("_ids").to_pylist()
            record = np.full((len(ids), 2 + length), end, kind) if wide == 2 else np.full((len(ids), 1 + length), end, kind)
            head = record.shape[1] - length
            size = np.array([len(x) // wide for x in ids], "<u4")
            record[:, :head] = size[:, None].view(kind).reshape(len(ids), head)
            for k in np.flatnonzero(size == length):
                record[k, head:] = np.frombuffer(ids[k], kind)
            for k in np.flatnonzero(size < length):
                record[k, head:head + size[k]] = np.frombuffer(ids[k], kind)
            shard = slot // per_shard
            by = np.argsort(shard, kind="stable")
            groups = np.split(by, np.flatnonzero(np.diff(shard[by])) + 1) if len(by) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(shard[g[0]]) for g in groups], pa.int64()), pa.array([slot[g].tobytes() for g in groups], pa.binary()),
                 pa.array([pa.compress(record[g].tobytes(), codec="zstd", asbytes=True) for g in groups], pa.binary())], ["shard", "slots", "records"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        fs.create_dir(root, recursive=True)
        shard, buffer, done = None, None, []

        def close():
            if (buffer[:, :4].copy().view("<u4") == 0).any():
                raise ValueError(f"shard {shard} lacks a slot")
            name = f"{root}/.shard-{shard:08d}-{uuid.uuid4().hex}"
            with fs.open_output_stream(name) as f:
                f.write(buffer.tobytes())
            fs.move(name, f"{root}/shard-{shard:08d}.bin")
            done.append(shard)

        for b in batches:
            for k, slots, data in zip(*(b.column(c).to_pylist() for c in ("shard", "slots", "records"))):
                if k != shard:
                    if shard is not None:
                        close()
                    shard, buffer = k, np.zeros((count(k), stride), np.uint8)
                at = np.frombuffer(slots, np.int64) - k * per_shard
                buffer[at] = np.frombuffer(pa.decompress(data, len(at) * stride, codec="zstd", asbytes=True), np.uint8).reshape(-1, stride)
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["shard"])
            done.clear()
        if shard is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.int64())], ["shard"])

    shards = manifest["shards"]
    parts = min(shards, max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = rows.mapInArrow(spread, "shard bigint, slots binary, records binary")
    written_ = (dealt.repartitionById(parts, F.floor(F.col("shard") * parts / shards).cast("int"))
                .sortWithinPartitions("shard").mapInArrow(write, "shard bigint"))
    n = written_.agg(F.countDistinct("shard")).first()[0]
    if n != shards:
        raise ValueError(f"{n} of {shards} shards were written")


def _records(manifest: dict, shard: int, lo: int, hi: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first slot, lengths, padded ids) of the slots lo .. hi-1 of a shard, some at a time."""
    per_shard, stride, kind = manifest["per_shard"], manifest["stride"], "<u2" if manifest["id_bytes"] == 2 else "<u4"
    fs, root = _filesystem(manifest["path"])
    with fs.open_input_file(f"{root}/shard-{shard:08d}.bin") as f:
        f.seek((lo - shard * per_shard) * stride)
        for at in range(lo, hi, 512):
            raw = np.frombuffer(f.read(min(512, hi - at) * stride), np.uint8).reshape(-1, stride)
            yield at, raw[:, :4].copy().view("<u4")[:, 0].astype(np.int64), raw[:, 4:].copy().view(kind)


def read_sequences(spark: SparkSession, manifest: dict, start: int = 0, stop: int | None = None) -> DataFrame:
    """(slot, ids) of the slots from ``start`` up to ``stop``, as a reader that
    resumes at ``start`` gets them; only the shards that hold them are read."""
    length, per_shard, n = (manifest[k] for k in ("length", "per_shard", "n_sequences"))
    stop = n if stop is None else min(stop, n)
    schema = "slot bigint, ids array<int>"
    if start >= stop:
        return spark.createDataFrame([], schema)
    first, last = start // per_shard, (stop - 1) // per_shard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column("id").to_pylist():
                for at, size, ids in _records(manifest, shard, max(start, shard * per_shard), min(stop, (shard + 1) * per_shard)):
                    flat = ids[np.arange(length)[None, :] < size[:, None]].astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(size))), lists], ["slot", "ids"])

    parts = min(last - first + 1, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(first, last + 1, 1, parts).mapInArrow(run, schema)


def report(spark: SparkSession, manifest: dict) -> DataFrame:
    """One row per slot, read back from the shards: ``slot``, ``sequence`` (its
    number before the permutation), ``shard``, ``offset`` (in bytes),
    ``n_tokens``, ``sha256`` (of the ids as they lie in the shard)."""
    per_shard, stride, n = (manifest[k] for k in ("per_shard", "stride", "n_sequences"))
    schema = "slot bigint, sequence bigint, shard bigint, offset bigint, n_tokens bigint, sha256 string"
    if not n:
        return spark.createDataFrame([], schema)
    order = Order(n, manifest["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b.column("id").to_pylist():
                for at, size, ids in _records(manifest, shard, shard * per_shard, min(n, (shard + 1) * per_shard)):
                    slots = at + np.arange(len(size))
                    sha = [sha256_hex(x[:k].tobytes()) for x, k in zip(ids, size)]
                    yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(order.index(slots)), pa.array(np.full(len(size), shard)),
                                                      pa.array((slots - shard * per_shard) * stride), pa.array(size), pa.array(sha)],
                                                     ["slot", "sequence", "shard", "offset", "n_tokens", "sha256"])

    parts = min(manifest["shards"], max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return spark.range(0, manifest["shards"], 1, parts).mapInArrow(run, schema)
