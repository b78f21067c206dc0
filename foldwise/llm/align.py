"""Alignment of two tokenizers' ids over the same bytes.

Every text is encoded by a byte-level tokenizer (A) and a piece tokenizer
(B).  A place where a token of A and a token of B both end closes a group
and links those two tokens.  Groups are found by diagonal run skipping on
the two arrays of token ends: as long as the arrays agree at the present
shift between their indexes, blocks that double in size are compared as
bytes and jumped; at the first difference the two arrays are walked until
they meet again, which closes an irregular group and sets the next shift.

Linked tokens end together, so the bytes of one are a suffix of the other's.
The number of id pairs that can ever be linked is therefore bounded by the
vocabularies (``Vocabularies.pair_bound``; some hundred thousand), whatever
the corpus: the corpus-wide counts of linked pairs are the one table that is
broadcast.

Texts that are null or empty, or whose tokens of either side do not spell a
space followed by the text, have no tokens.  Rows are independent: repeated
rows give repeated results, an empty table an empty one.  Columns other than
id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import base64
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.llm.common import sha256_hex, with_key, written

#: vocabulary files by the name that ``public_tokenizers.path`` knows (or a path).
#: A's ranks hold the vocabulary of ``byte_bpe_50k.json``; the ids are the same
#: (tests compare both libraries on every code point)
A_FILE, B_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: bits of B's ids in the number of a pair
SHIFT = 15
#: wide groups whose texts are kept
CACHE = 1 << 18


def _path(name: str) -> str:
    import public_tokenizers
    return name if "/" in name else public_tokenizers.path(name)


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: str = A_FILE, b_file: str = B_FILE):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        with open(_path(a_file), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self._a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=_path(b_file))
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.a_bytes[rank] = token
        n = self._b.get_piece_size()
        if n > 1 << SHIFT or len(self.a_bytes) > 1 << 31 - SHIFT:
            raise ValueError("a vocabulary is too large for the number of a pair")
        pieces = [self._b.id_to_piece(i) for i in range(n)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self._a_sizes = [len(t) for t in self.a_bytes]
        self.a_length, self.b_length = (np.array([len(t) for t in side], np.int64) for side in (self.a_bytes, self.b_bytes))

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both sides, or none where the text has no tokens."""
        if not text:
            return [], []
        data = " " + text
        a, b = self._a.encode_ordinary(data), self._b.encode(text)
        data = data.encode()
        # A's ids stand for the text's own bytes, so their length decides
        if sum(map(self._a_sizes.__getitem__, a)) != len(data) or b"".join(map(self.b_bytes.__getitem__, b)) != data:
            return [], []
        return a, b

    def pair_bound(self) -> int:
        """How many pairs have one token's bytes as a suffix of the other's."""
        total, sides = 0, (self.a_bytes, self.b_bytes)
        for one, other, first in ((*sides, 0), (*reversed(sides), 1)):
            count = Counter(other)
            # equal bytes are counted from one side only
            total += sum(count[t[k:]] for t in one for k in range(first, len(t)))
        return total


@lru_cache(maxsize=2)
def vocabularies(a_file: str = A_FILE, b_file: str = B_FILE) -> Vocabularies:
    return Vocabularies(a_file, b_file)


def common_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes in both arrays (rising, without repeats) of the values in both."""
    ends_a, ends_b = np.ascontiguousarray(ends_a, np.int64), np.ascontiguousarray(ends_b, np.int64)
    raw_a, raw_b, a, b = ends_a.tobytes(), ends_b.tobytes(), ends_a.tolist(), ends_b.tolist()
    n, m, i, j = len(a), len(b), 0, 0
    starts, shifts, lengths = [], [], []
    while i < n and j < m:
        begin, step, longest = i, 1, min(n - i, m - j) + i
        growing = True
        while step:
            if i + step <= longest and raw_a[8 * i:8 * (i + step)] == raw_b[8 * j:8 * (j + step)]:
                i, j = i + step, j + step
                step = 2 * step if growing else step // 2
            elif step <= 32:
                # the first difference is at most 32 ends away
                while i < longest and a[i] == b[j]:
                    i, j = i + 1, j + 1
                break
            else:
                growing, step = False, step // 2
        if i > begin:
            starts.append(begin)
            shifts.append(j - i)
            lengths.append(i - begin)
        if i == n or j == m:
            break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                if i == n:
                    break
                x = a[i]
            else:
                j += 1
                if j == m:
                    break
                y = b[j]
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.array(lengths)
    at = np.arange(size.sum()) + np.repeat(np.array(starts) - np.append(0, np.cumsum(size)[:-1]), size)
    return at, at + np.repeat(np.array(shifts), size)


class Alignment:
    """Ids of both sides and, per link, the index of its token in each; the
    tokens after one link up to the next one form that one's group."""

    def __init__(self, a: list[int], b: list[int], vocab: Vocabularies):
        self.a, self.b = a, b
        self.ids_a, self.ids_b = np.array(a, np.int64), np.array(b, np.int64)
        self.link_a, self.link_b = common_ends(np.cumsum(vocab.a_length[self.ids_a]), np.cumsum(vocab.b_length[self.ids_b]))

    def pairs(self) -> np.ndarray:
        """The id pair of every link as one number."""
        return self.ids_a[self.link_a] << SHIFT | self.ids_b[self.link_b]

    def groups_text(self, shown: _PairText) -> str:
        """``a1,a2|b1;a3|b2,b3``: the decimal ids of the groups in order."""
        parts = list(map(shown.__getitem__, self.pairs().tolist()))
        wide = (np.diff(self.link_a, prepend=-1) > 1) | (np.diff(self.link_b, prepend=-1) > 1)
        starts_a, starts_b = np.append(0, self.link_a[:-1] + 1), np.append(0, self.link_b[:-1] + 1)
        at, a, b, known = np.flatnonzero(wide), self.a, self.b, shown.wide
        for g, i0, i1, j0, j1 in zip(at.tolist(), starts_a[at].tolist(), (self.link_a[at] + 1).tolist(), starts_b[at].tolist(), (self.link_b[at] + 1).tolist()):
            key = (*a[i0:i1], -1, *b[j0:j1])
            text = known.get(key)
            if text is None:
                if len(known) >= CACHE:
                    known.clear()
                text = known[key] = f"{','.join(map(str, a[i0:i1]))}|{','.join(map(str, b[j0:j1]))}"
            parts[g] = text
        return ";".join(parts)


class _PairText(dict):
    """The text of a group of one token a side, kept per pair (bounded as pairs are),
    and up to ``CACHE`` texts of wider groups."""

    def __init__(self):
        super().__init__()
        self.wide: dict[tuple, str] = {}

    def __missing__(self, pair: int) -> str:
        self[pair] = text = f"{pair >> SHIFT}|{pair & (1 << SHIFT) - 1}"
        return text


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """``(id, a_ids, b_ids, link_a, link_b)``: both sides' ids and, link by link,
    the index of the linked token in each side."""
    keyed = with_key(docs, id_col, text_col)
    names = ["a_ids", "b_ids", "link_a", "link_b"]
    schema = T.StructType([keyed.schema["_id"], *[T.StructField(n, T.ArrayType(T.IntegerType())) for n in names]])

    def run(batches):
        vocab = vocabularies(a_file, b_file)
        for b in batches:
            rows = [Alignment(*vocab.encode(t), vocab) for t in b.column(1).to_pylist()]
            sides = [[x.ids_a for x in rows], [x.ids_b for x in rows], [x.link_a for x in rows], [x.link_b for x in rows]]
            yield pa.RecordBatch.from_arrays([b.column(0), *[_lists(s) for s in sides]], ["_id", *names])

    return keyed.mapInArrow(run, schema).withColumnRenamed("_id", id_col)


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int32)))


def link_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """Per document the counts of its alignment, the digest of its groups, and its
    distinct linked pairs with how often it holds each; no texts, no ids."""
    keyed = with_key(docs, id_col, text_col)
    counts = ["n_a", "n_b", "n_groups", "n_links"]
    ints = T.ArrayType(T.IntegerType())
    schema = T.StructType([keyed.schema["_id"], *[T.StructField(c, T.LongType()) for c in counts], T.StructField("groups_sha256", T.StringType()),
                           T.StructField("pairs", ints), T.StructField("times", ints)])

    def run(batches):
        vocab, shown = vocabularies(a_file, b_file), _PairText()
        for b in batches:
            numbers, digests, pairs, times = [], [], [], []
            for text in b.column(1).to_pylist():
                x = Alignment(*vocab.encode(text), vocab)
                # tokens are never empty, so a place where both end is one link and one group
                numbers.append((len(x.a), len(x.b), len(x.link_a), len(x.link_a)))
                digests.append(sha256_hex(x.groups_text(shown).encode()) if x.a else "")
                pair, n = np.unique(x.pairs(), return_counts=True)
                pairs.append(pair)
                times.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([r[k] for r in numbers], pa.int64()) for k in range(4)], pa.array(digests, pa.string()),
                                              _lists(pairs), _lists(times)], ["_id", *counts, "groups_sha256", "pairs", "times"])

    return keyed.mapInArrow(run, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """``(pair, n)``: how many links of all documents hold each id pair, summed
    per batch before the shuffle."""

    def run(batches):
        for b in batches:
            pair, back = np.unique(b.column(0).flatten().to_numpy(), return_inverse=True)
            n = np.bincount(back, b.column(1).flatten().to_numpy(), len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int32()), pa.array(n)], ["pair", "n"])

    return links.select("pairs", "times").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_file: str = A_FILE, b_file: str = B_FILE) -> DataFrame:
    """The counts of ``link_table`` and, from the corpus-wide counts of linked
    pairs, ``n_best`` (links whose count is their B id's highest) and
    ``count_sum`` (the counts of all its links added up).

    Texts are encoded once; what follows reads the written pairs.
    """
    links = written(link_table(docs, id_col, text_col, a_file, b_file), "links", "zstd")
    # at most pair_bound() rows
    found = pair_counts(links).toPandas().sort_values("pair")
    pair, n = found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
    highest = np.zeros(1 << SHIFT, np.int64)
    np.maximum.at(highest, pair & (1 << SHIFT) - 1, n)
    sent = docs.sparkSession.sparkContext.broadcast((pair, n, n == highest[pair & (1 << SHIFT) - 1]))
    kept = ["_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    schema = T.StructType([*[links.schema[c] for c in kept], T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def run(batches):
        pair, n, best = sent.value
        for b in batches:
            size = b.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            at = np.searchsorted(pair, b.column("pairs").flatten().to_numpy())
            times = b.column("times").flatten().to_numpy().astype(np.int64)
            ends = np.append(0, np.cumsum(size))
            sums = [np.diff(np.append(0, np.cumsum(x))[ends]) for x in (times * best[at], times * n[at])]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *[pa.array(s, pa.int64()) for s in sums]], [*kept, "n_best", "count_sum"])

    return links.mapInArrow(run, schema).withColumnRenamed("_id", id_col)
