"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every prefix of a byte string there is exactly one token that ends
its BPE encoding.  ``PrefixState`` stores that last token for each prefix:
token ``t`` ends prefix ``i`` when its bytes are the prefix's suffix and
the pair (last token of the prefix before it, ``t``) stands when its
bytes are encoded alone.  Reading the table backwards gives the encoding
of any prefix; bytes can be appended without looking at the earlier ones
again, and after an edit only the prefixes up to the point where the
table agrees with the old one again are computed.

Texts are cut by the tokenizer's pattern first; each match is encoded by
itself, without special tokens.

Defined cases: a null text is an empty one and has no ids; repeated rows
are encoded alike; every column of the input is kept; an empty table gives
an empty table.  A row is never cut: memory per task is one Arrow batch
plus caches of a fixed number of short strings.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: the public pattern for Python's ``re``, right for texts without characters of ``_RARE``
_FAST = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[^\\W\\d_]+| ?\\d+| ?(?:[^\\w\\s]|_)+|\\s+(?!\\S)|\\s+")
#: characters that ``re`` and the pattern's own syntax may class differently:
#: separators below the blank, numbers that are no digits, all beyond Latin
_RARE = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")
#: a blank before a word: a match of the public pattern always ends before it
_BORDER = regex.compile(r" \S")
#: pieces and pairs a worker remembers, and the longest piece it keeps
_CACHE, _PAIRS, _CACHED_LEN = 300_000, 400_000, 48
_NEVER = float("inf")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    out: dict[bytes, int] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                out[base64.b64decode(token)] = int(rank)
    return out


class Encoder:
    """Ranks and pattern of one tokenizer, with memo tables per process."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.bytes_of = {r: b for b, r in self.ranks.items()}
        self._length = {r: len(b) for b, r in self.ranks.items()}
        self.longest = max(self._length.values())
        self.pattern = regex.compile(pattern)
        self._pairs: dict[int, bool] = {}
        self._pieces: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}
        self._public = pattern == default_pattern()
        #: tokens that are the encoding of their own bytes
        self.usable = {b: r for b, r in self.ranks.items() if self.merged(b) == [r]}
        self._border: dict[int, tuple[list, list]] = {}
        # finds all tokens that end at each byte, the longest first
        self._ends = ahocorasick.Automaton()
        for b, r in self.usable.items():
            self._ends.add_word(b.decode("latin-1"), (len(b), r))
        self._ends.make_automaton()

    # ------------------------------------------------------------ definition
    def _merge(self, parts: list[bytes]) -> int | None:
        """Merge the lowest-ranked neighbours, the leftmost of equals, in place;
        returns where, or None if no neighbours merge."""
        ranks, best, at = self.ranks, None, None
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if at is not None:
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return at

    def merged(self, data: bytes) -> list[int]:
        """The encoding by its definition; only for short strings."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while self._merge(parts) is not None:
            pass
        return [self.ranks[p] for p in parts]

    def border(self, token: int) -> tuple[list, list]:
        """How the first and the last part of the token's bytes grow while they
        are merged: (bytes, rank of the merge)."""
        got = self._border.get(token)
        if got is None:
            b = self.bytes_of[token]
            first, last, parts = [(b[:1], -1)], [(b[-1:], -1)], [b[i:i + 1] for i in range(len(b))]
            while (at := self._merge(parts)) is not None:
                if at == 0:
                    first.append((parts[0], self.ranks[parts[0]]))
                if at == len(parts) - 1:
                    last.append((parts[-1], self.ranks[parts[-1]]))
            got = self._border[token] = first, last
        return got

    def pair(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when put side by side.

        Follows the merges inside either token that change what lies at the
        border, by rank; they stay unless a merge across the border has its
        turn before one of them (of equal ranks the leftmost goes first).
        """
        a, b, get = self.border(left)[1], self.border(right)[0], self.ranks.get
        i = j = 0
        while True:
            na = a[i + 1][1] if i + 1 < len(a) else _NEVER
            nb = b[j + 1][1] if j + 1 < len(b) else _NEVER
            c = get(a[i][0] + b[j][0])
            if c is not None and c < na and c <= nb:
                return False
            if na <= nb:
                if na == _NEVER:
                    return True
                i += 1
            else:
                j += 1

    # -------------------------------------------------------------- encoding
    def extend(self, data: bytes, last: list[int], stop=None) -> None:
        """Append to ``last`` the one token that ends the encoding of each longer
        prefix of ``data``, until ``stop`` (if given) says so."""
        pairs, size, add = self._pairs, len(last), last.append
        for end, (n, t) in self._ends.iter(data.decode("latin-1"), max(0, size - self.longest)):
            if end < size - 1:
                continue
            if end >= size:
                break
            if n != size:
                left = last[size - n]
                ok = pairs.get(left << 32 | t)
                if ok is None:
                    if len(pairs) >= _PAIRS:
                        pairs.clear()
                    ok = pairs[left << 32 | t] = self.pair(left, t)
                if not ok:
                    continue
            add(t)
            size += 1
            if stop is not None and stop(size - 1):
                return
        if size <= len(data):
            raise ValueError("the vocabulary lacks a byte")

    def piece(self, data: bytes) -> list[int]:
        """Encoding of one match of the pattern."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        last = [-1]
        self.extend(data, last)
        return self.backwards(last, len(data))

    def backwards(self, last: list[int], i: int) -> list[int]:
        """The encoding of the prefix of ``i`` bytes from the table."""
        out, length = [], self._length
        while i:
            t = last[i]
            out.append(t)
            i -= length[t]
        out.reverse()
        return out

    def remember(self, s: str) -> tuple[int, ...]:
        """Encoding of a piece that is not in the young cache.  When that is full
        it becomes the old one, so what is seen again and again stays."""
        ids = self._old.get(s)
        if ids is None:
            ids = tuple(self.piece(s.encode()))
        if len(s) <= _CACHED_LEN:
            if len(self._pieces) >= _CACHE:
                self._old = self._pieces
                self._pieces = {}
            self._pieces[s] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        add = out.extend
        find = _FAST.findall if self._public and not _RARE.search(text) else self.pattern.findall
        for s in find(text):
            add(self._pieces.get(s) or self.remember(s))
        return out

    def forget(self) -> None:
        """Drop the memo tables; what the tokenizer needs stays."""
        self._pairs, self._pieces, self._old, self._border = {}, {}, {}, {}

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def append(self, text: str | None, ids: list[int], added: str | None) -> list[int]:
        """Ids of ``text + added`` from those of ``text``: only the text from its
        last blank before a word on is encoded again (a match always ends there)."""
        text, added = text or "", added or ""
        at = max((m.start() for m in _BORDER.finditer(text)), default=0) if self._public else 0
        tail = self.encode(text[at:])
        return list(ids[:len(ids) - len(tail)]) + self.encode(text[at:] + added)


class PrefixState:
    """Last token of every prefix of one byte string."""

    def __init__(self, enc: Encoder, data: bytes = b""):
        self.enc, self.data, self.last = enc, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.enc.extend(self.data, self.last)

    def edit(self, start: int, end: int, repl: bytes) -> int:
        """Replace ``data[start:end]``; returns how many prefixes were computed.

        Stops once the table has agreed with the old one for as many
        prefixes in a row as the longest token has bytes: each entry
        depends on no more than that many before it.
        """
        old, shift, same = self.last, len(repl) - (end - start), 0
        self.data = self.data[:start] + repl + self.data[end:]
        self.last = new = old[:start + 1]

        def agrees(i: int) -> bool:
            nonlocal same
            same = same + 1 if i - shift > end and old[i - shift] == new[i] else 0
            return same >= self.enc.longest

        self.enc.extend(self.data, new, agrees)
        done = len(new) - 1 - start
        new.extend(old[len(new) - shift:])
        return done

    def tokens(self, upto: int | None = None) -> list[int]:
        """Encoding of the prefix of ``upto`` bytes (all of them by default)."""
        return self.enc.backwards(self.last, len(self.data) if upto is None else upto)


@lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per process and tokenizer."""
    return Encoder(path, pattern)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    """What decoding needs: the bytes of every token."""
    return {r: b for b, r in read_ranks(path).items()}


# ------------------------------------------------------------------ DataFrame
def encode_documents(df: DataFrame, text: str = "text", out: str = "ids",
                     path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the array column ``out`` of token ids of ``text``.

    No shuffle: one Arrow pass.  A column of the name ``out`` is replaced.
    """
    path, pattern = path or default_path(), pattern or default_pattern()
    base = df.drop(out)
    schema = T.StructType(base.schema.fields + [T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        try:
            for b in batches:
                for part in slices(b, text):
                    flat, ends = array("i"), [0]
                    for t in part.column(text).to_pylist():
                        flat.extend(enc.encode(t))
                        ends.append(len(flat))
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32)))
                    yield pa.RecordBatch.from_arrays([*part.columns, lists], schema.names)
        finally:  # a worker that waits for other work keeps the tokenizer only
            enc.forget()
            pa.default_memory_pool().release_unused()

    return base.mapInArrow(run, schema)


def decode_documents(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the binary column ``out``: the bytes of the tokens in ``ids``
    (a null array: no bytes)."""
    path = path or default_path()
    base = df.drop(out)
    schema = T.StructType(base.schema.fields + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = token_bytes(path).__getitem__
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                col = part.column(ids)
                flat, n = col.flatten().to_numpy().tolist(), pa.compute.list_value_length(col).to_pylist()
                ends = np.cumsum([0, *(k or 0 for k in n)])
                data = pa.array([b"".join(map(get, flat[i:j])) for i, j in zip(ends, ends[1:])], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, data], schema.names)

    return base.mapInArrow(run, schema)


def append_documents(df: DataFrame, text: str, ids: str, added: str, out: str = "ids_appended",
                     path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with the ids of ``text`` followed by ``added``, from the ids of ``text``."""
    path, pattern = path or default_path(), pattern or default_pattern()
    base = df.drop(out)
    schema = T.StructType(base.schema.fields + [T.StructField(out, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, pattern)
        for b in batches:
            rows = zip(*(b.column(c).to_pylist() for c in (text, ids, added)))
            new = pa.array([enc.append(t, i or [], a) for t, i, a in rows], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, new], [*b.schema.names, out])

    return base.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    start = size = 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(text)).to_pylist()):
        if size and size + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    yield batch.slice(start)


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """Digest columns of encoded and decoded documents."""
    return [F.size(ids).cast("bigint").alias("n_tokens"),
            F.sha2(F.concat_ws(",", F.col(ids).cast("array<string>")), 256).alias("ids_sha256"),
            F.sha2(F.col(decoded), 256).alias("decoded_sha256")]
