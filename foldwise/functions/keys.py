"""Hashed keys: reproducible 'randomness' that both Spark and SQL can compute.

A row's position in a shuffled order is ``md5('<seed>-<salt>-' || id)``;
ties are broken by the id itself, so every ordering is total and the
same on any cluster layout.  DuckDB twin expressions live next to each
helper (``*_sql``) so the oracle queries use identical formulas.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hkey(seed, salt: str, id_col: str | Column) -> Column:
    """md5 text key for (seed, salt, id)."""
    idc = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}-{salt}-"), idc.cast("string")))


def hkey_sql(seed, salt: str, id_expr: str) -> str:
    return f"md5(concat('{seed}-{salt}-', cast({id_expr} as varchar)))"


def hindex(key: Column) -> Column:
    """60-bit non-negative integer from the first 15 hex digits of an md5 key."""
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def hindex_sql(key_expr: str) -> str:
    return f"cast(('0x' || substr({key_expr}, 1, 15)) as bigint)"


def huniform(key: Column) -> Column:
    """Uniform double in [0, 1) from an md5 key."""
    return hindex(key) / F.lit(float(1 << 60))


def huniform_sql(key_expr: str) -> str:
    return f"({hindex_sql(key_expr)} / 1152921504606846976.0)"


# Number of hex digits of the md5 key used to cut the global order into
# ordered bins.  3 digits -> 4096 bins; bins are uniform because md5 is.
_BIN_DIGITS = 3


def global_rank(df: DataFrame, key: str, tie: str, by: list[str] | None = None,
                out: str = "rank") -> DataFrame:
    """``row_number() over (partition by <by> order by key, tie)`` without a
    single-task window.

    The md5 key is cut into 4096 ordered bins by its first hex digits.  Per
    (group, bin) counts form a small table whose running sum gives each
    bin's offset; rows are then ranked inside (group, bin) partitions.  The
    result equals the global row_number exactly, while the largest window
    partition holds ~1/4096 of a group.  The offset table has at most
    ``#groups * 4096`` rows, a fixed bound, so it is broadcast.
    """
    by = list(by or [])
    binned = df.withColumn("_bin", F.substring(F.col(key), 1, _BIN_DIGITS))
    counts = binned.groupBy(*by, "_bin").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "_bin", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*by, "_bin").orderBy(F.col(key), F.col(tie))
    ranked = (binned.join(F.broadcast(offsets), on=[*by, "_bin"], how="inner")
              .withColumn(out, (F.col("_off") + F.row_number().over(w_in)).cast("bigint"))
              .drop("_bin", "_off"))
    return ranked


_MD5_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_MD5_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0 ** 32).astype(np.uint32)


def _md5_block(m: np.ndarray, length: int) -> np.ndarray:
    """md5 of messages of one length (at most 55 bytes), one a row of 64 bytes, as
    two big-endian words."""
    m[:, length] = 0x80
    m[:, 56:] = np.frombuffer(np.uint64(8 * length).tobytes(), np.uint8)
    words = np.ascontiguousarray(m.view("<u4").T)
    start = [np.full(len(m), v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = start
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f = f + a
        f += words[g]
        f += _MD5_SINES[i]
        turn = _MD5_TURNS[i // 16][i % 4]
        a, d, c, b = d, c, b, b + ((f << np.uint32(turn)) | (f >> np.uint32(32 - turn)))
    digest = np.stack([x + y for x, y in zip((a, b, c, d), start)], 1).astype("<u4")
    return digest.view(np.uint8).view(">u8")


def md5_order(head: str, ids: pa.StringArray) -> np.ndarray:
    """Positions of ``ids`` in the order of md5(``head``-id), of ``head`` for a null."""
    n = len(ids)
    keys = np.empty((n, 2), np.uint64)
    if not n:
        return np.zeros(0, np.int64)
    lead = f"{head}-".encode()
    at = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset:ids.offset + n + 1]
    sizes = np.diff(at) + len(lead)
    short = (sizes <= 55) & ids.is_valid().to_numpy(zero_copy_only=False)
    data = np.frombuffer(ids.buffers()[2] or b"", np.uint8)
    for size in np.unique(sizes[short]):
        rows = np.flatnonzero(short & (sizes == size))
        m = np.zeros((len(rows), 64), np.uint8)
        m[:, :len(lead)] = np.frombuffer(lead, np.uint8)
        m[:, len(lead):size] = data[at[rows][:, None] + np.arange(size - len(lead))]
        keys[rows] = _md5_block(m, int(size))
    for i in np.flatnonzero(~short):
        v = ids[int(i)].as_py()
        keys[i] = np.frombuffer(md5((head if v is None else f"{head}-{v}").encode()).digest(), ">u8")
    return np.lexsort((keys[:, 1], keys[:, 0]))
