"""Registry of named study queries and their SQL oracles.

``register(name, sql)`` records a callable ``(spark, sf_dir) -> DataFrame``
and, when the result is SQL-expressible, the DuckDB text that recomputes
it from the raw tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def sql_round(c: str | Column, digits: int = 6) -> Column:
    """round(x, d) the way SQL engines round doubles: scale, round half away
    from zero on the binary value, unscale (Spark's ``round`` rounds the
    decimal text instead, which differs on values like 8.0109415)."""
    col = (F.col(c) if isinstance(c, str) else c).cast("double")
    m = float(10 ** digits)
    # beyond 1e12 the scaled value leaves the long range used by floor();
    # doubles that large carry no digits at 1e-6 to round anyway
    return F.when(F.abs(col) >= 1e12, col).otherwise(F.signum(col) * F.floor(F.abs(col) * m + 0.5) / m)


def r6(c: str | Column) -> Column:
    """Round a result column to 6 places (both engines round the same way)."""
    return sql_round(c, 6)


def key_sql(seed, salt: str, id_expr: str = "row_id", extra: str | None = None) -> str:
    """DuckDB twin of ``split._key``."""
    parts = [f"'{seed}'", f"'{salt}'"]
    if extra is not None:
        parts.append(f"cast({extra} as varchar)")
    parts.append(f"cast({id_expr} as varchar)")
    return f"md5(concat_ws('-', {', '.join(parts)}))"
