"""Projections, filters and cleaning."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.quantiles import exact_quantiles


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """B1/B2: drop rows with a null in any column (or in ``cols`` only)."""
    return df.na.drop("any", subset=cols) if cols else df.na.drop("any")


def binarise(df: DataFrame, cond, out: str = "target") -> DataFrame:
    """0/1 target from a predicate (a null compares as false)."""
    return df.withColumn(out, F.when(cond, 1).otherwise(0))


def binarise_text(df: DataFrame, col: str, positive: str, trim: bool = True, lower: bool = False,
                  out: str = "target") -> DataFrame:
    """Normalise text (trim and/or lower) then compare with ``positive``."""
    c = F.col(col)
    if trim:
        c = F.trim(c)
    if lower:
        c = F.lower(c)
    return df.withColumn(out, (c == F.lit(positive)).cast("int"))


def to_double(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast features to double."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def coerce_number(df: DataFrame, col: str) -> DataFrame:
    """Text -> double; blank or malformed -> null."""
    return df.withColumn(col, F.expr(f"try_cast(trim({col}) AS double)"))


def first_present(df: DataFrame, names: list[str], out: str) -> DataFrame:
    """The first of several candidate column names that exists, as ``out``."""
    for n in names:
        if n in df.columns:
            return df.withColumnRenamed(n, out) if n != out else df
    raise KeyError(f"none of {names} present")


def indicator(df: DataFrame, col: str, value, out: str | None = None) -> DataFrame:
    """0/1 column from equality."""
    return df.withColumn(out or f"{col}_is_{value}", (F.col(col) == F.lit(value)).cast("int"))


def quantile_bucket(df: DataFrame, col: str, probs=(1 / 3, 2 / 3), out: str = "target") -> DataFrame:
    """Class by exact (linear) quantile cuts, right-closed intervals:
    (-inf, q1] -> 0, (q1, q2] -> 1, (q2, inf) -> 2.  Cut points are one
    small row joined back (broadcast)."""
    q = exact_quantiles(df, [col], list(probs))
    cuts = q.groupBy().agg(F.array_sort(F.collect_list("q")).alias("_cuts"))
    j = df.withColumn("_one", F.lit(1)).join(F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one")
    return j.withColumn(out, F.size(F.filter("_cuts", lambda c: c < F.col(col)))).drop("_one", "_cuts")


def feature_pairs(cols: list[str]) -> list[tuple[str, str]]:
    """All 2-column combinations in column order."""
    return list(itertools.combinations(cols, 2))


def profile(df: DataFrame, cols: list[str], target: str | None = None) -> DataFrame:
    """Tidy profile (column, n, mean, std (sample), min, q25, q50, q75, max);
    with ``target`` an extra row carries the positive rate in ``mean``."""
    base = df.agg(*[x for c in cols for x in (
        F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__mean").alias("mean"),
                             F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                             F.col(f"{c}__max").alias("max")) for c in cols])
    long = base.select(F.explode(arr).alias("r")).select("r.*")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).groupBy("column").agg(
        F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q25"),
        F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("q50"),
        F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q75"))
    out = long.join(q, "column")
    if target:
        t = df.agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("mean")).select(
            F.lit(target).alias("column"), "n", "mean", *[F.lit(None).cast("double").alias(x)
                                                          for x in ("std", "min", "max", "q25", "q50", "q75")])
        out = out.unionByName(t)
    return out
