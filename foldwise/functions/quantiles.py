"""Exact quantiles (linear interpolation) without collecting a group.

``percentile`` keeps every value of a group in one task; at scale a group
can be a third of the table.  Here values are first collapsed to
(group, column, value, count) — a map-side combined aggregation, so a hot
value costs one row — then cut into ordered value bins by approximate
quantile cut points (a small array), and exact cumulative counts come from
per-bin offsets plus a running sum inside each bin.  The value at 0-based
rank r is the one whose cumulative interval contains r; the quantile at p
interpolates ranks floor(h) and floor(h)+1, h = (n-1)p.  This equals
DuckDB ``quantile_cont`` / NumPy ``percentile`` (linear).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_BINS = 256


def long_values(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Unpivot to (by..., column, value); nulls dropped."""
    by = list(by or [])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
                    for c in cols])
    return (df.select(*by, F.explode(arr).alias("_cv"))
            .select(*by, "_cv.column", "_cv.value").filter(F.col("value").isNotNull()))


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float],
                    by: list[str] | None = None) -> DataFrame:
    """Long table (by..., column, p, q) of exact linear-interpolated quantiles."""
    by = list(by or [])
    g = by + ["column"]
    vals = long_values(df, cols, by)
    vc = vals.groupBy(*g, "value").agg(F.count(F.lit(1)).alias("_c"))
    # ordered value bins from approximate cut points (array of N_BINS-1 per group)
    cuts = vc.groupBy(*g).agg(F.percentile_approx(
        "value", [i / N_BINS for i in range(1, N_BINS)], 10 * N_BINS).alias("_cuts"))
    # one row per group and column; groups are folds or models, so few
    vb = vc.join(F.broadcast(cuts), on=g)
    vb = vb.withColumn("_bin", F.size(F.filter("_cuts", lambda c: c < F.col("value")))).drop("_cuts")
    bins = vb.groupBy(*g, "_bin").agg(F.sum("_c").alias("_bc"))
    wo = Window.partitionBy(*g).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*g, "_bin", F.coalesce(F.sum("_bc").over(wo), F.lit(0)).alias("_off"),
                       F.sum("_bc").over(Window.partitionBy(*g)).alias("_n"))
    wi = Window.partitionBy(*g, "_bin").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (vb.join(bins, on=[*g, "_bin"])
              .withColumn("_lo", F.col("_off") + F.coalesce(F.sum("_c").over(wi), F.lit(0)))
              .withColumn("_hi", F.col("_lo") + F.col("_c")))
    # targets: for each p the two ranks that bracket h = (n-1) p
    ps = F.array(*[F.lit(float(p)) for p in probs])
    tgt = (ranked.select(*g, "value", "_lo", "_hi", "_n", F.explode(ps).alias("p"))
           .withColumn("_h", (F.col("_n") - 1) * F.col("p"))
           .withColumn("_r0", F.floor("_h"))
           .withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_n") - 1)))
    at0 = (F.col("_lo") <= F.col("_r0")) & (F.col("_r0") < F.col("_hi"))
    at1 = (F.col("_lo") <= F.col("_r1")) & (F.col("_r1") < F.col("_hi"))
    picked = tgt.filter(at0 | at1)
    agg = picked.groupBy(*g, "p").agg(
        F.max(F.when(at0, F.col("value"))).alias("_v0"),
        F.max(F.when(at1, F.col("value"))).alias("_v1"),
        F.first("_h").alias("_h"), F.first("_r0").alias("_r0"))
    q = F.col("_v0") + (F.col("_h") - F.col("_r0")) * (F.col("_v1") - F.col("_v0"))
    return agg.select(*g, "p", q.alias("q"))


def quantile_wide(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                  name=lambda c, p: f"{c}_q{int(round(p * 100)):02d}") -> DataFrame:
    """Same as :func:`exact_quantiles` pivoted to one row per group."""
    by = list(by or [])
    long = exact_quantiles(df, cols, probs, by).withColumn(
        "_name", F.concat_ws("_q", F.col("column"),
                             F.lpad(F.round(F.col("p") * 100).cast("int").cast("string"), 2, "0")))
    names = [name(c, p) for c in cols for p in probs]
    grouped = long.groupBy(*by) if by else long.groupBy()
    return grouped.pivot("_name", names).agg(F.first("q"))
