"""Running totals over an ordered value without a single-task window.

``running_before(df, by, order, sums)`` adds ``<c>_before``: the sum of
``c`` over rows of the same group with a strictly smaller ``order`` value
(``desc=True``: strictly larger).  Rows must be unique on (by, order) —
callers pre-aggregate with ``groupBy(by, order)``, which also collapses hot
values.  The order is cut into bins by approximate quantile cut points (a
small array per group); per-bin sums give exact bin offsets (a window over
at most N_BINS rows per group) and a window inside each bin finishes the
running sum.  No window partition holds more than one bin.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

N_BINS = 256


def running_before(df: DataFrame, by: list[str], order: str, sums: list[str], desc: bool = False,
                   n_bins: int = N_BINS) -> DataFrame:
    by = list(by)
    o = F.col(order)
    key = (-o) if desc else o
    d = df.withColumn("_ok", key.cast("double"))
    probs = [i / n_bins for i in range(1, n_bins)]
    grouped = d.groupBy(*by) if by else d.groupBy()
    cuts = grouped.agg(F.percentile_approx("_ok", probs, 10 * n_bins).alias("_cuts"))
    if by:
        d = d.join(F.broadcast(cuts), on=by)
    else:
        d = d.withColumn("_one", F.lit(1)).join(F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one").drop("_one")
    # cuts below the value: counted in steps of ``step`` cuts, then within one step
    step = math.isqrt(n_bins)
    below = lambda i: F.coalesce(F.get("_cuts", i) < F.col("_ok"), F.lit(False)).cast("int")
    d = d.withColumn("_step", step * reduce(add, [below(F.lit(i - 1)) for i in range(step, n_bins, step)], F.lit(0)))
    at = F.col("_step") + reduce(add, [below(F.col("_step") + i) for i in range(step)])
    d = d.withColumn("_bin", F.when(F.col("_cuts").isNotNull(), at)).drop("_cuts", "_step")
    bins = d.groupBy(*by, "_bin").agg(*[F.sum(c).alias(f"_bs_{c}") for c in sums])
    wb = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*by, "_bin", *[F.coalesce(F.sum(f"_bs_{c}").over(wb), F.lit(0)).alias(f"_off_{c}")
                                      for c in sums])
    wi = Window.partitionBy(*by, "_bin").orderBy("_ok").rowsBetween(Window.unboundedPreceding, -1)
    out = d.join(bins, on=[*by, "_bin"])
    for c in sums:
        out = out.withColumn(f"{c}_before", F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0)))
    return out.drop("_ok", "_bin", *[f"_off_{c}" for c in sums])
