"""Metrics and result aggregation as grouped DataFrame jobs.

Every metric takes a scored table and a list of grouping columns ``by``
(cell, fold, seed, model, ...) and returns one row per group, so a whole
sweep is scored in one aggregation.  Ranking metrics collapse scores to
distinct values first (map-side combined) and use exact running totals
from :mod:`foldwise.functions.ordered`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.ordered import running_before
from foldwise.functions.quantiles import exact_quantiles


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- J1 - J4
def accuracy(df: DataFrame, by: list[str], y: str = "y", p: str = "pred", out: str = "accuracy") -> DataFrame:
    return df.groupBy(*by).agg(F.avg((_c(y) == _c(p)).cast("double")).alias(out))


def prf_exprs(y: str = "y", p: str = "pred", positive=1, prefix: str = "") -> list[Column]:
    """Precision / recall / F1 of the positive class (0 when undefined)."""
    tp = F.sum(((_c(y) == positive) & (_c(p) == positive)).cast("double"))
    pp = F.sum((_c(p) == positive).cast("double"))
    ap = F.sum((_c(y) == positive).cast("double"))
    prec = F.when(pp > 0, tp / pp).otherwise(0.0)
    rec = F.when(ap > 0, tp / ap).otherwise(0.0)
    f1 = F.when((pp + ap) > 0, 2 * tp / (pp + ap)).otherwise(0.0)
    return [prec.alias(f"{prefix}precision"), rec.alias(f"{prefix}recall"), f1.alias(f"{prefix}f1")]


def prf(df: DataFrame, by: list[str], y: str = "y", p: str = "pred", positive=1) -> DataFrame:
    return df.groupBy(*by).agg(*prf_exprs(y, p, positive))


def confusion(df: DataFrame, by: list[str], labels: list, y: str = "y", p: str = "pred") -> DataFrame:
    """Counts for the full label grid (absent cells are 0)."""
    lab = F.array(*[F.lit(v) for v in labels])
    counts = df.groupBy(*by, F.col(y).alias("true_label"), F.col(p).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("n"))
    grid = (df.select(*by).distinct() if by else df.sparkSession.range(1).select())
    grid = grid.withColumn("true_label", F.explode(lab)).withColumn("pred_label", F.explode(lab))
    return (grid.join(counts, on=[*by, "true_label", "pred_label"], how="left")
            .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint")))


def class_report(df: DataFrame, by: list[str], labels: list, y: str = "y", p: str = "pred") -> DataFrame:
    """Per-class precision / recall / F1 / support plus accuracy, macro and
    weighted averages, as one long table (by..., row, precision, recall, f1, support)."""
    per = []
    for v in labels:
        per.append(df.groupBy(*by).agg(*prf_exprs(y, p, v),
                                       F.sum((_c(y) == v).cast("bigint")).alias("support"))
                   .withColumn("row", F.lit(str(v))))
    cls = per[0]
    for x in per[1:]:
        cls = cls.unionByName(x)
    g = cls.groupBy(*by)
    macro = g.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                  F.avg("f1").alias("f1"), F.sum("support").alias("support")).withColumn("row", F.lit("macro avg"))
    tot = F.sum("support")
    weighted = g.agg((F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                     (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                     (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                     tot.alias("support")).withColumn("row", F.lit("weighted avg"))
    acc = df.groupBy(*by).agg(F.avg((_c(y) == _c(p)).cast("double")).alias("f1"),
                              F.count(F.lit(1)).alias("support")).withColumn("row", F.lit("accuracy"))
    acc = acc.withColumn("precision", F.lit(None).cast("double")).withColumn("recall", F.lit(None).cast("double"))
    return cls.unionByName(macro).unionByName(weighted).unionByName(acc.select(*cls.columns))


# ---------------------------------------------------------------- J5 - J8
def score_counts(df: DataFrame, by: list[str], y: str = "y", s: str = "score") -> DataFrame:
    """(by..., score, pos, neg): one row per distinct score (map-side combined)."""
    return df.groupBy(*by, F.col(s).alias("score")).agg(
        F.sum((_c(y) == 1).cast("bigint")).alias("pos"), F.sum((_c(y) != 1).cast("bigint")).alias("neg"))


def roc_auc(df: DataFrame, by: list[str], y: str = "y", s: str = "score", out: str = "roc_auc") -> DataFrame:
    """Mann-Whitney AUC with ties counted one half (= tie-averaged rank sum)."""
    sc = running_before(score_counts(df, by, y, s), by, "score", ["neg"])
    return sc.groupBy(*by).agg(
        (F.sum(F.col("pos") * (F.col("neg_before") + 0.5 * F.col("neg")))
         / (F.sum("pos") * F.sum("neg"))).alias(out))


def _desc_cum(df: DataFrame, by: list[str], y: str, s: str) -> DataFrame:
    """Per distinct threshold (descending): tp / fp at score >= threshold, totals."""
    sc = running_before(score_counts(df, by, y, s), by, "score", ["pos", "neg"], desc=True)
    # one row of totals per model, attached by broadcast
    keys = by or ["_one"]
    sc = sc if by else sc.withColumn("_one", F.lit(1))
    total = sc.groupBy(*keys).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    out = (sc.withColumn("tp", F.col("pos_before") + F.col("pos")).withColumn("fp", F.col("neg_before") + F.col("neg"))
           .join(F.broadcast(total), keys))
    return out if by else out.drop("_one")


def roc_curve(df: DataFrame, by: list[str], y: str = "y", s: str = "score") -> DataFrame:
    """(by..., threshold, fpr, tpr), one point per distinct score plus the
    (0, 0) start at threshold +inf; all points kept."""
    c = _desc_cum(df, by, y, s)
    pts = c.select(*by, F.col("score").cast("double").alias("threshold"),
                   (F.col("fp") / F.col("N")).alias("fpr"), (F.col("tp") / F.col("P")).alias("tpr"))
    start = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    start = start.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"),
                         F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_curve(df: DataFrame, by: list[str], y: str = "y", s: str = "score") -> DataFrame:
    """(by..., threshold, precision, recall) per distinct score, ending at (1, 0)."""
    c = _desc_cum(df, by, y, s)
    pts = c.select(*by, F.col("score").cast("double").alias("threshold"),
                   (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                   (F.col("tp") / F.col("P")).alias("recall"))
    end = df.select(*by).distinct() if by else df.sparkSession.range(1).select()
    end = end.select(*by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                     F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, by: list[str], y: str = "y", s: str = "score",
                      out: str = "average_precision") -> DataFrame:
    """Sum over thresholds of (recall step) x precision."""
    c = _desc_cum(df, by, y, s)
    return c.groupBy(*by).agg(
        F.sum((F.col("pos") / F.col("P")) * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias(out))


# ---------------------------------------------------------------- J9 - J14
def brier(df: DataFrame, by: list[str], y: str = "y", s: str = "score", out: str = "brier") -> DataFrame:
    return df.groupBy(*by).agg(F.avg((_c(s) - _c(y)) * (_c(s) - _c(y))).alias(out))


def calibration(df: DataFrame, by: list[str], n_bins: int = 10, y: str = "y", s: str = "score") -> DataFrame:
    """Quantile calibration: edges are exact quantiles of the score at
    i/n_bins; a row's bin is the number of interior edges strictly below
    its score; empty bins vanish.  (by..., bin, mean_pred, frac_pos, n)."""
    probs = [i / n_bins for i in range(1, n_bins)]
    sc = df.select(*by, F.col(s).cast("double").alias("_s"), F.col(y).alias("_y"))
    edges = exact_quantiles(sc, ["_s"], probs, by=by).groupBy(*by).agg(
        F.array_sort(F.collect_list("q")).alias("_edges"))  # n_bins - 1 values per group
    j = sc.join(F.broadcast(edges), on=by) if by else sc.withColumn("_one", F.lit(1)).join(
        F.broadcast(edges.withColumn("_one", F.lit(1))), "_one")
    j = j.withColumn("bin", F.size(F.filter("_edges", lambda e: e < F.col("_s"))))
    return j.groupBy(*by, "bin").agg(F.avg("_s").alias("mean_pred"), F.avg(F.col("_y").cast("double")).alias("frac_pos"),
                                     F.count(F.lit(1)).alias("n"))


def r2(df: DataFrame, by: list[str], y: str = "y", p: str = "pred", out: str = "r2") -> DataFrame:
    """1 - SSE/SST with the mean of the scored rows."""
    g = df.groupBy(*by).agg(F.sum((_c(y) - _c(p)) ** 2).alias("_sse"), F.sum(_c(y)).alias("_sy"),
                            F.sum(_c(y) * _c(y)).alias("_syy"), F.count(F.lit(1)).alias("_n"))
    sst = F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("_n")
    return g.select(*by, (1 - F.col("_sse") / sst).alias(out))


def mae(df: DataFrame, by: list[str], y: str = "y", p: str = "pred", out: str = "mae") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.abs(_c(y) - _c(p))).alias(out))


def residual_histogram(df: DataFrame, by: list[str], n_bins: int = 40, y: str = "y", p: str = "pred") -> DataFrame:
    """Equal-width histogram of residuals (true - pred); last bin closed."""
    r = df.select(*by, (_c(y) - _c(p)).alias("resid"))
    mm = r.groupBy(*by).agg(F.min("resid").alias("_lo"), F.max("resid").alias("_hi"))
    j = r.join(F.broadcast(mm), on=by) if by else r.withColumn("_one", F.lit(1)).join(
        F.broadcast(mm.withColumn("_one", F.lit(1))), "_one")
    width = (F.col("_hi") - F.col("_lo")) / n_bins
    b = F.when(width == 0, 0).otherwise(F.least(F.floor((F.col("resid") - F.col("_lo")) / width), F.lit(n_bins - 1)))
    j = j.withColumn("bin", b.cast("int"))
    return j.groupBy(*by, "bin").agg(F.count(F.lit(1)).alias("n"),
                                     F.first("_lo").alias("lo"), F.first("_hi").alias("hi")).withColumn(
        "edge_lo", F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / n_bins).drop("lo", "hi")


# ---------------------------------------------------------------- J15 - J25
def mean_std(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Mean and population std across folds / seeds."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    return df.groupBy(*by).agg(*aggs)


def summary(df: DataFrame, by: list[str], col: str, digits: int = 4) -> DataFrame:
    """Grouped mean, sample std, min, max, rounded."""
    from foldwise.plans.catalog import sql_round
    return df.groupBy(*by).agg(sql_round(F.avg(col), digits).alias("mean"),
                               sql_round(F.stddev_samp(col), digits).alias("std"),
                               sql_round(F.min(col), digits).alias("min"), sql_round(F.max(col), digits).alias("max"))


def rank_avg(df: DataFrame, by: list[str], value: str, out: str = "rank") -> DataFrame:
    """1-based rank of ``value`` within ``by`` with ties averaged."""
    w = Window.partitionBy(*by).orderBy(value)
    wt = Window.partitionBy(*by, value)
    return df.withColumn(out, F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0)


def spearman_matrix(df: DataFrame, model: str = "model", feature: str = "feature",
                    value: str = "value") -> DataFrame:
    """Spearman rho for every pair of importance vectors (long form, unit diagonal)."""
    r = rank_avg(df, [model], value, "_r").select(model, feature, "_r")
    a = r.select(F.col(model).alias("model_a"), F.col(feature).alias("_f"), F.col("_r").alias("_ra"))
    b = r.select(F.col(model).alias("model_b"), F.col(feature).alias("_f"), F.col("_r").alias("_rb"))
    j = a.join(b, "_f")
    return j.groupBy("model_a", "model_b").agg(
        F.when(F.col("model_a") == F.col("model_b"), F.lit(1.0)).otherwise(F.corr("_ra", "_rb")).alias("rho"))


def pareto_front(df: DataFrame, x: str, y: str, minimize_x: bool = True, maximize_y: bool = True,
                 by: list[str] | None = None) -> DataFrame:
    """Rows not dominated by any other row (no worse on both axes, strictly
    better on one); exact ties are all kept.

    Distributed form: collapse to the best y per distinct x (map-side
    combined), compute the best y among strictly better x with exact
    running maxima (value bins + per-bin offsets), and keep a row iff its
    y beats that prefix maximum and is the best at its own x.
    """
    by = list(by or [])
    xs = F.col(x) if minimize_x else -F.col(x)
    ys = F.col(y) if maximize_y else -F.col(y)
    d = df.withColumn("_x", xs.cast("double")).withColumn("_y", ys.cast("double"))
    best_at_x = d.groupBy(*by, "_x").agg(F.max("_y").alias("_ybest"))
    # running max of _ybest over strictly smaller _x, via value bins
    probs = [i / 256 for i in range(1, 256)]
    grouped = best_at_x.groupBy(*by) if by else best_at_x.groupBy()
    cuts = grouped.agg(F.percentile_approx("_x", probs, 2560).alias("_cuts"))
    bx = (best_at_x.join(F.broadcast(cuts), on=by) if by else best_at_x.withColumn("_one", F.lit(1)).join(
        F.broadcast(cuts.withColumn("_one", F.lit(1))), "_one").drop("_one"))
    bx = bx.withColumn("_bin", F.size(F.filter("_cuts", lambda c: c < F.col("_x")))).drop("_cuts")
    bins = bx.groupBy(*by, "_bin").agg(F.max("_ybest").alias("_bm"))
    wb = Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = bins.select(*by, "_bin", F.max("_bm").over(wb).alias("_prev_bins"))
    wi = Window.partitionBy(*by, "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    bx = (bx.join(bins, on=[*by, "_bin"])
          .withColumn("_prefix", F.greatest(F.col("_prev_bins"), F.max("_ybest").over(wi)))
          .select(*by, "_x", "_ybest", "_prefix"))
    j = d.join(bx, on=[*by, "_x"])
    keep = (F.col("_y") == F.col("_ybest")) & (F.col("_prefix").isNull() | (F.col("_y") > F.col("_prefix")))
    return j.filter(keep).drop("_x", "_y", "_ybest", "_prefix")


def best_row(df: DataFrame, metric: str, by: list[str] | None = None, tie: list[str] | None = None,
             maximize: bool = True) -> DataFrame:
    """First best row per group: max (or min) metric, ties to the smallest tie key."""
    by = list(by or [])
    tie = list(tie or [])
    key = F.struct(F.col(metric).isNull(), (-F.col(metric) if maximize else F.col(metric)), *[F.col(t) for t in tie])
    # combined in the tasks first: no group is ever together in one task
    best = df.groupBy(*by).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in df.columns]), key).alias("_best"))
    return best.where("_best is not null").select("_best.*")


def top_n(df: DataFrame, metric: str, n: int, tie: list[str], maximize: bool = True) -> DataFrame:
    """Top-N leaderboard (TakeOrderedAndProject: each task keeps n rows)."""
    order = [F.col(metric).desc() if maximize else F.col(metric).asc()] + [F.col(t).asc() for t in tie]
    return df.orderBy(*order).limit(n)


def matrix(df: DataFrame, row: str, cols: list[str], value: str, labels: list[str], sep: str = "|") -> DataFrame:
    """Pivot to a matrix; several column keys are joined into one label."""
    lab = F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]) if len(cols) > 1 else F.col(cols[0]).cast("string")
    return df.withColumn("_lab", lab).groupBy(row).pivot("_lab", labels).agg(F.first(value))


def score_list(df: DataFrame, by: list[str], order: str, score: str, digits: int = 4, sep: str = ";") -> DataFrame:
    """Ordered ';'-joined scores per group (a few per group: folds / seeds)."""
    arr = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(score).alias("s"))))
    return df.groupBy(*by).agg(arr.alias("_a")).select(
        *by, F.array_join(F.transform("_a", lambda e: F.format_number(e["s"], digits)), sep).alias("raw_scores"))


def cumulative(df: DataFrame, order: str, value: str, by: list[str] | None = None, out: str = "cumulative") -> DataFrame:
    """Running share (sum up to and including this row), via exact running totals."""
    by = list(by or [])
    r = running_before(df, by, order, [value])
    return r.withColumn(out, F.col(f"{value}_before") + F.col(value)).drop(f"{value}_before")


# ---------------------------------------------------------------- J28
def normalised(df: DataFrame, cols: list[str]) -> DataFrame:
    """Class scores divided by their row's sum; null where that is 0."""
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return df.select(*[x for x in df.columns if x not in cols], *[(F.col(c) / F.nullif(total, F.lit(0.0))).alias(c) for c in cols])


def row_sum_mean(df: DataFrame, cols: list[str], by: list[str] | None = None, out: str = "proba_rowsum_mean") -> DataFrame:
    """Mean over rows of the sum of class probabilities; rows with a null are left out."""
    return df.groupBy(*(by or [])).agg(F.avg(sum((F.col(c) for c in cols[1:]), F.col(cols[0]))).alias(out))
