"""Encoding and scaling fitted on train rows only.

Scaler parameters are fitted *per fold* in one pass: per-fold moments are
aggregated once (map-side partial aggregation), and the parameters of
"train rows of fold f" are the total minus fold f.  The parameter table
has one row per fold — a fixed, tiny size — and is broadcast-joined back.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.quantiles import exact_quantiles

SCALERS = ("none", "standard", "minmax", "robust", "maxabs")


def _fold_view(df: DataFrame, fold_col: str | None, train_col: str | None) -> tuple[DataFrame, str]:
    """Rows tagged with the fold whose *train* side they belong to.

    - fold_col: K-fold CV; row in fold g is train for every f != g.
    - train_col: a hold-out flag (0 = train); single pseudo-fold 0.
    - neither: all rows fit, pseudo-fold 0.
    """
    if fold_col:
        return df, fold_col
    if train_col:
        return df.filter(F.col(train_col) == 0).withColumn("_pf", F.lit(0)), "_pf"
    return df.withColumn("_pf", F.lit(0)), "_pf"


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard", fold_col: str | None = None,
               train_col: str | None = None, center: bool = True) -> DataFrame:
    """Parameter table ``(fold, <c>__center, <c>__scale ...)``; one row per fold.

    standard: mean and *population* std (constant column -> scale 1);
    minmax: min and range (constant -> scale 1, so values map to 0);
    robust: median and IQR by exact linear quantiles (zero IQR -> 1);
    maxabs: 0 and max |x| (0 -> 1); none: 0 and 1.
    With ``fold_col`` the row for fold f is fitted on rows with fold != f.
    """
    base, fc = _fold_view(df, fold_col, train_col)
    cv = fold_col is not None
    if kind == "none":
        folds = base.select(F.col(fc).alias("fold")).distinct()
        return folds.select("fold", *[x for c in cols for x in (F.lit(0.0).alias(f"{c}__center"),
                                                                   F.lit(1.0).alias(f"{c}__scale"))])
    if kind == "standard":
        aggs = [F.count(F.lit(1)).alias("_n")]
        for c in cols:
            aggs += [F.sum(F.col(c)).alias(f"{c}__s"), F.sum(F.col(c) * F.col(c)).alias(f"{c}__ss")]
        per = base.groupBy(F.col(fc).alias("fold")).agg(*aggs)
        if cv:  # train side of fold f = all folds - fold f
            tot = Window.partitionBy()
            per = per.select("fold", *[(F.sum(F.col(x)).over(tot) - F.col(x)).alias(x)
                                       for x in ["_n"] + [f"{c}__{s}" for c in cols for s in ("s", "ss")]])
        out = [F.col("fold")]
        for c in cols:
            mean = F.col(f"{c}__s") / F.col("_n")
            var = F.greatest(F.col(f"{c}__ss") / F.col("_n") - mean * mean, F.lit(0.0))
            sd = F.sqrt(var)
            out += [(mean if center else F.lit(0.0)).alias(f"{c}__center"),
                    F.when(sd == 0, 1.0).otherwise(sd).alias(f"{c}__scale")]
        return per.select(*out)
    if kind in ("minmax", "maxabs"):
        aggs = []
        for c in cols:
            if kind == "minmax":
                aggs += [F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi")]
            else:
                aggs += [F.max(F.abs(F.col(c))).alias(f"{c}__hi")]
        per = base.groupBy(F.col(fc).alias("fold")).agg(*aggs)
        if cv:  # K x K self-join of the per-fold table (K rows)
            other = per.select(*[F.col(x).alias(f"o_{x}") for x in per.columns])
            j = per.select("fold").join(other, F.col("fold") != F.col("o_fold"))
            ag = []
            for c in cols:
                if kind == "minmax":
                    ag += [F.min(f"o_{c}__lo").alias(f"{c}__lo")]
                ag += [F.max(f"o_{c}__hi").alias(f"{c}__hi")]
            per = j.groupBy("fold").agg(*ag)
        out = [F.col("fold")]
        for c in cols:
            if kind == "minmax":
                rng = F.col(f"{c}__hi") - F.col(f"{c}__lo")
                out += [F.col(f"{c}__lo").alias(f"{c}__center"),
                        F.when(rng == 0, 1.0).otherwise(rng).alias(f"{c}__scale")]
            else:
                m = F.col(f"{c}__hi")
                out += [F.lit(0.0).alias(f"{c}__center"), F.when(m == 0, 1.0).otherwise(m).alias(f"{c}__scale")]
        return per.select(*out)
    if kind == "robust":
        if cv:  # each row is train data for the K-1 other folds
            k = int(base.agg(F.max(fc)).first()[0]) + 1   # number of folds (a small scalar)
            others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col(fc))
            lab = base.withColumn("_tf", F.explode(others)).drop(fc).withColumnRenamed("_tf", "fold")
        else:
            lab = base.withColumnRenamed(fc, "fold")
        q = exact_quantiles(lab, cols, [0.25, 0.5, 0.75], by=["fold"])
        wide = q.groupBy("fold").pivot("column", cols).agg(
            F.max(F.when(F.col("p") == 0.25, F.col("q"))).alias("q1"),
            F.max(F.when(F.col("p") == 0.5, F.col("q"))).alias("q2"),
            F.max(F.when(F.col("p") == 0.75, F.col("q"))).alias("q3"))
        out = [F.col("fold")]
        for c in cols:
            iqr = F.col(f"{c}_q3") - F.col(f"{c}_q1")
            out += [F.col(f"{c}_q2").alias(f"{c}__center"), F.when(iqr == 0, 1.0).otherwise(iqr).alias(f"{c}__scale")]
        return wide.select(*out)
    raise ValueError(f"unknown scaler {kind}")


def apply_scaler(df: DataFrame, params: DataFrame, cols: list[str], fold_col: str | None = None,
                 as_fold: str | None = None) -> DataFrame:
    """(x - center) / scale with the parameters of ``as_fold`` (default: the
    row's own fold; pseudo-fold 0 without folds).  Broadcast join: one
    parameter row per fold."""
    key = as_fold or fold_col
    if key is None:
        d = df.withColumn("_pf", F.lit(0))
        key = "_pf"
    else:
        d = df
    j = d.join(F.broadcast(params.withColumnRenamed("fold", "_fold_p")), F.col(key) == F.col("_fold_p"))
    for c in cols:
        j = j.withColumn(c, (F.col(c) - F.col(f"{c}__center")) / F.col(f"{c}__scale"))
    drop = ["_fold_p"] + [f"{c}__{s}" for c in cols for s in ("center", "scale")]
    if key == "_pf":
        drop.append("_pf")
    return j.drop(*drop)


def inverse_scale(df: DataFrame, params: DataFrame, cols: list[str], fold: int = 0) -> DataFrame:
    """Back to raw units, x * scale + center (e.g. centroids)."""
    p = params.filter(F.col("fold") == fold).withColumnRenamed("fold", "_fold_p")
    j = df.withColumn("_pf", F.lit(fold)).join(F.broadcast(p), F.col("_pf") == F.col("_fold_p"))
    j = j.drop("_pf", "_fold_p")
    for c in cols:
        j = j.withColumn(c, F.col(c) * F.col(f"{c}__scale") + F.col(f"{c}__center"))
    return j.drop(*[f"{c}__{s}" for c in cols for s in ("center", "scale")])


# ---------------------------------------------------------------- C1, C2
def vocabulary(df: DataFrame, cols: list[str]) -> dict[str, list[str]]:
    """Sorted distinct levels of each categorical column, one aggregation.

    The vocabulary size is the number of distinct levels (bounded by the
    schema's categories, not by rows); it is brought to the driver to fix
    the output schema of the encoding projection.
    """
    row = df.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols]).first()
    return {c: list(row[c]) for c in cols}


def dummies(df: DataFrame, cols: list[str], vocab: dict[str, list[str]] | None = None,
            drop_first: bool = True, keep: list[str] | None = None) -> DataFrame:
    """0/1 columns ``<col>_<level>`` for every level in sorted order; the first
    level dropped (``drop_first``).  Unseen levels -> all zeros."""
    vocab = vocab or vocabulary(df, cols)
    others = [c for c in df.columns if c not in cols] if keep is None else keep
    out = [F.col(c) for c in others]
    for c in cols:
        levels = vocab[c][1:] if drop_first else vocab[c]
        out += [(F.col(c) == F.lit(v)).cast("double").alias(f"{c}_{v}") for v in levels]
    return df.select(*out)


def one_hot(df: DataFrame, cols: list[str], vocab: dict[str, list[str]] | None = None,
            keep: list[str] | None = None) -> DataFrame:
    """All levels kept; an unseen level encodes as all zeros."""
    return dummies(df, cols, vocab, drop_first=False, keep=keep)


# ---------------------------------------------------------------- C10, C11
def monomials(cols: list[str], degree: int, interaction_only: bool = False) -> list[tuple[str, ...]]:
    """All monomials of degree 1..d (no bias), ordered by degree then
    lexicographically by column position."""
    out: list[tuple[str, ...]] = []
    for d in range(1, degree + 1):
        gen = itertools.combinations(cols, d) if interaction_only else itertools.combinations_with_replacement(cols, d)
        out.extend(gen)
    return out


def monomial_name(m: tuple[str, ...]) -> str:
    return "*".join(m)


def poly(df: DataFrame, cols: list[str], degree: int, interaction_only: bool = False,
         keep: list[str] | None = None) -> DataFrame:
    """Polynomial expansion as generated product columns (codegen-friendly)."""
    keep = keep if keep is not None else [c for c in df.columns if c not in cols]
    prods: list[Column] = []
    for m in monomials(cols, degree, interaction_only):
        e = F.col(m[0])
        for c in m[1:]:
            e = e * F.col(c)
        prods.append(e.alias(monomial_name(m)))
    return df.select(*[F.col(c) for c in keep], *prods)
