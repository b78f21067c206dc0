"""Generalised linear models on Spark ML with the reference's parameter
conventions (SURVEY F8-F14).

Spark's objective is mean loss + regParam * penalty; the reference's is
C * summed loss + 1/2 |w|^2.  Dividing by C*n gives regParam = 1/(C*n)
with n the *training* row count (or the sum of weights).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, OneVsRest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)


def logistic(train: DataFrame, cols: list[str], C: float = 1.0, label: str = "target",
             weight: str | None = None, family: str = "binomial", n: float | None = None,
             max_iter: int = 200):
    """L2 logistic regression, free intercept, C-parameterised."""
    if n is None:
        n = train.agg(F.sum(F.col(weight)) if weight else F.count(F.lit(1))).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * n), elasticNetParam=0.0,
                            standardization=False, maxIter=max_iter, tol=1e-8, family=family)
    if weight:
        lr = lr.setWeightCol(weight)
    return lr.fit(assemble(train, cols))


def glm_irls(train: DataFrame, cols: list[str], label: str = "target", reg: float = 0.0, max_iter: int = 50):
    """IRLS logistic (GeneralizedLinearRegression, binomial/logit)."""
    g = GeneralizedLinearRegression(family="binomial", link="logit", featuresCol="features", labelCol=label,
                                    regParam=reg, maxIter=max_iter, tol=1e-8)
    return g.fit(assemble(train, cols))


def one_vs_rest(train: DataFrame, cols: list[str], C: float = 1.0, label: str = "target"):
    n = train.count()
    base = LogisticRegression(featuresCol="features", labelCol=label, regParam=1.0 / (C * n),
                              standardization=False, maxIter=200, tol=1e-8)
    return OneVsRest(classifier=base, featuresCol="features", labelCol=label).fit(assemble(train, cols))


def ovr_normalised_proba(model, df: DataFrame, cols: list[str], k: int) -> DataFrame:
    """One-vs-rest emits margins only: sigmoid each class margin, normalise to sum 1."""
    t = model.transform(assemble(df, cols))
    raw = vector_to_array("rawPrediction")
    sig = F.transform(raw, lambda m: 1.0 / (1.0 + F.exp(-m)))
    tot = F.aggregate(sig, F.lit(0.0), lambda a, x: a + x)
    return t.withColumn("proba", F.transform(sig, lambda x: x / tot)).drop("features", "rawPrediction")


def class_balanced_weights(df: DataFrame, label: str = "target", out: str = "w") -> DataFrame:
    """n / (K * n_class) per row, from a per-class count table (K rows, broadcast)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    cw = counts.withColumn("_o", F.lit(1)).join(tot.withColumn("_o", F.lit(1)), "_o").select(
        label, (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    return df.join(F.broadcast(cw), label)


# ------------------------------------------------------------------ batched Newton solver
def _conds(subset) -> list:
    """Normalise a subset spec: None, one (col, op, value) or a list of them (AND)."""
    if subset is None:
        return []
    return [subset] if isinstance(subset, tuple) else list(subset)


class LogitSpec:
    """One L2 logistic model of a batch: C * sum(w_i * loss_i) + 1/2 |beta|^2
    (intercept free) over the rows where ``subset`` holds.

    subset: (column, op, value) with op in {"==", "!="}, or None for all rows.
    scale: per-feature factors whose squares weigh the penalty.  With the
    standard deviations of the feature columns over the model's own rows
    the fit equals one on features standardised on those rows only (the
    shift goes into the free intercept), so folds share one design.
    """

    def __init__(self, key, features: list[str], C: float = 1.0, subset=None, weight: str | None = None,
                 loss: str = "log", penalize_intercept: bool = False, scale=None):
        self.key, self.features, self.C, self.subset, self.weight = key, list(features), float(C), subset, weight
        self.loss, self.penalize_intercept = loss, penalize_intercept
        self.scale = np.ones(len(self.features)) if scale is None else np.asarray(scale, dtype=float)


def subset_scales(df: DataFrame, features: list[str], scaled: list[str], subsets: dict) -> dict:
    """Per key the population standard deviations of ``features`` over the rows of
    its subset (1 for constant columns and for those not in ``scaled``), all
    from one aggregation."""
    aggs, names = [], []
    for i, (k, sub) in enumerate(subsets.items()):
        cond = F.lit(True)
        for col, op, val in _conds(sub):
            cond = cond & ((F.col(col) == val) if op == "==" else (F.col(col) != val))
        for c in scaled:
            aggs.append(F.stddev_pop(F.when(cond, F.col(c))).alias(f"s{i}_{c}"))
            names.append((k, c, f"s{i}_{c}"))
    row = df.agg(*aggs).first()
    out = {k: {} for k in subsets}
    for k, c, n in names:
        out[k][c] = row[n] or 1.0
    return {k: np.array([v.get(c, 1.0) for c in features]) for k, v in out.items()}


def _derivatives(z, y, sw, loss):
    """Per row the factors of its features in the gradient and of their products in the Hessian."""
    if loss == "squared_hinge":          # labels to +-1; generalised Hessian
        ys = 2 * y - 1
        viol = np.maximum(0.0, 1 - ys * z)
        return -2 * ys * viol * sw, (viol > 0) * sw * 2
    p = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
    return (p - y) * sw, p * (1 - p) * sw


def _add_sums(acc: dict, b: pa.RecordBatch, feats, groups) -> None:
    """Add the batch's gradient and Hessian of models with the same features to
    ``acc``; ``groups`` are (subset, models).  Rows that belong to the same
    subsets are met together: their products of columns are made once."""
    def column(c):
        return b.column(c).to_numpy(zero_copy_only=False)

    member = np.ones((len(groups), b.num_rows), dtype=bool)
    for m, (subset, _) in zip(member, groups):
        for col, op, val in subset:
            v = column(col)
            m &= (v == val) if op == "==" else (v != val)
    kinds, kind = np.unique(np.packbits(member, axis=0), axis=1, return_inverse=True)
    kind = kind.ravel()
    XT = np.ones((len(feats) + 1, b.num_rows))
    for i, c in enumerate(feats):
        XT[i + 1] = column(c)
    p, y = len(XT), column("_y")
    weights = {w: column(w).astype(np.float64) for w in {w for _, models in groups for _, w, _, _ in models} if w}
    one, two = np.triu_indices(p)
    step = max(256, (1 << 19) // len(one))
    for k in range(kinds.shape[1]):
        at = np.flatnonzero(kind == k)
        models = [m for has, (_, own) in zip(member[:, at[0]], groups) if has for m in own]
        if not models:
            continue
        B = np.stack([bt for _, _, bt, _ in models])
        for s in range(0, len(at), step):
            rows = at[s:s + step]
            X, yr = XT[:, rows], y[rows]
            Z = B @ X
            der = [_derivatives(z, yr, weights[w][rows] if w else 1.0, loss) for z, (_, w, _, loss) in zip(Z, models)]
            G = X @ np.stack([g for g, _ in der], 1)
            if len(models) == 1:
                H = [(X * der[0][1]) @ X.T]
            else:
                half = (X[one] * X[two]) @ np.stack([h for _, h in der], 1)
                H = np.empty((len(models), p, p))
                H[:, one, two] = H[:, two, one] = half.T
            for i, (key, *_) in enumerate(models):
                a = acc.setdefault(key, [0, 0])
                a[0], a[1] = a[0] + G[:, i], a[1] + H[i]


def newton_logistic(df: DataFrame, specs: list[LogitSpec], label: str = "target", max_iter: int = 100,
                    tol: float = 1e-7) -> dict:
    """Fit many L2 logistic models with one data pass per Newton iteration.

    Every task accumulates, for every still-active model, the gradient and
    Hessian of its own rows and features (NumPy on Arrow batches; models of
    the same features share the products of the columns, whatever their rows) and
    emits one serialized partial per model; partials are summed with
    treeReduce and the driver takes the Newton step (p+1 sized systems).
    The result is the optimum of the penalised likelihood to ``tol``; a model
    that has not converged after ``max_iter`` passes is an error.
    Returns {key: (coef array, intercept)}."""
    cols = sorted({c for s in specs for c in s.features} | {c for s in specs for c, _, _ in _conds(s.subset)}
                  | {s.weight for s in specs if s.weight})
    base = df.select(F.col(label).cast("double").alias("_y"), *[F.col(c) for c in cols]).cache()
    beta = {s.key: np.zeros(len(s.features) + 1) for s in specs}
    active = {s.key for s in specs}
    by_key = {s.key: s for s in specs}
    sc = df.sparkSession.sparkContext
    for _ in range(max_iter):
        if not active:
            break
        groups: dict = {}
        for k in active:
            m = by_key[k]
            groups.setdefault(tuple(m.features), {}).setdefault(tuple(_conds(m.subset)), []).append((k, m.weight, beta[k], m.loss))
        bc = sc.broadcast([(feats, list(g.items())) for feats, g in groups.items()])

        def part(batches):
            acc: dict = {}
            for b in batches:
                for feats, own in bc.value:
                    if b.num_rows:
                        _add_sums(acc, b, feats, own)
            for k, (g, H) in acc.items():
                yield pa.RecordBatch.from_arrays([pa.array([str(k)]), pa.array([g.tobytes()], pa.binary()), pa.array([H.tobytes()], pa.binary())], ["key", "g", "h"])

        parts = base.mapInArrow(part, "key string, g binary, h binary")
        sizes = {str(k): len(beta[k]) for k in active}

        def to_dict(r):
            m = sizes[r["key"]]
            return {r["key"]: (np.frombuffer(r["g"]).copy(), np.frombuffer(r["h"]).reshape(m, m).copy())}

        def merge(a, b):
            for k, (g, H) in b.items():
                if k in a:
                    a[k] = (a[k][0] + g, a[k][1] + H)
                else:
                    a[k] = (g, H)
            return a

        tot = parts.rdd.map(to_dict).treeReduce(merge, depth=2)
        bc.unpersist()
        for k in list(active):
            g, H = tot[str(k)]
            C = by_key[k].C
            # a free intercept has no penalty
            reg = np.diag(np.concatenate([[1.0 if by_key[k].penalize_intercept else 0.0], by_key[k].scale ** 2]))
            grad = C * g + reg @ beta[k]
            hess = C * H + reg
            step = np.linalg.solve(hess, grad)
            big = np.max(np.abs(step))
            if big > 20.0:                        # damp early steps on near-separable data
                step = step * (20.0 / big)
            beta[k] = beta[k] - step
            if np.max(np.abs(step)) < tol * max(1.0, np.max(np.abs(beta[k]))):
                active.discard(k)
    base.unpersist()
    if active:
        raise ValueError(f"no convergence after {max_iter} passes: {sorted(map(str, active))}")
    return {k: (b[1:], b[0]) for k, b in beta.items()}


def logit_score(df: DataFrame, features: list[str], coef, intercept, out: str = "score"):
    """P(y=1) as a Spark expression of the fitted coefficients."""
    z = F.lit(float(intercept))
    for c, w in zip(features, coef):
        z = z + F.col(c) * float(w)
    return df.withColumn(out, 1.0 / (1.0 + F.exp(-z)))


def batch_accuracy(test: DataFrame, fits: dict, features: dict, label: str = "target",
                   subsets: dict | None = None) -> dict:
    """Accuracy (threshold 0.5) of many fitted logistic models in one aggregation.
    ``subsets`` optionally restricts each model to rows where (col, op, value) holds."""
    aggs = []
    keys = list(fits)
    for i, k in enumerate(keys):
        coef, b0 = fits[k]
        z = F.lit(float(b0))
        for c, w in zip(features[k], coef):
            z = z + F.col(c) * float(w)
        hit = ((z > 0).cast("int") == F.col(label)).cast("double")
        if subsets and subsets.get(k):
            cond = F.lit(True)
            for col, op, val in _conds(subsets[k]):
                cond = cond & ((F.col(col) == val) if op == "==" else (F.col(col) != val))
            hit = F.when(cond, hit)
        aggs.append(F.avg(hit).alias(f"a{i}"))
    row = test.agg(*aggs).first()
    return {k: row[f"a{i}"] for i, k in enumerate(keys)}
