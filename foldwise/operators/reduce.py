"""Dimensionality reduction from one covariance pass.

The covariance of the standardised features comes from the per-group
Gram (one distributed aggregation, p x p to the driver); the
eigen-decomposition is p x p algebra; projections, reconstructions and
whitening are generated column expressions evaluated by Spark, so every
component count of a sweep reuses the same decomposition.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.operators import linear as L


class PCAFit:
    """Mean, scale and eigen-pairs of a standardised covariance."""

    def __init__(self, cols, mean, scale, evals, evecs, n):
        self.cols, self.mean, self.scale = cols, mean, scale
        self.evals, self.evecs, self.n = evals, evecs, n

    def ratio(self) -> np.ndarray:
        return self.evals / self.evals.sum()


def covariance(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{group: (n, mean, centred cross-product matrix)} from one Gram pass."""
    d = df.withColumn("_g", F.lit(0)) if group is None else df.withColumn("_g", F.col(group))
    d = d.withColumn("_y0", F.lit(0.0))
    grams = L.gram_arrays(d, cols, "_y0", by="_g")
    out = {}
    for g, G in grams.items():
        n, mx, _, Cxx, _, _ = L._moments(G)
        out[g] = (n, mx, Cxx)
    return out


def pca_fit(df: DataFrame, cols: list[str], standardise: bool = True) -> PCAFit:
    """Standardise (population std), eigen-decompose the sample covariance
    (divisor n-1); components sorted by variance, sign fixed so the largest
    |loading| of each component is positive."""
    n, mx, Cxx = covariance(df, cols)[0]
    sd = np.sqrt(np.maximum(np.diag(Cxx) / n, 0.0)) if standardise else np.ones(len(cols))
    sd = np.where(sd == 0, 1.0, sd)
    C = Cxx / np.outer(sd, sd) / (n - 1)
    evals, evecs = np.linalg.eigh(C)
    order = np.argsort(evals)[::-1]
    evals, evecs = np.maximum(evals[order], 0.0), evecs[:, order]
    for j in range(evecs.shape[1]):
        i = np.argmax(np.abs(evecs[:, j]))
        if evecs[i, j] < 0:
            evecs[:, j] = -evecs[:, j]
    return PCAFit(cols, mx, sd, evals, evecs, n)


def project(df: DataFrame, fit: PCAFit, k: int, keep: list[str], whiten: bool = False) -> DataFrame:
    """Component scores pc1..pck: one NumPy matmul per Arrow batch with the
    (p x k) loadings broadcast (no wide generated expressions)."""
    import pandas as pd
    from pyspark.sql import types as T
    W = fit.evecs[:, :k] / (np.sqrt(fit.evals[:k]) if whiten else 1.0)
    bc = df.sparkSession.sparkContext.broadcast((fit.mean, fit.scale, W))
    cols = fit.cols

    def run(batches):
        mean, scale, Wm = bc.value
        for b in batches:
            Z = (b[cols].to_numpy(dtype=np.float64) - mean) / scale
            S = Z @ Wm
            out = b[keep].copy()
            for j in range(S.shape[1]):
                out[f"pc{j + 1}"] = S[:, j]
            yield out

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"pc{j + 1}", T.DoubleType()) for j in range(k)])
    return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)


def reconstruction_errors(df: DataFrame, fit: PCAFit, ns: list[int]) -> dict:
    """||Z - Z_n||_F for every n in one pass: per row |z|^2 minus the running
    sum of squared scores, summed per n inside tasks."""
    import pandas as pd
    bc = df.sparkSession.sparkContext.broadcast((fit.mean, fit.scale, fit.evecs))
    cols = fit.cols

    def run(batches):
        mean, scale, V = bc.value
        acc = np.zeros(len(ns))
        for b in batches:
            Z = (b[cols].to_numpy(dtype=np.float64) - mean) / scale
            S2 = np.cumsum((Z @ V) ** 2, axis=1)
            z2 = (Z * Z).sum(axis=1)
            for t, n in enumerate(ns):
                acc[t] += float((z2 - S2[:, n - 1]).sum())
        yield pd.DataFrame({"t": list(range(len(ns))), "r": acc})

    rows = df.select(*cols).mapInPandas(run, "t int, r double").groupBy("t").agg(F.sum("r").alias("r")).collect()
    return {ns[r["t"]]: float(np.sqrt(max(r["r"], 0.0))) for r in rows}


def kernel_pca_project(df: DataFrame, train: DataFrame, landmarks: np.ndarray, cols: list[str], kernel: str, k: int,
                       keep: list[str], gamma: float | None = None, degree: int = 3,
                       coef0: float = 1.0) -> DataFrame:
    """Kernel PCA through a Nystrom map.

    The m landmark rows (a parameter, not the row count) span the feature
    space: a row's map is its kernel row against them times the inverse root
    of their own kernel.  Centre and covariance of the mapped rows come from
    one Gram pass over all ``train`` rows, and the components are that
    covariance's.  Exact where the landmarks span the train rows, as they do
    for the linear kernel with m >= p, and when they are the train set."""
    import pandas as pd
    from pyspark.sql import types as T
    gamma = gamma if gamma is not None else 1.0 / len(cols)

    def kern(A, B):
        if kernel == "linear":
            return A @ B.T
        if kernel == "rbf":
            d = (A * A).sum(1)[:, None] + (B * B).sum(1)[None, :] - 2 * A @ B.T
            return np.exp(-gamma * np.maximum(d, 0.0))
        if kernel == "poly":
            return (gamma * (A @ B.T) + coef0) ** degree
        raise ValueError(kernel)

    ev, V = np.linalg.eigh(kern(landmarks, landmarks))
    span = ev > max(ev[-1], 0) * 1e-10
    root = V[:, span] / np.sqrt(ev[span])
    if root.shape[1] < k:
        raise ValueError("the landmarks span fewer than k directions")

    def mapped(X):
        return kern(X, landmarks) @ root

    part = train.select(*cols, F.lit(0).alias("_g"), F.lit(0.0).alias("_y0"))
    G = L.gram_blocks(part, cols, "_y0", "_g", mapped, root.shape[1])[0]
    n, mean, _, C, _, _ = L._moments(G)
    var, U = np.linalg.eigh(C / max(n - 1, 1))
    U = U[:, np.argsort(var)[::-1][:k]]
    U = U * np.where(U[np.abs(U).argmax(axis=0), np.arange(k)] < 0, -1.0, 1.0)
    bc = df.sparkSession.sparkContext.broadcast((root @ U, mean @ U, landmarks))

    def run(batches):
        A, centre, Lm = bc.value
        for b in batches:
            S = kern(b[cols].to_numpy(dtype=np.float64), Lm) @ A - centre
            out = b[keep].copy()
            for j in range(S.shape[1]):
                out[f"kp{j + 1}"] = S[:, j]
            yield out

    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(f"kp{j + 1}", T.DoubleType()) for j in range(k)])
    return df.select(*keep, *[c for c in cols if c not in keep]).mapInPandas(run, schema)
