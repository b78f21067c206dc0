"""Steps that several jobs read are computed once; models that share rows share a pass."""

from dataclasses import replace

import numpy as np

from foldwise.operators import boosting as BO
from foldwise.operators import glm as G
from foldwise.plans import glm_queries, linear_queries
from foldwise.sources import fixtures as fx


def counted(spark, df):
    """``df`` and a counter of its rows computed so far."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(len(b))
            yield b
    return df.mapInPandas(run, df.schema), seen


def rows(spark, n=240):
    rnd = np.random.default_rng(5)
    X, cat = rnd.normal(size=(n, len(fx.T_NUMERIC))), rnd.integers(0, 3, (n, len(fx.T_CATEGORICAL)))
    y = (X[:, 0] + 0.5 * X[:, 1] + rnd.normal(size=n) > 0).astype(int)
    names = ["row_id", "target", *fx.T_NUMERIC, *fx.T_CATEGORICAL]
    data = [(f"r{i}", int(y[i]), *map(float, X[i]), *(f"v{c}" for c in cat[i])) for i in range(n)]
    return spark.createDataFrame(data, names).repartition(3).cache()


def test_boosting_computes_its_rows_once(spark):
    df, seen = counted(spark, rows(spark))
    BO.fit(df, fx.T_NUMERIC, replace(BO.LEVEL, rounds=1, max_depth=1))
    assert seen.value == 240


def test_hold_out_design_computes_its_rows_once(spark):
    df, seen = counted(spark, rows(spark))
    h, feats = glm_queries.holdout_design(df)
    assert h.count() == 240 and h.where("is_test = 1").count() in range(48, 51)
    assert seen.value == 240


def test_regression_folds_compute_their_rows_once(spark, monkeypatch):
    df, seen = counted(spark, rows(spark).select("row_id", "target"))
    monkeypatch.setattr(linear_queries, "r1_units", lambda spark, d: df)
    assert [r["count"] for r in linear_queries._folds(spark, "").groupBy("fold").count().collect()] == [48] * 5
    assert seen.value == 240


def test_newton_models_with_the_same_rows(spark):
    """Optima of models that share features and rows, with weights and subsets, as a
    Newton solver finds them one by one; rows left out may hold nulls."""
    rnd = np.random.default_rng(6)
    n = 300
    X = rnd.normal(size=(n, 3))
    y = (X @ [1.0, -0.5, 0.2] + rnd.normal(size=n) > 0).astype(int)
    w, fold = rnd.uniform(0.5, 2, n), np.arange(n) % 3
    data = [(int(y[i]), int(fold[i]), float(w[i]), *map(float, X[i])) for i in range(n)] + [(1, 9, None, None, None, None)]
    df = spark.createDataFrame(data, "target int, fold int, w double, a double, b double, c double").repartition(4)
    specs = [G.LogitSpec((C, fo, wt, len(fs)), fs, C, [("fold", "!=", fo), ("fold", "!=", 9)], weight=wt)
             for C in (0.1, 1.0, 10.0) for fo in (0, 1) for wt in (None, "w") for fs in (["a", "b", "c"], ["c", "a"])]
    fits = G.newton_logistic(df, specs)
    for s in specs:
        keep = fold != s.subset[0][2]
        D = np.column_stack([np.ones(keep.sum()), *[X[keep, "abc".index(f)] for f in s.features]])
        sw, beta, reg = w[keep] if s.weight else np.ones(keep.sum()), np.zeros(D.shape[1]), np.diag([0.0] + [1.0] * len(s.features))
        for _ in range(30):
            p = 1 / (1 + np.exp(-D @ beta))
            beta -= np.linalg.solve(s.C * (D.T * (p * (1 - p) * sw)) @ D + reg, s.C * D.T @ ((p - y[keep]) * sw) + reg @ beta)
        coef, b0 = fits[s.key]
        assert np.allclose([b0, *coef], beta, atol=1e-6)
