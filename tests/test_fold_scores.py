"""Margins of all keys from one pass; models of overlapping subsets share products."""

import numpy as np
import pyarrow as pa

from foldwise.functions.ordered import running_before
from foldwise.operators import glm as G
from foldwise.plans.glm_queries import _fold_scores


def test_fold_scores_in_one_pass(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 2))
    df = spark.createDataFrame([(i % 3, i % 2, float(a), float(b)) for i, (a, b) in enumerate(x)], "fold int, target int, a double, b double")
    fits = {(c, f): (rng.normal(size=2), float(rng.normal())) for c in (0.1, 1.0) for f in range(3)}
    out = _fold_scores(df, fits, ["a", "b"])
    got = sorted((r["key"], r["fold"], r["y"], r["score"]) for r in out.collect())
    want = sorted((c, i % 3, i % 2, fits[c, i % 3][1] + a * fits[c, i % 3][0][0] + b * fits[c, i % 3][0][1]) for c in (0.1, 1.0) for i, (a, b) in enumerate(x.tolist()))
    assert got == want
    assert "Union" not in out._jdf.queryExecution().toString()      # the rows are read once for all keys


def test_sums_of_overlapping_subsets():
    rng = np.random.default_rng(5)
    n = 700
    cols = {"a": rng.normal(size=n), "b": rng.normal(size=n), "fold": np.arange(n) % 4, "_y": (rng.random(n) < 0.4).astype(float)}
    batch = pa.RecordBatch.from_pydict(cols)
    groups = [((("fold", "!=", f),), [((c, f), None, rng.normal(size=3), "log") for c in (1, 2)]) for f in range(4)]
    acc = {}
    G._add_sums(acc, batch, ("a", "b"), groups)
    X = np.stack([np.ones(n), cols["a"], cols["b"]], 1)
    for (subset, models) in groups:
        m = cols["fold"] != subset[0][2]
        for key, _, beta, _ in models:
            p = 1 / (1 + np.exp(-X[m] @ beta))
            assert np.allclose(acc[key][0], X[m].T @ (p - cols["_y"][m]))
            assert np.allclose(acc[key][1], (X[m] * (p * (1 - p))[:, None]).T @ X[m])


def test_running_before_counts_cuts_in_steps(spark):
    v = [None, float("nan"), -0.0, 0.0] + [float(i % 97) / 7 for i in range(400)]
    df = spark.createDataFrame([(1, x) for x in v] + [(2, 5.0)], "g int, s double").groupBy("g", "s").count()
    out = running_before(df, ["g"], "s", ["count"])
    assert "lambda" not in out._jdf.queryExecution().toString()     # compiled comparisons
    for r in out.where("g = 1 and s >= 0 and s < 1000").collect():
        assert r["count_before"] == sum(x is None or x < r["s"] for x in v)
