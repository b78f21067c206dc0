"""Histogram boosting against plain loops, and its invariants."""

import math
from dataclasses import replace

import numpy as np
import pytest

import __spark_entry__ as E
from foldwise.operators import boosting as B

FEATURES = ["a", "b", "c"]


def rows(n=700, seed=0):
    rng = np.random.default_rng(seed)
    X = np.stack([rng.integers(0, 9, n), rng.normal(0, 1, n).round(3), rng.integers(0, 2, n)], 1).astype(float)
    y = (X[:, 0] / 4 + X[:, 1] * X[:, 2] + rng.normal(0, 0.7, n) > 1.2).astype(int)
    return X, y


def frame(spark, X, y, parts=5):
    df = spark.createDataFrame([(i, int(t), *map(float, x)) for i, (x, t) in enumerate(zip(X, y))], "row_id long, target int, a double, b double, c double")
    return df.repartition(parts)


def plain(X, y, p):
    """Every split of every open leaf from sums over its rows; one leaf opened at a time."""
    cuts = []
    for x in X.T:
        v = np.unique(x)
        cuts.append((v[1:] + v[:-1]) / 2 if len(v) <= p.max_bins else np.unique(np.percentile(x, [100 * k / p.max_bins for k in range(1, p.max_bins)])))
    margin = np.full(len(y), math.log(y.sum() / (len(y) - y.sum())))
    trees = []
    for _ in range(p.rounds):
        pr = 1 / (1 + np.exp(-margin))
        g, h = np.rint((pr - y) * B.SCALE) / B.SCALE, np.rint(pr * (1 - pr) * B.SCALE) / B.SCALE

        def best(at):
            top = None
            part = lambda r: g[r].sum() ** 2 / (h[r].sum() + p.reg_lambda)
            for f in range(X.shape[1]):
                for c in cuts[f]:
                    left, right = at[X[at, f] <= c], at[X[at, f] > c]
                    if min(len(left), len(right)) < max(p.min_rows, 1) or min(h[left].sum(), h[right].sum()) < p.min_hessian:
                        continue
                    gain = part(left) + part(right) - part(at)
                    if gain > 1e-6 and (top is None or gain > top[0] + 1e-9):
                        top = gain, f, c, left, right
            return top

        leaves, out = {"": (np.arange(len(y)), best(np.arange(len(y))))}, {}
        while True:
            able = {k: v for k, v in leaves.items() if v[1] and len(k) < (p.max_depth or 99)}
            if not able or p.growth == "leaf" and len(leaves) >= p.max_leaves:
                break
            k = max(able, key=lambda k: able[k][1][0]) if p.growth == "leaf" else min(able, key=lambda k: (len(k), k))
            gain, f, c, left, right = leaves.pop(k)[1]
            out[k] = (FEATURES[f], c, gain)
            leaves[k + "L"], leaves[k + "R"] = (left, best(left)), (right, best(right))
        for k, (at, _) in leaves.items():
            out[k] = -p.rate * g[at].sum() / (h[at].sum() + p.reg_lambda)
            margin[at] += out[k]
        trees.append(out)
    return trees, 1 / (1 + np.exp(-margin))


CASES = {"leaf": replace(B.LEAF, rounds=5, max_leaves=7, refresh=2), "level": replace(B.LEVEL, rounds=4, max_depth=3, refresh=3),
         "bins": replace(B.LEAF, rounds=3, max_leaves=6, max_bins=16, min_rows=5), "deep": replace(B.LEVEL, rounds=2, max_depth=9, min_hessian=0.1)}


@pytest.mark.parametrize("case", CASES)
def test_trees_equal_plain_loops(spark, case):
    p = CASES[case]
    X, y = rows(seed=len(case))
    model = B.fit(frame(spark, X, y), FEATURES, p)
    want, scores = plain(X, y, p)
    got = [{} for _ in model.trees]
    for k, _, path, feature, threshold, gain, _, value in B.nodes(model):
        got[k][path] = value if feature is None else (feature, threshold, gain)
    assert [sorted(t) for t in got] == [sorted(t) for t in want]
    for a, b in zip(got, want):
        for path, v in b.items():
            if isinstance(v, tuple):
                assert a[path][0] == v[0] and a[path][1:] == pytest.approx(v[1:], rel=1e-6)
            else:
                assert a[path] == pytest.approx(v, abs=1e-9)
    s = {r["row_id"]: r["score"] for r in B.score(frame(spark, X, y), model, ["row_id"]).collect()}
    assert [s[i] for i in range(len(y))] == pytest.approx(scores.tolist(), abs=1e-9)


def test_layout_does_not_matter(spark):
    X, y = rows(900)
    p = replace(B.HISTOGRAM, rounds=4, max_leaves=8, refresh=2)
    one, many = (B.fit(frame(spark, X, y, k), FEATURES, p) for k in (1, 7))
    assert B.nodes(one) == B.nodes(many)


def test_early_stopping(spark):
    assert not B.stopped([3, 2, 1], 3, 0) and B.stopped([1, 2, 2, 2], 3, 0) and not B.stopped([1, 2, 2, 0.5], 3, 0)
    assert B.stopped([1.0, 1.0, 1.0 - 1e-9], 2, 1e-7)
    rng = np.random.default_rng(1)
    X, y = rng.normal(0, 1, (10_400, 3)), rng.integers(0, 2, 10_400)   # nothing to learn
    model = B.fit(frame(spark, X, y), FEATURES, replace(B.HISTOGRAM, rounds=60, max_leaves=4, patience=2))
    assert len(model.trees) < 60 and len(model.losses) == len(model.trees) + 1
    assert model.losses[0] == pytest.approx(math.log(2), abs=0.01)


def test_edges(spark):
    X, y = rows(60)
    df = frame(spark, X, y)
    one = B.fit(df.withColumn("target", df.target * 0 + 1), FEATURES, B.LEAF)
    assert not one.trees and all(r["score"] > 0.99 for r in B.score(df, one, ["row_id"]).collect())
    assert not B.fit(df.limit(0), FEATURES, B.LEAF).trees
    few = B.fit(df, FEATURES, replace(B.LEAF, rounds=2, min_rows=31))   # no split leaves 31 rows on both sides
    assert [t.feature for t in few.trees] == [[-1], [-1]]
    holes = spark.createDataFrame([(i, int(i % 3 == 0), None if i % 3 == 0 else float(i), 1.0, 1.0) for i in range(90)], "row_id long, target int, a double, b double, c double")
    model = B.fit(holes, FEATURES, replace(B.LEAF, rounds=1, max_leaves=2))
    assert model.trees[0].feature[0] == 0   # a missing value lies above every cut
    assert model.importance("split").tolist() == [1, 0, 0] and model.importance()[0] > 0


