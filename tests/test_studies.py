"""What the studies must not depend on: test rows, layout, table size."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.operators import cluster as CL
from foldwise.operators import extra_trees as ET
from foldwise.operators import glm as G
from foldwise.operators import linear as L
from foldwise.operators import sgd as SGD
from foldwise.operators import split as S
from foldwise.plans import glm_queries as Q
from foldwise.session import checkpoint_dir
from foldwise.sources import fixtures as fx

from small_tables import SF_SMALL


@pytest.mark.parametrize("center", [True, False])
def test_scaler_ignores_test_rows(spark, center):
    t1 = fx.t1(spark, SF_SMALL)
    test_ids = S.holdout(t1, 0.2, 0, by="target").where("is_test = 1").select("row_id")
    other = t1.join(test_ids.withColumn("_t", F.lit(1)), "row_id", "left").withColumn(
        "l_extendedprice", F.when(F.col("_t") == 1, F.col("l_extendedprice") * 1000).otherwise(F.col("l_extendedprice"))).drop("_t")
    a, b = (Q.holdout_design(d, center=center)[0].where("is_test = 0").select("row_id", "l_extendedprice").orderBy("row_id").toPandas() for d in (t1, other))
    assert np.allclose(a["l_extendedprice"], b["l_extendedprice"], atol=1e-9)


def test_scaled_penalty_equals_a_fit_on_standardised_rows(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, 1]
    y = (X @ [1, 0.3, -2] + rng.normal(size=400) > 0).astype(int)
    df = spark.createDataFrame([(i, int(y[i]), i % 4, *map(float, X[i])) for i in range(400)], "row_id long, target int, fold int, a double, b double, c double")
    cols, sub = ["a", "b", "c"], ("fold", "!=", 1)
    scale = G.subset_scales(df, cols, cols, {"m": sub})["m"]
    coef, b0 = G.newton_logistic(df, [G.LogitSpec("m", cols, 0.1, sub, scale=scale)])["m"]
    own = df.where("fold <> 1").select("row_id", "target", *[((F.col(c) - float(X[np.arange(400) % 4 != 1][:, j].mean())) / float(scale[j])).alias(c) for j, c in enumerate(cols)])
    direct, d0 = G.newton_logistic(own, [G.LogitSpec("m", cols, 0.1)])["m"]
    assert np.allclose(coef * scale, direct, atol=1e-6)


def test_sgd_does_not_depend_on_partitions(spark):
    h, feats = Q.holdout_design(fx.t1(spark, SF_SMALL), center=False)
    h = h.cache()
    w = [SGD.fit(h.repartition(n), feats, [SGD.Cell("log_loss", "optimal"), SGD.Cell("hinge", "constant")], epochs=2, tol=None, batch_size=64,
                 train_filter=F.col("is_test") == 0)[0] for n in (2, 7)]
    assert np.abs(w[0] - w[1]).max() < 1e-9


def test_minibatch_updates_have_their_size_at_any_table_size(spark):
    rng = np.random.default_rng(1)
    small = rng.normal(size=(300, 2)) + 8 * rng.integers(0, 2, (300, 1))
    for rep in (1, 12):
        df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(np.tile(small, (rep, 1)))], "row_id long, x double, y double")
        C = CL.minibatch_kmeans(df, ["x", "y"], 2, batch_size=64, n_batches=20, n_init=2)
        assert len(C) == 2
        for c in C:
            assert np.allclose(sorted(c[:, 0]), [0, 8], atol=0.8)


def test_silhouette_matches_all_pairs(spark):
    rng = np.random.default_rng(3)
    X, lab = rng.normal(size=(60, 2)), rng.integers(0, 4, 60)
    lab[0] = 9  # a singleton
    d = ((X[:, None] - X[None]) ** 2).sum(axis=2)
    want = []
    for i in range(60):
        own = (lab == lab[i]) & (np.arange(60) != i)
        a = d[i, own].mean() if own.any() else None
        b = min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        want.append(0.0 if a is None else (b - a) / max(a, b))
    df = spark.createDataFrame([(i, int(lab[i]), float(X[i, 0]) + 1e6, float(X[i, 1])) for i in range(60)], "row_id long, label int, x double, y double")
    got = {r.row_id: r.silhouette for r in CL.silhouette(df, ["x", "y"], per_row=True).collect()}
    assert np.allclose([got[i] for i in range(60)], want, atol=1e-6)


def test_tsqr_singular_values(spark):
    rng = np.random.default_rng(4)
    X = rng.normal(size=(500, 3))
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], "row_id long, a double, b double, c double")
    expand = lambda Z: np.hstack([Z, Z ** 2])
    R = L.tsqr(df, ["a", "b", "c"], expand, 6, rows_per_group=60, fan_in=3)
    assert np.allclose(np.linalg.svd(R, compute_uv=False), np.linalg.svd(expand(X), compute_uv=False))


def test_shared_folder_is_required_off_local(spark):
    class Off:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError):
        checkpoint_dir(Off)


def test_extra_trees_learn_and_ignore_layout(spark):
    rng = np.random.default_rng(6)
    X = rng.normal(size=(600, 4))
    y = ((X[:, 0] > 0) ^ (X[:, 1] > 0)).astype(int)
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, int(y[i]), *map(float, X[i])) for i in range(600)], "row_id long, target int, a double, b double, c double, d double")
    one = ET.fit(df.where("row_id < 400"), cols, n_trees=20, max_depth=8)
    two = ET.fit(df.where("row_id < 400").repartition(5), cols, n_trees=20, max_depth=8)
    assert (one.feature == two.feature).all() and np.allclose(one.threshold, two.threshold)
    got = {r.row_id: r.score for r in ET.score(df, one, cols, ["row_id"]).collect()}
    assert np.mean([(got[i] > 0.5) == y[i] for i in range(400, 600)]) > 0.85
    # leaves hold their rows' share of positives
    leaf = one.leaves(X[:400], 0)
    for n in np.unique(leaf):
        assert np.isclose(one.value[n], y[:400][leaf == n].mean())
