"""Operator invariants and brute-force cross-checks on the sf0.001 tables."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldwise.functions.keys import global_rank
from foldwise.functions.quantiles import exact_quantiles
from foldwise.operators import knn as KN
from foldwise.operators import split as S
from foldwise.sources import fixtures as fx

from small_tables import SF_SMALL


def test_global_rank_equals_row_number(spark):
    df = fx.n1(spark, SF_SMALL).withColumn("k", F.md5(F.col("row_id").cast("string")))
    a = global_rank(df, "k", "row_id", out="r").select("row_id", "r")
    b = df.select("row_id", F.row_number().over(Window.orderBy("k", "row_id")).alias("r"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_folds_partition_rows_and_balance(spark):
    n1 = fx.n1(spark, SF_SMALL)
    f = S.kfold(n1, 5, 0, by="target").toPandas()
    assert len(f) == n1.count() and f.row_id.is_unique
    sizes = f.groupby("fold").size()
    assert sizes.max() - sizes.min() <= 1
    per_class = f.groupby(["target", "fold"]).size().groupby("target")
    assert all((g.max() - g.min()) <= 1 for _, g in per_class)


def test_exact_quantiles_match_numpy(spark):
    r1 = fx.r1(spark, SF_SMALL)
    q = exact_quantiles(r1, ["l_extendedprice", "l_quantity"], [0.1, 0.25, 0.5, 0.9]).toPandas()
    pdf = r1.select("l_extendedprice", "l_quantity").toPandas()
    for _, row in q.iterrows():
        expect = np.percentile(pdf[row["column"]].to_numpy(), row["p"] * 100)
        assert row["q"] == pytest.approx(expect, rel=1e-12)


@pytest.mark.parametrize("metric", ["euclidean", "manhattan", "minkowski_p3"])
def test_knn_strategies_match_brute_force(spark, metric):
    n2 = fx.n2(spark, SF_SMALL)
    feats = fx.N2_FEATURES
    pdf = n2.select("row_id", "target", *feats).toPandas().sort_values("row_id")
    X = (pdf[feats].to_numpy() - pdf[feats].to_numpy().mean(0)) / pdf[feats].to_numpy().std(0)
    sc = spark.createDataFrame(
        [(int(i), int(t), *map(float, x)) for i, t, x in zip(pdf.row_id, pdf.target, X)],
        ["row_id", "target", *feats])
    k = 7
    p = KN.METRICS[metric]
    D = KN._np_dist(X, X, p)
    expect = {}
    ids = pdf.row_id.to_numpy()
    for i in range(len(ids)):
        order = np.lexsort((ids, D[i]))[:k]
        expect[int(ids[i])] = [int(ids[j]) for j in order]
    for sizes in ({}, {"cell_rows": 16}, {"cell_rows": 5, "tile_rows": 3}, {"tile_rows": 10}):
        nb = KN.knn_join(sc, sc, feats, k, metric, **sizes).toPandas()
        got = {int(q): list(g.sort_values("rank").tid.astype(int)) for q, g in nb.groupby("qid")}
        assert got == expect, sizes


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0])
def test_knn_tiles_pass_over_far_leaves(monkeypatch, p):
    """Same rows as from all distances, ties included, from few of the distances."""
    rnd = np.random.default_rng(1)
    X = np.round(np.concatenate([rnd.normal(size=(3000, 4)), rnd.normal(size=(1000, 4)) * 3]), 1)
    X[100:140] = X[100]
    Q, k = np.concatenate([X[:500], rnd.normal(size=(300, 4))]), 7
    D = KN._np_dist(Q, X, p)
    cols, vals = KN._topk_rows(D, k)
    expect = {i: list(zip(c, v)) for i, (c, v) in enumerate(zip(cols.tolist(), vals.tolist()))}
    done, plain = [], KN._np_dist
    monkeypatch.setattr(KN, "_np_dist", lambda a, b, p: done.append(len(a) * len(b)) or plain(a, b, p))
    bound = vals[:, -1] * np.where(np.arange(len(Q)) % 2, 1, 0.5)
    for limit in (None, bound):
        got = {i: [] for i in range(len(Q))}
        for i, c, v in zip(*(x.tolist() for x in KN._Tile(X).meet(Q, p, k, limit))):
            got[i].append((c, v))
        most = np.inf if limit is None else limit
        assert {i: sorted(r, key=lambda t: t[::-1]) for i, r in got.items()} == {
            i: [t for t in r if t[1] <= np.broadcast_to(most, len(Q))[i]] for i, r in expect.items()}
    assert sum(done) < D.size


def test_knn_small_cells_travel_together(spark):
    """Tiles of a few rows are dealt to tasks in bundles, not one by one."""
    n2 = fx.n2(spark, SF_SMALL)
    nb = KN.knn_join(n2, n2, fx.N2_FEATURES, 3, cell_rows=8, tile_rows=4)
    groups = [x for x in nb._jdf.queryExecution().optimizedPlan().toString().splitlines() if "FlatMapCoGroupsInPandas" in x]
    assert groups and all("_bundle" in x and "_cell" not in x.split("meet")[0] for x in groups)
    assert nb.groupBy("qid").count().where("count <> 3").count() == 0


def test_knn_hot_points_and_groups(spark):
    """A third of the train rows in one point, few rows in one group, queries far
    outside; all metrics at once against every pair."""
    rng = np.random.default_rng(0)
    train = [(i, g, i % 3, *((1.0, 1.0) if i % 3 == 0 else rng.normal(0, 3, 2).round(1))) for g in (0, 1) for i in range(240)]
    train += [(i, 2, 1, float(i), 0.0) for i in range(3)]
    query = [(i, i % 3, *(rng.normal(0, 3, 2).round(1) if i % 5 else (40.0, -70.0))) for i in range(60)] + [(99, 0, 1.0, 1.0)]
    t = spark.createDataFrame([(int(r[0]), int(r[1]), int(r[2]), float(r[3]), float(r[4])) for r in train],
                              "row_id long, g int, target int, a double, b double")
    q = spark.createDataFrame([(int(r[0]), int(r[1]), float(r[2]), float(r[3])) for r in query], "row_id long, g int, a double, b double")
    metrics = list(KN.METRICS)
    for sizes in ({}, {"cell_rows": 12, "tile_rows": 7}):
        got = {}
        for r in KN.knn_join(q, t, ["a", "b"], 6, metrics, group="g", **sizes).collect():
            got.setdefault((r["metric"], r["qid"]), {})[r["rank"]] = (r["tid"], r["label"])
        for i, g, a, b in query:
            side = [r for r in train if r[1] == g]
            for m in metrics:
                d = KN._np_dist(np.array([[a, b]]), np.array([r[3:] for r in side]), KN.METRICS[m])[0]
                order = np.lexsort(([r[0] for r in side], d))[:6]
                assert got[m, i] == {n + 1: (side[j][0], side[j][2]) for n, j in enumerate(order)}, (m, i, sizes)


def test_bootstrap_weights_are_poisson(spark):
    n2 = fx.n2(spark, SF_SMALL).select("row_id")
    w = S.bootstrap_weights(n2, 50, 3)
    n = n2.count() * 50
    count = {r["w"]: r["count"] for r in w.groupBy("w").count().collect()}
    assert abs(sum(k * v for k, v in count.items()) / n - 1) < 0.05
    for k, p in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert abs(count[k] / n - p) < 0.02
    again = S.bootstrap_weights(n2.repartition(7), 50, 3)
    assert w.exceptAll(again).isEmpty() and again.exceptAll(w).isEmpty()
    # resamples are not alike: two of them agree on a row as often as chance has it
    a, b = (w.where(f"b = {i}").select("row_id", F.col("w").alias(f"w{i}")) for i in (1, 2))
    both = a.join(b, "row_id").count() / n2.count()
    assert abs(both - 0.632 ** 2) < 0.1


def test_bootstrap_draws_size(spark):
    n2 = fx.n2(spark, SF_SMALL)
    d = S.bootstrap_draws(n2, 20, 0)
    n = n2.count()
    assert d.count() == 20 * n
    assert d.groupBy("b").count().agg(F.min("count"), F.max("count")).first() == (n, n)


def test_bootstrap_draws_counted(spark):
    """Every draw by hand; ids come twice and are null."""
    ids = [*range(300), 7, 7, 150, None, None]
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "row_id long, place long")
    got = S.bootstrap_draws(df, 5, 3, counted=True).collect()
    key = lambda text: hashlib.md5(text.encode()).hexdigest()
    order = sorted(ids, key=lambda i: (key("3-ord" if i is None else f"3-ord-{i}"), i is not None, i or 0))
    for b in range(1, 6):
        drawn = [order[int(key(f"3-boot-{b}-{i}")[:15], 16) % len(ids)] for i in range(1, len(ids) + 1)]
        mine = [r for r in got if r["b"] == b]
        w = Counter()
        for r in mine:
            w[r["row_id"]] += r["w"]
        assert w == Counter(drawn)
        assert sum(r["new"] for r in mine) == len(set(drawn) - {None})
    assert S.bootstrap_draws(df.limit(0), 5, 3).count() == 0


@pytest.mark.parametrize("name", ["d8_bootstrap", "j17_bootstrap_ci"])
def test_bootstrap_queries_draw_exactly_n(spark, name):
    import __spark_entry__ as E
    one, exact = (E.queries()[n](spark, SF_SMALL).collect() for n in (name, f"{name}_exact"))
    assert sorted(one) == sorted(exact)
    assert name[0] == "j" or {r["n_draws"] for r in one} == {fx.n1(spark, SF_SMALL).count()}


def test_permute_all_matches_permute_column(spark):
    n2 = fx.n2(spark, SF_SMALL).select("row_id", "target", *fx.N2_FEATURES)
    one = S.permute_column(n2, "c_acctbal", 1, 0).select("row_id", "c_acctbal")
    allp = S.permute_all(n2, ["spend_high", "c_acctbal"], 2, 0).filter(
        (F.col("feature") == "c_acctbal") & (F.col("rep") == 1)).select("row_id", "c_acctbal")
    assert sorted(one.collect()) == sorted(allp.collect())


def test_kernel_pca_uses_all_train_rows(spark):
    """The linear kernel is plain PCA whatever the landmarks; with all train rows as
    landmarks any kernel equals the centred kernel matrix's eigenvectors."""
    from foldwise.operators import reduce as R
    rng = np.random.default_rng(2)
    X = rng.normal(0, 1, (90, 4)) @ np.diag([3, 2, 1, 0.5])
    cols = ["a", "b", "c", "d"]
    df = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(X)], ["row_id", *cols])
    S_ = np.linalg.svd(X - X.mean(0), full_matrices=False)
    got = R.kernel_pca_project(df, df, X[:7], cols, "linear", 3, ["row_id"]).toPandas().sort_values("row_id")
    assert np.allclose(np.abs(got[["kp1", "kp2", "kp3"]]), np.abs(S_[0] * S_[1])[:, :3], atol=1e-6)
    K = np.exp(-((X[:, None] - X[None]) ** 2).sum(-1) / 4)
    one = np.full((90, 90), 1 / 90)
    ev, V = np.linalg.eigh(K - one @ K - K @ one + one @ K @ one)
    want = V[:, ::-1][:, :2] * np.sqrt(ev[::-1][:2])
    got = R.kernel_pca_project(df, df, X, cols, "rbf", 2, ["row_id"]).toPandas().sort_values("row_id")
    assert np.allclose(np.abs(got[["kp1", "kp2"]]), np.abs(want), atol=1e-5)


def test_sgd_parts_are_added_in_spark(spark, monkeypatch):
    from foldwise.operators import sgd
    monkeypatch.setattr(sgd, "FAN_IN", 3)
    rng = np.random.default_rng(0)
    w, n = rng.normal(0, 1, (20, 2, 3)), rng.integers(1, 9, 20)
    parts = spark.createDataFrame([(i, int(n[i]), (w[i] * n[i]).tobytes(), np.array([1.0, i]).tobytes(), float(i)) for i in range(20)], sgd._PART)
    out = sgd._added(parts, 20, (2, 3))
    assert len(out) <= 3 and sum(r["n"] for r in out) == n.sum() and max(r["steps"] for r in out) == 19
    total = sum(np.frombuffer(r["w"]).reshape(2, 3) for r in out)
    assert np.allclose(total, (w * n[:, None, None]).sum(0), atol=1e-9)
    assert np.allclose(sum(np.frombuffer(r["l"]) for r in out), [20, 190])


def test_knn_votes_copy_no_rows(spark):
    """Votes of every k come from one list a query, null labels and ties included."""
    rows = [(0, 1, 1, 0.5), (0, 2, 0, 1.0), (0, 3, 0, 1.0), (1, 1, 1, 0.0), (1, 2, 0, 0.1), (1, 3, 0, 0.2), (2, 1, None, 1.0), (2, 2, 1, 1.0), (2, 3, 1, 4.0)]
    nb = spark.createDataFrame(rows, "qid long, rank int, label int, dist double")
    out = KN.knn_classify(nb, [1, 2, 3], [])
    got = {(r.qid, r.k, r.weights): r.pred for r in out.collect()}
    assert [got[0, k, "uniform"] for k in (1, 2, 3)] == [1, 0, 0] and [got[0, k, "distance"] for k in (1, 2, 3)] == [1, 1, 0]
    assert [got[1, k, "uniform"] for k in (1, 2, 3)] == [1, 0, 0] and [got[1, k, "distance"] for k in (1, 2, 3)] == [1, 1, 1]
    assert [got[2, k, "uniform"] for k in (1, 2, 3)] == [None, 1, 1] and [got[2, k, "distance"] for k in (1, 2, 3)] == [None, 1, 1]
    far = {(r.qid, r.k, r.weights): r.pred for r in KN.knn_regress(nb, [1, 3], []).collect()}
    assert far[0, 3, "uniform"] == pytest.approx(1 / 3) and far[0, 3, "distance"] == pytest.approx(0.5) and far[1, 3, "distance"] == 1
    assert far[2, 1, "uniform"] is None and far[2, 1, "distance"] is None and far[2, 3, "uniform"] == 1 and far[2, 3, "distance"] == pytest.approx(1.25 / 2.25)
    for df in (out, KN.knn_regress(nb, [1, 3], [])):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
