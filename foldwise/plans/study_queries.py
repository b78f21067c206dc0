"""Validation, search and study drivers (K1-K18), permutation importance (J26,
J27), prediction flips (E6) and the extrapolation probe (E7)."""

from __future__ import annotations

import time
from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwise.operators import features as FE
from foldwise.operators import forest as FO
from foldwise.operators import glm as G
from foldwise.operators import knn as KN
from foldwise.operators import metrics as M
from foldwise.operators import split as S
from foldwise.plans import knn_study as KS
from foldwise.plans import search as SR
from foldwise.plans import study_sql as SQL
from foldwise.plans.catalog import r6, register
from foldwise.plans.tree_queries import t2_numeric
from foldwise.sources import fixtures as fx

SEED = 0
N2F = fx.N2_FEATURES
N1F = fx.N1_FEATURES


def _union(dfs):
    return reduce(lambda a, b: a.unionByName(b), dfs)


# ---------------------------------------------------------------- K1 - K3
def _knn_fold_metrics(df, feats, k=5, weights="uniform", metric="euclidean", seeds=(SEED,), k_folds=5):
    p = KS.knn_cv_predictions(df, feats, [k], list(seeds), (metric,), (weights,), k_folds)
    return p.groupBy("seed", "fold").agg(
        F.avg((F.col("y") == F.col("pred")).cast("double")).alias("accuracy"), *M.prf_exprs("y", "pred"))


@register("k1_cv_score", SQL.K1)
def k1_cv_score(spark, d):
    """Stratified 5-fold CV accuracy of kNN (k = 5, uniform, euclidean, fold-wise scaling) per fold."""
    return _knn_fold_metrics(fx.n2(spark, d), N2F).select("fold", r6("accuracy").alias("accuracy"))


@register("k2_cv_report", SQL.K2)
def k2_cv_report(spark, d):
    """Multi-metric CV report (accuracy, precision, recall, F1) per fold, on the held-out
    rows and on the train rows (``train_``), which find themselves among their neighbours."""
    n2 = fx.n2(spark, d)
    truth = n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y"))
    q, t = KS.cv_tables(n2, N2F, 5, SEED)
    out = None
    for prefix, side in (("", q), ("train_", t)):
        pr = KN.knn_classify(KN.knn_join(side, t, N2F, 5, group="fold"), [5], ["fold"], ("uniform",)).join(truth, "qid")
        m = pr.groupBy("fold").agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias(f"{prefix}accuracy"),
                                   *M.prf_exprs("y", "pred", prefix=prefix))
        m = m.select("fold", *[r6(c).alias(c) for c in m.columns[1:]])
        out = m if out is None else out.join(m, "fold")
    return out


@register("k3_out_of_fold")
def k3_out_of_fold(spark, d):
    """Out-of-fold probabilities for every row from kNN (k = 15 vote share) and
    logistic (batched Newton per fold), pivoted wide, with OOF AUC per model."""
    n2 = fx.n2(spark, d)
    nb = KS.cv_neighbours(n2, N2F, 15, [SEED], ("euclidean",))
    knn = nb.groupBy("qid").agg(F.avg(F.col("label").cast("double")).alias("prob")).select(
        F.col("qid").alias("row_id"), F.lit("knn").alias("model"), "prob")
    f = S.kfold(n2, 5, SEED, by="target")
    p = FE.fit_scaler(f, N2F, "standard", fold_col="fold")
    z = FE.apply_scaler(f, p, N2F, fold_col="fold").cache()
    fits = G.newton_logistic(z, [G.LogitSpec(fo, N2F, 1.0, ("fold", "!=", fo)) for fo in range(5)])
    parts = []
    for fo in range(5):
        parts.append(G.logit_score(z.filter(F.col("fold") == fo), N2F, *fits[fo], out="prob")
                     .select("row_id", F.lit("logistic").alias("model"), "prob"))
    long = knn.unionByName(_union(parts)).join(n2.select("row_id", F.col("target").alias("y_true")), "row_id")
    auc = M.roc_auc(long.withColumnRenamed("y_true", "y").withColumnRenamed("prob", "score"), ["model"])
    wide = long.groupBy("row_id", "y_true").pivot("model", ["knn", "logistic"]).agg(F.first("prob"))
    aucs = {r["model"]: r["roc_auc"] for r in auc.collect()}
    return wide.select("row_id", "y_true", F.col("knn").alias("oof_knn"), F.col("logistic").alias("oof_logistic"),
                       F.lit(aucs.get("knn")).alias("oof_auc_knn"), F.lit(aucs.get("logistic")).alias("oof_auc_logistic"))


# ---------------------------------------------------------------- K4 - K9 (forest search on a stratified subsample)
#: rows that a search fits on, as in the study it stands for
SEARCH_ROWS = 15_000


def _search_data(spark, d, rows: int = SEARCH_ROWS):
    return FO.draw(t2_numeric(spark, d), fx.T_NUMERIC, rows, SEED)


@register("k4_grid_search")
def k4_grid_search(spark, d):
    """Exhaustive 54-cell random-forest grid x 3 stratified folds (ROC AUC)."""
    data = _search_data(spark, d)
    cands = SR.grid_candidates()
    t0 = time.time()
    sc = SR.cv_evaluate(spark, data, cands, 3, SEED)
    secs = time.time() - t0
    rows = [(i, SR.params_text(cands[i]), float(sc[i])) for i in sorted(sc)]
    b = SR.best_of(sc)
    return spark.createDataFrame(rows, "candidate int, params string, cv_auc double").withColumn(
        "is_best", F.col("candidate") == b).withColumn("wall_clock_s", F.lit(secs))


def _compare(spark, d):
    data = _search_data(spark, d)
    g, rc40 = SR.grid_candidates(), SR.random_candidates(40, SEED)

    def exhaustive(cands):
        sc = SR.cv_evaluate(spark, data, cands, 3, SEED)
        b = SR.best_of(sc)
        return cands[b], sc[b]

    def halving(cands, min_rows):
        b, score, _ = SR.halving_search(spark, data, cands, 3, min_rows, 3, SEED)
        return cands[b], score

    # the random arm of halving starts at the smallest sample: 2 rows x 3 folds x 2 classes
    arms = [("GridSearch", lambda: exhaustive(g)), ("RandomSearch", lambda: exhaustive(rc40[:20])),
            ("HalvingGridSearch", lambda: halving(g, None)), ("HalvingRandomSearch", lambda: halving(rc40, 12))]
    out = []
    for name, run in arms:
        t0 = time.time()
        best, score = run()
        out.append((name, score, time.time() - t0, SR.params_text(best)))
    return out


@register("k5_k6_k7_k8_search_comparison")
def k8_search_comparison(spark, d):
    """Grid, random (20), halving grid and halving random (40) searches: best CV AUC,
    wall clock and best parameters, with the Pareto flag on (seconds, score)."""
    rows = _compare(spark, d)
    df = spark.createDataFrame([(m, float(s), float(t), p) for m, s, t, p in rows],
                               "method string, best_score double, wall_clock_s double, best_params string")
    front = M.pareto_front(df, "wall_clock_s", "best_score").select("method", F.lit(True).alias("pareto"))
    return df.join(front, "method", "left").withColumn("pareto", F.coalesce("pareto", F.lit(False)))


@register("k9_n_iter_sensitivity")
def k9_n_iter_sensitivity(spark, d, ns=(10, 50, 200)):
    """Random search n_iter in {10, 50, 200}: the 200 hashed candidates are evaluated
    once; n_iter = n is a prefix, so its best is a running maximum."""
    data = _search_data(spark, d)
    cands = SR.random_candidates(max(ns), SEED)
    rows, sc, t0 = [], {}, time.time()
    for n in sorted(ns):   # the clock is read after each prefix
        done = len(sc)
        new = SR.cv_evaluate(spark, data, cands[done:n], 3, SEED)
        sc |= {done + i: v for i, v in new.items()}
        b = SR.best_of(sc)
        rows.append((n, float(sc[b]), time.time() - t0, SR.params_text(cands[b])))
    return spark.createDataFrame(rows, "n_iter int, best_score double, wall_clock_s double, best_params string")


# ---------------------------------------------------------------- K10
@register("k10_nested_cv")
def k10_nested_cv(spark, d, cs=(0.01, 0.1, 1.0, 10.0), outer: int = 5, inner: int = 3):
    """Nested CV for logistic C: outer 5 folds, inner 3 folds re-drawn inside each outer
    train set; all 60 inner fits and 5 refits run as two batched Newton jobs."""
    n1 = fx.n1(spark, d)
    # the common scaling only conditions the solver: every fit brings the spread of its own train rows
    p = FE.fit_scaler(n1, N1F, "standard")
    base = S.kfold(FE.apply_scaler(n1, p, N1F), outer, SEED, by="target", out="outer").cache()
    z = base
    for f in range(outer):   # every inner split is drawn from the same cached base (linear plan)
        inn = S.kfold(base.filter(F.col("outer") != f).select("row_id", "target"), inner, SEED, by="target",
                      salt=f"inner{f}", out=f"inner_{f}").select("row_id", f"inner_{f}")
        z = z.join(inn, "row_id", "left").fillna({f"inner_{f}": -1})
    z = z.cache()
    specs, subsets = [], {}
    train = {(f, g): [("outer", "!=", f), (f"inner_{f}", "!=", g)] for f in range(outer) for g in range(inner)}
    scale = G.subset_scales(z, N1F, N1F, train | {f: ("outer", "!=", f) for f in range(outer)})
    for f in range(outer):
        for g in range(inner):
            for c in cs:
                specs.append(G.LogitSpec((f, g, c), N1F, c, train[f, g], scale=scale[f, g]))
                subsets[(f, g, c)] = [("outer", "!=", f), (f"inner_{f}", "==", g)]
    fits = G.newton_logistic(z, specs)
    acc = G.batch_accuracy(z, fits, {k: N1F for k in fits}, subsets=subsets)
    best = {}
    for f in range(outer):
        mean = {c: np.mean([acc[(f, g, c)] for g in range(inner)]) for c in cs}
        bc = max(cs, key=lambda c: (mean[c], -c))
        best[f] = (bc, float(mean[bc]))
    refit = G.newton_logistic(z, [G.LogitSpec(f, N1F, best[f][0], ("outer", "!=", f), scale=scale[f]) for f in range(outer)])
    oacc = G.batch_accuracy(z, refit, {f: N1F for f in range(outer)}, subsets={f: ("outer", "==", f) for f in range(outer)})
    z.unpersist()
    base.unpersist()
    rows = [(f, float(oacc[f]), float(best[f][0]), best[f][1]) for f in range(outer)]
    return spark.createDataFrame(rows, "outer_fold int, outer_score double, best_C double, inner_best double")


# ---------------------------------------------------------------- K11 - K16 (kNN as the estimator)
def _acc_by(p, by):
    return p.groupBy(*by).agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias("score"))


@register("k11_splitter_variance", SQL.k11())
def k11_splitter_variance(spark, d, seeds=(0, 1, 2)):
    """Five splitters x seeds (hold-out, stratified hold-out, K-fold, stratified K-fold,
    repeated stratified K-fold 5x2): kNN (k = 5) score per fold, one row per fold."""
    n2 = fx.n2(spark, d)
    parts = []
    for s in seeds:
        for name, strat in (("holdout", False), ("stratified_holdout", True)):
            te, tr = KS.holdout_tables(n2, N2F, 0.25, s, stratify=strat)
            nb = KN.knn_join(te, tr, N2F, 5)
            pr = KN.knn_classify(nb, [5], [], ("uniform",)).join(
                n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
            parts.append(_acc_by(pr.withColumn("fold", F.lit(0)), ["fold"]).select(
                F.lit(name).alias("splitter"), F.lit(s).alias("seed"), "fold", "score"))
        for name, strat in (("kfold", False), ("stratified_kfold", True)):
            q, t = KS.cv_tables(n2, N2F, 5, s, stratify=strat)
            nb = KN.knn_join(q, t, N2F, 5, group="fold")
            pr = KN.knn_classify(nb, [5], ["fold"], ("uniform",)).join(
                n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
            parts.append(_acc_by(pr, ["fold"]).select(F.lit(name).alias("splitter"), F.lit(s).alias("seed"),
                                                     "fold", "score"))
        for r in range(2):
            q, t = KS.cv_tables(n2, N2F, 5, s * 100 + r + 1000)
            nb = KN.knn_join(q, t, N2F, 5, group="fold")
            pr = KN.knn_classify(nb, [5], ["fold"], ("uniform",)).join(
                n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
            parts.append(_acc_by(pr, ["fold"]).select(F.lit("repeated_stratified_kfold").alias("splitter"),
                                                     F.lit(s).alias("seed"), (F.col("fold") + 5 * r).alias("fold"),
                                                     "score"))
    return _union(parts).withColumn("score", r6("score"))


@register("k12_fold_count", SQL.k12())
def k12_fold_count(spark, d, ks=(3, 5, 10, 20), seeds=(0, 1, 2)):
    """K in {3, 5, 10, 20} x seeds: mean / std per seed, raw fold scores, and the
    across-seed std with the mean within-CV std (two-level aggregation)."""
    n2 = fx.n2(spark, d)
    parts = []
    for kf in ks:
        p = KS.knn_cv_predictions(n2, N2F, [5], list(seeds), ("euclidean",), ("uniform",), kf)
        parts.append(_acc_by(p, ["seed", "fold"]).withColumn("k_folds", F.lit(kf)))
    s = _union(parts)
    per_seed = s.groupBy("k_folds", "seed").agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))
    raw = M.score_list(s, ["k_folds", "seed"], "fold", "score")
    out = per_seed.join(raw, ["k_folds", "seed"])
    two = per_seed.groupBy("k_folds").agg(F.stddev_pop("mean_score").alias("across_seed_std"),
                                          F.avg("std_score").alias("mean_within_cv_std"))
    out = out.join(F.broadcast(two), "k_folds")
    return out.select("k_folds", "seed", "raw_scores", *[r6(c).alias(c) for c in ("mean_score", "std_score", "across_seed_std", "mean_within_cv_std")])


@register("k13_leakage", SQL.k13())
def k13_leakage(spark, d, seeds=(0, 1, 2)):
    """Scaler fitted on all rows (leaky) vs on each train fold (clean): kNN CV accuracy
    per seed and the inflation."""
    n2 = fx.n2(spark, d)
    rows = []
    for s in seeds:
        clean = KS.knn_cv_predictions(n2, N2F, [5], [s], ("euclidean",), ("uniform",))
        f = S.kfold(n2, 5, s, by="target")
        p = FE.fit_scaler(f, N2F, "standard")
        z = FE.apply_scaler(f, p, N2F)
        others = F.filter(F.sequence(F.lit(0), F.lit(4)), lambda g: g != F.col("fold"))
        t = z.withColumn("_as", F.explode(others)).drop("fold").withColumnRenamed("_as", "fold")
        nb = KN.knn_join(z, t, N2F, 5, group="fold")
        leaky = KN.knn_classify(nb, [5], ["fold"], ("uniform",)).join(
            n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
        lm = _acc_by(leaky, ["fold"]).agg(F.avg("score")).first()[0]
        cm = _acc_by(clean, ["fold"]).agg(F.avg("score")).first()[0]
        rows.append((s, float(lm), float(cm), float(lm - cm)))
    out = spark.createDataFrame(rows, "seed int, leaky_mean double, clean_mean double, inflation double")
    return out.select("seed", *[(r6(c) + 0.0).alias(c) for c in out.columns[1:]])


def _scaled_fold_tables(n2, scaler, s):
    return KS.cv_tables(n2, N2F, 5, s, scaler)


@register("k14_k17_scaler_algo_matrix")
def k14_scaler_algo_matrix(spark, d, seeds=(0,), scalers=FE.SCALERS):
    """Scaler (none, standard, minmax, robust, maxabs) x algorithm (kNN, logistic) x seeds x
    5 folds: accuracy mean / std, run count, and fit / predict seconds (K17: clock around
    forced actions)."""
    n2 = fx.n2(spark, d)
    rows = []
    for sc in scalers:
        for s in seeds:
            q, t = _scaled_fold_tables(n2, sc, s)
            q = q.cache()
            t0 = time.time()
            nb = KN.knn_join(q, t, N2F, 5, group="fold").cache()
            nb.count()
            t_fit = time.time() - t0
            t0 = time.time()
            pr = KN.knn_classify(nb, [5], ["fold"], ("uniform",)).join(
                n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
            accs = [r["score"] for r in _acc_by(pr, ["fold"]).collect()]
            rows.append(("knn", sc, accs, t_fit, time.time() - t0))
            nb.unpersist()
            t0 = time.time()
            fits = G.newton_logistic(q, [G.LogitSpec(fo, N2F, 1.0, ("fold", "!=", fo)) for fo in range(5)])
            t_fit = time.time() - t0
            t0 = time.time()
            acc = G.batch_accuracy(q, fits, {fo: N2F for fo in range(5)}, subsets={fo: ("fold", "==", fo) for fo in range(5)})
            rows.append(("logistic", sc, list(acc.values()), t_fit, time.time() - t0))
            q.unpersist()
    agg = {}
    for alg, sc, accs, tf, tp in rows:
        a = agg.setdefault((alg, sc), [[], 0.0, 0.0, 0])
        a[0] += accs
        a[1] += tf
        a[2] += tp
        a[3] += 5
    out = [(alg, sc, float(np.mean(v[0])), float(np.std(v[0])), len(v[0]), v[1], v[2], v[1] / v[3])
           for (alg, sc), v in agg.items()]
    return spark.createDataFrame(out, "algorithm string, scaler string, acc_mean double, acc_std double, n_runs int, "
                                      "fit_time_total_s double, predict_time_total_s double, fit_time_per_fit_s double")


@register("k15_outlier_ablation")
def k15_outlier_ablation(spark, d, seeds=(0, 1), fracs=(0.0, 0.05, 0.1, 0.2), scalers=("standard", "robust")):
    """Outliers injected into train rows only (x50 on 1..p columns) at several rates;
    standard vs robust scaling; kNN and logistic accuracy on the clean test rows.
    Every (seed, rate, scaler) variant is a config id in one long frame: one grouped
    neighbour join and one batched logistic fit serve all of them."""
    n2 = fx.n2(spark, d)
    cfgs, parts = [], []
    for s in seeds:
        h = S.holdout(n2, 0.25, s, by="target")
        for fr in fracs:
            dirty = S.inject_outliers(h, N2F, fr, s, 50.0) if fr > 0 else h
            for sc in scalers:
                p = FE.fit_scaler(dirty, N2F, sc, train_col="is_test")
                parts.append(FE.apply_scaler(dirty, p, N2F).withColumn("cfg", F.lit(len(cfgs))))
                cfgs.append((s, fr, sc))
    z = _union(parts).select("cfg", "row_id", "target", "is_test", *N2F).cache()
    nb = KN.knn_join(z.filter("is_test = 1"), z.filter("is_test = 0"), N2F, 5, group="cfg")
    pr = KN.knn_classify(nb, [5], ["cfg"], ("uniform",)).join(
        n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
    knn_acc = {r["cfg"]: r["score"] for r in _acc_by(pr, ["cfg"]).collect()}
    fits = G.newton_logistic(z, [G.LogitSpec(i, N2F, 1.0, [("cfg", "==", i), ("is_test", "==", 0)])
                                 for i in range(len(cfgs))])
    lacc = G.batch_accuracy(z, fits, {i: N2F for i in fits},
                            subsets={i: [("cfg", "==", i), ("is_test", "==", 1)] for i in fits})
    z.unpersist()
    rows = []
    for i, (s, fr, sc) in enumerate(cfgs):
        rows.append((s, fr, sc, "knn", float(knn_acc[i])))
        rows.append((s, fr, sc, "logistic", float(lacc[i])))
    return spark.createDataFrame(rows, "seed int, outlier_frac double, scaler string, algorithm string, test_acc double")


@register("k16_multi_seed", SQL.k16())
def k16_multi_seed(spark, d, seeds=(0, 1, 2, 3, 4)):
    """One metric over seeds: kNN stratified-CV accuracy per seed, then mean, std and the raw list."""
    p = KS.knn_cv_predictions(fx.n2(spark, d), N2F, [5], list(seeds), ("euclidean",), ("uniform",))
    per = _acc_by(p, ["seed", "fold"]).groupBy("seed").agg(F.avg("score").alias("score"))
    raw = F.array_sort(F.collect_list(F.struct("seed", "score")))
    return per.agg(r6(F.avg("score")).alias("mean"), r6(F.stddev_pop("score")).alias("std"),
                   F.array_join(F.transform(raw, lambda e: F.format_number(e["score"], 4)), ";").alias("raw"))


@register("k18_evaluate", SQL.K18)
def k18_evaluate(spark, d):
    """Quick evaluation (seed 42): stratified 75/25 hold-out kNN (k = 5) headline metrics
    and confusion counts."""
    n2 = fx.n2(spark, d)
    te, tr = KS.holdout_tables(n2, N2F, 0.25, 42)
    nb = KN.knn_join(te, tr, N2F, 5)
    pr = KN.knn_classify(nb, [5], [], ("uniform",)).join(
        n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
    out = pr.agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias("accuracy"), *M.prf_exprs("y", "pred"),
                  F.sum(((F.col("y") == 1) & (F.col("pred") == 1)).cast("int")).alias("tp"),
                  F.sum(((F.col("y") == 0) & (F.col("pred") == 1)).cast("int")).alias("fp"),
                  F.sum(((F.col("y") == 1) & (F.col("pred") == 0)).cast("int")).alias("fn"),
                  F.sum(((F.col("y") == 0) & (F.col("pred") == 0)).cast("int")).alias("tn"))
    return out.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "tp", "fp", "fn", "tn")


# ---------------------------------------------------------------- J26, J27
@register("j26_permutation_importance")
def j26_permutation_importance(spark, d, reps: int = 5):
    """Logistic model on N2 (stratified 75/25): test accuracy drop when one feature is
    permuted among the test rows, 5 repeats; all (feature, repeat) permutations are
    scored as one long frame and one grouped aggregation."""
    n2 = fx.n2(spark, d)
    h = S.holdout(n2, 0.25, SEED, by="target")
    p = FE.fit_scaler(h, N2F, "standard", train_col="is_test")
    z = FE.apply_scaler(h, p, N2F).cache()
    coef, b0 = G.newton_logistic(z, [G.LogitSpec(0, N2F, 1.0, ("is_test", "==", 0))])[0]
    te = z.filter("is_test = 1").select("row_id", "target", *N2F)
    base_rows = te.select("row_id", "target", *N2F, F.lit("__base__").alias("feature"), F.lit(-1).alias("rep"))
    perm = S.permute_all(te, N2F, reps, SEED).select("row_id", "target", *N2F, "feature", "rep")
    long = G.logit_score(base_rows.unionByName(perm), N2F, coef, b0)
    acc = long.groupBy("feature", "rep").agg(
        F.avg(((F.col("score") >= 0.5).cast("int") == F.col("target")).cast("double")).alias("acc"))
    base = acc.filter("feature = '__base__'").select(F.col("acc").alias("base"))
    drops = acc.filter("feature <> '__base__'").withColumn("_o", F.lit(1)).join(
        F.broadcast(base.withColumn("_o", F.lit(1))), "_o").withColumn("drop", F.col("base") - F.col("acc"))
    out = drops.groupBy("feature").agg(F.avg("drop").alias("perm_mean"), F.stddev_pop("drop").alias("perm_std"))
    return out


@register("j27_importance_compare")
def j27_importance_compare(spark, d):
    """Impurity importance of a random forest vs permutation importance (test AUC drop),
    joined on feature name (not position) and ranked by their sum."""
    from pyspark.ml.classification import RandomForestClassifier
    base = t2_numeric(spark, d)
    h = G.assemble(S.holdout(base, 0.25, SEED, by="target"), fx.T_NUMERIC).cache()
    m = RandomForestClassifier(featuresCol="features", labelCol="target", numTrees=100, maxDepth=10,
                               seed=SEED).fit(h.filter("is_test = 0"))
    imp = spark.createDataFrame([(c, float(v)) for c, v in zip(fx.T_NUMERIC, m.featureImportances.toArray())],
                                "feature string, tree_importance double")
    te = h.filter("is_test = 1").select("row_id", "target", *fx.T_NUMERIC)
    base_rows = te.withColumn("feature", F.lit("__base__")).withColumn("rep", F.lit(-1))
    perm = S.permute_all(te, fx.T_NUMERIC, 5, SEED).select("row_id", "target", *fx.T_NUMERIC, "feature", "rep")
    long = G.assemble(base_rows.unionByName(perm), fx.T_NUMERIC)
    sc = m.transform(long).select("feature", "rep", F.col("target").alias("y"),
                                  vector_to_array("probability")[1].alias("score"))
    auc = M.roc_auc(sc, ["feature", "rep"])
    b = auc.filter("feature = '__base__'").first()["roc_auc"]
    perm = auc.filter("feature <> '__base__'").groupBy("feature").agg(
        (F.lit(b) - F.avg("roc_auc")).alias("perm_mean"), F.stddev_pop("roc_auc").alias("perm_std"))
    out = imp.join(perm, "feature").withColumn("rank_sum", F.col("tree_importance") + F.col("perm_mean"))
    h.unpersist()
    return out.orderBy(F.col("rank_sum").desc())


# ---------------------------------------------------------------- E6, E7
@register("e6_flip_report", SQL.e6())
def e6_flip_report(spark, d):
    """Held-out rows whose kNN label under some scaler differs from the unscaled one:
    per-scaler labels, flag, first flipping row and per-scaler accuracy."""
    n2 = fx.n2(spark, d)
    parts = []
    for sc in FE.SCALERS:
        te, tr = KS.holdout_tables(n2, N2F, 0.25, SEED, sc)
        nb = KN.knn_join(te, tr, N2F, 5)
        parts.append(KN.knn_classify(nb, [5], [], ("uniform",)).select("qid", F.lit(sc).alias("scaler"), "pred"))
    long = _union(parts)
    wide = long.groupBy("qid").pivot("scaler", list(FE.SCALERS)).agg(F.first("pred"))
    flip = F.lit(False)
    for sc in FE.SCALERS[1:]:
        flip = flip | (F.col(sc) != F.col("none"))
    wide = wide.withColumn("flipped", flip).join(n2.select(F.col("row_id").alias("qid"), F.col("target").alias("y")), "qid")
    first = wide.filter("flipped").agg(F.min("qid").alias("first_flip_row"))
    accs = wide.agg(*[r6(F.avg((F.col(sc) == F.col("y")).cast("double"))).alias(f"acc_{sc}") for sc in FE.SCALERS])
    return (wide.filter("flipped").withColumn("_o", F.lit(1))
            .join(F.broadcast(first.withColumn("_o", F.lit(1))), "_o").join(F.broadcast(accs.withColumn("_o", F.lit(1))), "_o").drop("_o"))


@register("e7_extrapolation_probe", SQL.e7())
def e7_extrapolation_probe(spark, d, n_points: int = 400):
    """kNN (k = 5) and one-feature OLS fitted on (orders per customer -> spend) and
    scored on an x-grid running to twice the train range."""
    kr = fx.kr(spark, d).select("row_id", F.col("n_orders").alias("x"), F.col("target").alias("y"))
    st = kr.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.regr_slope("y", "x").alias("slope"),
                F.regr_intercept("y", "x").alias("icpt"))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(n_points - 1))).alias("gid"), "lo", "hi", "slope", "icpt")
    grid = grid.withColumn("x", F.col("lo") + (2 * (F.col("hi") - F.col("lo"))) * F.col("gid") / (n_points - 1)).repartition("gid")
    nb = KN.knn_join(grid, kr.withColumnRenamed("y", "target"), ["x"], 5, qid="gid")
    knn = KN.knn_regress(nb, [5], [], ("uniform",)).select(F.col("qid").alias("gid"), F.col("pred").alias("knn_pred"))
    return grid.join(knn, "gid").select("gid", r6("x").alias("x"), r6(F.col("icpt") + F.col("slope") * F.col("x")).alias("ols_pred"),
                                        r6("knn_pred").alias("knn_pred"), (F.col("x") > F.col("hi")).alias("beyond_train"))
