"""Queries for clustering (H1-H11) and dimensionality reduction."""

from __future__ import annotations

import time

import numpy as np
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from foldwise.operators import cluster as CL
from foldwise.operators import features as FE
from foldwise.operators import glm as G
from foldwise.operators import kmeans as KM
from foldwise.operators import reduce as R
from foldwise.operators import split as S
from foldwise.plans.catalog import r6, register
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq

L1F = fx.L1_FEATURES


def m1_scaled(spark, d):
    """Customer features standardised on all rows (population std)."""
    m = fx.m1(spark, d)
    p = FE.fit_scaler(m, fx.M1_FEATURES, "standard")
    return FE.apply_scaler(m, p, fx.M1_FEATURES)


def _d2_sql(a: str, b: str, cols) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


L1_SQL = fq.with_(l1=fq.L1) + ", cen as (select label_a, count(*) as n, " + ", ".join(
    f"avg({c}) as {c}" for c in L1F) + " from l1 group by label_a)\n"


# ---------------------------------------------------------------- H3
@register("h3_assign_nearest", L1_SQL + f"""select row_id, label from (
  select l1.row_id, cen.label_a as label, row_number() over (partition by l1.row_id
         order by {_d2_sql('l1', 'cen', L1F)}, cen.label_a) as rn from l1, cen) x where rn = 1""")
def h3_assign_nearest(spark, d):
    """Each customer to its nearest segment centroid (k-row broadcast array)."""
    l1 = fx.l1(spark, d)
    cents = CL.centroids(l1, L1F, "label_a").withColumnRenamed("label_a", "label")
    return CL.assign(l1, cents, L1F).select("row_id", F.col("cluster").alias("label"))


# ---------------------------------------------------------------- H6 - H10 (exact on L1)
@register("h6_inertia", L1_SQL + f"select round(sum({_d2_sql('l1', 'cen', L1F)}), 6) as inertia from l1 join cen using (label_a)")
def h6_inertia(spark, d):
    l1 = fx.l1(spark, d)
    cents = CL.centroids(l1, L1F, "label_a")
    j = l1.join(F.broadcast(cents.select("label_a", *[F.col(c).alias(f"m_{c}") for c in L1F])), "label_a")
    d2 = sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in L1F), F.lit(0.0))
    return j.agg(r6(F.sum(d2)).alias("inertia"))


_L1V = " + ".join(f"var_pop({c})" for c in L1F)


@register("h7_silhouette", L1_SQL + f""", va as (select label_a, {_L1V} as v from l1 group by label_a),
md as (select l1.row_id, l1.label_a as own, cen.label_a as other, cen.n, {_d2_sql('l1', 'cen', L1F)} + va.v as d
       from l1, cen join va on va.label_a = cen.label_a),
ab as (select row_id, max(case when own = other then n end) as n, max(case when own = other and n > 1 then d * n / (n - 1) end) as a,
              min(case when own <> other then d end) as b from md group by row_id)
select round(avg(case when n > 1 and b is not null and greatest(a, b) > 0 then (b - a) / greatest(a, b) else 0 end), 6) as silhouette from ab""")
def h7_silhouette(spark, d):
    """Silhouette (squared euclidean) of the segment labelling."""
    s = CL.silhouette(fx.l1(spark, d), L1F, "label_a")
    return s.select(r6("silhouette").alias("silhouette"))


@register("h8_davies_bouldin", L1_SQL + f""", s as (select label_a, avg(sqrt({_d2_sql('l1', 'cen', L1F)})) as s
  from l1 join cen using (label_a) group by label_a),
c as (select cen.*, s.s from cen join s using (label_a)),
r as (select a.label_a, max((a.s + b.s) / sqrt({_d2_sql('a', 'b', L1F)})) as r
      from c a join c b on a.label_a <> b.label_a group by a.label_a)
select round(avg(r), 6) as davies_bouldin from r""")
def h8_davies_bouldin(spark, d):
    return CL.davies_bouldin(fx.l1(spark, d), L1F, "label_a").select(r6("davies_bouldin").alias("davies_bouldin"))


@register("h9_calinski_harabasz", L1_SQL + f""", g as (select {", ".join(f"avg({c}) as {c}" for c in L1F)},
  count(*) as n_all from l1),
w as (select sum({_d2_sql('l1', 'cen', L1F)}) as w from l1 join cen using (label_a)),
b as (select sum(cen.n * ({_d2_sql('cen', 'g', L1F)})) as b from cen, g)
select round((b / ((select count(*) from cen) - 1)) / (w / ((select n_all from g) - (select count(*) from cen))), 6)
  as calinski_harabasz from w, b""")
def h9_calinski_harabasz(spark, d):
    l1 = fx.l1(spark, d)
    cents = CL.centroids(l1, L1F, "label_a")
    allm = l1.agg(*[F.avg(c).alias(f"g_{c}") for c in L1F], F.count(F.lit(1)).alias("n_all"))
    j = l1.join(F.broadcast(cents.select("label_a", *[F.col(c).alias(f"m_{c}") for c in L1F])), "label_a")
    w = j.agg(F.sum(sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in L1F), F.lit(0.0))).alias("W"))
    cb = cents.withColumn("_o", F.lit(1)).join(F.broadcast(allm.withColumn("_o", F.lit(1))), "_o")
    b = cb.agg(F.sum(F.col("n") * sum(((F.col(c) - F.col(f"g_{c}")) ** 2 for c in L1F), F.lit(0.0))).alias("B"),
               F.count(F.lit(1)).alias("k"), F.first("n_all").alias("n_all"))
    out = w.withColumn("_o", F.lit(1)).join(b.withColumn("_o", F.lit(1)), "_o")
    ch = (F.col("B") / (F.col("k") - 1)) / (F.col("W") / (F.col("n_all") - F.col("k")))
    return out.select(r6(ch).alias("calinski_harabasz"))


@register("h10_adjusted_rand", fq.with_(l1=fq.L1) + """, ct as (select label_a, label_b, count(*) as n from l1 group by all),
s as (select sum(n * (n - 1) / 2.0) as sij, sum(n) as big_n from ct),
a as (select sum(na * (na - 1) / 2.0) as sa from (select sum(n) as na from ct group by label_a)),
b as (select sum(nb * (nb - 1) / 2.0) as sb from (select sum(n) as nb from ct group by label_b))
select round((sij - sa * sb / (big_n * (big_n - 1) / 2.0)) / ((sa + sb) / 2 - sa * sb / (big_n * (big_n - 1) / 2.0)), 6)
  as ari from s, a, b""")
def h10_adjusted_rand(spark, d):
    """Agreement of two labellings (segment vs nation mod 5)."""
    return CL.adjusted_rand(fx.l1(spark, d), "label_a", "label_b").select(r6("ari").alias("ari"))


@register("h11_cluster_profile", L1_SQL + "select label_a as cluster, n as members, " + ", ".join(
    f"round({c}, 6) as {c}" for c in L1F) + " from cen")
def h11_cluster_profile(spark, d):
    """Cluster sizes and centroids in raw units: means in standardised space mapped back."""
    l1 = fx.l1(spark, d)
    p = FE.fit_scaler(l1, L1F, "standard")
    z = FE.apply_scaler(l1, p, L1F)
    cz = CL.centroids(z, L1F, "label_a")
    raw = FE.inverse_scale(cz, p, L1F)
    return raw.select(F.col("label_a").alias("cluster"), F.col("n").alias("members"), *[r6(c).alias(c) for c in L1F])


# ---------------------------------------------------------------- H1, H2, H4, H5 (rows-only)
@register("h1_kmeans")
def h1_kmeans(spark, d, k: int = 5, n_init: int = 10):
    """k-means (k-means++ seeding) on standardised customer features, best of n_init starts."""
    m = m1_scaled(spark, d)
    starts = [(s, "k-means++", k) for s in range(n_init)]
    C, inertia, _ = KM.multi_start_kmeans(m, fx.M1_FEATURES, starts)
    best = min(inertia, key=inertia.get)
    lab = KM.labels_for(m, fx.M1_FEATURES, C[best])
    return lab.groupBy("label").agg(F.count(F.lit(1)).alias("members")).withColumn("inertia", F.lit(inertia[best]))


@register("h2_init_comparison")
def h2_init_comparison(spark, d, k: int = 5, n_inits=(1, 5, 10, 25), seeds=(0, 1, 2, 3, 4)):
    """k-means++ vs random seeding x n_init x seeds: inertia mean/std, silhouette of the best
    start.  Fewer starts are a prefix of more, so each start runs once, all in the same
    Lloyd passes; ``time_mean_s`` is their measured time shared out by starts."""
    m = m1_scaled(spark, d).cache()
    starts = [(s * 1000 + r, init, k) for init in ("k-means++", "random") for s in seeds for r in range(max(n_inits))]
    place = {st: i for i, st in enumerate(starts)}
    t0 = time.time()
    C, inertia, _ = KM.multi_start_kmeans(m, fx.M1_FEATURES, starts)
    per_start = (time.time() - t0) / len(starts)
    best = {(init, n, s): min((place[(s * 1000 + r, init, k)] for r in range(n)), key=lambda i: inertia[i])
            for init in ("k-means++", "random") for n in n_inits for s in seeds}
    rows, sil = [], {}
    for init, n_init in sorted({(a, b) for a, b, _ in best}):
        picks = [best[(init, n_init, s)] for s in seeds]
        iners = [inertia[i] for i in picks]
        for i in picks:   # a start that is the best of several counts is scored once
            if i not in sil:
                lab = KM.labels_for(m, fx.M1_FEATURES, C[i])
                sil[i] = CL.silhouette(lab, fx.M1_FEATURES, "label").first()[0]
        rows.append((init, n_init, float(np.mean(iners)), float(np.std(iners)), float(np.mean([sil[i] for i in picks])),
                     per_start * n_init))
    m.unpersist()
    return spark.createDataFrame(rows, "init string, n_init int, inertia_mean double, inertia_std double, "
                                       "silhouette_mean double, time_mean_s double")


@register("h4_minibatch_vs_full")
def h4_minibatch_vs_full(spark, d, ks=(3, 5, 8)):
    """Mini-batch (batches of 64 rows) vs full k-means for k in {3,5,8}, best of 10 starts
    each: inertias over all rows, seconds, ARI of labels."""
    m = m1_scaled(spark, d).cache()
    rows = []
    for k in ks:
        t0 = time.time()
        C, inertia, _ = KM.multi_start_kmeans(m, fx.M1_FEATURES, [(r, "k-means++", k) for r in range(10)])
        b = min(inertia, key=inertia.get)
        t_full = time.time() - t0
        t0 = time.time()
        Cs = CL.minibatch_kmeans(m, fx.M1_FEATURES, k, batch_size=64)
        ins = KM.final_inertia(m, fx.M1_FEATURES, dict(enumerate(Cs)))
        bm = min(ins, key=ins.get)
        Cm, mini_in = Cs[bm], ins[bm]
        t_mini = time.time() - t0
        lf = KM.labels_for(m, fx.M1_FEATURES, C[b], "full")
        both = KM.labels_for(lf, fx.M1_FEATURES, Cm, "mini")
        ari = CL.adjusted_rand(both, "full", "mini").first()[0]
        rows.append((k, float(inertia[b]), float(mini_in), t_full, t_mini, float(ari)))
    m.unpersist()
    return spark.createDataFrame(rows, "k int, full_inertia double, mini_inertia double, full_time_s double, "
                                       "mini_time_s double, ari_agreement double")


@register("h5_k_sweep")
def h5_k_sweep(spark, d, ks=tuple(range(2, 13)), n_init: int = 10):
    """k = 2..12: inertia, silhouette, Davies-Bouldin, Calinski-Harabasz; all k in one multi-start run."""
    m = m1_scaled(spark, d).cache()
    starts = [(r, "k-means++", k) for k in ks for r in range(n_init)]
    C, inertia, _ = KM.multi_start_kmeans(m, fx.M1_FEATURES, starts)
    rows = []
    for k in ks:
        idx = [i for i, s in enumerate(starts) if s[2] == k]
        b = min(idx, key=lambda i: inertia[i])
        lab = KM.labels_for(m, fx.M1_FEATURES, C[b]).cache()
        sil = CL.silhouette(lab, fx.M1_FEATURES, "label").first()[0]
        db = CL.davies_bouldin(lab, fx.M1_FEATURES, "label").first()[0]
        ch = CL.calinski_harabasz(lab, fx.M1_FEATURES, "label").first()[0]
        rows.append((k, float(inertia[b]), float(sil), float(db), float(ch)))
        lab.unpersist()
    m.unpersist()
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double, davies_bouldin double, "
                                       "calinski_harabasz double")


# ---------------------------------------------------------------- I0 - I7 (P1 embeddings)
P1F = [f"e{i}" for i in range(fx.P1_DIMS)]


@register("i0_correlation", fq.with_(p1=fq.P1) + " union all ".join(
    f"select '{P1F[i]}' as i, '{P1F[j]}' as j, round(corr({P1F[i]}, {P1F[j]}), 6) as corr from p1"
    for i in range(fx.P1_DIMS) for j in range(i, fx.P1_DIMS)))
def i0_correlation(spark, d):
    """Correlation matrix (long form, i <= j) from one Gram pass."""
    n, mx, Cxx = R.covariance(fx.p1(spark, d), P1F)[0]
    sd = np.sqrt(np.diag(Cxx))
    corr = Cxx / np.outer(sd, sd)
    rows = [(P1F[i], P1F[j], float(corr[i, j])) for i in range(len(P1F)) for j in range(i, len(P1F))]
    return spark.createDataFrame(rows, "i string, j string, corr double").select("i", "j", r6("corr").alias("corr"))


def _p1_split(spark, d):
    return S.holdout(fx.p1(spark, d), 0.25, 0, by="target")


def _pca(spark, d):
    h = _p1_split(spark, d).cache()
    fit = R.pca_fit(h.filter("is_test = 0"), P1F)
    return h, fit


@register("i1_pca_loadings")
def i1_pca_loadings(spark, d, k: int = 10):
    """Loadings of the first 10 components fitted on the train split (standardised)."""
    _, fit = _pca(spark, d)
    rows = [(j + 1, P1F[i], float(fit.evecs[i, j])) for j in range(k) for i in range(len(P1F))]
    return spark.createDataFrame(rows, "component int, feature string, loading double")


@register("i2_explained_variance")
def i2_explained_variance(spark, d):
    """Explained-variance ratio and cumulative share per component."""
    _, fit = _pca(spark, d)
    r = fit.ratio()
    rows = [(j + 1, float(r[j]), float(r[: j + 1].sum())) for j in range(len(r))]
    return spark.createDataFrame(rows, "pc int, explained_ratio double, cumulative double")


def _accs(proj, feature_sets: dict, C: float = 1.0) -> dict:
    """Test accuracy of one logistic model per feature set, all fitted together
    (batched Newton passes over the train rows), scored in one aggregation."""
    specs = [G.LogitSpec(k, cols, C, subset=("is_test", "==", 0)) for k, cols in feature_sets.items()]
    fits = G.newton_logistic(proj, specs)
    return G.batch_accuracy(proj.filter("is_test = 1"), fits, feature_sets)


@register("i3_components_sweep")
def i3_components_sweep(spark, d, ns=tuple(range(1, 31))):
    """Logistic test accuracy on the first n components, n = 1..30, from one decomposition."""
    h, fit = _pca(spark, d)
    proj = R.project(h, fit, max(ns), ["row_id", "target", "is_test"]).cache()
    acc = _accs(proj, {n: [f"pc{j + 1}" for j in range(n)] for n in ns})
    rows = [(n, float(acc[n])) for n in ns]
    proj.unpersist()
    return spark.createDataFrame(rows, "n_components int, test_acc double")


@register("i4_reconstruction")
def i4_reconstruction(spark, d, ns=(1, 2, 5, 10, 15, 20, 30)):
    """Frobenius reconstruction error of the train rows per component count (row-wise
    residual pass), checked against sqrt((n-1) * sum of dropped eigenvalues)."""
    h, fit = _pca(spark, d)
    tr = h.filter("is_test = 0")
    ns = [n for n in ns if n <= len(P1F)]
    errs = R.reconstruction_errors(tr, fit, ns)
    rows = []
    for n in ns:
        err = errs[n]
        ident = float(np.sqrt((fit.n - 1) * fit.evals[n:].sum()))
        rows.append((n, err, float(fit.ratio()[:n].sum()), ident))
    return spark.createDataFrame(rows, "n_components int, frob_error double, cumulative_variance double, "
                                       "frob_error_from_eigen double")


@register("i5_whitening_ablation")
def i5_whitening_ablation(spark, d, ns=(2, 5, 10, 20)):
    """Logistic test accuracy with and without whitened components."""
    h, fit = _pca(spark, d)
    rows = []
    for wh in (False, True):
        proj = R.project(h, fit, max(ns), ["row_id", "target", "is_test"], whiten=wh).cache()
        acc = _accs(proj, {n: [f"pc{j + 1}" for j in range(n)] for n in ns})
        rows += [(wh, n, float(acc[n])) for n in ns]
        proj.unpersist()
    return spark.createDataFrame(rows, "whiten boolean, n_components int, test_acc double")


@register("i6_kernel_pca")
def i6_kernel_pca(spark, d, k: int = 10, landmarks: int = 200):
    """PCA vs kernel PCA (linear, rbf gamma=1/p, poly degree 3) with 10 components,
    then logistic test accuracy.  The first `landmarks` train rows of a hashed order
    span the kernel map (Nystrom); its centre and covariance are those of all train rows."""
    h, fit = _pca(spark, d)
    z = R.project(h, fit, len(P1F), ["row_id", "target", "is_test"])  # standardised rotation keeps distances
    zcols = [f"pc{j + 1}" for j in range(len(P1F))]
    pk = R.project(h, fit, k, ["row_id", "target", "is_test"])
    rows = [("pca", "none", float(_accs(pk, {0: [f"pc{j + 1}" for j in range(k)]})[0]))]
    lm = S.subsample(z.filter("is_test = 0"), landmarks, 0).select(*zcols).toPandas().to_numpy(dtype=np.float64)
    for kern in ("linear", "rbf", "poly"):
        try:
            kp = R.kernel_pca_project(z, z.filter("is_test = 0"), lm, zcols, kern, k, ["row_id", "target", "is_test"]).cache()
            acc = _accs(kp, {0: [f"kp{j + 1}" for j in range(k)]})[0]
            kp.unpersist()
            rows.append(("kernel_pca", kern, float(acc)))
        except (PySparkException, ValueError, np.linalg.LinAlgError):   # a failed kernel is a null row, not an abort
            rows.append(("kernel_pca", kern, None))
    return spark.createDataFrame(rows, "method string, kernel string, test_acc double")


@register("i7_projection")
def i7_projection(spark, d):
    """2-D / 3-D projection table with the class of every row."""
    h, fit = _pca(spark, d)
    return R.project(h, fit, 3, ["row_id", "target"])
