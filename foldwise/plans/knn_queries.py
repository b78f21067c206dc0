"""Queries for neighbour joins and kNN studies."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldwise.operators import features as FE
from foldwise.operators import knn as KN
from foldwise.plans import knn_study as KS
from foldwise.plans.catalog import key_sql, r6, register
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq

SEED = 0


# ------------------------------------------------------------------ SQL builders
def strat_folds_sql(src: str, seeds: list[int], k: int = 5) -> str:
    """(src columns..., seed, fold): stratified folds, one copy per seed."""
    parts = []
    for s in seeds:
        parts.append(f"""select x.*, {s} as seed,
  (coalesce(o.off, 0) + row_number() over (partition by x.target order by x.k, x.row_id) - 1) % {k} as fold
from (select *, {key_sql(s, 'fold')} as k from {src}) x
join (select target as t2, sum(count(*)) over (order by target rows between unbounded preceding and 1 preceding)
             as off from {src} group by target) o on x.target = o.t2""")
    return "\nunion all\n".join(parts)


def holdout_sql(src: str, frac: float, seed: int, strat: bool = True, salt: str = "holdout") -> str:
    part = "partition by target " if strat else ""
    over = "(partition by target)" if strat else "()"
    return (f"select *, cast(row_number() over ({part}order by {key_sql(seed, salt)}, row_id) "
            f"<= ceil({frac} * count(*) over {over}) as integer) as is_test from {src}")


def std_params_sql(src: str, feats: list[str], cv: bool, k: int = 5, by: str = "seed") -> str:
    """Per (by, fold): mean and population std on the train side (sum form)."""
    aggs = ", ".join(f"sum({c}) as s_{c}, sum({c} * {c}) as ss_{c}" for c in feats)
    if cv:
        base = (f"select f.{by}, fl.fold, count(*) as n, {aggs.replace('sum(', 'sum(f.')} from {src} f "
                f"join (select unnest(range(0, {k})) as fold) fl on f.fold <> fl.fold group by f.{by}, fl.fold")
    else:
        base = f"select 0 as {by}, 0 as fold, count(*) as n, {aggs} from {src} where is_test = 0"
    outs = []
    for c in feats:
        sd = f"sqrt(greatest(ss_{c} / n - (s_{c} / n) * (s_{c} / n), 0.0))"
        outs.append(f"s_{c} / n as m_{c}, case when {sd} = 0 then 1.0 else {sd} end as d_{c}")
    return f"select {by}, fold, {', '.join(outs)} from ({base}) b"


def none_params_sql(feats: list[str], by: str = "seed") -> str:
    return f"select 0 as {by}, 0 as fold, " + ", ".join(f"0.0 as m_{c}, 1.0 as d_{c}" for c in feats)


def scaled_sql(alias: str, feats: list[str], p: str = "p") -> str:
    return ", ".join(f"({alias}.{c} - {p}.m_{c}) / {p}.d_{c} as {c}" for c in feats)


def topk_sql(q: str, t: str, feats: list[str], metric: str, kmax: int, on: str, part: str) -> str:
    ds, d = KN.dist_sql([f"q.{c}" for c in feats], [f"t.{c}" for c in feats], KN.METRICS[metric])
    return f"""select q.*, t.tid, t.label, {ds} as dist_s, {d} as dist, '{metric}' as metric,
  row_number() over (partition by {part} order by {ds}, t.tid) as rank
from {q} q join {t} t on {on}
qualify rank <= {kmax}"""


def vote_sql(nb: str, ks: list[int], keys: str) -> str:
    """Predicted label per (keys, k, weights, qid); same rules as knn_classify."""
    kl = ", ".join(str(k) for k in ks)
    return f"""
ex as (select nb.*, ks.k from {nb} nb join (select unnest([{kl}]) as k) ks on nb.rank <= ks.k),
per as (select {keys}, k, qid, label, cast(count(*) as double) as n,
               sum(case when dist > 0 then 1.0 / dist else 0.0 end) as inv,
               sum(case when dist = 0 then 1.0 else 0.0 end) as z
        from ex group by {keys}, k, qid, label),
sc as (select {keys}, k, qid, label, 'uniform' as weights, n as score from per
       union all
       select {keys}, k, qid, label, 'distance' as weights,
              case when max(z) over (partition by {keys}, k, qid) > 0 then z else inv end as score from per),
pred as (select {keys}, k, weights, qid, label as pred from sc
         qualify row_number() over (partition by {keys}, k, weights, qid order by score desc, label asc) = 1)"""


def regress_sql(nb: str, ks: list[int], keys: str) -> str:
    kl = ", ".join(str(k) for k in ks)
    return f"""
ex as (select nb.*, ks.k from {nb} nb join (select unnest([{kl}]) as k) ks on nb.rank <= ks.k),
agg as (select {keys}, k, qid, avg(label) as u,
               sum(case when dist > 0 then label / dist end) as wy, sum(case when dist > 0 then 1.0 / dist end) as w,
               avg(case when dist = 0 then label end) as z from ex group by {keys}, k, qid),
pred as (select {keys}, k, 'uniform' as weights, qid, u as pred from agg
         union all
         select {keys}, k, 'distance' as weights, qid, case when z is not null then z else wy / w end as pred from agg)"""


# ------------------------------------------------------------------ E1
def _e1_sql() -> str:
    f = fx.N2_FEATURES
    return fq.with_(n2=fq.N2) + f""", h as (select *, 1 as is_test0 from n2),
p as ({std_params_sql("(select *, 0 as is_test from n2)", f, cv=False)}),
s as (select n2.row_id, {scaled_sql("n2", f)} from n2, p),
q as (select row_id as qid, {", ".join(f)} from s),
t as (select row_id as tid, 0 as label, {", ".join(f)} from s),
nb as ({topk_sql("q", "t", f, "euclidean", 5, "true", "q.qid")})
select qid, cast(rank as integer) as rank, tid, round(dist, 6) as dist from nb"""


def _e1(spark, d, **sizes):
    n2 = fx.n2(spark, d)
    p = FE.fit_scaler(n2, fx.N2_FEATURES, "standard")
    s = FE.apply_scaler(n2, p, fx.N2_FEATURES)
    nb = KN.knn_join(s, s, fx.N2_FEATURES, 5, "euclidean", **sizes)
    return nb.select("qid", "rank", "tid", r6("dist").alias("dist"))


@register("e1_knn_join", _e1_sql())
def e1_knn_join(spark, d):
    """Exact 5-NN of every customer among all customers."""
    return _e1(spark, d)


@register("e1_knn_join_band", _e1_sql())
def e1_knn_join_band(spark, d):
    """Same neighbours through many small cells, several tiles each."""
    return _e1(spark, d, cell_rows=64, tile_rows=40)


# ------------------------------------------------------------------ E2
def _e2_sql() -> str:
    f = fx.N2_FEATURES
    return fq.with_(n2=fq.N2) + f""", h as ({holdout_sql("n2", 0.25, SEED)}),
p as ({std_params_sql("h", f, cv=False)}),
s as (select h.row_id, h.target, h.is_test, {scaled_sql("h", f)} from h, p),
q as (select 0 as g, row_id as qid, target as y, {", ".join(f)} from s where is_test = 1),
t as (select row_id as tid, target as label, {", ".join(f)} from s where is_test = 0),
nb as ({topk_sql("q", "t", f, "manhattan", 5, "true", "q.qid")}),
{vote_sql("nb", [5], "g")}
select pred.qid, pred.weights, pred.pred from pred"""


@register("e2_knn_classify", _e2_sql())
def e2_knn_classify(spark, d):
    """Hold-out kNN votes (k=5, manhattan), uniform and distance weighted."""
    te, tr = KS.holdout_tables(fx.n2(spark, d), fx.N2_FEATURES, 0.25, SEED)
    nb = KN.knn_join(te, tr, fx.N2_FEATURES, 5, "manhattan")
    return KN.knn_classify(nb, [5], []).select("qid", "weights", "pred")


# ------------------------------------------------------------------ E3
def _e3_sql() -> str:
    f = fx.KR_FEATURES
    return fq.with_(kr=fq.KR) + f""", h as ({holdout_sql("kr", 0.25, SEED, strat=False)}),
p as ({std_params_sql("h", f, cv=False)}),
s as (select h.row_id, h.target, h.is_test, {scaled_sql("h", f)} from h, p),
q as (select 0 as g, row_id as qid, {", ".join(f)} from s where is_test = 1),
t as (select row_id as tid, target as label, {", ".join(f)} from s where is_test = 0),
nb as ({topk_sql("q", "t", f, "manhattan", 10, "true", "q.qid")}),
{regress_sql("nb", [10], "g")}
select qid, weights, round(pred, 6) as pred from pred"""


@register("e3_knn_regress", _e3_sql())
def e3_knn_regress(spark, d):
    """Hold-out kNN regression (k=10, manhattan, scaled), both weightings."""
    df = fx.kr(spark, d)
    te, tr = KS.holdout_tables(df, fx.KR_FEATURES, 0.25, SEED, stratify=False)
    nb = KN.knn_join(te, tr, fx.KR_FEATURES, 10, "manhattan")
    return KN.knn_regress(nb, [10], []).select("qid", "weights", r6("pred").alias("pred"))


# ------------------------------------------------------------------ E4 (flagship)
def knn_sweep_sql(src_sql: str, feats: list[str], ks: list[int], seeds: list[int], metrics) -> str:
    nb_parts = "\nunion all\n".join(
        f"select * from ({topk_sql('q', 't', feats, m, max(ks), 'q.seed = t.seed and q.fold = t.fold', 'q.seed, q.qid')})"
        for m in metrics)
    return fq.with_(src=src_sql) + f""", fo as ({strat_folds_sql("src", seeds)}),
p as ({std_params_sql("fo", feats, cv=True)}),
q as (select fo.seed, fo.fold, fo.row_id as qid, fo.target as y, {scaled_sql("fo", feats)}
      from fo join p on fo.seed = p.seed and fo.fold = p.fold),
t as (select fo.seed, p.fold, fo.row_id as tid, fo.target as label, {scaled_sql("fo", feats)}
      from fo join p on fo.seed = p.seed and fo.fold <> p.fold),
nb as ({nb_parts}),
{vote_sql("nb", ks, "seed, metric, fold")},
scored as (select pred.*, q.y from pred join q on pred.seed = q.seed and pred.qid = q.qid),
pf as (select seed, metric, k, weights, fold, avg(cast(y = pred as double)) as acc,
              case when sum(cast(pred = 1 as double)) + sum(cast(y = 1 as double)) > 0
                   then 2 * sum(cast(y = 1 and pred = 1 as double))
                        / (sum(cast(pred = 1 as double)) + sum(cast(y = 1 as double))) else 0.0 end as f1
       from scored group by seed, metric, k, weights, fold),
ps as (select seed, metric, k, weights, avg(acc) as acc, avg(f1) as f1 from pf group by seed, metric, k, weights)
select k as n_neighbors, weights, metric, round(avg(acc), 6) as acc_mean, round(stddev_pop(acc), 6) as acc_std,
       round(avg(f1), 6) as f1_mean, round(stddev_pop(f1), 6) as f1_std, count(*) as n_seeds
from ps group by k, weights, metric"""


def _round_sweep(df):
    return df.select(F.col("n_neighbors").cast("int").alias("n_neighbors"), "weights", "metric",
                     r6("acc_mean").alias("acc_mean"), r6("acc_std").alias("acc_std"),
                     r6("f1_mean").alias("f1_mean"), r6("f1_std").alias("f1_std"), "n_seeds")


@register("e4_knn_sweep", knn_sweep_sql(fq.N2, fx.N2_FEATURES, KS.K_VALUES, [0, 1, 2], KS.METRIC_NAMES))
def e4_knn_sweep(spark, d):
    """Flagship: stratified 5-fold CV accuracy/F1 over k x weights x metric,
    3 seeds, fold-wise standard scaling, one neighbour table per (seed, metric)."""
    return _round_sweep(KS.knn_sweep(fx.n2(spark, d), fx.N2_FEATURES))


# ------------------------------------------------------------------ E4 regression grid
REG_K = [1, 3, 5, 10, 20, 50, 100, 200]


def _e4r_sql() -> str:
    f = fx.KR_FEATURES
    parts = []
    for scaled in (False, True):
        par = std_params_sql("h", f, cv=False) if scaled else none_params_sql(f)
        sc = "true" if scaled else "false"
        for m in ("euclidean", "manhattan"):
            for split, flag in (("test", 1), ("train", 0)):
                parts.append(f"""select {sc} as scaled, '{split}' as split, nb.* from (
  with p as ({par}),
  s as (select h.row_id, h.target, h.is_test, {scaled_sql("h", f)} from h, p),
  q as (select 0 as g, row_id as qid, target as y, {", ".join(f)} from s where is_test = {flag}),
  t as (select row_id as tid, target as label, {", ".join(f)} from s where is_test = 0)
  {topk_sql("q", "t", f, m, max(REG_K), "true", "q.qid")}) nb""")
    allnb = "\nunion all\n".join(parts)
    return fq.with_(kr=fq.KR) + f""", h as ({holdout_sql("kr", 0.25, SEED, strat=False)}),
nb as ({allnb}),
{regress_sql("nb", REG_K, "scaled, split, metric")},
scored as (select pred.*, h.target as y from pred join h on pred.qid = h.row_id),
g as (select k, weights, metric, scaled, split, 1 - sum((y - pred) * (y - pred))
               / (sum(y * y) - count(*) * avg(y) * avg(y)) as r2, avg(abs(y - pred)) as mae
      from scored group by k, weights, metric, scaled, split)
select a.k, a.weights, a.metric, a.scaled, round(a.r2, 6) + 0.0 as train_r2, round(b.r2, 6) + 0.0 as test_r2,
       round(b.mae, 6) + 0.0 as test_mae
from g a join g b on a.k = b.k and a.weights = b.weights and a.metric = b.metric and a.scaled = b.scaled
where a.split = 'train' and b.split = 'test'"""


@register("e4_knn_regression_grid", _e4r_sql())
def e4_knn_regression_grid(spark, d):
    """k x weights x metric x scaled regression grid: train/test R², test MAE."""
    g = KS.knn_regression_grid(fx.kr(spark, d), fx.KR_FEATURES, REG_K)
    return g.select(F.col("k").cast("int").alias("k"), "weights", "metric", "scaled",
                    # + 0.0 folds a rounded -0.0 (R² of exactly 0 when k covers the whole train set)
                    (r6("train_r2") + 0.0).alias("train_r2"), (r6("test_r2") + 0.0).alias("test_r2"),
                    (r6("test_mae") + 0.0).alias("test_mae"))


# ------------------------------------------------------------------ E5
SURFACE_PAIR = ("spend_urgent", "spend_high")
SURFACE_K = [1, 5, 25]


def _e5_sql(steps: int = 220) -> str:
    a, b = SURFACE_PAIR
    f = [a, b]
    return fq.with_(n2=fq.N2) + f""", h as ({holdout_sql("n2", 0.25, SEED)}),
p as ({std_params_sql("h", f, cv=False)}),
s as (select h.row_id, h.target, h.is_test, {scaled_sql("h", f)} from h, p),
t as (select row_id as tid, target as label, {a}, {b} from s where is_test = 0),
r as (select min({a}) as a_lo, max({a}) as a_hi, min({b}) as b_lo, max({b}) as b_hi from t),
q as (select 0 as g, ix * {steps} + iy as qid, ix, iy,
             (a_lo - 0.5) + ((a_hi + 0.5) - (a_lo - 0.5)) * ix / {steps - 1} as {a},
             (b_lo - 0.5) + ((b_hi + 0.5) - (b_lo - 0.5)) * iy / {steps - 1} as {b}
      from r, (select unnest(range(0, {steps})) as ix) xs, (select unnest(range(0, {steps})) as iy) ys),
nb as ({topk_sql("q", "t", f, "euclidean", max(SURFACE_K), "true", "q.qid")}),
{vote_sql("nb", SURFACE_K, "g")}
select pred.k, q.ix, q.iy, round(q.{a}, 6) as x, round(q.{b}, 6) as y, pred.pred as label
from pred join q on pred.qid = q.qid where pred.weights = 'uniform'"""


@register("e5_decision_surface", _e5_sql())
def e5_decision_surface(spark, d):
    """220 x 220 grid over the padded scaled range of a feature pair, labelled for k in {1, 5, 25}."""
    s = KS.decision_surface(fx.n2(spark, d), SURFACE_PAIR, SURFACE_K)
    return s.select(F.col("k").cast("int").alias("k"), F.col("ix").cast("bigint").alias("ix"),
                    F.col("iy").cast("bigint").alias("iy"), r6("x").alias("x"), r6("y").alias("y"), "label")
