"""Queries for metrics and result aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from foldwise.operators import metrics as M
from foldwise.operators import split as S
from foldwise.plans.catalog import key_sql, r6, register, sql_round
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq
from foldwise.sources.tables import table

MODELS = ("m1", "m2", "m3")


def y1_long(spark, d):
    """Scored test set in long form: (model, row_id, y, score, pred)."""
    y = fx.y1(spark, d)
    parts = [y.select(F.lit(m).alias("model"), "row_id", "y", F.col(f"score_{i}").alias("score"))
             for i, m in enumerate(MODELS, start=1)]
    long = reduce(lambda a, b: a.unionByName(b), parts)
    return long.withColumn("pred", (F.col("score") >= 0.5).cast("int"))


Y1L_SQL = fq.with_(y1=fq.Y1) + ", yl as (" + " union all ".join(
    f"select '{m}' as model, row_id, y, score_{i} as score, cast(score_{i} >= 0.5 as integer) as pred from y1"
    for i, m in enumerate(MODELS, start=1)) + ")\n"


# ---------------------------------------------------------------- J1 - J4
@register("j1_accuracy", Y1L_SQL + "select model, round(avg(cast(y = pred as double)), 6) as accuracy from yl group by model")
def j1_accuracy(spark, d):
    return M.accuracy(y1_long(spark, d), ["model"]).select("model", r6("accuracy").alias("accuracy"))


_PRF_SQL = """round(case when sum(cast(pred = 1 as double)) > 0 then sum(cast(y = 1 and pred = 1 as double))
   / sum(cast(pred = 1 as double)) else 0 end, 6) as precision,
 round(case when sum(cast(y = 1 as double)) > 0 then sum(cast(y = 1 and pred = 1 as double))
   / sum(cast(y = 1 as double)) else 0 end, 6) as recall,
 round(case when sum(cast(pred = 1 as double)) + sum(cast(y = 1 as double)) > 0
   then 2 * sum(cast(y = 1 and pred = 1 as double)) / (sum(cast(pred = 1 as double)) + sum(cast(y = 1 as double)))
   else 0 end, 6) as f1"""


@register("j2_precision_recall_f1", Y1L_SQL + f"select model, {_PRF_SQL} from yl group by model")
def j2_precision_recall_f1(spark, d):
    r = M.prf(y1_long(spark, d), ["model"])
    return r.select("model", *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@register("j3_confusion", Y1L_SQL + """select g.model, g.t as true_label, g.p as pred_label,
  cast(coalesce(c.n, 0) as bigint) as n
from (select m.model, t.t, p.p from (select distinct model from yl) m, (select unnest([0, 1]) as t) t,
      (select unnest([0, 1]) as p) p) g
left join (select model, y, pred, count(*) as n from yl group by model, y, pred) c
  on g.model = c.model and g.t = c.y and g.p = c.pred""")
def j3_confusion(spark, d):
    return M.confusion(y1_long(spark, d), ["model"], [0, 1])


def _cr_sql() -> str:
    per = " union all ".join(f"""select model, '{v}' as row,
  case when sum(cast(pred = {v} as double)) > 0 then sum(cast(y = {v} and pred = {v} as double))
    / sum(cast(pred = {v} as double)) else 0 end as precision,
  case when sum(cast(y = {v} as double)) > 0 then sum(cast(y = {v} and pred = {v} as double))
    / sum(cast(y = {v} as double)) else 0 end as recall,
  case when sum(cast(pred = {v} as double)) + sum(cast(y = {v} as double)) > 0
    then 2 * sum(cast(y = {v} and pred = {v} as double)) / (sum(cast(pred = {v} as double))
    + sum(cast(y = {v} as double))) else 0 end as f1,
  sum(cast(y = {v} as bigint)) as support from yl group by model""" for v in (0, 1))
    return Y1L_SQL + f""", cls as ({per}),
allr as (select * from cls
  union all select model, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from cls group by model
  union all select model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) from cls group by model
  union all select model, 'accuracy', null, null, avg(cast(y = pred as double)), count(*) from yl group by model)
select model, row, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
       cast(support as bigint) as support from allr"""


@register("j4_class_report", _cr_sql())
def j4_class_report(spark, d):
    r = M.class_report(y1_long(spark, d), ["model"], [0, 1])
    return r.select("model", "row", *[r6(c).alias(c) for c in ("precision", "recall", "f1")],
                    F.col("support").cast("bigint").alias("support"))


# ---------------------------------------------------------------- J5 - J8
_SC_SQL = """, sc as (select model, score, sum(cast(y = 1 as bigint)) as pos, sum(cast(y <> 1 as bigint)) as neg
            from yl group by model, score),
cum as (select *, coalesce(sum(pos) over (partition by model order by score desc rows between unbounded preceding
               and 1 preceding), 0) + pos as tp,
               coalesce(sum(neg) over (partition by model order by score desc rows between unbounded preceding
               and 1 preceding), 0) + neg as fp,
               coalesce(sum(neg) over (partition by model order by score asc rows between unbounded preceding
               and 1 preceding), 0) as neg_below,
               sum(pos) over (partition by model) as P, sum(neg) over (partition by model) as N from sc)
"""


@register("j5_roc_auc", Y1L_SQL + _SC_SQL + """select model,
  round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) as roc_auc from cum group by model""")
def j5_roc_auc(spark, d):
    return M.roc_auc(y1_long(spark, d), ["model"]).select("model", r6("roc_auc").alias("roc_auc"))


@register("j6_roc_curve", Y1L_SQL + _SC_SQL + """select model, cast(score as double) as threshold,
  round(fp / N, 6) as fpr, round(tp / P, 6) as tpr from cum
union all select distinct model, cast('inf' as double), 0.0, 0.0 from yl""")
def j6_roc_curve(spark, d):
    r = M.roc_curve(y1_long(spark, d), ["model"])
    return r.select("model", "threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@register("j7_pr_curve", Y1L_SQL + _SC_SQL + """select model, cast(score as double) as threshold,
  round(tp / (tp + fp), 6) as precision, round(tp / P, 6) as recall from cum
union all select distinct model, cast(null as double), 1.0, 0.0 from yl""")
def j7_pr_curve(spark, d):
    r = M.pr_curve(y1_long(spark, d), ["model"])
    return r.select("model", "threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@register("j8_average_precision", Y1L_SQL + _SC_SQL + """select model,
  round(sum((pos / P) * (tp / (tp + fp))), 6) as average_precision from cum group by model""")
def j8_average_precision(spark, d):
    r = M.average_precision(y1_long(spark, d), ["model"])
    return r.select("model", r6("average_precision").alias("average_precision"))


# ---------------------------------------------------------------- J9 - J11
@register("j9_brier", Y1L_SQL + "select model, round(avg((score - y) * (score - y)), 6) as brier from yl group by model")
def j9_brier(spark, d):
    return M.brier(y1_long(spark, d), ["model"]).select("model", r6("brier").alias("brier"))


_CAL_SQL = ", e as (select model, " + ", ".join(
    f"quantile_cont(score, {i / 10}) as e{i}" for i in range(1, 10)) + """ from yl group by model),
cal as (select yl.model, """ + " + ".join(f"cast(e.e{i} < yl.score as integer)" for i in range(1, 10)) + """ as bin,
          avg(score) as mean_pred, avg(cast(y as double)) as frac_pos, count(*) as n
        from yl join e on yl.model = e.model group by yl.model, bin)
"""


@register("j10_calibration", Y1L_SQL + _CAL_SQL + """select model, cast(bin as integer) as bin,
  round(mean_pred, 6) as mean_pred, round(frac_pos, 6) as frac_pos, n from cal""")
def j10_calibration(spark, d):
    c = M.calibration(y1_long(spark, d), ["model"], 10)
    return c.select("model", F.col("bin").cast("int"), r6("mean_pred").alias("mean_pred"),
                    r6("frac_pos").alias("frac_pos"), "n")


@register("j11_calibration_overlay", Y1L_SQL + _CAL_SQL + """select cal.model, cast(bin as integer) as bin,
  round(mean_pred, 6) as mean_pred, round(frac_pos, 6) as frac_pos, round(b.brier, 6) as brier
from cal join (select model, avg((score - y) * (score - y)) as brier from yl group by model) b on cal.model = b.model""")
def j11_calibration_overlay(spark, d):
    yl = y1_long(spark, d)
    c = M.calibration(yl, ["model"], 10).join(M.brier(yl, ["model"]), "model")
    return c.select("model", F.col("bin").cast("int"), r6("mean_pred").alias("mean_pred"),
                    r6("frac_pos").alias("frac_pos"), r6("brier").alias("brier"))


# ---------------------------------------------------------------- J12 - J14 (fixed linear score on R1)
R1P_SQL = fq.with_(r1=fq.R1) + ", rp as (select row_id, target as y, 0.9 * l_extendedprice / 10000.0 as pred from r1)\n"


def r1_scored(spark, d):
    return fx.r1(spark, d).select("row_id", F.col("target").alias("y"),
                                  (F.lit(0.9) * F.col("l_extendedprice") / 10000.0).alias("pred"))


@register("j12_r2", R1P_SQL + "select round(1 - sum((y - pred) * (y - pred)) / (sum(y * y) - count(*) * avg(y) * avg(y)), 6) as r2 from rp")
def j12_r2(spark, d):
    return M.r2(r1_scored(spark, d), []).select(r6("r2").alias("r2"))


@register("j13_mae", R1P_SQL + "select round(avg(abs(y - pred)), 6) as mae from rp")
def j13_mae(spark, d):
    return M.mae(r1_scored(spark, d), []).select(r6("mae").alias("mae"))


@register("j14_residual_histogram", R1P_SQL + """, r as (select y - pred as resid from rp),
mm as (select min(resid) as lo, max(resid) as hi from r),
b as (select lo, hi, cast(case when hi = lo then 0 else least(floor((resid - lo) / ((hi - lo) / 40)), 39) end
             as integer) as bin from r, mm)
select bin, count(*) as n, round(min(lo) + bin * (min(hi) - min(lo)) / 40, 6) as edge_lo from b group by bin""")
def j14_residual_histogram(spark, d):
    h = M.residual_histogram(r1_scored(spark, d), [], 40)
    return h.select(F.col("bin").cast("int"), "n", r6("edge_lo").alias("edge_lo"))


# ---------------------------------------------------------------- J15, J16, J22-J24 (per-fold scores)
def fold_scores(spark, d):
    """Accuracy of each Y1 model on each of 5 hashed folds: (model, fold, score)."""
    yl = y1_long(spark, d)
    folds = S.kfold(fx.y1(spark, d).select("row_id"), 5, 0)
    return M.accuracy(yl.join(folds, "row_id"), ["model", "fold"], out="score")


FOLD_SQL = Y1L_SQL + f""", fo as (select row_id, (row_number() over (order by {key_sql(0, 'fold')}, row_id) - 1) % 5 as fold
             from y1),
fs as (select model, fold, avg(cast(y = pred as double)) as score from yl join fo using (row_id) group by model, fold)
"""


@register("j15_mean_std", FOLD_SQL + "select model, round(avg(score), 6) as score_mean, round(stddev_pop(score), 6) as score_std from fs group by model")
def j15_mean_std(spark, d):
    r = M.mean_std(fold_scores(spark, d), ["model"], ["score"])
    return r.select("model", r6("score_mean").alias("score_mean"), r6("score_std").alias("score_std"))


@register("j16_summary", FOLD_SQL + """select model, round(avg(score), 4) as mean, round(stddev_samp(score), 4) as std,
  round(min(score), 4) as min, round(max(score), 4) as max from fs group by model""")
def j16_summary(spark, d):
    return M.summary(fold_scores(spark, d), ["model"], "score")


@register("j22_matrix", FOLD_SQL + """select cast(fold as integer) as fold,
  round(max(case when model = 'm1' then score end), 6) as m1, round(max(case when model = 'm2' then score end), 6) as m2,
  round(max(case when model = 'm3' then score end), 6) as m3 from fs group by fold""")
def j22_matrix(spark, d):
    m = M.matrix(fold_scores(spark, d), "fold", ["model"], "score", list(MODELS))
    return m.select(F.col("fold").cast("int"), *[r6(c).alias(c) for c in MODELS])


@register("j23_two_level_matrix", Y1L_SQL + f""", fo as (select row_id,
   (row_number() over (order by {key_sql(0, 'fold')}, row_id) - 1) % 5 as fold from y1)
select model, {", ".join(f"round(avg(case when fold = {f} and y = {v} then score end), 6) as \"{f}|{v}\""
                         for f in range(5) for v in (0, 1))}
from yl join fo using (row_id) group by model""")
def j23_two_level_matrix(spark, d):
    yl = y1_long(spark, d).join(S.kfold(fx.y1(spark, d).select("row_id"), 5, 0), "row_id")
    cells = yl.groupBy("model", "fold", "y").agg(F.avg("score").alias("v"))
    labels = [f"{f}|{v}" for f in range(5) for v in (0, 1)]
    m = M.matrix(cells, "model", ["fold", "y"], "v", labels)
    return m.select("model", *[r6(F.col(f"`{c}`")).alias(c) for c in labels])


@register("j24_score_list", FOLD_SQL + """select model, string_agg(printf('%.4f', score), ';' order by fold) as raw_scores
from fs group by model""")
def j24_score_list(spark, d):
    return M.score_list(fold_scores(spark, d), ["model"], "fold", "score")


# ---------------------------------------------------------------- J17
def _interval(t, acc):
    """Accuracy of ``t``, and mean and 2.5 / 97.5 percentiles over its resamples."""
    from foldwise.functions.quantiles import exact_quantiles
    q = exact_quantiles(acc, ["a"], [0.025, 0.975])
    lo = q.filter(F.col("p") == 0.025).select(F.col("q").alias("boot_ci_lo"))
    hi = q.filter(F.col("p") == 0.975).select(F.col("q").alias("boot_ci_hi"))
    base = acc.agg(F.avg("a").alias("boot_mean"), F.count(F.lit(1)).alias("n_boot"))
    test = t.agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias("test_acc"))
    out = test.withColumn("_k", F.lit(1))
    for x in (base, lo, hi):
        out = out.join(x.withColumn("_k", F.lit(1)), "_k")
    return out.select(r6("test_acc").alias("test_acc"), r6("boot_mean").alias("boot_mean"),
                      r6("boot_ci_lo").alias("boot_ci_lo"), r6("boot_ci_hi").alias("boot_ci_hi"), "n_boot")


_J17_SQL = Y1L_SQL + f""", t as (select * from yl where model = 'm1'),
o as (select row_id, y, pred, row_number() over (order by {key_sql(0, 'ord')}, row_id) as ord from t),
n as (select count(*) as n from t),
slots as (select b, cast(('0x' || substr(md5(concat_ws('-', '0', 'boot', cast(b as varchar), cast(o.ord as varchar))), 1, 15)) as bigint) % n.n + 1 as pick
          from o, n, (select unnest(range(1, 201)) as b) bb),
acc as (select b, avg(cast(o.y = o.pred as double)) as a from slots join o on slots.pick = o.ord group by b)
select round((select avg(cast(y = pred as double)) from t), 6) as test_acc, round(avg(a), 6) as boot_mean,
       round(quantile_cont(a, 0.025), 6) as boot_ci_lo, round(quantile_cont(a, 0.975), 6) as boot_ci_hi,
       count(*) as n_boot from acc"""


def _j17(spark, d):
    t = y1_long(spark, d).filter("model = 'm1'")
    hit = F.when(F.col("y") == F.col("pred"), F.col("w")).when(F.col("y") != F.col("pred"), F.lit(0))
    draws = S.bootstrap_draws(t.select("row_id", "y", "pred"), 200, 0, counted=True).withColumn("_hit", hit)
    share = F.sum("_hit").cast("double") / F.sum(F.when(F.col("_hit").isNotNull(), F.col("w"))).cast("double")
    return _interval(t, draws.groupBy("b").agg(share.alias("a")))


@register("j17_bootstrap_ci", _J17_SQL)
def j17_bootstrap_ci(spark, d):
    """Bootstrap interval of the accuracy from resamples of exactly n draws."""
    return _j17(spark, d)


@register("j17_bootstrap_ci_exact", _J17_SQL)
def j17_bootstrap_ci_exact(spark, d):
    """As ``j17_bootstrap_ci``; the name under which the exact resamples were kept
    while that one counted Poisson draws."""
    return _j17(spark, d)


@register("j17_bootstrap_ci_poisson", Y1L_SQL + f""", t as (select * from yl where model = 'm1'),
w as ({S.bootstrap_weights_sql('t', 200, 0)}),
acc as (select b, cast(sum(case when y = pred then w else 0 end) as double) / cast(sum(w) as double) as a from w group by b)
select round((select avg(cast(y = pred as double)) from t), 6) as test_acc, round(avg(a), 6) as boot_mean,
       round(quantile_cont(a, 0.025), 6) as boot_ci_lo, round(quantile_cont(a, 0.975), 6) as boot_ci_hi,
       count(*) as n_boot from acc""")
def j17_bootstrap_ci_poisson(spark, d):
    """Bootstrap interval of the accuracy from Poisson(1) counts, in one pass."""
    t = y1_long(spark, d).filter("model = 'm1'")
    w = S.bootstrap_weights(t.select("row_id", "y", "pred"), 200, 0)
    hit = F.sum(F.when(F.col("y") == F.col("pred"), F.col("w")).otherwise(0)).cast("double")
    return _interval(t, w.groupBy("b").agg((hit / F.sum("w").cast("double")).alias("a")))


# ---------------------------------------------------------------- J18 (importance vectors from the data)
THRESHOLDS = (52000.0, 77000.0, 91000.0)


def importance_vectors(spark, d):
    """(model, feature, value): |corr(feature, net > threshold)| rounded to 2
    places (ties occur), one 'model' per threshold — computed by Spark from T1."""
    base = fx._t_base(spark, d)
    parts = []
    for i, thr in enumerate(THRESHOLDS, start=1):
        y = (F.col("net") > thr).cast("double")
        row = base.agg(*[sql_round(F.abs(F.corr(F.col(c).cast("double"), y)), 2).alias(c) for c in fx.T_NUMERIC])
        arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in fx.T_NUMERIC])
        parts.append(row.select(F.lit(f"t{i}").alias("model"), F.explode(arr).alias("fv"))
                     .select("model", "fv.feature", "fv.value"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def _imp_sql() -> str:
    base = fq._T_BASE
    sel = []
    expr = {c: c for c in fx.T_NUMERIC}
    expr["ship_month"] = "month(l_shipdate)"
    for i, thr in enumerate(THRESHOLDS, start=1):
        for c in fx.T_NUMERIC:
            sel.append(f"select 't{i}' as model, '{c}' as feature, (select round(abs(corr(cast({expr[c]} as double), "
                       f"cast({fq.NET} > {thr} as double))), 2) {base}) as value")
    return " union all ".join(sel)


@register("j18_rank_agreement", f"""with v as ({_imp_sql()}),
r as (select model, feature, rank() over (partition by model order by value)
             + (count(*) over (partition by model, value) - 1) / 2.0 as rk from v)
select a.model as model_a, b.model as model_b,
       round(case when a.model = b.model then 1.0 else corr(a.rk, b.rk) end, 6) as rho
from r a join r b on a.feature = b.feature group by a.model, b.model""")
def j18_rank_agreement(spark, d):
    r = M.spearman_matrix(importance_vectors(spark, d))
    return r.select("model_a", "model_b", r6("rho").alias("rho"))


# ---------------------------------------------------------------- J19 - J21, J25
@register("j19_pareto_front", """select p_partkey, p_retailprice, p_size from part p
where not exists (select 1 from part o where o.p_retailprice <= p.p_retailprice and o.p_size >= p.p_size
                  and (o.p_retailprice < p.p_retailprice or o.p_size > p.p_size))""")
def j19_pareto_front(spark, d):
    """Parts not dominated on (cheaper, larger)."""
    p = table(spark, d, "part").select("p_partkey", "p_retailprice", "p_size")
    return M.pareto_front(p, "p_retailprice", "p_size", minimize_x=True, maximize_y=True)


@register("j20_best_row", """select p_type, p_partkey, p_retailprice from part
qualify row_number() over (partition by p_type order by p_retailprice desc, p_partkey) = 1""")
def j20_best_row(spark, d):
    p = table(spark, d, "part").select("p_type", "p_partkey", "p_retailprice")
    return M.best_row(p, "p_retailprice", ["p_type"], ["p_partkey"])


@register("j21_top_n", """select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit 10""")
def j21_top_n(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return M.top_n(c, "c_acctbal", 10, ["c_custkey"])


@register("j25_cumulative_share", """with s as (select p_size, sum(p_retailprice) as v from part group by p_size),
t as (select sum(v) as tot from s)
select cast(p_size as integer) as p_size, round(v / tot, 6) as share,
       round(sum(v) over (order by p_size rows between unbounded preceding and current row) / tot, 6) as cumulative
from s, t""")
def j25_cumulative_share(spark, d):
    p = table(spark, d, "part")
    s = p.groupBy("p_size").agg(F.sum("p_retailprice").alias("v"))
    tot = p.agg(F.sum("p_retailprice")).scalar()
    c = M.cumulative(s, "p_size", "v")
    return c.select(F.col("p_size").cast("int"), r6(F.col("v") / tot).alias("share"),
                    r6(F.col("cumulative") / tot).alias("cumulative"))


# ---------------------------------------------------------------- J28
_SCORES = ["score_1", "score_2", "score_3"]


@register("j28_row_sum_mean", fq.with_(y1=fq.Y1) + """, s as (select *, score_1 + score_2 + score_3 as total from y1)
select 'raw' as form, round(avg(total), 6) as proba_rowsum_mean from s
union all select 'normalised', round(avg(score_1 / nullif(total, 0) + score_2 / nullif(total, 0) + score_3 / nullif(total, 0)), 6) from s""")
def j28_row_sum_mean(spark, d):
    """Mean sum of three one-vs-rest scores a row, as they are and after normalisation."""
    y = fx.y1(spark, d).select("row_id", *_SCORES)
    raw = M.row_sum_mean(y, _SCORES).withColumn("form", F.lit("raw"))
    out = raw.unionByName(M.row_sum_mean(M.normalised(y, _SCORES), _SCORES).withColumn("form", F.lit("normalised")))
    return out.select("form", r6("proba_rowsum_mean").alias("proba_rowsum_mean"))
