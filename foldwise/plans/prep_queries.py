"""Queries for sources/sinks (A), cleaning (B) and encoders/scalers (C)."""

from __future__ import annotations


from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.keys import hindex, hindex_sql
from foldwise.operators import clean as CL
from foldwise.operators import features as FE
from foldwise.operators import split as S
from foldwise.plans.catalog import key_sql, r6, register
from foldwise.plans.knn_queries import holdout_sql, std_params_sql
from foldwise.session import run_dir
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq
from foldwise.sources import tables as TB

NULL_EVERY = 50   # about 2% of cells are replaced by the missing-value token


def _text_dir(spark, d: str, name: str) -> str:
    return run_dir(spark, f"foldwise-text/{name}")


def _spoil(df, cols: list[str], token: str = "?"):
    """Cells replaced by ``token`` where md5('0-q1-<col>-<id>') mod 50 = 0; all text."""
    out = [F.col("row_id").cast("string").alias("row_id")]
    for c in df.columns:
        if c == "row_id":
            continue
        v = F.col(c).cast("string")
        if c in cols:
            h = hindex(F.md5(F.concat_ws("-", F.lit("0"), F.lit("q1"), F.lit(c), F.col("row_id").cast("string"))))
            v = F.when(h % NULL_EVERY == 0, F.lit(token)).otherwise(v)
        out.append(v.alias(c))
    return df.select(*out)


def _spoil_sql(cols_all: list[str], spoil: list[str], src: str, token_null: bool = True) -> str:
    sel = []
    for c in cols_all:
        if c in spoil:
            h = hindex_sql(f"md5(concat_ws('-', '0', 'q1', '{c}', cast(row_id as varchar)))")
            sel.append(f"case when {h} % {NULL_EVERY} = 0 then null else {c} end as {c}")
        else:
            sel.append(c)
    return f"select {', '.join(sel)} from {src}"


N1_SCHEMA = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("target", T.IntegerType())]
                         + [T.StructField(c, T.DoubleType()) for c in fx.N1_FEATURES])


def a1_frame(spark, d):
    n1 = fx.n1(spark, d)
    path = _text_dir(spark, d, "n1-headerless")
    _spoil(n1, fx.N1_FEATURES).write.mode("overwrite").option("header", False).csv(path)
    return TB.read_headerless(spark, path, N1_SCHEMA, null_token="?")


_A1_SQL = fq.with_(n1=fq.N1) + ", sp as (" + _spoil_sql(["row_id", "target"] + fx.N1_FEATURES, fx.N1_FEATURES, "n1") + ")\n"


@register("a1_read_headerless", _A1_SQL + "select row_id, target, " + ", ".join(
    f"round({c}, 6) as {c}" for c in fx.N1_FEATURES) + " from sp")
def a1_read_headerless(spark, d):
    """N1 written as headerless CSV with '?' in ~2% of cells, read back with fixed names."""
    df = a1_frame(spark, d)
    return df.select("row_id", "target", *[r6(c).alias(c) for c in fx.N1_FEATURES])


T1_COLS = ["row_id", "target"] + fx.T_NUMERIC + fx.T_CATEGORICAL
T1_SCHEMA = T.StructType([T.StructField("row_id", T.StringType()), T.StructField("target", T.IntegerType())]
                         + [T.StructField(c, T.DoubleType()) for c in fx.T_NUMERIC]
                         + [T.StructField(c, T.StringType()) for c in fx.T_CATEGORICAL])


def a2_frame(spark, d):
    t1 = fx.t1(spark, d)
    path = _text_dir(spark, d, "t1-padded")
    spoiled = _spoil(t1, fx.T_NUMERIC + fx.T_CATEGORICAL)
    spoiled.write.mode("overwrite").option("header", False).option("sep", ", ").csv(path)
    return TB.read_headerless(spark, path, T1_SCHEMA, null_token="?", trim=True)


_A2_SQL = fq.with_(t1=fq.T1) + ", sp as (" + _spoil_sql(T1_COLS, fx.T_NUMERIC + fx.T_CATEGORICAL, "t1") + ")\n"


@register("a2_read_padded", _A2_SQL + "select row_id, target, " + ", ".join(
    [f"round({c}, 6) as {c}" for c in fx.T_NUMERIC] + fx.T_CATEGORICAL) + " from sp")
def a2_read_padded(spark, d):
    """T1 written with ', ' separators and '?' tokens, read back trimmed."""
    df = a2_frame(spark, d)
    return df.select("row_id", "target", *[r6(c).alias(c) for c in fx.T_NUMERIC], *fx.T_CATEGORICAL)


@register("a3_read_semicolon", fq.with_(c1=fq.C1) + "select * from c1")
def a3_read_semicolon(spark, d):
    """C1 written as ';' CSV with header and quoted fields, read back."""
    c1 = fx.c1(spark, d)
    path = _text_dir(spark, d, "c1-semicolon")
    c1.write.mode("overwrite").option("header", True).option("sep", ";").option("quoteAll", True).csv(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("target", T.IntegerType())]
                          + [T.StructField(c, T.StringType()) for c in fx.C1_COLUMNS])
    return TB.read_csv(spark, path, schema, sep=";")


@register("a4_read_csv_header", fq.with_(n2=fq.N2) + "select row_id, target, " + ", ".join(
    f"round({c}, 6) as {c}" for c in fx.N2_FEATURES) + " from n2")
def a4_read_csv_header(spark, d):
    """N2 written as comma CSV with a header, read back with an explicit schema."""
    n2 = fx.n2(spark, d)
    path = _text_dir(spark, d, "n2-header")
    n2.write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("target", T.IntegerType())]
                          + [T.StructField(c, T.DoubleType()) for c in fx.N2_FEATURES])
    df = TB.read_csv(spark, path, schema)
    return df.select("row_id", "target", *[r6(c).alias(c) for c in fx.N2_FEATURES])


@register("a5_read_table", fq.with_(r1=fq.R1) + "select row_id, round(target, 6) as target, " + ", ".join(
    f"round({c}, 6) as {c}" for c in fx.R1_FEATURES) + " from r1")
def a5_read_table(spark, d):
    """Ready-made table as (row_id, target, features) with double features."""
    r = TB.read_table(fx.r1(spark, d), fx.R1_FEATURES, "target", "row_id")
    return r.select("row_id", r6("target").alias("target"), *[r6(c).alias(c) for c in fx.R1_FEATURES])


@register("a6_result_union", fq.with_(n1=fq.N1) + """select 'rate' as kind, cast(target as varchar) as grp,
  round(avg(avg_price), 6) as mean_price, cast(count(*) as bigint) as n, null as max_qty from n1 group by target
union all select 'qty', cast(cast(o_month as integer) as varchar), null, cast(count(*) as bigint),
  round(max(sum_qty), 6) from n1 group by o_month""")
def a6_result_union(spark, d):
    """Two result tables with different columns unioned by name (missing -> null),
    written to parquet in the shared folder and read back."""
    n1 = fx.n1(spark, d)
    a = n1.groupBy("target").agg(r6(F.avg("avg_price")).alias("mean_price"), F.count(F.lit(1)).alias("n")).select(
        F.lit("rate").alias("kind"), F.col("target").cast("string").alias("grp"), "mean_price", "n")
    b = n1.groupBy("o_month").agg(F.count(F.lit(1)).alias("n"), r6(F.max("sum_qty")).alias("max_qty")).select(
        F.lit("qty").alias("kind"), F.col("o_month").cast("int").cast("string").alias("grp"), "n", "max_qty")
    path = _text_dir(spark, d, "a6-results")
    TB.save_result([a, b], path, "parquet")
    return spark.read.parquet(path).select("kind", "grp", "mean_price", "n", "max_qty")


def _a7_sql() -> str:
    from foldwise.plans.metric_queries import MODELS, Y1L_SQL
    cols = ", ".join(f"max(case when model = '{m}' then score end) as oof_{m}" for m in MODELS)
    return Y1L_SQL + f"select row_id, y as y_true, {cols} from yl group by row_id, y"


@register("a7_wide_oof", _a7_sql())
def a7_wide_oof(spark, d):
    """Long (row, model, score) predictions pivoted to one column per model."""
    from foldwise.plans.metric_queries import MODELS, y1_long
    yl = y1_long(spark, d).withColumnRenamed("y", "y_true")
    return TB.wide_oof(yl, list(MODELS), label="y_true", value="score")


def _a8_sql() -> str:
    from foldwise.plans.catalog import ORACLE
    cols = ", ".join(f"max(case when model_b = '{m}' then rho end) as {m}" for m in ("t1", "t2", "t3"))
    return f"select model_a, {cols} from ({ORACLE['j18_rank_agreement']}) x group by model_a"


@register("a8_labelled_matrix", _a8_sql())
def a8_labelled_matrix(spark, d):
    """Spearman agreement (J18) pivoted to a labelled model x model matrix."""
    from foldwise.operators import metrics as M
    from foldwise.plans.metric_queries import importance_vectors
    long = M.spearman_matrix(importance_vectors(spark, d)).withColumn("rho", r6("rho"))
    return TB.labelled_matrix(long, "model_a", "model_b", "rho", ["t1", "t2", "t3"])


# ---------------------------------------------------------------- B
@register("b1_drop_incomplete", _A1_SQL + "select count(*) as n_rows, cast(sum(target) as bigint) as n_pos from sp where "
          + " and ".join(f"{c} is not null" for c in fx.N1_FEATURES))
def b1_drop_incomplete(spark, d):
    """Rows left after dropping any row with a null (from the spoiled N1 text)."""
    df = CL.drop_incomplete(a1_frame(spark, d))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("target").cast("bigint").alias("n_pos"))


@register("b2_drop_incomplete_features", _A2_SQL.replace(
    "sp as (" + _spoil_sql(T1_COLS, fx.T_NUMERIC + fx.T_CATEGORICAL, "t1"),
    "sp as (" + _spoil_sql(T1_COLS, fx.T_NUMERIC + fx.T_CATEGORICAL + ["target"], "t1")) +
    "select count(*) as n_rows, count(target) as n_target from sp where " + " and ".join(
        f"{c} is not null" for c in fx.T_NUMERIC + fx.T_CATEGORICAL))
def b2_drop_incomplete_features(spark, d):
    """Null features drop a row; a null target does not (target spoiled too)."""
    t1 = fx.t1(spark, d)
    path = _text_dir(spark, d, "t1-padded-target")
    _spoil(t1, fx.T_NUMERIC + fx.T_CATEGORICAL + ["target"]).write.mode("overwrite").option("sep", ", ").csv(path)
    df = TB.read_headerless(spark, path, T1_SCHEMA, null_token="?", trim=True)
    df = CL.drop_incomplete(df, fx.T_NUMERIC + fx.T_CATEGORICAL)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count("target").alias("n_target"))


@register("b3_binarise", fq.with_(n1=fq.N1, c1=fq.C1) + """select 'gt0' as rule, cast(sum(case when sum_qty > 100 then 1 else 0 end) as bigint) as n_pos from n1
union all select 'eq2', cast(sum(case when o_month = 2 then 1 else 0 end) as bigint) from n1
union all select 'eqp', cast(sum(case when o_orderstatus = 'P' then 1 else 0 end) as bigint) from c1""")
def b3_binarise(spark, d):
    """Three predicate targets: a threshold, an equality on a number, on a string."""
    n1, c1 = fx.n1(spark, d), fx.c1(spark, d)
    a = CL.binarise(n1, F.col("sum_qty") > 100).agg(F.sum("target").alias("n_pos")).select(F.lit("gt0").alias("rule"), "n_pos")
    b = CL.binarise(n1, F.col("o_month") == 2).agg(F.sum("target").alias("n_pos")).select(F.lit("eq2").alias("rule"), "n_pos")
    c = CL.binarise(c1, F.col("o_orderstatus") == "P").agg(F.sum("target").alias("n_pos")).select(F.lit("eqp").alias("rule"), "n_pos")
    return a.unionByName(b).unionByName(c).select("rule", F.col("n_pos").cast("bigint").alias("n_pos"))


@register("b4_binarise_text", """select c_custkey as row_id,
  cast(lower(c_mktsegment) = 'building' as integer) as is_building,
  cast(trim(' ' || c_mktsegment || ' ') = 'MACHINERY' as integer) as is_machinery from customer""")
def b4_binarise_text(spark, d):
    """Text targets: lower-cased equality, and trimmed equality of padded text."""
    c = TB.table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"), "c_mktsegment")
    c = CL.binarise_text(c, "c_mktsegment", "building", trim=False, lower=True, out="is_building")
    c = c.withColumn("_pad", F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
    c = CL.binarise_text(c, "_pad", "MACHINERY", trim=True, out="is_machinery")
    return c.select("row_id", "is_building", "is_machinery")


@register("b5_b6_drop_and_cast", """select c_custkey as row_id, cast(c_nationkey as double) as c_nationkey,
  cast(c_acctbal as double) as c_acctbal from customer""")
def b5_b6_drop_and_cast(spark, d):
    """Identifier-like and text columns dropped, remaining features cast to double."""
    c = TB.table(spark, d, "customer").drop("c_name", "c_mktsegment").withColumnRenamed("c_custkey", "row_id")
    return CL.to_double(c, ["c_nationkey", "c_acctbal"])


@register("b7_coerce_number", """select row_id, try_cast(trim(q) as double) as l_quantity from (
  select l_orderkey * 10 + l_linenumber as row_id,
         case when cast(('0x' || substr(md5(concat_ws('-', '0', 'blank', cast(l_orderkey as varchar),
              cast(l_linenumber as varchar))), 1, 15)) as bigint) % 50 = 0 then ' '
              else ' ' || cast(cast(l_quantity as bigint) as varchar) || ' ' end as q from lineitem) x""")
def b7_coerce_number(spark, d):
    """Padded number text with blanks in ~2% of rows -> double / null."""
    li = TB.table(spark, d, "lineitem")
    h = hindex(F.md5(F.concat_ws("-", F.lit("0"), F.lit("blank"), F.col("l_orderkey").cast("string"),
                                 F.col("l_linenumber").cast("string"))))
    txt = F.when(h % 50 == 0, F.lit(" ")).otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("bigint").cast("string"), F.lit(" ")))
    df = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"), txt.alias("l_quantity"))
    return CL.coerce_number(df, "l_quantity")


@register("b8_b9_first_present_indicator", """select c_custkey as row_id,
  cast(c_mktsegment = 'BUILDING' as integer) as segment_is_BUILDING from customer""")
def b8_b9_first_present_indicator(spark, d):
    """Column resolved under one of two names, then a 0/1 indicator of one value."""
    c = TB.table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("Gender"))
    c = CL.first_present(c, ["Genre", "Gender"], "segment")
    return CL.indicator(c, "segment", "BUILDING").select("row_id", "segment_is_BUILDING")


@register("b10_quantile_bucket", fq.with_(t3=fq.T3_RAW) + """, q as (select quantile_cont(l_extendedprice, 1/3) as q1,
  quantile_cont(l_extendedprice, 2/3) as q2 from t3)
select row_id, cast((q1 < l_extendedprice)::int + (q2 < l_extendedprice)::int as integer) as target from t3, q""")
def b10_quantile_bucket(spark, d):
    """Three classes from exact tercile cuts of price, right-closed."""
    b = CL.quantile_bucket(fx.t3_raw(spark, d), "l_extendedprice")
    return b.select("row_id", F.col("target").cast("int"))


def _b11_sql() -> str:
    pairs = CL.feature_pairs(fx.N2_FEATURES)
    return fq.with_(n2=fq.N2) + " union all ".join(
        f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as corr from n2" for a, b in pairs)


@register("b11_feature_pairs", _b11_sql())
def b11_feature_pairs(spark, d):
    """Every 2-feature combination with its correlation, in one aggregation."""
    n2 = fx.n2(spark, d)
    pairs = CL.feature_pairs(fx.N2_FEATURES)
    row = n2.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    arr = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r6(F.col(f"`{a}|{b}`")).alias("corr"))
                    for a, b in pairs])
    return row.select(F.explode(arr).alias("x")).select("x.*")


def _b12_sql() -> str:
    parts = [f"""select '{c}' as column, count({c}) as n, round(avg({c}), 6) as mean, round(stddev_samp({c}), 6) as std,
  round(min({c}), 6) as min, round(quantile_cont({c}, 0.25), 6) as q25, round(quantile_cont({c}, 0.5), 6) as q50,
  round(quantile_cont({c}, 0.75), 6) as q75, round(max({c}), 6) as max from n1""" for c in fx.N1_FEATURES]
    parts.append("select 'target', count(*), round(avg(cast(target as double)), 6), null, null, null, null, null, null from n1")
    return fq.with_(n1=fq.N1) + " union all ".join(parts)


@register("b12_profile", _b12_sql())
def b12_profile(spark, d):
    """Tidy profile: count, mean, sample std, min, quartiles, max per feature; positive rate."""
    p = CL.profile(fx.n1(spark, d), fx.N1_FEATURES, "target")
    return p.select("column", "n", *[r6(c).alias(c) for c in ("mean", "std", "min", "q25", "q50", "q75", "max")])


# ---------------------------------------------------------------- C1, C2
def _dummy_long(df, cols, vocab, drop_first, by=None):
    enc = FE.dummies(df, cols, vocab, drop_first=drop_first, keep=list(by or []))
    names = [c for c in enc.columns if c not in (by or [])]
    arr = F.array(*[F.struct(F.lit(n).alias("dummy"), F.col(f"`{n}`").alias("v")) for n in names])
    long = enc.select(*(by or []), F.explode(arr).alias("x")).select(*(by or []), "x.dummy", "x.v")
    return long.groupBy(*(by or []), "dummy").agg(F.sum("v").cast("bigint").alias("n_ones"))


@register("c1_dummies", fq.with_(t1=fq.T1) + " union all ".join(
    f"""select '{c}_' || {c} as dummy, count(*) as n_ones from t1
where {c} <> (select min({c}) from t1) group by {c}""" for c in fx.T_CATEGORICAL))
def c1_dummies(spark, d):
    """Sorted-vocabulary dummies with the first level dropped; ones per dummy column."""
    t1 = fx.t1(spark, d)
    return _dummy_long(t1, fx.T_CATEGORICAL, FE.vocabulary(t1, fx.T_CATEGORICAL), True)


@register("c2_one_hot_unseen", fq.with_(c1=fq.C1) + f""", h as ({holdout_sql("c1", 0.25, 0)}),
v as (select distinct n_name as lvl from h where is_test = 0),
lv as (select lvl from v)
select h.is_test, 'n_name_' || lv.lvl as dummy, cast(sum(case when h.n_name = lv.lvl then 1 else 0 end) as bigint) as n_ones
from h, lv group by h.is_test, lv.lvl
union all
select is_test, '__unseen__', cast(sum(case when n_name not in (select lvl from v) then 1 else 0 end) as bigint) from h group by is_test""")
def c2_one_hot_unseen(spark, d):
    """One-hot with a vocabulary fitted on train rows; test rows with an unseen
    level encode as all zeros (counted as __unseen__)."""
    h = S.holdout(fx.c1(spark, d), 0.25, 0, by="target")
    vocab = FE.vocabulary(h.filter("is_test = 0"), ["n_name"])
    long = _dummy_long(h, ["n_name"], vocab, False, by=["is_test"])
    enc = FE.one_hot(h, ["n_name"], vocab, keep=["is_test"])
    dummies = [c for c in enc.columns if c != "is_test"]
    zero = sum((F.col(f"`{c}`") for c in dummies), F.lit(0.0)) == 0
    uns = enc.groupBy("is_test").agg(F.sum(zero.cast("int")).cast("bigint").alias("n_ones")).withColumn(
        "dummy", F.lit("__unseen__"))
    return long.unionByName(uns.select("is_test", "dummy", "n_ones"))


# ---------------------------------------------------------------- C3 - C9 (fold-wise parameters on N2)
def _fold_n2(spark, d):
    return S.kfold(fx.n2(spark, d), 5, 0, by="target")


_FOLD_N2_SQL = fq.with_(n2=fq.N2) + f""", fo as (select x.*,
  (coalesce(o.off, 0) + row_number() over (partition by x.target order by x.k, x.row_id) - 1) % 5 as fold
  from (select *, {key_sql(0, 'fold')} as k from n2) x
  join (select target as t2, sum(count(*)) over (order by target rows between unbounded preceding and 1 preceding)
        as off from n2 group by target) o on x.target = o.t2),
tr as (select fl.fold, f.* exclude (fold) from fo f join (select unnest(range(0, 5)) as fold) fl on f.fold <> fl.fold)
"""


def _param_out(p, cols):
    return p.select(F.col("fold").cast("int").alias("fold"),
                    *[r6(f"{c}__{s}").alias(f"{c}__{s}") for c in cols for s in ("center", "scale")])


def _param_sql(center_expr, scale_expr) -> str:
    sel = ", ".join(f"round({center_expr(c)}, 6) as {c}__center, round({scale_expr(c)}, 6) as {c}__scale"
                    for c in fx.N2_FEATURES)
    return _FOLD_N2_SQL + f"select cast(fold as integer) as fold, {sel} from tr group by fold"


def _sd(c):
    return f"sqrt(greatest(sum({c} * {c}) / count(*) - (sum({c}) / count(*)) * (sum({c}) / count(*)), 0.0))"


@register("c3_standard_scaler", _param_sql(lambda c: f"sum({c}) / count(*)",
                                           lambda c: f"case when {_sd(c)} = 0 then 1.0 else {_sd(c)} end"))
def c3_standard_scaler(spark, d):
    """Per-fold mean / population std fitted on the other folds (one pass)."""
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "standard", fold_col="fold"), fx.N2_FEATURES)


@register("c4_standard_uncentred", _param_sql(lambda c: "cast(0.0 as double)",
                                              lambda c: f"case when {_sd(c)} = 0 then 1.0 else {_sd(c)} end"))
def c4_standard_uncentred(spark, d):
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "standard", fold_col="fold", center=False),
                      fx.N2_FEATURES)


@register("c5_minmax_scaler", _param_sql(lambda c: f"min({c})",
                                         lambda c: f"case when max({c}) - min({c}) = 0 then 1.0 else max({c}) - min({c}) end"))
def c5_minmax_scaler(spark, d):
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "minmax", fold_col="fold"), fx.N2_FEATURES)


def _iqr(c):
    return f"(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"


@register("c6_robust_scaler", _param_sql(lambda c: f"quantile_cont({c}, 0.5)",
                                         lambda c: f"case when {_iqr(c)} = 0 then 1.0 else {_iqr(c)} end"))
def c6_robust_scaler(spark, d):
    """Per-fold median / IQR by exact linear quantiles (distributed)."""
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "robust", fold_col="fold"), fx.N2_FEATURES)


@register("c7_maxabs_scaler", _param_sql(lambda c: "cast(0.0 as double)",
                                         lambda c: f"case when max(abs({c})) = 0 then 1.0 else max(abs({c})) end"))
def c7_maxabs_scaler(spark, d):
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "maxabs", fold_col="fold"), fx.N2_FEATURES)


@register("c8_no_scaling", _FOLD_N2_SQL + "select cast(fold as integer) as fold, " + ", ".join(
    f"cast(0.0 as double) as {c}__center, cast(1.0 as double) as {c}__scale" for c in fx.N2_FEATURES)
    + " from fo group by fold")
def c8_no_scaling(spark, d):
    return _param_out(FE.fit_scaler(_fold_n2(spark, d), fx.N2_FEATURES, "none", fold_col="fold"), fx.N2_FEATURES)


@register("c9_inverse_scale", fq.with_(n2=fq.N2) + "select row_id, " + ", ".join(
    f"round({c}, 4) as {c}" for c in fx.N2_FEATURES) + " from n2")
def c9_inverse_scale(spark, d):
    """Scale with fitted parameters, then map back to raw units."""
    n2 = fx.n2(spark, d)
    p = FE.fit_scaler(n2, fx.N2_FEATURES, "standard")
    back = FE.inverse_scale(FE.apply_scaler(n2, p, fx.N2_FEATURES), p, fx.N2_FEATURES)
    from foldwise.plans.catalog import sql_round
    return back.select("row_id", *[sql_round(c, 4).alias(c) for c in fx.N2_FEATURES])


# ---------------------------------------------------------------- C10 - C12 (R1, standardised)
POLY_COLS = ["l_quantity", "l_discount", "l_tax", "p_size"]


def _poly_sql(degree: int, interaction_only: bool, folds: bool = False) -> str:
    ms = FE.monomials(POLY_COLS, degree, interaction_only)
    if not folds:
        par = std_params_sql("(select *, 0 as is_test from r1)", POLY_COLS, cv=False)
        sc = "s as (select " + ", ".join(f"(r1.{c} - p.m_{c}) / p.d_{c} as {c}" for c in POLY_COLS) + " from r1, p)"
        body = " union all ".join(
            f"select '{FE.monomial_name(m)}' as monomial, round(avg({' * '.join(m)}), 6) + 0.0 as mean from s" for m in ms)
        return fq.with_(r1=fq.R1) + f", p as ({par}), {sc} " + body
    fo = f"fo as (select *, cast((row_number() over (order by {key_sql(0, 'fold')}, row_id) - 1) % 5 as integer) as fold from r1)"
    par = std_params_sql("fo", POLY_COLS, cv=True, by="g")
    par = par.replace("select f.g, fl.fold", "select 0 as g, fl.fold").replace("group by f.g, fl.fold", "group by fl.fold")
    sc = ("s as (select fo.fold, " + ", ".join(f"(fo.{c} - p.m_{c}) / p.d_{c} as {c}" for c in POLY_COLS)
          + " from fo join p on fo.fold = p.fold)")
    body = " union all ".join(
        f"select fold, '{FE.monomial_name(m)}' as monomial, round(avg({' * '.join(m)}), 6) + 0.0 as mean from s group by fold"
        for m in ms)
    return fq.with_(r1=fq.R1) + f", {fo}, p as ({par}), {sc} " + body


def _poly_means(df, degree, interaction_only, by=None):
    ex = FE.poly(df, POLY_COLS, degree, interaction_only, keep=list(by or []))
    names = [FE.monomial_name(m) for m in FE.monomials(POLY_COLS, degree, interaction_only)]
    arr = F.array(*[F.struct(F.lit(n).alias("monomial"), F.col(f"`{n}`").alias("v")) for n in names])
    long = ex.select(*(by or []), F.explode(arr).alias("x")).select(*(by or []), "x.monomial", "x.v")
    # + 0.0 folds a rounded -0.0 into 0.0 (means of centred columns are ~0)
    return long.groupBy(*(by or []), "monomial").agg((r6(F.avg("v")) + F.lit(0.0)).alias("mean"))


@register("c10_polynomial", _poly_sql(3, False))
def c10_polynomial(spark, d):
    """Degree-3 polynomial expansion of standardised features; mean of each monomial."""
    r1 = fx.r1(spark, d)
    p = FE.fit_scaler(r1, POLY_COLS, "standard")
    return _poly_means(FE.apply_scaler(r1, p, POLY_COLS), 3, False)


@register("c11_polynomial_interaction_only", _poly_sql(3, True))
def c11_polynomial_interaction_only(spark, d):
    r1 = fx.r1(spark, d)
    p = FE.fit_scaler(r1, POLY_COLS, "standard")
    return _poly_means(FE.apply_scaler(r1, p, POLY_COLS), 3, True)


@register("c12_leak_safe_recipe", _poly_sql(2, False, folds=True))
def c12_leak_safe_recipe(spark, d):
    """Scale (fitted on the other folds) then expand, per fold: monomial means of held-out rows."""
    f = S.kfold(fx.r1(spark, d), 5, 0)
    p = FE.fit_scaler(f, POLY_COLS, "standard", fold_col="fold")
    sc = FE.apply_scaler(f, p, POLY_COLS, fold_col="fold")
    return _poly_means(sc, 2, False, by=["fold"]).select(F.col("fold").cast("int"), "monomial", "mean")
