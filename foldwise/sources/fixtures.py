"""Stand-in study tables built from the driver's parquet tables.

The reference studies public data sets that cannot be fetched here; each
builder below derives a table of the same *shape* (id, features, target)
from the whole of the given tables, so its size grows with them.  Every
builder has a DuckDB twin in ``fixtures_sql`` with identical formulas.

Targets are planted from the features (the raw tables carry no signal),
following the formulas fixed in FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.keys import hkey, huniform
from foldwise.sources.tables import table

# Fixed values (thresholds and shifts of the planted targets).
N1_NET_THRESHOLD = 52000.0
N2_SHARE_THRESHOLD = 0.4
T1_NET_THRESHOLD = 77000.0
T2_NET_THRESHOLD = 91000.0
S1_THRESHOLD = 120.0
Y1_SHIFTS = (0.05, 0.15, 0.3)
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PRIORITY_COLS = ("spend_urgent", "spend_high", "spend_medium", "spend_unspecified", "spend_low")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

N1_FEATURES = ["n_lines", "sum_qty", "avg_disc", "avg_tax", "avg_price", "max_price",
               "o_totalprice", "o_month"]
N2_FEATURES = list(PRIORITY_COLS) + ["c_acctbal"]
R1_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size",
               "p_retailprice", "ship_month", "s_acctbal"]
T_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size",
             "p_retailprice", "ship_month"]
T_CATEGORICAL = ["l_returnflag", "l_linestatus", "o_orderpriority", "p_type"]
C1_COLUMNS = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", "o_quarter", "o_year"]
M1_FEATURES = ["total_spend", "n_orders", "recency_days", "is_building"]
L1_FEATURES = ["f_spend", "f_orders", "f_acctbal"]
P1_DIMS = 64
S1_FEATURES = ["hour", "k", "value"] + [f"is_{e}" for e in EVENT_TYPES]


def net_expr() -> F.Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))


def lineitem_row_id() -> F.Column:
    """Unique lineitem key (the table has no natural one)."""
    parts = [F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
             F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"),
             F.col("l_quantity").cast("bigint").cast("string"),
             F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
             F.round(F.col("l_discount") * 100).cast("bigint").cast("string"),
             F.round(F.col("l_tax") * 100).cast("bigint").cast("string"),
             F.col("l_returnflag"), F.col("l_linestatus"),
             F.col("l_shipdate").cast("date").cast("string")]
    return F.md5(F.concat_ws("|", *parts))


def n1(spark: SparkSession, d: str) -> DataFrame:
    """Heart-disease stand-in: one row per order with its line aggregates."""
    li = table(spark, d, "lineitem")
    agg = (li.groupBy("l_orderkey")
           .agg(F.count(F.lit(1)).cast("double").alias("n_lines"),
                F.sum("l_quantity").alias("sum_qty"),
                F.avg("l_discount").alias("avg_disc"),
                F.avg("l_tax").alias("avg_tax"),
                F.avg("l_extendedprice").alias("avg_price"),
                F.max("l_extendedprice").alias("max_price"),
                F.avg(net_expr()).alias("avg_net")))
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice",
                                          F.month("o_orderdate").cast("double").alias("o_month"))
    j = o.join(agg, o.o_orderkey == agg.l_orderkey, "inner")
    return j.select(F.col("o_orderkey").alias("row_id"),
                    (F.col("avg_net") > N1_NET_THRESHOLD).cast("int").alias("target"),
                    *[F.col(c).cast("double").alias(c) for c in N1_FEATURES])


def n2(spark: SparkSession, d: str) -> DataFrame:
    """Wholesale stand-in: per-customer spend by order priority + balance."""
    o = table(spark, d, "orders")
    spend = (o.groupBy("o_custkey")
             .agg(*[F.sum(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))
                          .otherwise(F.lit(0.0))).alias(c)
                    for p, c in zip(PRIORITIES, PRIORITY_COLS)]))
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    j = c.join(spend, c.c_custkey == spend.o_custkey, "left")
    cols = [F.coalesce(F.col(x), F.lit(0.0)).alias(x) for x in PRIORITY_COLS]
    j = j.select(F.col("c_custkey").alias("row_id"), *cols, F.col("c_acctbal").cast("double"))
    total = sum((F.col(x) for x in PRIORITY_COLS), F.lit(0.0))
    share = F.when(total > 0, (F.col("spend_urgent") + F.col("spend_high")) / total).otherwise(0.0)
    return j.select("row_id", (share > N2_SHARE_THRESHOLD).cast("int").alias("target"), *N2_FEATURES)


def r1(spark: SparkSession, d: str) -> DataFrame:
    """Housing stand-in: every lineitem with part and supplier numerics; target net/10000."""
    li = table(spark, d, "lineitem")
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    s = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    j = li.join(p, li.l_partkey == p.p_partkey).join(s, li.l_suppkey == s.s_suppkey)
    j = j.withColumn("ship_month", F.month("l_shipdate"))
    return j.select(lineitem_row_id().alias("row_id"), (net_expr() / 10000.0).alias("target"),
                    *[F.col(c).cast("double").alias(c) for c in R1_FEATURES])


def _t_base(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    p = table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice", "p_type")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.withColumn("ship_month", F.month("l_shipdate")).withColumn("net", net_expr())


def t1(spark: SparkSession, d: str, threshold: float = T1_NET_THRESHOLD) -> DataFrame:
    """Telco / Adult stand-in: mixed numeric + categorical; binary target net > threshold."""
    j = _t_base(spark, d)
    return j.select(lineitem_row_id().alias("row_id"),
                    (F.col("net") > threshold).cast("int").alias("target"),
                    *[F.col(c).cast("double").alias(c) for c in T_NUMERIC],
                    *[F.col(c) for c in T_CATEGORICAL])


def t2(spark: SparkSession, d: str) -> DataFrame:
    """Bank-marketing stand-in: as T1 with a rarer positive class."""
    return t1(spark, d, T2_NET_THRESHOLD)


def t3_raw(spark: SparkSession, d: str) -> DataFrame:
    """3-class stand-in before bucketing: price kept as the bucketing source."""
    j = _t_base(spark, d)
    num = [c for c in T_NUMERIC if c != "l_extendedprice"]
    return j.select(lineitem_row_id().alias("row_id"),
                    F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
                    F.col("net").cast("double").alias("net"),
                    *[F.col(c).cast("double").alias(c) for c in num],
                    *[F.col(c) for c in T_CATEGORICAL])


def c1(spark: SparkSession, d: str) -> DataFrame:
    """Mushroom stand-in: all-string columns, exactly separable target."""
    o = table(spark, d, "orders")
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    pr = F.col("o_orderpriority")
    tgt = (((F.substring(pr, 1, 2) == "1-") | (F.substring(pr, 1, 2) == "2-"))
           & (F.col("o_orderstatus") != "F")) | (F.col("c_mktsegment") == "BUILDING")
    return j.select(F.col("o_orderkey").alias("row_id"), tgt.cast("int").alias("target"),
                    "o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name",
                    F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("o_quarter"),
                    F.year("o_orderdate").cast("string").alias("o_year"))


def m1(spark: SparkSession, d: str) -> DataFrame:
    """Mall-customer stand-in: per customer spend, order count, recency, segment flag."""
    o = table(spark, d, "orders")
    last_all = o.agg(F.max(F.to_date("o_orderdate")).alias("m")).scalar()
    per = (o.groupBy("o_custkey")
           .agg(F.sum("o_totalprice").alias("total_spend"),
                F.count(F.lit(1)).cast("double").alias("n_orders"),
                F.max(F.to_date("o_orderdate")).alias("last_date")))
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    j = c.join(per, c.c_custkey == per.o_custkey, "inner")
    return j.select(F.col("c_custkey").alias("row_id"), "total_spend", "n_orders",
                    F.datediff(last_all, F.col("last_date")).cast("double").alias("recency_days"),
                    (F.col("c_mktsegment") == "BUILDING").cast("double").alias("is_building"))


def l1(spark: SparkSession, d: str) -> DataFrame:
    """Two labelings of the customers (segment; nation mod 5) over three features."""
    o = table(spark, d, "orders")
    per = (o.groupBy("o_custkey")
           .agg(F.sum("o_totalprice").alias("spend"), F.count(F.lit(1)).alias("cnt")))
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey")
    j = c.join(per, c.c_custkey == per.o_custkey, "inner")
    return j.select(F.col("c_custkey").alias("row_id"),
                    F.col("c_mktsegment").alias("label_a"),
                    (F.col("c_nationkey") % 5).cast("string").alias("label_b"),
                    (F.col("spend") / 100000.0).alias("f_spend"),
                    F.col("cnt").cast("double").alias("f_orders"),
                    (F.col("c_acctbal") / 1000.0).alias("f_acctbal"))


def p1(spark: SparkSession, d: str) -> DataFrame:
    """Breast-cancer stand-in: embedding exploded to 64 columns; planted target."""
    e = table(spark, d, "embeddings")
    cols = [F.element_at("embedding", i + 1).cast("double").alias(f"e{i}") for i in range(P1_DIMS)]
    df = e.select(F.col("vec_id").alias("row_id"), F.col("label").cast("int").alias("label"), *cols)
    proj = sum((F.col(f"e{i}") for i in range(8)), F.lit(0.0)) - sum(
        (F.col(f"e{i}") for i in range(8, 16)), F.lit(0.0))
    return df.withColumn("target", (proj > 0).cast("int"))


def s1(spark: SparkSession, d: str) -> DataFrame:
    """Adult-as-a-stream stand-in: events with hour, k, value and type dummies."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.select(F.col("event_id").alias("row_id"), "ts",
                    F.hour("ts").cast("double").alias("hour"), k.alias("k"),
                    F.col("value").cast("double").alias("value"),
                    *[(F.col("event_type") == t).cast("double").alias(f"is_{t}") for t in EVENT_TYPES],
                    ((F.col("value") + k) > S1_THRESHOLD).cast("int").alias("target"))


def y1(spark: SparkSession, d: str) -> DataFrame:
    """A scored test set: y = order finished; three scores, rounded so ties occur."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    y = (F.col("o_orderstatus") == "F").cast("int")
    out = o.select(F.col("o_orderkey").alias("row_id"), y.alias("y"))
    for m, shift in enumerate(Y1_SHIFTS, start=1):
        u = huniform(hkey(0, f"y1m{m}", "row_id"))
        # floor(x*100 + 0.5)/100 rather than round(): both engines then do the
        # same IEEE arithmetic, so tie-inducing 2-decimal scores agree bit for bit
        out = out.withColumn(f"score_{m}", F.floor((u * 0.7 + F.col("y") * shift) * 100 + 0.5) / 100.0)
    return out


KR_FEATURES = ["n_orders", "recency_days", "is_building", "acctbal_k"]


def kr(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour-regression stand-in: per customer, target = spend / 1e5."""
    m = m1(spark, d)
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("row_id"),
                                           (F.col("c_acctbal") / 1000.0).alias("acctbal_k"))
    j = m.join(c, "row_id")
    return j.select("row_id", (F.col("total_spend") / 100000.0).alias("target"), *KR_FEATURES)
