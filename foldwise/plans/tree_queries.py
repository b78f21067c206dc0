"""Queries for trees and ensembles."""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from functools import partial

from pyspark.errors import PySparkException
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from foldwise.operators import boosting as BO
from foldwise.operators import extra_trees as ET
from foldwise.operators import features as FE
from foldwise.operators import glm as G
from foldwise.operators import metrics as M
from foldwise.operators import split as S
from foldwise.plans import boost_sql as BSQL
from foldwise.plans.catalog import r6, register, sql_round
from foldwise.session import run_dir
from foldwise.sources import fixtures as fx
from foldwise.sources import fixtures_sql as fq

SEED = 0
CRITERIA = ("gini", "entropy")
DEPTHS = (2, 4, 6, 8, 12, 30)        # 30 is Spark's maximum, standing for "unlimited"
LEAVES = (1, 5, 20)


def c1_design(spark, d):
    """C1 one-hot (all levels, vocabulary from train rows) with a stratified 75/25 split."""
    h = S.holdout(fx.c1(spark, d), 0.25, SEED, by="target")
    vocab = FE.vocabulary(h.filter("is_test = 0"), fx.C1_COLUMNS)
    enc = FE.one_hot(h, fx.C1_COLUMNS, vocab, keep=["row_id", "target", "is_test"])
    feats = [c for c in enc.columns if c not in ("row_id", "target", "is_test")]
    safe = [f"f{i}" for i in range(len(feats))]
    enc = enc.select("row_id", "target", "is_test", *[F.col(f"`{c}`").alias(s) for c, s in zip(feats, safe)])
    return enc, safe, dict(zip(safe, feats))


def _tree(criterion, depth, leaf, seed=SEED):
    return DecisionTreeClassifier(featuresCol="features", labelCol="target", impurity=criterion, maxDepth=depth,
                                  minInstancesPerNode=leaf, maxBins=255, seed=seed)


def _acc(model, te):
    return model.transform(te).agg(F.avg((F.col("prediction") == F.col("target")).cast("double"))).first()[0]


@register("g1_decision_tree")
def g1_decision_tree(spark, d):
    """Gini tree, depth 6, leaf 1 on the one-hot C1 design: test accuracy, nodes, depth."""
    enc, feats, _ = c1_design(spark, d)
    a = G.assemble(enc, feats).cache()
    m = _tree("gini", 6, 1).fit(a.filter("is_test = 0"))
    acc = _acc(m, a.filter("is_test = 1"))
    a.unpersist()
    return spark.createDataFrame([("gini", 6, 1, float(acc), m.numNodes, m.depth)],
                                 "criterion string, max_depth int, min_samples_leaf int, test_acc double, "
                                 "n_nodes int, depth int")


@register("g2_tree_grid")
def g2_tree_grid(spark, d, parallelism: int = 8):
    """criterion x max_depth x min_samples_leaf grid (2 x 6 x 3): hold-out accuracy;
    fits are independent Spark jobs submitted concurrently from a thread pool."""
    enc, feats, _ = c1_design(spark, d)
    a = G.assemble(enc, feats).cache()
    tr, te = a.filter("is_test = 0").cache(), a.filter("is_test = 1").cache()
    cells = [(c, dp, lf) for c in CRITERIA for dp in DEPTHS for lf in LEAVES]

    def run(cell):
        c, dp, lf = cell
        return (c, dp, lf, float(_acc(_tree(c, dp, lf).fit(tr), te)))

    with ThreadPoolExecutor(parallelism) as ex:
        rows = list(ex.map(run, cells))
    for x in (tr, te, a):
        x.unpersist()
    return spark.createDataFrame(rows, "criterion string, max_depth int, min_samples_leaf int, test_acc double")


def _gains_sql() -> str:
    parts = []
    for c in fx.C1_COLUMNS:
        parts.append(f"""select '{c}' as feature, {c} as level, cast(count(*) as double) as n_l,
  cast(sum(target) as double) as pos_l from tr group by {c}""")
    body = " union all ".join(parts)
    return fq.with_(c1=fq.C1) + f""", h as (select *, cast(row_number() over (partition by target order by
  md5(concat_ws('-', '0', 'holdout', cast(row_id as varchar))), row_id) <= ceil(0.25 * count(*) over (partition by target))
  as integer) as is_test from c1),
tr as (select * from h where is_test = 0),
tot as (select cast(count(*) as double) as n, cast(sum(target) as double) as pos from tr),
lv as ({body}),
g as (select feature, level, n_l, pos_l, n, pos,
  1 - ((pos * 1.0 / n) * (pos * 1.0 / n) + (1 - pos * 1.0 / n) * (1 - pos * 1.0 / n)) as gini_p,
  1 - ((pos_l * 1.0 / n_l) * (pos_l * 1.0 / n_l) + (1 - pos_l * 1.0 / n_l) * (1 - pos_l * 1.0 / n_l)) as gini_l,
  case when n - n_l = 0 then 0 else 1 - (((pos - pos_l) * 1.0 / (n - n_l)) * ((pos - pos_l) * 1.0 / (n - n_l))
    + (1 - (pos - pos_l) * 1.0 / (n - n_l)) * (1 - (pos - pos_l) * 1.0 / (n - n_l))) end as gini_r from lv, tot)
select feature, level, round(gini_p - (n_l * 1.0 / n) * gini_l - ((n - n_l) * 1.0 / n) * gini_r, 6) as gain from g"""


@register("g3_split_gains", _gains_sql())
def g3_split_gains(spark, d):
    """Root split scoring: Gini decrease of every (feature = level) candidate on the
    train rows, from one grouped count per feature (the histogram core of tree growth)."""
    h = S.holdout(fx.c1(spark, d), 0.25, SEED, by="target").filter("is_test = 0")
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("level")) for c in fx.C1_COLUMNS])
    lv = (h.select("target", F.explode(arr).alias("x")).groupBy("x.feature", "x.level")
          .agg(F.count(F.lit(1)).alias("n_l"), F.sum("target").alias("pos_l")))
    tot = h.agg(F.count(F.lit(1)).alias("n"), F.sum("target").alias("pos"))
    j = lv.withColumn("_o", F.lit(1)).join(F.broadcast(tot.withColumn("_o", F.lit(1))), "_o")

    def gini(pos, n):
        p = pos * 1.0 / n
        return 1 - (p * p + (1 - p) * (1 - p))
    nr = F.col("n") - F.col("n_l")
    gr = F.when(nr == 0, F.lit(0.0)).otherwise(gini(F.col("pos") - F.col("pos_l"), nr))
    gain = gini(F.col("pos"), F.col("n")) - (F.col("n_l") * 1.0 / F.col("n")) * gini(F.col("pos_l"), F.col("n_l")) \
        - (nr * 1.0 / F.col("n")) * gr
    return j.select("feature", "level", r6(gain).alias("gain"))


def _node_table(model, spark):
    """The fitted tree's node table (id, prediction, impurity, gain, children,
    split, counts) read back as a DataFrame from the saved model."""
    path = run_dir(spark, "foldwise-models/tree")
    model.write().overwrite().save(path)
    return spark.read.parquet(f"{path}/data")


@register("g11_impurity_importance")
def g11_impurity_importance(spark, d):
    """Normalised impurity (gain) importance per one-hot feature of the depth-6 tree."""
    enc, feats, names = c1_design(spark, d)
    m = _tree("gini", 6, 1).fit(G.assemble(enc.filter("is_test = 0"), feats))
    imp = m.featureImportances.toArray()
    rows = [(names[f], float(v)) for f, v in zip(feats, imp)]
    return spark.createDataFrame(rows, "feature string, importance double")


@register("g12_tree_rules")
def g12_tree_rules(spark, d, max_depth: int = 4):
    """Tree as a rule table for the top levels: node, depth, path test, counts, class.
    Built from the node table by iterative parent -> child joins."""
    enc, feats, names = c1_design(spark, d)
    m = _tree("gini", 6, 1).fit(G.assemble(enc.filter("is_test = 0"), feats))
    nodes = _node_table(m, spark).select("id", "prediction", "impurity", "gain", "leftChild", "rightChild",
                                          F.col("split.featureIndex").alias("fi"),
                                          F.col("split.leftCategoriesOrThreshold").alias("thr"),
                                          "rawCount").cache()
    root_id = nodes.agg(F.min("id")).first()[0]
    level = nodes.filter(F.col("id") == root_id).select("id", F.lit(0).alias("depth"), F.lit("").alias("path"))
    out = level
    fname = F.element_at(F.array(*[F.lit(names[f]) for f in feats]), F.col("fi") + 1)
    for dpt in range(1, max_depth + 1):
        par = level.join(nodes, "id").filter(F.col("leftChild") >= 0)
        test = F.concat(fname, F.lit(" <= "), F.format_number(F.element_at("thr", 1), 3))
        left = par.select(F.col("leftChild").alias("id"), F.lit(dpt).alias("depth"),
                          F.concat_ws(" AND ", F.when(F.col("path") != "", F.col("path")), test).alias("path"))
        right = par.select(F.col("rightChild").alias("id"), F.lit(dpt).alias("depth"),
                           F.concat_ws(" AND ", F.when(F.col("path") != "", F.col("path")),
                                       F.concat(F.lit("NOT "), test)).alias("path"))
        level = left.unionByName(right)
        out = out.unionByName(level)
    res = out.join(nodes, "id").select(F.col("id").alias("node"), "depth", "path", F.col("rawCount").alias("n"),
                                       F.col("prediction").cast("int").alias("class"), "impurity")
    return res


def t2_numeric(spark, d):
    df = fx.t2(spark, d)
    return df.select("row_id", "target", *fx.T_NUMERIC)


ENSEMBLES = {
    "random_forest": lambda s: RandomForestClassifier(featuresCol="features", labelCol="target", numTrees=300,
                                                      featureSubsetStrategy="sqrt", maxDepth=30, maxBins=255, seed=s),
    "gradient_boosting": lambda s: GBTClassifier(featuresCol="features", labelCol="target", maxIter=200, maxDepth=3,
                                                 stepSize=0.1, maxBins=255, seed=s),
}


BOOSTERS = {"histogram_boosting": BO.HISTOGRAM, "second_order_level": BO.LEVEL, "second_order_leaf": BO.LEAF}

MODELS = (*ENSEMBLES, "extra_trees")


def _evaluate(h, name: str, s: int):
    """AUC, F1, accuracy on the test rows and fit seconds of one model; ``h`` has
    the features assembled and by name."""
    t0 = time.time()
    if name == "extra_trees":
        forest = ET.fit(h.filter("is_test = 0"), fx.T_NUMERIC, 300, seed=s)
        secs = time.time() - t0
        pr = ET.score(h.filter("is_test = 1"), forest, fx.T_NUMERIC, ["target"]).select(
            F.col("target").alias("y"), (F.col("score") > 0.5).cast("int").alias("pred"), "score")
    elif name in BOOSTERS:
        boosted = BO.fit(h.filter("is_test = 0"), fx.T_NUMERIC, BOOSTERS[name], seed=s)
        secs = time.time() - t0
        pr = BO.score(h.filter("is_test = 1"), boosted, ["target"]).select(
            F.col("target").alias("y"), (F.col("score") > 0.5).cast("int").alias("pred"), "score")
    else:
        m = ENSEMBLES[name](s).fit(h.filter("is_test = 0"))
        secs = time.time() - t0
        pr = m.transform(h.filter("is_test = 1")).select(
            F.col("target").alias("y"), F.col("prediction").cast("int").alias("pred"), vector_to_array("probability")[1].alias("score"))
    pr = pr.cache()
    auc = M.roc_auc(pr, []).first()[0]
    r = pr.agg(F.avg((F.col("y") == F.col("pred")).cast("double")).alias("acc"), *M.prf_exprs()).first()
    pr.unpersist()
    return name, s, float(auc), float(r["f1"]), float(r["acc"]), secs


_ROW = "model string, seed int, roc_auc double, f1 double, accuracy double, fit_time_s double"


def _split(spark, d, s):
    return G.assemble(S.holdout(t2_numeric(spark, d), 0.2, s, by="target"), fx.T_NUMERIC).select("row_id", "target", "is_test", "features", *fx.T_NUMERIC).cache()


def _one_model(spark, d, name, s=SEED):
    h = _split(spark, d, s)
    row = _evaluate(h, name, s)
    h.unpersist()
    return spark.createDataFrame([row], _ROW)


@register("g5_random_forest")
def g5_random_forest(spark, d):
    """Random forest (300 trees, sqrt features, depth 30, the most Spark allows) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "random_forest")


@register("g6_extra_trees")
def g6_extra_trees(spark, d):
    """Extremely randomised trees (300, sqrt features, depth 12) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "extra_trees")


@register("g7_gradient_boosting")
def g7_gradient_boosting(spark, d):
    """Gradient boosting (200 trees of depth 3) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "gradient_boosting")


@register("g8_histogram_boosting")
def g8_histogram_boosting(spark, d):
    """Histogram boosting (up to 300 best-first trees of 31 leaves, a tenth of the
    train rows kept for early stopping) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "histogram_boosting")


@register("g9_second_order_level")
def g9_second_order_level(spark, d):
    """Second-order boosting level by level (300 trees of depth 6, lambda 1) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "second_order_level")


@register("g10_second_order_leaf")
def g10_second_order_leaf(spark, d):
    """Second-order boosting best-first (300 trees of 31 leaves) on a stratified 80/20 hold-out."""
    return _one_model(spark, d, "second_order_leaf")


#: the first rounds, small enough to be unrolled in SQL
FIRST_ROUNDS = {"g8_first_rounds": replace(BO.HISTOGRAM, rounds=2, max_leaves=3), "g9_first_rounds": replace(BO.LEVEL, rounds=2, max_depth=2),
                "g10_first_rounds": replace(BO.LEAF, rounds=2, max_leaves=3)}


def _first_rounds(spark, d, name):
    """Every node of the first two trees on all rows: split, gain, rows, leaf value."""
    model = BO.fit(t2_numeric(spark, d), fx.T_NUMERIC, FIRST_ROUNDS[name], seed=SEED)
    out = spark.createDataFrame(BO.nodes(model), "round int, depth int, path string, feature string, threshold double, gain double, rows long, value double")
    return out.select("round", "depth", "path", "feature", r6("threshold").alias("threshold"), sql_round("gain", 4).alias("gain"), "rows", r6("value").alias("value"))


for _name, _p in FIRST_ROUNDS.items():
    register(_name, BSQL.first_rounds(_p, SEED))(partial(_first_rounds, name=_name))


@register("g13_ensemble_benchmark")
def g13_ensemble_benchmark(spark, d, seeds=(0, 1, 2), models=MODELS, parallelism: int = 8):
    """Ensembles x seeds on stratified 80/20 hold-outs: AUC, F1, accuracy, fit seconds,
    and each model's mean and standard deviation of them over the seeds.  The
    (model, seed) fits are independent jobs submitted concurrently; a model Spark
    cannot fit is a row of nulls."""
    splits = {s: _split(spark, d, s) for s in seeds}

    def run(job):
        name, s = job
        try:
            return _evaluate(splits[s], name, s)
        except PySparkException:
            return name, s, None, None, None, None

    with ThreadPoolExecutor(parallelism) as ex:
        rows = list(ex.map(run, [(n, s) for s in seeds for n in models]))
    for h in splits.values():
        h.unpersist()
    out = spark.createDataFrame(rows, _ROW)
    over = {"roc_auc": "auc", "f1": "f1", "accuracy": "accuracy", "fit_time_s": "fit_time"}
    per = out.groupBy("model").agg(*[f(c).alias(f"{n}_{k}") for c, n in over.items() for k, f in (("mean", F.avg), ("std", F.stddev_pop))])
    return out.join(F.broadcast(per), "model")


@register("g13_booster_benchmark")
def g13_booster_benchmark(spark, d, seeds=(0, 1, 2)):
    """The other three ensembles: histogram and second-order boosting, as above."""
    return g13_ensemble_benchmark(spark, d, seeds, tuple(BOOSTERS))


@register("g4_ccp_path")
def g4_ccp_path(spark, d):
    """Cost-complexity pruning path of a full-depth gini tree: weakest-link alphas
    (every floor(len/30)-th), train / test accuracy, node count and depth per alpha;
    all pruned trees are scored in one pass; first best test accuracy flagged."""
    from foldwise.operators import trees as TR
    enc, feats, _ = c1_design(spark, d)
    a = G.assemble(enc, feats).cache()
    m = _tree("gini", 30, 1).fit(a.filter("is_test = 0"))
    tree = TR.Tree(TR.node_table(m, spark))
    path = TR.ccp_path(tree)
    step = max(1, len(path) // 30)
    chosen = path[::step]
    acc = TR.score_pruned(enc, feats, tree, [p for _, p in chosen])
    rows = []
    for i, (alpha, pr) in enumerate(chosen):
        n_nodes, depth = TR.structure(tree, pr)
        tr = acc[(acc.i == i) & (acc.split == 0)].acc
        te = acc[(acc.i == i) & (acc.split == 1)].acc
        rows.append((float(alpha), float(tr.iloc[0]) if len(tr) else None, float(te.iloc[0]) if len(te) else None,
                     int(n_nodes), int(depth)))
    a.unpersist()
    best = max(range(len(rows)), key=lambda i: (rows[i][2] or -1, -i))
    out = [r + (i == best,) for i, r in enumerate(rows)]
    return spark.createDataFrame(out, "ccp_alpha double, train_acc double, test_acc double, n_nodes int, depth int, "
                                      "is_best boolean")
