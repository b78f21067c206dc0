"""Neighbour joins: exact k-nearest train rows per query row.

One plan at every size; no row of either side reaches the driver.

* Equal train vectors beyond the k smallest ids can be nobody's neighbour
  (ties go by id) and are dropped while they are grouped.
* Up to three axes are cut by quantiles (a few hundred cuts at most, as cells
  multiply), so a cell holds about ``cell_rows`` train rows.  A cell with more
  rows than a tile, on either side, is cut into tiles.  A task meets bundles of
  tile pairs: many small ones travel together, as a Python call for each would
  cost more than its distances.  The train rows of a large pair are halved into
  leaves along their widest axes, and a query passes over leaves farther away
  than its k-th distance.
* Pass 1 looks in a query's own cell; its k-th distance bounds the true one.
  A query that finds fewer than k rows there looks in boxes of cells that
  double their reach.  Every coordinate difference is at most the distance, so
  pass 2 looks in just the other cells that the bound reaches, keeps only rows
  within the bound, and merges both.

Ties are broken by train id, so results are a pure function of the data.
Distances are accumulated feature by feature in column order (the same
order the SQL oracle uses).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.session import run_dir

CELL_ROWS = 4096            # train rows aimed at per cell
TILE_ROWS = 4096            # rows of either side that a task meets at once
MAX_AXES = 3
BUNDLE_ROWS = 1 << 16       # rows of both sides that travel to a task together
LEAF_ROWS = 64              # rows of a leaf within a tile
_BLOCK_ELEMS = 4_000_000    # distance-matrix block size inside a task
_FOUND_ROWS = 1 << 21       # neighbours a bundle may find

METRICS = {"euclidean": 2.0, "manhattan": 1.0, "minkowski_p3": 3.0}


# ------------------------------------------------------------------ distances
def _np_dist(Q: np.ndarray, Tm: np.ndarray, p: float) -> np.ndarray:
    """Pre-root distance sums (monotone in the distance), feature by feature."""
    acc = np.zeros((Q.shape[0], Tm.shape[0]))
    for j in range(Q.shape[1]):
        acc = _add(acc, np.abs(Q[:, j, None] - Tm[None, :, j]), p)
    return acc


def _add(acc: np.ndarray, d: np.ndarray, p: float) -> np.ndarray:
    """``acc`` with one feature's differences added in place."""
    if p == 1.0:
        acc += d
    elif p == 2.0:
        acc += d * d
    else:
        acc += d * d * d if p == 3.0 else d ** p
    return acc


def _np_root(s: np.ndarray, p: float) -> np.ndarray:
    if p == 1.0:
        return s
    if p == 2.0:
        return np.sqrt(s)
    return np.cbrt(s) if p == 3.0 else s ** (1.0 / p)


def dist_sql(q: list[str], t: list[str], p: float) -> tuple[str, str]:
    """(pre-root sum, distance) in SQL."""
    terms = []
    for a, b in zip(q, t):
        d = f"abs({a} - {b})"
        terms.append(d if p == 1.0 else (f"{d} * {d}" if p == 2.0 else f"{d} * {d} * {d}"))
    s = "(" + " + ".join(terms) + ")"
    root = s if p == 1.0 else (f"sqrt({s})" if p == 2.0 else f"cbrt({s})")
    return s, root


def _topk_rows(S: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row-wise k smallest of S with ties to the lower column index.

    Returns (indices, values) of shape (m, k'), k' = min(k, n), ordered by
    (value, index).
    """
    m, n = S.shape
    kk = min(k, n)
    if kk == 0:
        return np.zeros((m, 0), dtype=np.int64), np.zeros((m, 0))
    kth = np.partition(S, kk - 1, axis=1)[:, kk - 1][:, None]
    sel = S <= kth
    if not (sel.sum(axis=1) == kk).all():
        lt = S < kth
        eq = S == kth
        need = kk - lt.sum(axis=1, keepdims=True)
        sel = lt | (eq & (np.cumsum(eq, axis=1) <= need))
    rows, cols = np.nonzero(sel)            # row-major: kk entries per row
    cols = cols.reshape(m, kk)
    vals = np.take_along_axis(S, cols, axis=1)
    order = np.lexsort((cols, vals), axis=1)
    return np.take_along_axis(cols, order, axis=1), np.take_along_axis(vals, order, axis=1)


def _leaves(X: np.ndarray, size: int) -> list[np.ndarray]:
    """Positions of the rows, halved at the median of the widest axis until no
    part has more than ``size``."""
    out, todo = [], [np.arange(len(X))]
    while todo:
        i = todo.pop()
        if len(i) <= size:
            out.append(i)
            continue
        part = X[i]
        half = len(i) // 2
        order = np.argpartition(part[:, np.argmax(part.max(axis=0) - part.min(axis=0))], half)
        todo += [i[order[half:]], i[order[:half]]]
    return out


def _nearest(Q: np.ndarray, Tm: np.ndarray, p: float, k: int, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, columns, values) of the k smallest of every row of Q, only of those
    within ``bound`` where it is given."""
    S = _np_dist(Q, Tm, p)
    if bound is None:
        cols, vals = _topk_rows(S, k)
        return np.repeat(np.arange(len(Q)), cols.shape[1]), cols.ravel(), vals.ravel()
    near = S <= bound[:, None]
    many = np.flatnonzero(near.sum(axis=1) > k)
    if len(many):
        cols, vals = _topk_rows(S[many], k)
        near[many] = False
        near[np.repeat(many, cols.shape[1]), cols.ravel()] = (vals <= bound[many, None]).ravel()
    rows, cols = np.nonzero(near)
    return rows, cols, S[rows, cols]


class _Tile:
    """Train rows of a tile, by id, with the boxes around its leaves."""

    def __init__(self, Tm: np.ndarray):
        self.rows = Tm
        self.leaves = [np.sort(i) for i in _leaves(Tm, LEAF_ROWS)] if len(Tm) > 4 * LEAF_ROWS and not np.isnan(Tm).any() else []
        self.low = np.array([Tm[i].min(axis=0) for i in self.leaves])
        self.high = np.array([Tm[i].max(axis=0) for i in self.leaves])
        self.least = min(map(len, self.leaves), default=0)

    def meet(self, Q: np.ndarray, p: float, k: int, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, train row, value) of the k nearest rows of every query that lie
        within its bound."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        whole = self.least < k or np.isnan(Q).any()
        step = max(1, _BLOCK_ELEMS // max(1, len(self.rows) if whole else 8 * len(self.leaves)))
        for s in range(0, len(Q), step):
            part, most = Q[s:s + step], None if bound is None else bound[s:s + step]
            rows, cols, vals = _nearest(part, self.rows, p, k, most) if whole else self._within(part, p, k, most)
            found.append((rows + s, cols, vals))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _within(self, Q: np.ndarray, p: float, k: int, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # a query's distance to the box is no more than to any row in it: rounding
        # keeps the order of differences and of their sums
        gap = np.zeros((len(Q), len(self.leaves)))
        for j in range(Q.shape[1]):
            q = Q[:, j, None]
            gap = _add(gap, np.maximum(np.maximum(self.low[None, :, j] - q, q - self.high[None, :, j]), 0), p)
        if bound is None:   # the k-th distance in the nearest leaf bounds the true one
            home, bound = gap.argmin(axis=1), np.empty(len(Q))
            for i in np.unique(home):
                own = np.flatnonzero(home == i)
                bound[own] = np.partition(_np_dist(Q[own], self.rows[self.leaves[i]], p), k - 1, axis=1)[:, k - 1]
        near = gap <= bound[:, None]
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for i in np.flatnonzero(near.any(axis=0)):
            own = np.flatnonzero(near[:, i])
            rows, cols, vals = _nearest(Q[own], self.rows[self.leaves[i]], p, k, bound[own])
            found.append((own[rows], self.leaves[i][cols], vals))
        rows, cols, vals = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((cols, vals, rows))
        rows, cols, vals = rows[order], cols[order], vals[order]
        first = np.searchsorted(rows, rows)   # where each query's rows begin
        best = np.arange(len(rows)) - first < k
        return rows[best], cols[best], vals[best]


# ------------------------------------------------------------------ the join
def _out_schema(group: list[str], gtypes, qid_type, tid_type, label_type) -> T.StructType:
    fields = [T.StructField(g, t) for g, t in zip(group, gtypes)]
    fields += [T.StructField("metric", T.StringType()),
               T.StructField("qid", qid_type), T.StructField("rank", T.IntegerType()),
               T.StructField("tid", tid_type), T.StructField("dist_s", T.DoubleType()),
               T.StructField("dist", T.DoubleType()), T.StructField("label", label_type)]
    return T.StructType(fields)


class _Grid:
    """Quantile cuts on a few axes; a cell is one number."""

    def __init__(self, train: DataFrame, xs: list[str], rows: int, cell_rows: int):
        """``rows``: train rows of the largest group."""
        axes = min(MAX_AXES, len(xs)) if rows > cell_rows else 0
        per = int(np.ceil((rows / cell_rows) ** (1 / axes))) if axes else 1
        probs = [i / per for i in range(1, per)]
        cuts = train.agg(*[F.percentile_approx(c, probs, max(10_000, 20 * per)).alias(c) for c in xs]).first() if axes else {}
        # the axes that cut best: a column of few values has few different cuts
        found = sorted(((c, sorted(set(cuts[c] or []))) for c in xs), key=lambda t: -len(t[1]))[:axes] if axes else []
        self.axes = [(c, F.array(*[F.lit(float(v)) for v in v]).cast("array<double>"), len(v) + 1) for c, v in found if v]
        self.reach = max((n for _, _, n in self.axes), default=1)

    def place(self, cuts: Column, x: Column) -> Column:
        return F.size(F.filter(cuts, lambda c: c < x))

    def number(self, places: list[Column]) -> Column:
        cell = F.lit(0).cast("long")
        for (_, _, n), b in zip(self.axes, places):
            cell = cell * n + b
        return cell

    def own(self, df: DataFrame) -> DataFrame:
        return df.withColumn("_cell", self.number([self.place(cuts, F.col(c)) for c, cuts, _ in self.axes]))

    def box(self, df: DataFrame, low, high, skip: Column | None) -> DataFrame:
        """A row per cell between ``low`` and ``high`` (functions of an axis) but ``skip``."""
        names = []
        for a, (c, cuts, n) in enumerate(self.axes):
            lo, hi = F.greatest(low(c, cuts), F.lit(0)), F.least(high(c, cuts), F.lit(n - 1))
            df = df.withColumn(f"_b{a}", F.explode(F.sequence(lo, hi)))
            names.append(f"_b{a}")
        df = df.withColumn("_to", self.number([F.col(b) for b in names])).drop(*names)
        if skip is not None:
            df = df.where(F.col("_to") != skip)
        return df.withColumn("_cell", F.col("_to")).drop("_to")


def _tiles(query: DataFrame, train: DataFrame, keys: list[str], xs: list[str], k: int, metrics: list[tuple[str, float]],
           schema: T.StructType, tile_rows: int) -> DataFrame:
    """The k best train rows of every (query, train tile) in equal cells, only those
    within the query's bound (``_s<metric>``) where it has one; not ranked yet."""
    cell = [*keys, "_cell"]
    sizes = (train.groupBy(*cell).agg(F.count(F.lit(1)).alias("_nt")).join(query.groupBy(*cell).agg(F.count(F.lit(1)).alias("_nq")), cell)
             .withColumn("_tt", F.ceil(F.col("_nt") / tile_rows)).withColumn("_qq", F.ceil(F.col("_nq") / tile_rows))
             .withColumn("_c", F.monotonically_increasing_id()))
    # both sides take tiles and bundles from here, so it is written
    sizes = _kept(sizes, "cells")
    rows = sizes.agg(F.sum(F.col("_nt") * F.col("_qq") + F.col("_nq") * F.col("_tt"))).first()[0] or 0
    bundles = max(1, -(-rows // max(1 << 13, min(BUNDLE_ROWS, _FOUND_ROWS // (k * len(metrics))))))
    sizes = sizes.drop("_nt", "_nq")
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    again = sizes.select(*[F.col(c).alias(c) for c in sizes.columns])   # the sides of a cogroup share no column
    t = train.join(again, cell).withColumn("_ti", F.pmod(F.xxhash64("tid"), F.col("_tt"))).withColumn("_qi", spread("_qq"))
    q = query.join(sizes, cell).withColumn("_qi", F.pmod(F.xxhash64("qid"), F.col("_qq"))).withColumn("_ti", spread("_tt"))
    bounds = [c for c in query.columns if c.startswith("_s")]
    pair = ["_c", "_ti", "_qi"]
    bundle = F.pmod(F.xxhash64(*pair), F.lit(bundles)).alias("_bundle")

    # metrics travel as their place in the list
    coded = T.StructType([T.StructField("metric", T.IntegerType()) if f.name == "metric" else f for f in schema.fields])

    def pairs(df: pd.DataFrame) -> dict[tuple, slice]:
        """Where each tile pair lies in ``df``, which is sorted by them."""
        at = df[pair].to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]).any(axis=1)]))
        return {tuple(at[i]): slice(i, j) for i, j in zip(begin, np.append(begin[1:], len(at)))}

    def meet(qdf, tdf):
        if not len(qdf) or not len(tdf):
            return pd.DataFrame({f.name: np.zeros(0) for f in schema.fields})
        qdf, tdf = qdf.sort_values(pair, kind="stable"), tdf.sort_values([*pair, "tid"], kind="stable")
        Q, Tm, there = qdf[xs].to_numpy(dtype=np.float64), tdf[xs].to_numpy(dtype=np.float64), pairs(tdf)
        limit = {name: qdf[f"_s{name}"].to_numpy() for name, _ in metrics} if bounds else {}
        out = [[np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)], [np.zeros(0)]]
        for which, own in pairs(qdf).items():
            if which not in there:
                continue
            other = there[which]
            tile = _Tile(Tm[other])
            for place, (name, p) in enumerate(metrics):
                row, col, vals = tile.meet(Q[own], p, k, limit[name][own] if bounds else None)
                for o, x in zip(out, (np.full(len(row), place, np.int32), row + own.start, col + other.start, vals, _np_root(vals, p))):
                    o.append(x)
        place, row, col, vals, dist = (np.concatenate(o) for o in out)
        found = {g: qdf[g].to_numpy()[row] for g in [*keys, "qid"]}
        found |= {"metric": place, "rank": np.zeros(len(row), np.int32), "dist_s": vals, "dist": dist}
        found |= {c: tdf[c].to_numpy()[col] for c in ("tid", "label")}
        return pd.DataFrame({f.name: found[f.name] for f in schema.fields})

    found = (q.select(bundle, *pair, *keys, "qid", *xs, *bounds).groupBy("_bundle")
             .cogroup(t.select(bundle, *pair, "tid", "label", *xs).groupBy("_bundle")).applyInPandas(meet, coded))
    return found.withColumn("metric", F.element_at(F.array(*[F.lit(name) for name, _ in metrics]), F.col("metric") + 1))


def _merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k best of what all tiles found for a query."""
    w = Window.partitionBy(*keys, "metric", "qid").orderBy("dist_s", "tid")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn_join(query: DataFrame, train: DataFrame, features: list[str], k: int,
             metric: str | list[str] = "euclidean", group: str | list[str] | None = None,
             qid: str = "row_id", tid: str = "row_id", label: str = "target",
             cell_rows: int = CELL_ROWS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """k nearest train rows of every query row, within equal ``group`` values.

    ``metric`` may be a list: all metrics are computed in the same pass.
    Output: (group..., metric, qid, rank 1..k, tid, dist_s (pre-root), dist, label).
    """
    metrics = [(m, METRICS[m] if m in METRICS else float(m)) for m in ([metric] if isinstance(metric, str) else metric)]
    keys = [group] if isinstance(group, str) else list(group or [])
    schema = _out_schema(keys, [train.schema[g].dataType for g in keys], query.schema[qid].dataType,
                         train.schema[tid].dataType, train.schema[label].dataType)
    xs = [f"_x{i}" for i in range(len(features))]
    vector = [F.col(c).cast("double").alias(x) for c, x in zip(features, xs)]
    q = query.select(*keys, F.col(qid).alias("qid"), *vector)
    t = train.select(*keys, F.col(tid).alias("tid"), F.col(label).alias("label"), *vector)
    t = t.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, *xs).orderBy("tid"))).where(F.col("_r") <= k).drop("_r")
    # both sides are written: passes read them more than once, and no plan grows with the rounds
    t, q = _kept(t, "train"), _kept(q, "query")
    counted = t.groupBy(*keys).count() if keys else t.agg(F.count(F.lit(1)).alias("count"))
    rows = counted.agg(F.max("count")).first()[0] or 0   # groups are folds, seeds or models
    grid = _Grid(t, xs, rows, cell_rows)
    t, q = grid.own(t), grid.own(q)
    columns = [f.name for f in schema.fields]
    if not grid.axes:
        return _merged(_tiles(q, t, keys, xs, k, metrics, schema, tile_rows), keys, k).select(*columns)

    id_cols = [*keys, "qid"]

    def bounds(found: DataFrame) -> DataFrame:
        """Per query with k rows: the k-th distance of each metric, and the farthest."""
        return found.where(F.col("rank") == k).groupBy(*id_cols).agg(
            *[F.max(F.when(F.col("metric") == m, F.col("dist_s"))).alias(f"_s{m}") for m, _ in metrics], F.max("dist").alias("_r"))

    found = _kept(_merged(_tiles(q, t, keys, xs, k, metrics, schema, tile_rows), keys, k), "near")
    reach = 1
    while reach < 2 * grid.reach:
        todo = _kept(q.join(bounds(found).select(*id_cols), id_cols, "left_anti"), "todo")
        if todo.isEmpty():
            break
        around = grid.box(todo.drop("_cell"), lambda c, cuts, r=reach: grid.place(cuts, F.col(c)) - r, lambda c, cuts, r=reach: grid.place(cuts, F.col(c)) + r, None)
        wider = _merged(_tiles(around, t, keys, xs, k, metrics, schema, tile_rows), keys, k)
        # a wider box holds what the smaller one held
        found = _kept(found.join(todo.select(*id_cols), id_cols, "left_anti").unionByName(wider), "found")
        reach *= 2
    # a query has k rows, or has seen all cells
    edge = F.col("_r") * (1 + 1e-9) + 1e-12
    far = grid.box(q.join(bounds(found), id_cols), lambda c, cuts: grid.place(cuts, F.col(c) - edge), lambda c, cuts: grid.place(cuts, F.col(c) + edge), F.col("_cell"))
    both = found.unionByName(_tiles(far.drop("_r"), t, keys, xs, k, metrics, schema, tile_rows))
    if reach > 1:   # boxes meet cells again; the same train row counts once
        both = both.dropDuplicates([*keys, "metric", "qid", "tid"])
    return _merged(both, keys, k).select(*columns)


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, run_dir(df.sparkSession, f"foldwise-knn/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ E2, E3


def _lists(neigh: DataFrame, ks: list[int], keys: list[str]) -> DataFrame:
    """A row per (keys, qid, k) with the list of the k neighbours, by rank (one
    neighbour table serves all k; its rows are not copied for each)."""
    own = neigh.groupBy(*keys, "qid").agg(F.sort_array(F.collect_list(F.struct("rank", "label", "dist"))).alias("_n"))
    own = own.withColumn("k", F.explode(F.array(*[F.lit(int(x)) for x in ks])))
    return own.withColumn("_n", F.expr("filter(_n, x -> x.rank <= k)")).where(F.size("_n") > 0)


def _both(weights: tuple[str, ...], uniform: str, distance: str) -> Column:
    """A (weights, pred) for each weighting."""
    return F.inline(F.array(*[F.struct(F.lit(w).alias("weights"), F.expr(uniform if w == "uniform" else distance).alias("pred")) for w in weights]))


def knn_classify(neigh: DataFrame, ks: list[int], keys: list[str],
                 weights: tuple[str, ...] = ("uniform", "distance")) -> DataFrame:
    """Vote per (keys, k, weights, qid): uniform count or 1/d; if any neighbour
    is at distance 0, only those count.  Ties go to the smaller label.

    Output: (keys..., k, weights, qid, pred).
    """
    e = _lists(neigh, ks, keys).withColumn("_l", F.expr("array_distinct(transform(_n, x -> x.label))"))
    e = e.withColumn("_any", F.expr("exists(_n, x -> x.dist = 0)"))
    best = "array_max(transform(_l, l -> struct({} as s, -l as m, l as l))).l"
    count = "cast(size(filter(_n, x -> x.label <=> l{})) as double)"
    inverse = "aggregate(_n, 0D, (s, x) -> if(x.label <=> l and x.dist > 0, s + 1D / x.dist, s))"
    return e.select(*keys, "k", "qid", _both(weights, best.format(count.format("")), best.format(
        f"if(_any, {count.format(' and x.dist = 0')}, {inverse})"))).select(*keys, "k", "weights", "qid", "pred")


def knn_regress(neigh: DataFrame, ks: list[int], keys: list[str],
                weights: tuple[str, ...] = ("uniform", "distance")) -> DataFrame:
    """Mean neighbour target, uniform or 1/d weighted (zero-distance rule as above).

    Output: (keys..., k, weights, qid, pred).
    """
    e = _lists(neigh.withColumn("label", F.col("label").cast("double")), ks, keys)
    e = e.withColumn("_y", F.expr("filter(_n, x -> x.label is not null)")).withColumn("_z", F.expr("filter(_y, x -> x.dist = 0)"))
    mean = "aggregate({0}, 0D, (s, x) -> s + x.label) / nullif(size({0}), 0)"
    # null, as a sum of nothing is, where no neighbour is away
    total = "aggregate({}, cast(null as double), (s, x) -> if(x.dist > 0, coalesce(s, 0D) + {} / x.dist, s))"
    return e.select(*keys, "k", "qid", _both(weights, mean.format("_y"), f"if(size(_z) > 0, {mean.format('_z')}, {total.format('_y', 'x.label')} / {total.format('_n', '1D')})")
                    ).select(*keys, "k", "weights", "qid", "pred")
