"""Histogram gradient boosting on all rows.

Features are cut once into at most ``max_bins`` bins, and the rows become
blocks of small integers in the shared folder.  Growing a tree takes one
pass per level: every task parts its rows along the branches of the tree so
far that lead to nodes asked for and adds up gradient, second derivative and rows per (node, feature, bin).  The sums are merged in Spark;
what reaches the driver has nodes x features x bins cells, whatever the
number of rows.  Only the smaller child of a split is summed; its sibling is
the parent's histogram less that.

Growth is level by level or best-first: the queue always opens the leaf with
the largest gain until ``max_leaves``.  To keep best-first growth at one pass
per level, the histograms of all leaves that may still be opened are
summed ahead of the queue, which then decides on exact gains only.

Gradients are added as integers (multiples of 1 / ``SCALE``), so sums, trees
and scores do not depend on how rows are dealt over tasks.  Margins are kept
with the blocks from round to round and written every ``refresh`` rounds: a
lost executor costs as many trees on its blocks at most, and no lineage grows
with the rounds.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.keys import hkey, huniform
from foldwise.functions.quantiles import exact_quantiles, long_values
from foldwise.session import run_dir, stored

SCALE = float(1 << 24)
BLOCK_ROWS = 1 << 16


@dataclass(frozen=True)
class Params:
    rounds: int = 300
    rate: float = 0.1
    growth: str = "leaf"             # "leaf": best-first, "level": level by level
    max_leaves: int = 31
    max_depth: int | None = None
    reg_lambda: float = 0.0          # added to the second derivatives
    min_rows: int = 20               # least rows of a leaf
    min_hessian: float = 1e-3        # least sum of second derivatives of a leaf
    max_bins: int = 255
    validation: float = 0.0          # share of rows kept for early stopping
    patience: int = 10
    tolerance: float = 1e-7
    refresh: int = 16


#: histogram boosting: best-first, a tenth of the rows decides when to stop (on more than 10,000 rows)
HISTOGRAM = Params(validation=0.1)
#: second-order boosting, level by level
LEVEL = Params(growth="level", max_depth=6, max_leaves=64, reg_lambda=1.0, min_rows=1, min_hessian=1.0)
#: second-order boosting, best-first
LEAF = Params()


@dataclass
class Tree:
    """Flat nodes: rows at or below ``cut`` (a bin) go to ``child``, others to the next."""
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    child: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)

    def add(self, depth: int, rows: int, value: float) -> int:
        for name, v in (("feature", -1), ("cut", 0), ("child", -1), ("value", value), ("gain", 0.0), ("rows", rows), ("depth", depth)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def packed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        return np.array(self.feature), np.array(self.cut), np.array(self.child), np.array(self.value)


@dataclass
class Model:
    features: list[str]
    cuts: list[np.ndarray]
    start: float
    trees: list[Tree]
    losses: list[float]              # on the rows kept for early stopping, before and after every round

    def importance(self, kind: str = "gain") -> np.ndarray:
        """Per feature the number of splits (``split``) or their gains added up."""
        out = np.zeros(len(self.features))
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    out[f] += g if kind == "gain" else 1
        return out


# ------------------------------------------------------------------ bins
def find_cuts(df: DataFrame, features: list[str], max_bins: int = 255) -> list[np.ndarray]:
    """Per feature the cuts between bins: halfway between neighbours where there
    are at most ``max_bins`` values, else the exact quantiles."""
    n = {r["column"]: r["n"] for r in long_values(df, features).distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [c for c in features if 0 < n.get(c, 0) <= max_bins]
    many = [c for c in features if n.get(c, 0) > max_bins]
    cuts = {c: np.zeros(0) for c in features}
    if few:   # at most max_bins values a feature
        values = long_values(df, few).distinct().toPandas()
        for c, v in values.groupby("column")["value"]:
            v = np.sort(v.to_numpy())
            cuts[c] = (v[:-1] + v[1:]) / 2
    if many:
        q = exact_quantiles(df, many, [k / max_bins for k in range(1, max_bins)]).select("column", "q").toPandas()
        for c, v in q.groupby("column")["q"]:
            cuts[c] = np.unique(v.to_numpy())
    return [cuts[c] for c in features]


def _binned(X: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bins feature by feature (features x rows); a missing value is above every cut."""
    return np.stack([np.searchsorted(c, x, "left") for c, x in zip(cuts, X.T)]).astype(np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16)


def _blocks(df: DataFrame, features: list[str], label: str, cuts: list[np.ndarray], held: str | None, n: int, start: float):
    """The rows as blocks (bins, labels, held-out marks), written to the shared folder.
    Few rows are dealt over all cores; many are taken as they lie."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    sent = spark.sparkContext.broadcast(cuts)
    names, m = list(features), len(features)

    def run(batches):
        kept: list = []

        def block():
            X, y, h = (np.concatenate([k[i] for k in kept]) for i in range(3))
            kept.clear()
            bins = _binned(X, sent.value)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                (len(y), pa.int64()), (bins.dtype.itemsize, pa.int32()), (bins.tobytes(), pa.binary()), (y.astype(np.int8).tobytes(), pa.binary()),
                (h.astype(np.int8).tobytes(), pa.binary()))], ["n", "width", "bins", "y", "held"])

        for b in batches:
            if b.num_rows:
                columns = [b.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(m + 2)]
                kept.append((np.stack(columns[:m], 1), columns[m], columns[m + 1]))
                if sum(len(k[1]) for k in kept) >= BLOCK_ROWS:
                    yield block()
        if kept:
            yield block()

    rows = df.select(*[F.col(c).cast("double") for c in names], F.col(label).cast("double").alias("_y"),
                     (F.col(held).cast("double") if held else F.lit(0.0)).alias("_held"))
    if n < cores * BLOCK_ROWS:
        rows = rows.repartition(min(cores, n // 4096 + 1))
    path = run_dir(spark, "foldwise-boosting/blocks")
    rows.mapInArrow(run, "n long, width int, bins binary, y binary, held binary").write.parquet(path)
    return spark.read.parquet(path).rdd.map(partial(_unpacked, m=m, start=start))


@dataclass
class _Block:
    bins: np.ndarray
    y: np.ndarray
    train: np.ndarray
    margin: np.ndarray


def _unpacked(r, m: int, start: float) -> _Block:
    bins = np.frombuffer(r["bins"], np.uint8 if r["width"] == 1 else np.uint16).reshape(m, r["n"])
    return _Block(bins, np.frombuffer(r["y"], np.int8), np.frombuffer(r["held"], np.int8) == 0, np.full(r["n"], start))


def _parted(packed, bins: np.ndarray, rows: np.ndarray, wanted=None):
    """(node, its rows) of every leaf, or of every ``wanted`` node; branches that
    lead to none are not followed."""
    feature, cut, child, _ = packed
    ends = np.zeros(len(feature), bool)
    ends[np.flatnonzero(feature < 0) if wanted is None else wanted] = True
    leads = ends.copy()
    for i in range(len(feature) - 1, -1, -1):      # children come after their parent
        if feature[i] >= 0:
            leads[i] |= leads[child[i]] | leads[child[i] + 1]
    stack = [(0, rows)] if leads[0] else []
    while stack:
        i, at = stack.pop()
        if ends[i] or feature[i] < 0:
            yield i, at
            continue
        right = bins[feature[i]][at] > cut[i]
        for c, side in ((child[i], ~right), (child[i] + 1, right)):
            if leads[c]:
                stack.append((c, at[side]))


def _leaf_of(packed, bins: np.ndarray) -> np.ndarray:
    node = np.zeros(bins.shape[1], np.int64)
    for i, at in _parted(packed, bins, np.arange(bins.shape[1])):
        node[at] = i
    return node


def _moved(block: _Block, tree) -> _Block:
    """The block after one more tree."""
    return replace(block, margin=block.margin + tree[3][_leaf_of(tree, block.bins)])


def _sums(blocks, growing, wanted: list[int], n_bins: int, loss: bool):
    """One partial sum: (gradient, second derivative, rows) per wanted node,
    feature and bin; log loss and rows of the held-out rows if asked for."""
    total, lost = None, np.zeros(2)
    for b in blocks:
        m = b.bins.shape[0]
        margin = b.margin
        if loss:
            held = ~b.train
            z = margin[held] * (1 - 2 * b.y[held])
            # log(1 + e^z), added as integers
            lost += [np.rint(np.logaddexp(0, z) * SCALE).sum(), held.sum()]
        place = {w: k for k, w in enumerate(wanted)}
        parts = [(place[i], at) for i, at in _parted(growing, b.bins, np.flatnonzero(b.train), wanted)]
        rows = np.concatenate([r for _, r in parts])
        at = np.repeat([k for k, _ in parts], [len(r) for _, r in parts])
        p, y = 1 / (1 + np.exp(-margin[rows])), b.y[rows]
        g, h = np.rint((p - y) * SCALE), np.rint(p * (1 - p) * SCALE)
        size = len(wanted) * n_bins
        here = np.zeros((3, m, size), np.int64)
        for f in range(m):
            cell = at * n_bins + b.bins[f][rows]
            here[0, f], here[1, f] = np.bincount(cell, g, size), np.bincount(cell, h, size)
            here[2, f] = np.bincount(cell, minlength=size)
        total = here if total is None else total + here
    if total is not None:
        yield total, lost


def _merged(a, b):
    return a[0] + b[0], a[1] + b[1]


class _Passes:
    """The blocks with their margins, and one pass over them at a time."""

    def __init__(self, spark, blocks, m: int, n_bins: int, refresh: int):
        self.spark, self.blocks, self.m, self.n_bins, self.refresh = spark, blocks.cache(), m, n_bins, refresh
        self.before, self.rounds = None, 0

    def sums(self, growing, wanted: list[int], loss: bool = False):
        """(len(wanted), 3, features, bins) and the held-out loss, merged in Spark
        (pairwise over tasks where there are many)."""
        parts = self.blocks.mapPartitions(partial(_sums, growing=growing, wanted=wanted, n_bins=self.n_bins, loss=loss))
        few = self.blocks.getNumPartitions() <= 32
        total, lost = parts.reduce(_merged) if few else parts.treeReduce(_merged, 3)
        return total.reshape(3, self.m, len(wanted), self.n_bins).transpose(2, 0, 1, 3), lost

    def grown(self, tree: Tree) -> None:
        """The tree counts from now on; now and then the margins are written."""
        if self.before is not None:   # its successor has been computed by the passes since
            self.before.unpersist()
        self.before, self.rounds = self.blocks, self.rounds + 1
        moved = self.blocks.map(partial(_moved, tree=tree.packed()))
        if self.rounds % self.refresh == 0:
            path = run_dir(self.spark, "foldwise-boosting/margins")
            moved.saveAsPickleFile(path, batchSize=1)
            moved = self.spark.sparkContext.pickleFile(path, self.blocks.getNumPartitions())
        self.blocks = moved.cache()

    def close(self) -> None:
        for rdd in (self.before, self.blocks):
            if rdd is not None:
                rdd.unpersist()


# ---------------------------------------------------------------- growing
def _best(histogram: np.ndarray, p: Params):
    """(gain, feature, cut, left sums, right sums) of the best split or None; the
    lowest feature, then the lowest cut, among equal gains."""
    left = np.cumsum(histogram, axis=2)[:, :, :-1]
    whole = histogram[:, 0, :].sum(axis=1)
    right = whole[:, None, None] - left
    gl, hl, gr, hr = left[0] / SCALE, left[1] / SCALE, right[0] / SCALE, right[1] / SCALE
    fine = (left[2] >= p.min_rows) & (right[2] >= p.min_rows) & (hl >= p.min_hessian) & (hr >= p.min_hessian)
    fine &= (left[2] > 0) & (right[2] > 0)
    if not fine.any():
        return None
    score = lambda g, h: np.divide(g * g, h + p.reg_lambda, out=np.zeros_like(g), where=h + p.reg_lambda > 0)
    g, h = whole[0] / SCALE, whole[1] / SCALE
    gain = np.where(fine, score(gl, hl) + score(gr, hr) - float(score(np.array(g), np.array(h))), -np.inf)
    f, c = np.unravel_index(gain.argmax(), gain.shape)
    return (float(gain[f, c]), int(f), int(c), left[:, f, c], right[:, f, c]) if gain[f, c] > 1e-6 else None


def _grow(passes: _Passes, p: Params, loss: bool):
    """One tree, with the held-out loss before it."""
    tree = Tree()

    def node(depth, sums):
        g, h = sums[0] / SCALE, sums[1] / SCALE
        return tree.add(depth, int(sums[2]), float(-p.rate * g / (h + p.reg_lambda)) if h + p.reg_lambda > 0 else 0.0)

    one = np.array([-1]), np.array([0]), np.array([-1]), np.zeros(1)
    histogram, lost = passes.sums(one, [0], loss)
    # what may be opened: node of the scout tree -> (histogram, best split)
    scout = Tree()
    scout.add(0, 0, 0.0)
    known = {0: (histogram[0], _best(histogram[0], p))}
    deep = p.max_depth or 10 ** 9
    while True:
        order, leaves = _opened(scout, known, p, deep)
        # leaves that the queue would open next, but for which children are not known
        ask = []
        for s in order:
            if scout.child[s] < 0:
                _, f, c, left, right = known[s][1]
                scout.feature[s], scout.cut[s] = f, c
                scout.child[s] = a = scout.add(scout.depth[s] + 1, int(left[2]), 0.0)
                scout.add(scout.depth[s] + 1, int(right[2]), 0.0)
                # children at the greatest depth are leaves: only their sums are needed
                if scout.depth[a] < deep:
                    ask.append((s, a, a if left[2] <= right[2] else a + 1))
                else:
                    known[a], known[a + 1] = (None, None), (None, None)
        if not ask:
            break
        sums, _ = passes.sums(scout.packed(), [small for _, _, small in ask])
        for (s, a, small), part in zip(ask, sums):
            other = known[s][0] - part
            for child in (a, a + 1):
                own = part if child == small else other
                known[child] = own, _best(own, p)
            known[s] = None, known[s][1]
    # the queue's own tree, in the order in which it opened its leaves
    place = {0: node(0, histogram[0][:, 0, :].sum(axis=1))}
    for s in _opened(scout, known, p, deep)[0]:
        gain, f, c, left, right = known[s][1]
        i = place[s]
        tree.feature[i], tree.cut[i], tree.gain[i] = f, c, gain
        a = scout.child[s]
        tree.child[i] = place[a] = node(tree.depth[i] + 1, left)
        place[a + 1] = node(tree.depth[i] + 1, right)
    return tree, lost


def _opened(scout: Tree, known: dict, p: Params, deep: int) -> tuple[list[int], int]:
    """Scout nodes in the order in which they are opened, as far as gains are known.

    Level by level: all that gain.  Best-first: by gain; a leaf whose
    children are unknown is opened all the same and its children left out, so
    the list holds at least what the final queue opens among the known."""
    if p.growth == "level":
        order = [s for s in range(len(scout.feature)) if s in known and known[s][1] is not None and scout.depth[s] < deep]
        return order, len(order) + 1
    order, heap = [], []

    def push(s):
        if s in known and known[s][1] is not None and scout.depth[s] < deep:
            heapq.heappush(heap, (-known[s][1][0], s))

    push(0)
    while heap and len(order) + 1 < p.max_leaves:
        _, s = heapq.heappop(heap)
        order.append(s)
        if scout.child[s] >= 0:
            push(scout.child[s])
            push(scout.child[s] + 1)
    return order, len(order) + 1


def fit(df: DataFrame, features: list[str], p: Params = HISTOGRAM, label: str = "target", id_col: str = "row_id", seed: int = 0) -> Model:
    """Boost on all rows of ``df``; label 0 / 1.  Rows with a null label are left out.
    The rows are stored, as counts, cuts and blocks read them in jobs of their own."""
    df = stored(df.where(F.col(label).isNotNull()).select(*([id_col] if p.validation else []), label, *features), "boosting")
    n, pos = (int(x or 0) for x in df.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first())
    held = None
    if p.validation and n > 10_000:
        held = "_held"
        df = df.withColumn(held, (huniform(hkey(seed, "stop", id_col)) < p.validation).cast("int"))
    cuts = find_cuts(df, features, p.max_bins)
    if held:
        n, pos = (int(x or 0) for x in df.where(f"{held} = 0").agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first())
    if not 0 < pos < n:   # one class or none: no gradient to follow
        return Model(features, cuts, 30.0 if n and pos == n else -30.0, [], [])
    model = Model(features, cuts, float(np.log(pos / (n - pos))), [], [])
    passes = _Passes(df.sparkSession, _blocks(df, features, label, cuts, held, n, model.start), len(features), max(map(len, cuts)) + 1, p.refresh)
    try:
        for _ in range(p.rounds):
            tree, lost = _grow(passes, p, bool(held))
            if held:
                model.losses.append(float(lost[0] / SCALE / max(lost[1], 1)))
                if stopped(model.losses, p.patience, p.tolerance):
                    break
            model.trees.append(tree)
            passes.grown(tree)
    finally:
        passes.close()
    return model


def stopped(losses: list[float], patience: int, tolerance: float) -> bool:
    """Whether none of the last ``patience`` losses is better than the one before them."""
    if len(losses) <= patience:
        return False
    return min(losses[-patience:]) > losses[-patience - 1] - tolerance


def score(df: DataFrame, model: Model, keep: list[str], out: str = "score") -> DataFrame:
    """``keep`` columns and the probability of label 1."""
    sent = df.sparkSession.sparkContext.broadcast((model.cuts, model.start, [t.packed() for t in model.trees]))
    fields = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in keep)
    features = model.features

    def run(batches):
        cuts, start, trees = sent.value
        for pdf in batches:
            bins = _binned(pdf[features].to_numpy(dtype=np.float64), cuts)
            margin = np.full(len(pdf), start)
            for t in trees:
                margin += t[3][_leaf_of(t, bins)]
            yield pdf[keep].assign(**{out: 1 / (1 + np.exp(-margin))})

    return df.select(*dict.fromkeys([*keep, *features])).mapInPandas(run, f"{fields}, {out} double")


def nodes(model: Model, rounds: int | None = None) -> list[tuple]:
    """(round, depth, path, feature, threshold, gain, rows, value) of every node; the
    path has an L or R per step down, the value is a leaf's."""
    out = []
    for k, t in enumerate(model.trees[:rounds]):
        stack = [(0, "")]
        while stack:
            i, path = stack.pop()
            f = t.feature[i]
            inner = f >= 0
            out.append((k, t.depth[i], path, model.features[f] if inner else None, float(model.cuts[f][t.cut[i]]) if inner else None,
                        t.gain[i] if inner else None, t.rows[i], None if inner else t.value[i]))
            if inner:
                stack += [(t.child[i], path + "L"), (t.child[i] + 1, path + "R")]
    return out
