"""Tree post-processing on the fitted model's node table.

A Spark ML tree lives on the driver once fitted; its node table (id,
prediction, impurity, impurityStats, rawCount, children, split) is read
back from the saved model.  Weakest-link pruning runs on that table; the
scoring of every pruned tree is one pass over the data: each task walks
its rows down the (broadcast) node arrays once, keeps the path, and for
every alpha predicts with the first pruned ancestor on the path.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.session import run_dir


def node_table(model, spark) -> pd.DataFrame:
    path = run_dir(spark, "foldwise-models/tree")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "id", "prediction", "impurity", "impurityStats", "rawCount", "leftChild", "rightChild",
        F.col("split.featureIndex").alias("fi"), F.col("split.leftCategoriesOrThreshold").alias("thr"))
    return nodes.toPandas().sort_values("id").reset_index(drop=True)


class Tree:
    def __init__(self, nodes: pd.DataFrame):
        self.n = len(nodes)
        idx = {int(i): k for k, i in enumerate(nodes["id"])}
        self.left = np.array([idx.get(int(c), -1) if c >= 0 else -1 for c in nodes["leftChild"]])
        self.right = np.array([idx.get(int(c), -1) if c >= 0 else -1 for c in nodes["rightChild"]])
        self.fi = np.array([int(f) if l >= 0 else -1 for f, l in zip(nodes["fi"], self.left)])
        self.thr = np.array([float(t[0]) if (l >= 0 and t is not None and len(t)) else 0.0
                             for t, l in zip(nodes["thr"], self.left)])
        self.pred = nodes["prediction"].to_numpy()
        self.count = nodes["rawCount"].to_numpy(dtype=np.float64)
        self.impurity = nodes["impurity"].to_numpy(dtype=np.float64)
        parents = set(self.left[self.left >= 0]) | set(self.right[self.right >= 0])
        self.root = [k for k in range(self.n) if k not in parents][0]


def ccp_path(tree: Tree) -> list[tuple[float, frozenset]]:
    """Weakest-link pruning on weighted impurity: [(alpha, pruned internal nodes)].
    R(t) = n_t / N * impurity(t); g(t) = (R(t) - R(T_t)) / (leaves(T_t) - 1)."""
    N = tree.count[tree.root]
    R = tree.count / N * tree.impurity
    pruned: set = set()
    out = [(0.0, frozenset())]

    def subtree(t):
        if tree.left[t] < 0 or t in pruned:
            return R[t], 1
        a, la = subtree(tree.left[t])
        b, lb = subtree(tree.right[t])
        return a + b, la + lb

    while True:
        best, bt = None, None
        stack = [tree.root]
        while stack:
            t = stack.pop()
            if tree.left[t] < 0 or t in pruned:
                continue
            rs, nl = subtree(t)
            g = (R[t] - rs) / max(nl - 1, 1)
            if best is None or g < best - 1e-15:
                best, bt = g, t
            stack += [tree.left[t], tree.right[t]]
        if bt is None:
            break
        pruned.add(bt)
        out.append((max(best, 0.0), frozenset(pruned)))
        if bt == tree.root:
            break
    return out


def structure(tree: Tree, pruned: frozenset) -> tuple[int, int]:
    """(node count, depth) of the pruned tree."""
    n, depth = 0, 0
    stack = [(tree.root, 0)]
    while stack:
        t, dd = stack.pop()
        n += 1
        depth = max(depth, dd)
        if tree.left[t] >= 0 and t not in pruned:
            stack += [(tree.left[t], dd + 1), (tree.right[t], dd + 1)]
    return n, depth


def score_pruned(df: DataFrame, features: list[str], tree: Tree, prunings: list[frozenset],
                 label: str = "target", split_col: str = "is_test") -> pd.DataFrame:
    """Accuracy of every pruned tree on each split, one pass over the rows."""
    P = len(prunings)
    mask = np.zeros((P, tree.n), dtype=bool)
    for i, pr in enumerate(prunings):
        mask[i, list(pr)] = True
    bc = df.sparkSession.sparkContext.broadcast((tree.left, tree.right, tree.fi, tree.thr, tree.pred, tree.root, mask))

    def run(batches):
        left, right, fi, thr, pred, root, msk = bc.value
        for b in batches:
            X = b[features].to_numpy(dtype=np.float64)
            y = b[label].to_numpy()
            sp = b[split_col].to_numpy()
            cur = np.full(len(X), root)
            out = np.full((msk.shape[0], len(X)), -1.0)
            decided = np.zeros((msk.shape[0], len(X)), dtype=bool)
            for _ in range(64):
                at = cur
                hit = msk[:, at] & ~decided                 # pruned here: predict this node
                out[hit] = np.broadcast_to(pred[at], out.shape)[hit]
                decided |= hit
                leaf = left[at] < 0
                out[:, leaf] = np.where(decided[:, leaf], out[:, leaf], pred[at][leaf][None, :])
                decided[:, leaf] = True
                if decided.all():
                    break
                go_left = X[np.arange(len(X)), np.maximum(fi[at], 0)] <= thr[at]
                cur = np.where(leaf, at, np.where(go_left, left[at], right[at]))
            rows = []
            for s in (0, 1):
                m = sp == s
                if m.any():
                    correct = (out[:, m] == y[m][None, :]).sum(axis=1)
                    rows += [(i, s, float(correct[i]), int(m.sum())) for i in range(msk.shape[0])]
            yield pd.DataFrame(rows, columns=["i", "split", "c", "n"])

    res = (df.select(label, split_col, *features).mapInPandas(run, "i int, split int, c double, n long")
           .groupBy("i", "split").agg((F.sum("c") / F.sum("n")).alias("acc")).toPandas())
    return res
