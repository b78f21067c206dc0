"""Many random forests grown together on a bounded sample.

A search fits the same rows again and again.  Candidates that differ only
in their number of trees or their depth share trees: a smaller forest is a
prefix of a larger one, and a depth limit is a node's value on the way down.
So candidates fall into groups of (features a split, least rows of a leaf),
and a unit of work is (group, fold, ``BATCH`` trees).  Spark deals units over
tasks; a task grows its trees level by level as histogram sums keyed by
(tree, node, bin) and routes the fold's held-out rows along.  Per candidate
and fold the units' votes are added up and scored in one grouped pass.

The sample's bound is a parameter of the search (``rows`` of ``draw``); it is
broadcast as small integers.  Draws are hashed by (seed, group, fold, batch),
so scores do not depend on the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.keys import global_rank, hkey
from foldwise.operators import split as S
from foldwise.operators.boosting import _binned, find_cuts

#: trees of a unit
BATCH = 20
UNLIMITED = 10 ** 6


@dataclass
class Sample:
    """Bins (features x rows), labels and each row's place in its class by a
    hashed order; folds and smaller samples are cut from that place."""
    bins: np.ndarray
    y: np.ndarray
    place: np.ndarray
    n_bins: int

    def first(self, n: int) -> Sample:
        """The first ``n`` rows in stratified order (each class by its share)."""
        sizes = np.bincount(self.y, minlength=2)
        share = n * sizes / max(sizes.sum(), 1)
        quota = np.floor(share).astype(int)
        for c in np.argsort(-(share - quota), kind="stable")[:n - quota.sum()]:
            quota[c] += 1
        rows = np.flatnonzero(self.place < quota[self.y])
        return Sample(self.bins[:, rows], self.y[rows], self.place[rows], self.n_bins)


def draw(df: DataFrame, features: list[str], rows: int = 15_000, seed: int = 0, max_bins: int = 64) -> Sample:
    """A stratified sample of at most ``rows`` rows of ``row_id, target, features``."""
    part = S.subsample(df, rows, seed, by="target").withColumn("_k", hkey(seed, "search", "row_id"))
    part = global_rank(part, "_k", "row_id", ["target"], "_place").select("target", "_place", *features).cache()
    cuts = find_cuts(part, features, max_bins)
    pdf = part.orderBy("target", "_place").toPandas()
    part.unpersist()
    return Sample(_binned(pdf[features].to_numpy(dtype=np.float64), cuts), pdf["target"].to_numpy().astype(np.int64),
                  pdf["_place"].to_numpy().astype(np.int64) - 1, max(map(len, cuts)) + 1)


def _best_splits(cell, w, wy, N, P, n_bins: int, min_leaf: int):
    """Best cut per node from its occupied cells: (nodes, scores, bins); among equal
    scores the lowest bin."""
    size = len(N) * n_bins
    n, pos = np.bincount(cell, w, size), np.bincount(cell, wy, size)
    used = np.flatnonzero(n)
    node, n, pos = used // n_bins, n[used], pos[used]
    starts = np.flatnonzero(np.diff(node, prepend=-1))
    before = np.repeat(np.append(0, np.cumsum(n))[starts], np.diff(np.append(starts, len(used))))
    before_pos = np.repeat(np.append(0, np.cumsum(pos))[starts], np.diff(np.append(starts, len(used))))
    ln, lp = np.cumsum(n) - before, np.cumsum(pos) - before_pos
    rn, rp = N[node] - ln, P[node] - lp
    fine = (ln >= min_leaf) & (rn >= max(min_leaf, 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        # weighted gini decrease, up to what all cuts of a node share
        s = np.where(fine, (lp * lp + (ln - lp) ** 2) / ln + (rp * rp + (rn - rp) ** 2) / rn, -np.inf)
    top = np.maximum.reduceat(s, starts)
    at = np.flatnonzero(s == np.repeat(top, np.diff(np.append(starts, len(used)))))
    at = at[np.flatnonzero(np.diff(node[at], prepend=-1))]
    return node[at], s[at], used[at] % n_bins


def grow(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, test: np.ndarray, n_bins: int, m: int, min_leaf: int, depths: list[int], rng) -> dict[int, np.ndarray]:
    """Grow one tree per row of ``weight`` (trees x rows, how often each row was
    drawn); per depth limit the share of positives (trees x test rows)."""
    p, n_trees = len(bins), len(weight)
    pt, pr = np.nonzero(weight)
    pw = weight[pt, pr].astype(np.float64)
    pwy, pn = pw * y[pr], pt.copy()
    qt, qr = np.repeat(np.arange(n_trees), len(test)), np.tile(np.arange(len(test)), n_trees)
    qn, vote = qt.copy(), np.zeros((n_trees, len(test)))
    K, depth, out = n_trees, 0, {}
    while True:
        N, P = np.bincount(pn, pw, K), np.bincount(pn, pwy, K)
        vote[qt, qr] = (P / np.maximum(N, 1))[qn]
        if depth in depths:
            out[depth] = vote.copy()
        if depth >= max(depths):
            break
        open_ = (P > 0) & (P < N) & (N >= 2 * min_leaf)
        if not open_.any():
            break
        place = np.cumsum(open_) - 1
        keep, kept = open_[pn], open_[qn]
        pr, pw, pwy, pn = pr[keep], pw[keep], pwy[keep], place[pn[keep]]
        qt, qr, qn = qt[kept], qr[kept], place[qn[kept]]
        N, P, K = N[open_], P[open_], int(open_.sum())
        order = np.argsort(rng.random((K, p)), axis=1)
        score, feature, cut = np.full(K, -np.inf), np.zeros(K, np.int64), np.zeros(K, np.int64)
        for j in range(p):
            # beyond the first m features only for nodes that none of them can split
            if j < m:
                at = slice(None)
            else:
                at = np.flatnonzero(~np.isfinite(score)[pn])
                if not len(at):
                    break
            cell = pn[at] * n_bins + bins[order[pn[at], j], pr[at]]
            node, s, c = _best_splits(cell, pw[at], pwy[at], N, P, n_bins, min_leaf)
            better = s > score[node]
            node = node[better]
            score[node], feature[node], cut[node] = s[better], order[node, j], c[better]
        split = np.isfinite(score)
        place = 2 * (np.cumsum(split) - 1)
        keep, kept = split[pn], split[qn]
        pr, pw, pwy, pn = pr[keep], pw[keep], pwy[keep], pn[keep]
        pn = place[pn] + (bins[feature[pn], pr] > cut[pn])
        qt, qr, qn = qt[kept], qr[kept], qn[kept]
        qn = place[qn] + (bins[feature[qn], test[qr]] > cut[qn])
        K, depth = 2 * int(split.sum()), depth + 1
        if not K:
            break
    for d in depths:
        out.setdefault(d, vote)
    return out


def _auc(y: np.ndarray, s: np.ndarray) -> float:
    """Rank-sum AUC, ties counted one half; 0.5 where a class is missing."""
    v, back = np.unique(s, return_inverse=True)
    pos, neg = np.bincount(back, y, len(v)), np.bincount(back, 1 - y, len(v))
    before = np.cumsum(neg) - neg
    both = pos.sum() * neg.sum()
    return float((pos * (before + neg / 2)).sum() / both) if both else 0.5


def split_features(max_features, p: int) -> int:
    return max(1, int(np.sqrt(p)) if max_features == "sqrt" else int(float(max_features) * p))


def evaluate(spark, sample: Sample, candidates: list[dict], k: int = 3, seed: int = 0) -> list[list[float]]:
    """AUC of every candidate on each of ``k`` stratified folds of the sample.

    A candidate has ``n_estimators``, ``max_depth`` (or None), ``min_samples_leaf``
    and ``max_features`` (``sqrt`` or a share)."""
    p = len(sample.bins)
    groups: dict[tuple, list] = {}
    for i, c in enumerate(candidates):
        g = split_features(c["max_features"], p), int(c["min_samples_leaf"])
        groups.setdefault(g, []).append((i, int(c["n_estimators"]), UNLIMITED if c["max_depth"] is None else int(c["max_depth"])))
    units = [(m, leaf, fold, batch) for (m, leaf), members in groups.items() for fold in range(k)
             for batch in range(-(-max(n for _, n, _ in members) // BATCH))]
    sent = spark.sparkContext.broadcast((sample, groups))

    def votes(batches):
        sample, groups = sent.value
        fold_of = sample.place % k
        for pdf in batches:
            for m, leaf, fold, batch in pdf.itertuples(index=False):
                members = [x for x in groups[m, leaf] if x[1] > batch * BATCH]
                rng = np.random.default_rng([seed, m, leaf, fold, batch])
                train, test = np.flatnonzero(fold_of != fold), np.flatnonzero(fold_of == fold)
                weight = np.zeros((BATCH, len(sample.y)), np.int32)
                for t in range(BATCH):
                    weight[t, train] = np.bincount(rng.integers(0, len(train), len(train)), minlength=len(train))
                grown = grow(sample.bins, sample.y, weight, test, sample.n_bins, m, leaf, sorted({d for _, _, d in members}), rng)
                yield pd.DataFrame([(i, fold, batch, grown[d][:n - batch * BATCH].sum(axis=0).tobytes()) for i, n, d in members],
                                   columns=["candidate", "fold", "batch", "votes"])

    def scored(pdf):
        sample, _ = sent.value
        i, fold = int(pdf["candidate"].iloc[0]), int(pdf["fold"].iloc[0])
        total = sum(np.frombuffer(v) for v in pdf.sort_values("batch")["votes"])
        return pd.DataFrame([(i, fold, _auc(sample.y[sample.place % k == fold], total))], columns=["candidate", "fold", "auc"])

    todo = spark.createDataFrame(units, "m int, leaf int, fold int, batch int").repartition(min(len(units), 8 * spark.sparkContext.defaultParallelism))
    found = (todo.mapInPandas(votes, "candidate int, fold int, batch int, votes binary")
             .groupBy("candidate", "fold").applyInPandas(scored, "candidate int, fold int, auc double"))
    out = [[0.0] * k for _ in candidates]
    for r in found.collect():   # candidates x folds
        out[r["candidate"]][r["fold"]] = r["auc"]
    sent.unpersist()
    return out
