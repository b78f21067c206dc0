"""The forests of a search against plain recursion and a plain rung table."""

import math

import numpy as np
import pytest

from foldwise.operators import forest as FO
from foldwise.operators import metrics as M
from foldwise.plans import search as SR

GRID = {"n_estimators": [5, 25], "max_depth": [None, 3], "min_samples_leaf": [1, 9], "max_features": ["sqrt", 0.9]}


def sample(n=400, seed=0, p=4, n_bins=12):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, n_bins, (p, n)).astype(np.uint8)
    y = (bins[0].astype(int) * bins[-1] + rng.normal(0, 15, n) > 30).astype(np.int64)
    place = np.zeros(n, np.int64)
    for c in (0, 1):
        place[y == c] = rng.permutation((y == c).sum())
    return FO.Sample(bins, y, place, n_bins)


def plain_tree(bins, y, w, at, test, min_leaf, depth):
    """Votes for ``test`` of the tree that tries every split of every feature."""
    n, pos = w[at].sum(), (w * y)[at].sum()
    out = {t: pos / n for t in test}
    if depth == 0 or pos in (0, n) or n < 2 * min_leaf:
        return out
    best = None
    for f in range(len(bins)):
        for c in np.unique(bins[f, at])[:-1]:
            left = at[bins[f, at] <= c]
            right = at[bins[f, at] > c]
            ln, rn = w[left].sum(), w[right].sum()
            if min(ln, rn) < min_leaf:
                continue
            lp, rp = (w * y)[left].sum(), (w * y)[right].sum()
            s = (lp ** 2 + (ln - lp) ** 2) / ln + (rp ** 2 + (rn - rp) ** 2) / rn
            best = max(best or (-1,), (s, f, c, left, right), key=lambda b: b[0])
    if best is None:
        return out
    _, f, c, left, right = best
    sides = [t for t in test if bins[f, t] <= c], [t for t in test if bins[f, t] > c]
    return plain_tree(bins, y, w, left, sides[0], min_leaf, depth - 1) | plain_tree(bins, y, w, right, sides[1], min_leaf, depth - 1)


@pytest.mark.parametrize("min_leaf", [1, 6])
def test_growing_equals_recursion(min_leaf):
    """One feature, so that no draw of features decides: every vote at every depth."""
    s = sample(150, 3, p=1)
    rng = np.random.default_rng(0)
    test = np.flatnonzero(s.place % 3 == 0)
    train = np.flatnonzero(s.place % 3)
    weight = np.zeros((4, len(s.y)), np.int32)
    for t in range(4):
        weight[t, train] = np.bincount(rng.integers(0, len(train), len(train)), minlength=len(train))
    got = FO.grow(s.bins, s.y, weight, test, s.n_bins, 1, min_leaf, [0, 1, 3, FO.UNLIMITED], rng)
    for depth in got:
        for t in range(4):
            want = plain_tree(s.bins, s.y, weight[t].astype(float), np.flatnonzero(weight[t]), list(test), min_leaf, depth)
            assert got[depth][t] == pytest.approx([want[i] for i in test])


def test_every_split_is_the_best_of_its_features():
    """With all features offered, no other first split scores higher."""
    s = sample(300, 5)
    rng = np.random.default_rng(1)
    everything = np.arange(len(s.y))
    got = FO.grow(s.bins, s.y, np.ones((1, len(s.y)), np.int32), everything, s.n_bins, 4, 1, [1], rng)[1][0]
    score = lambda v: sum(((v == x).sum() * (2 * x * x - 2 * x + 1)) for x in np.unique(v))
    best = 0
    for f in range(4):
        for c in range(s.n_bins - 1):
            left = s.bins[f] <= c
            if 0 < left.sum() < len(left):
                best = max(best, score(np.where(left, s.y[left].mean(), s.y[~left].mean())))
    assert score(got) == pytest.approx(best)


def test_shared_forests_equal_single_ones(spark):
    """Candidates score the same alone and beside those they share trees with."""
    s = sample()
    cands = SR.grid_candidates(GRID)
    together = FO.evaluate(spark, s, cands, 3, 0)
    for i in (0, 3, 6, 9, 15):
        assert FO.evaluate(spark, s, [cands[i]], 3, 0)[0] == together[i]
    assert all(0.5 < np.mean(v) <= 1 for v in together)


def test_halving_equals_a_plain_rung_table(spark):
    s = sample()
    cands = SR.grid_candidates(GRID)
    best, score, rungs = SR.halving_search(spark, s, cands, 3, None, 3, 0)
    alive, table = list(range(len(cands))), []
    for r, n in enumerate(SR.rung_sizes(400, len(cands))):
        part = s.first(n)
        assert len(part.y) == n
        scores = {i: np.mean(FO.evaluate(spark, part, [cands[i]], 3, 0)[0]) for i in alive}
        table.append((r, n, len(alive)))
        alive = sorted(alive, key=lambda i: (-scores[i], i))[:max(1, math.ceil(len(alive) / 3))]
    assert rungs == table and best == alive[0] and score == pytest.approx(scores[best])
    assert SR.rung_sizes(15_000, 54) == [555, 1665, 4995, 14985] and SR.rung_sizes(15_000, 40, 3, 12) == [12, 36, 108, 324]


def test_auc(spark):
    rng = np.random.default_rng(0)
    y, v = rng.integers(0, 2, 500), rng.integers(0, 40, 500) / 8
    want = M.roc_auc(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, v)], "y int, score double"), []).first()[0]
    assert FO._auc(y, v) == pytest.approx(want)
    assert FO._auc(np.zeros(5, np.int64), np.arange(5.0)) == 0.5


def test_folds_are_stratified():
    s = sample(999)
    for f in range(3):
        fold = s.place % 3 == f
        for c in (0, 1):
            assert abs((fold & (s.y == c)).sum() - (s.y == c).sum() / 3) <= 1
