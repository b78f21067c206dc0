"""Rows parted along the branches that lead to the nodes asked for."""

import numpy as np

from foldwise.operators import boosting as BO

#: 0 -> 1, 2; 1 -> 3, 4; 2 -> 5, 6
TREE = np.array([0, 1, 1, -1, -1, -1, -1]), np.array([4, 2, 6, 0, 0, 0, 0]), np.array([1, 3, 5, -1, -1, -1, -1]), np.arange(7.0)


class _Counted(np.ndarray):
    """Bins that count the values looked up."""
    seen = 0

    def __getitem__(self, k):
        out = super().__getitem__(k)
        if isinstance(k, np.ndarray):
            _Counted.seen += len(k)
        return np.asarray(out) if isinstance(k, np.ndarray) else out


def test_only_branches_asked_for_are_followed():
    rng = np.random.default_rng(6)
    bins = rng.integers(0, 10, size=(2, 5000)).astype(np.uint8)
    leaf = np.where(bins[0] <= 4, np.where(bins[1] <= 2, 3, 4), np.where(bins[1] <= 6, 5, 6))
    assert np.array_equal(BO._leaf_of(TREE, bins), leaf)
    rows = np.arange(0, 5000, 2)
    parts = dict(BO._parted(TREE, bins.view(_Counted), rows, [3, 4]))
    assert sorted(parts) == [3, 4] and all(np.array_equal(v, rows[leaf[rows] == k]) for k, v in parts.items())
    assert _Counted.seen == len(rows) + int((bins[0][rows] <= 4).sum())     # the other branch is left alone
    assert dict(BO._parted((np.array([-1]),) * 4, bins, rows, [0]))[0] is rows


def test_sums_of_nodes():
    rng = np.random.default_rng(7)
    n = 900
    bins, y, train = rng.integers(0, 10, size=(2, n)).astype(np.uint8), rng.integers(0, 2, n).astype(np.int8), rng.random(n) < 0.8
    b = BO._Block(bins, y, train, rng.normal(size=n))
    (total, lost), = BO._sums([b, b], TREE, [6, 3], 10, True)
    leaf = BO._leaf_of(TREE, bins)
    p = 1 / (1 + np.exp(-b.margin))
    for k, node in enumerate((6, 3)):
        for f in range(2):
            for v in range(10):
                at = train & (leaf == node) & (bins[f] == v)
                want = [np.rint((p - y)[at] * BO.SCALE).sum(), np.rint((p * (1 - p))[at] * BO.SCALE).sum(), at.sum()]
                assert np.array_equal(total[:, f, k * 10 + v], 2 * np.array(want))
    assert lost[1] == 2 * (~train).sum()
