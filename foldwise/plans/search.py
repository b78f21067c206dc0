"""Hyper-parameter search over random forests.

Candidates are rows of a small table (hashed draws for random search); all of
a search's candidates and folds are grown together by
:mod:`foldwise.operators.forest`.  Successive halving keeps the best third
per rung (ties to the lower candidate id); its rungs are growing stratified
prefixes of one binned sample.
"""

from __future__ import annotations

import hashlib
import math

from foldwise.operators import forest as FO

GRID = {"n_estimators": [100, 200, 300], "max_depth": [None, 10, 20], "min_samples_leaf": [1, 4, 16],
        "max_features": ["sqrt", 0.5]}
# integer-uniform [lo, hi) and real-uniform [loc, loc + scale)
DIST = {"n_estimators": ("int", 100, 400), "max_depth": ("int", 5, 30), "min_samples_leaf": ("int", 1, 32),
        "max_features": ("real", 0.3, 0.6)}


def grid_candidates(grid=GRID) -> list[dict]:
    keys = list(grid)
    out = [{}]
    for k in keys:
        out = [dict(c, **{k: v}) for c in out for v in grid[k]]
    return out


def _u(seed, i, name) -> float:
    h = hashlib.md5(f"{seed}-cand-{i}-{name}".encode()).hexdigest()
    return int(h[:8], 16) / 4294967296.0


def random_candidates(n: int, seed: int, dist=DIST) -> list[dict]:
    """Hashed draws: candidate i is a pure function of (seed, i), so n=10 is a prefix of n=200."""
    out = []
    for i in range(n):
        c = {}
        for name, (kind, a, b) in dist.items():
            u = _u(seed, i, name)
            c[name] = int(a + math.floor(u * (b - a))) if kind == "int" else a + b * u
        out.append(c)
    return out


def cv_evaluate(spark, sample: FO.Sample, candidates: list[dict], k: int = 3, seed: int = 0) -> dict[int, float]:
    """Mean cross-validated AUC per candidate index."""
    return {i: sum(v) / len(v) for i, v in enumerate(FO.evaluate(spark, sample, candidates, k, seed))}


def best_of(scores: dict) -> int:
    return max(sorted(scores), key=lambda i: scores[i])


def rung_sizes(n_total: int, n_candidates: int, factor: int = 3, min_rows: int | None = None, k: int = 3) -> list[int]:
    """Rows of every rung: from ``min_rows`` (by default as many as let the last rung
    use all rows) times ``factor`` a rung."""
    n_rungs = 1 + int(math.floor(math.log(n_candidates, factor) + 1e-9)) if n_candidates > 1 else 1
    if min_rows is None:
        min_rows = max(2 * k * 2, n_total // factor ** (n_rungs - 1))
    return [min(n_total, min_rows * factor ** r) for r in range(n_rungs)]


def halving_search(spark, sample: FO.Sample, candidates: list[dict], factor: int = 3, min_rows: int | None = None, k: int = 3, seed: int = 0):
    """Successive halving: rung r scores the survivors on the first n_r rows and
    keeps the best ceil(m / factor).  Returns (best index, best score, rung table)."""
    alive, rungs, scores = list(range(len(candidates))), [], {}
    for r, n_r in enumerate(rung_sizes(len(sample.y), len(candidates), factor, min_rows, k)):
        sc = cv_evaluate(spark, sample.first(n_r), [candidates[i] for i in alive], k, seed)
        scores = {alive[j]: s for j, s in sc.items()}
        rungs.append((r, n_r, len(alive)))
        alive = sorted(alive, key=lambda i: (-scores[i], i))[:max(1, math.ceil(len(alive) / factor))]
    return alive[0], scores[alive[0]], rungs


def params_text(c: dict) -> str:
    return "{" + ", ".join(f"'{k}': {v!r}" for k, v in c.items()) + "}"
