"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import hashlib
import math

import pytest

import __spark_entry__ as E

from small_tables import SF_SMALL

_E = E._load()
QUERIES, ORACLE = dict(_E.QUERIES), dict(_E.ORACLE)
import os

# heavy or non-SQL entries are covered elsewhere
SKIP = set()
# many-fit searches: run with FOLDWISE_SLOW=1
SLOW = {"k9_n_iter_sensitivity", "g13_ensemble_benchmark", "g13_booster_benchmark", "g8_histogram_boosting", "g9_second_order_level",
        "g10_second_order_leaf",
        "h2_init_comparison", "f7_condition_number", "f11_optimizer_comparison", "f15_sgd_grid", "f18_epoch_curve",
        "k14_k17_scaler_algo_matrix", "k15_outlier_ablation", "h5_k_sweep", "j27_importance_compare"}


def _norm(v):
    if v is None:
        return "null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n in ORACLE and n not in SKIP))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(sdf.columns, srows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in ORACLE))
def test_rows_only_query_runs(spark, name):
    if name in SLOW and not os.environ.get("FOLDWISE_SLOW"):
        pytest.skip("many-fit search; set FOLDWISE_SLOW=1")
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.collect()
    assert rows and len(set(df.columns)) == len(df.columns)
    for c, kind in df.dtypes:
        values = [r[c] for r in rows if r[c] is not None]
        assert values, f"{c} is null throughout"
        if kind == "double":
            assert not any(math.isnan(v) for v in values), c
            if c.endswith(("acc", "auc", "accuracy", "recall", "_score", "auc_mean", "acc_mean")):
                assert all(0 <= v <= 1 for v in values), c
            if c.endswith(("acc_std", "score_std", "r2_std", "_s", "inertia")):
                assert all(v >= 0 for v in values), c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
