"""Rows of 0 / 1 columns travel as bits; hashed orders and accuracies in bulk."""

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foldwise.functions.keys import md5_order
from foldwise.operators import sgd as SGD


def test_md5_order():
    ids = [None, "", "a", None] + ["é" * (i % 45) + str(i) for i in range(300)]
    keys = [md5(("3-sgd7" if i is None else f"3-sgd7-{i}").encode()).digest() for i in ids]
    got = md5_order("3-sgd7", pa.array(["x", *ids])[1:])
    assert [keys[i] for i in got] == sorted(keys) and sorted(got) == list(range(len(ids)))
    assert len(md5_order("h", pa.array([], pa.string()))) == 0


def test_packed_rows_are_short(spark):
    rng = np.random.default_rng(2)
    x = (rng.random((600, 40)) < 0.2).astype(float)
    x[:, 3] = rng.normal(size=600)
    x[5, 7], x[6, 8] = np.nan, 2.0
    cols = [f"c{j}" for j in range(40)]
    df = spark.createDataFrame([(i, i % 2, *map(float, r)) for i, r in enumerate(x)], "row_id long, target int, " + ", ".join(f"{c} double" for c in cols))
    rows = SGD.packed(df.repartition(3), cols, shards=2, keep=False).collect()
    assert sum(len(r["ids"]) for r in rows) == 600
    for r in rows:
        at = [int(i) for i in r["ids"]]
        got = SGD._full(r["wide"], r["x"], r["flags"], len(at), 40)
        assert np.array_equal(got, x[at], equal_nan=True)
        assert len(r["x"]) + len(r["flags"]) < len(at) * 40 * 8 / 5


def test_accuracies_of_many_weights_in_one_pass(spark):
    rows = [(i, i % 3 % 2, i % 2, float(i % 7) - 3, float(i % 5)) for i in range(200)]
    rows += [(300, None, 0, 1.0, 1.0), (301, 1, 0, None, 1.0), (302, 1, 1, float("nan"), 0.0), (303, 2, 1, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "row_id long, target int, is_test int, a double, b double")
    W = np.array([[1.0, -0.5, 0.1], [-1.0, 2.0, 0.0], [0.0, 0.0, 0.0]])
    got = SGD.accuracies(df, ["a", "b"], W, "is_test")
    for g in (0, 1):
        assert got[g] == SGD.accuracy(df, ["a", "b"], W, where=F.col("is_test") == g).tolist()
