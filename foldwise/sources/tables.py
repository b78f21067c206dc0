"""Readers for the driver's parquet tables and the reference's text inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.session import ship_package

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; Catalyst prunes columns and pushes filters into the scan."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- A1 - A4
def read_headerless(spark: SparkSession, path: str, schema: T.StructType,
                    null_token: str = "?", trim: bool = False, sep: str = ",") -> DataFrame:
    """Headerless delimited text with fixed column names; ``null_token`` -> null.

    ``trim=True`` handles the ``, `` separated variant (padding around
    values is dropped, so ``' ?'`` is null as well).
    """
    r = spark.read.schema(schema).option("sep", sep).option("nullValue", null_token)
    if trim:
        r = r.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
    return r.option("mode", "PERMISSIVE").csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             sep: str = ",", null_token: str | None = None) -> DataFrame:
    """Delimited text with a header line and quoted fields."""
    r = spark.read.option("header", True).option("sep", sep).option("quote", '"')
    if null_token is not None:
        r = r.option("nullValue", null_token)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def read_table(df: DataFrame, features: list[str], target: str, id_col: str) -> DataFrame:
    """A5: ready-made table as (row_id, target, features...), features as double."""
    return df.select(F.col(id_col).alias("row_id"), F.col(target).alias("target"),
                     *[F.col(c).cast("double").alias(c) for c in features])


# ---------------------------------------------------------------- A6 - A8
def union_results(dfs: list[DataFrame]) -> DataFrame:
    """Tidy result union; columns are the union of all, in first-seen order,
    missing ones null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def save_result(dfs: list[DataFrame] | DataFrame, path: str, fmt: str = "parquet") -> None:
    df = union_results(dfs) if isinstance(dfs, list) else dfs
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def wide_oof(long_preds: DataFrame, models: list[str], id_col: str = "row_id",
             label: str = "y_true", model_col: str = "model", value: str = "prob") -> DataFrame:
    """Long (row, model, prob) -> one row per id with ``oof_<model>`` columns.

    The pivot values are passed explicitly, so no extra job discovers them
    and the output schema is fixed.
    """
    w = (long_preds.groupBy(id_col, label).pivot(model_col, models).agg(F.first(value)))
    return w.select(id_col, label, *[F.col(m).alias(f"oof_{m}") for m in models])


def labelled_matrix(long_df: DataFrame, row: str, col: str, value: str,
                    labels: list[str]) -> DataFrame:
    """Long (row, col, value) -> square labelled matrix."""
    return long_df.groupBy(row).pivot(col, labels).agg(F.first(value)).orderBy(row)
