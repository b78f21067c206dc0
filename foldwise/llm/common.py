"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.session import checkpoint_dir


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder; no two calls share one."""
    return f"{checkpoint_dir(spark).rstrip('/')}/foldwise-llm/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written as parquet in the shared folder and read again.

    Cuts the lineage: what is read twice is computed once, and a lost
    executor costs a re-read, not a re-computation.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` under the operator's own names, so extra columns of any
    name cannot clash with its working columns."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))


def apart(df: DataFrame, working: list[str], text: str) -> tuple[DataFrame, str, dict[str, str]]:
    """``df`` with the columns that bear a ``working`` name under other names, the
    name of ``text`` then, and the names to give back (none: ``df`` itself)."""
    back: dict[str, str] = {}
    for c in df.columns:
        if c in working:
            new = f"input_{c}"
            while new in df.columns or new in working or new in back:
                new += "_"
            back[new] = c
    there = {old: new for new, old in back.items()}
    if back:
        df = df.select(*[F.col(f"`{c}`").alias(there.get(c, c)) for c in df.columns])
    return df, there.get(text, text), back


def renamed_back(df: DataFrame, back: dict[str, str]) -> DataFrame:
    """``df`` with the names that ``apart`` took away."""
    return df.select(*[F.col(f"`{c}`").alias(back.get(c, c)) for c in df.columns]) if back else df


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
