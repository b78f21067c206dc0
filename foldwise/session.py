"""Session helpers.

On a cluster the session already exists and carries the cluster's
settings; ``get_session`` only fills in what is unset.  The checkpoint
folder is read from ``spark.checkpoint.dir``; a scratch folder is chosen
only when nothing is configured (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_SHIPPED: set[str] = set()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "foldwise") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        # local sessions: keep everything on the loopback interface
        b = b.config("spark.driver.bindAddress", "127.0.0.1").config("spark.driver.host", "127.0.0.1")
        b = b.config("spark.driver.memory", os.environ.get("FOLDWISE_DRIVER_MEM", "16g"))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (spark.checkpoint.dir).

    Only a local session without one (tests) gets a scratch folder; on a
    cluster a folder that not all executors see would lose rows, so an
    unset one is an error there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="foldwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; what an earlier run wrote stays."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to a new shared folder and read from there: what is read
    by several jobs is joined and shuffled once."""
    path = run_dir(df.sparkSession, f"foldwise-rows/{name}")
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per session), so functions that
    run in Python workers find it there without an installation."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="foldwise-zip-"), "foldwise.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    f = os.path.join(top, n)
                    z.write(f, os.path.join("foldwise", os.path.relpath(f, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
