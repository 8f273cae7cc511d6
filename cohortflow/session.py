"""Session helpers: a tuned local session for tests and benches, and
lineage cuts that respect the cluster's shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "cohortflow",
) -> SparkSession:
    """Session for tests and benches. On a cluster the caller's session is
    used as is; these settings only mirror what a job there should run with."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Unset, a local master gets a
    scratch folder; any other master raises, because executors would write to
    disks that nobody else can read."""
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="cohortflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current.rstrip("/")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, on whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint
    folder and reading it back. Survives executor loss, unlike caching."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_forget, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _forget(spark: SparkSession, path: str) -> None:
    """Remove a written copy when the program ends (its session may be gone)."""
    with contextlib.suppress(Exception):
        remove_path(spark, path)
