"""Session helpers: one place for the runtime settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants regardless of cluster size.  Shuffle width is left
# to the cluster (AQE coalesces small stages); tests narrow it explicitly.
_BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # De-duplication state grows with the ids inside the watermark: off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app_name: str = "txnscope",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in _BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Timestamps are derived in UTC on both the Spark and the SQL side.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session with
    nothing configured (tests, laptops) gets a scratch folder of its own."""
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="txnscope-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table under the shared checkpoint folder
    and return a DataFrame reading it back.

    Cuts the lineage like ``checkpoint()``, but computes the input once (an
    eager reliable checkpoint runs the plan for its count and again to write
    the files) and stores it columnar and compressed.  Task retries rewrite
    only their own files under the writer's commit protocol."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table that was written by this library; nothing happens if it is not there."""
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system that Spark reads, sorted; none if it is not there."""
    at, fs = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(at)) if fs.exists(at) else []


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if the writer of the table has committed it."""
    at, fs = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(at)
