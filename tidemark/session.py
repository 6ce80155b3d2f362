"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Cluster-sized values (shuffle partitions,
# memory, checkpoint folder) are left to whoever submits the job.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A task writes up to so many partitions side by side; only rows of further ones are sorted first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # A table of many partitions is listed by so many tasks at most; unset, each folder is a task of its own.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


_scratch: dict[str, SparkSession] = {}


@atexit.register
def _clean_up() -> None:
    """Deletes the folders that this process was given; on a best-effort basis."""
    for folder, spark in _scratch.items():
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session may be gone, its folder with it
            return


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder that all executors share; deleted when the process ends.

    Under spark.checkpoint.dir where that is set, else beside the tables in the
    warehouse, which is shared wherever tables are.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    _scratch[folder] = spark
    return folder


def written_once(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to a shared folder and read back, for plans that go over it several times."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
