"""Session construction and shared scratch storage.

Scratch output (streaming checkpoints, round-trip tables, lineage cuts) goes
under the shared folder the cluster names in ``spark.checkpoint.dir``.  Only
when the session has none (local tests) do we create and register one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every pricelens job relies on.  They are all per-session SQL
# settings, so they are applied both at build time and by ``ensure_conf``
# on sessions handed to us by someone else.
DEFAULT_SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Pages can be large: keep Arrow batches into the shredder small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def build_session(master: str | None = "local[*]", app_name: str = "pricelens",
                  shuffle_partitions: int | None = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_SQL_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    ensure_streaming_conf(spark)
    return spark


def share_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package wherever the
    driver was started; on other machines it must be installed or shipped."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def ensure_conf(spark: SparkSession) -> None:
    """Apply the session-level SQL settings pricelens relies on."""
    share_package(spark)
    for k, v in DEFAULT_SQL_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HDFS_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def ensure_streaming_conf(spark: SparkSession) -> None:
    """State for first-seen dedup grows with the number of keys: keep it in
    RocksDB (off-heap, spills to local disk, checkpointed to the shared
    folder) unless the session already chose a provider of its own."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(key, HDFS_PROVIDER) == HDFS_PROVIDER:
        spark.conf.set(key, ROCKSDB_PROVIDER)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; a local one where none is set and all runs on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # on a cluster every machine would write to a folder of its own
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/pricelens/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str):
    """Write ``df`` as a parquet table under the shared checkpoint folder
    and read it back: cuts the lineage (expensive upstream steps such as
    the shredder run once, and a lost executor re-reads the table instead
    of recomputing), and keeps column pruning and filter pushdown."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


class Staging:
    """A scope for staged tables that removes them when the run is done.

        with Staging(spark) as st:
            good, bad = build_catalogue_split(pages, adapter, staging=st)
            publish(good, bad, out, staging=st)

    Staged tables live under the shared checkpoint folder; a batch run
    stages its records (about the size of the catalogue) once per run, so
    they are deleted at the end instead of accumulating run after run.
    Frames read from them must not be used after the scope closes.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def stage(self, df, name: str):
        path = scratch_dir(self.spark, name)
        self.paths.append(path)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def close(self) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
        self.paths = []

    def __enter__(self):
        return self

    def __exit__(self, *exc):
        self.close()
        return False
