"""First-seen dedup as a Structured Streaming job.

Landed files are read as a stream; the state is one row per key, kept by a
streaming aggregation (``min`` over a struct of the order fields and the
row), so within a micro-batch it is combined map-side and across
micro-batches it lives in the state store (RocksDB when configured).  In
update mode each micro-batch emits the keys whose first row changed; the
sink writes every micro-batch to its own folder, overwriting it on retry,
so a replayed batch never duplicates output.  The published view is the
minimum per key over all emitted rows, which equals the batch result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.session import ensure_streaming_conf, scratch_dir


def land_in_order(df: DataFrame, path: str, order: list[str], slices: int) -> int:
    """Write ``df`` as ``slices`` files range-partitioned by ``order`` (the way
    a fetcher would land them over time).  Returns the number of files."""
    df.repartitionByRange(slices, *order).write.mode("overwrite").parquet(path)
    return slices


def first_seen_updates(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    others = [c for c in stream.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others])
    return stream.groupBy(*keys).agg(F.min(packed).alias("_w"))


def run_update_stream(updates: DataFrame, out: str, checkpoint: str) -> None:
    """availableNow run of an update-mode stream into per-batch folders."""
    ensure_streaming_conf(updates.sparkSession)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    q = (updates.writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint)
         .foreachBatch(sink)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_first_seen(spark: SparkSession, out: str, keys: list[str], columns: list[str]) -> DataFrame:
    emitted = spark.read.parquet(out)
    best = emitted.groupBy(*keys).agg(F.min("_w").alias("_w"))
    return best.select(*keys, *[F.col("_w")[c].alias(c) for c in columns if c not in keys])


def first_seen_stream(spark: SparkSession, df: DataFrame, keys: list[str], order: list[str],
                      slices: int = 4, micro_batches: int = 2) -> DataFrame:
    """Land ``df``, stream it through the stateful dedup in about
    ``micro_batches`` micro-batches, return the result."""
    base = scratch_dir(spark, "stream-first-seen")
    n_files = land_in_order(df, f"{base}/landing", order, slices)
    stream = (spark.readStream.schema(df.schema)
              .option("maxFilesPerTrigger", max(1, -(-n_files // micro_batches)))
              .parquet(f"{base}/landing"))
    run_update_stream(first_seen_updates(stream, keys, order), f"{base}/out", f"{base}/checkpoint")
    return read_first_seen(spark, f"{base}/out", keys, df.columns).select(*df.columns)
