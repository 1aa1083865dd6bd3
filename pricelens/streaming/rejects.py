"""Records checked as they arrive: clean rows and rejects leave the stream in
the micro-batch that brought them, and a run's state goes when the run ends.

A record without id or name is a reject and touches no state.  Of the others the
first of (run, id) is clean and every later one is a reject.  Within a micro-batch
``order`` decides which is first, across micro-batches arrival does: what has left
as clean is not taken back.  Where micro-batches follow ``order`` the rejects equal
those of the batch job.  Spark's file source takes files by the time they were last
written, so files that one job writes at once have no order among micro-batches:
do not split such a load by ``files_per_trigger``.

State is one flag a (run, id).  Its event time is the end of the run (``run_end``),
so when the watermark, the newest run's end less ``lateness``, passes that end, the
flag is dropped.  The last run is ended by the next one, or by ``close_run``, which
lands a marker.  A row of a run that has ended so would be dropped by the watermark;
``run_reject_stream`` raises then, after the run, and names how many rows it lacks:
rerun from a new checkpoint and folder with a greater ``lateness``.

The rows of a hot id in a micro-batch meet in one task, in Arrow batches that are
passed on as they come: it holds one batch and one row.  ``files_per_trigger``
bounds their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricelens.operators import quality as Q
from pricelens.session import ensure_conf, ensure_streaming_conf
from pricelens.streaming.audit import StreamAudit, audited

RUN_END = "run_end"
LATENESS = "1 hour"
_FIELDS = ["product_id", "product_name", "request_url", "_source"]
# the product id of a marker; a landed id cannot be it, markers have no order fields
_CLOSED = "\u0000closed"


def _router(order: list[str]):
    """Flags of (run, id) and what leaves: clean rows with a null reason, rejects with theirs."""

    def route(key: tuple, frames: Iterator, state: GroupState) -> Iterator:
        if state.hasTimedOut:
            state.remove()
            return
        run_end, product_id = key
        if product_id == _CLOSED:
            # its only work was to move the watermark
            return
        seen, best, best_key = state.exists, None, None
        for rows in frames:
            rows = rows.sort_values(order, kind="stable")
            if not seen and len(rows):
                head = tuple(rows[c].iloc[0] for c in order)
                if best is None or head < best_key:
                    head_row, rest = rows.iloc[:1], rows.iloc[1:]
                    if best is not None:
                        yield best.assign(reject_reason=Q.DUPLICATE)
                    best, best_key, rows = head_row, head, rest
            if len(rows):
                yield rows.assign(reject_reason=Q.DUPLICATE)
        if best is not None:
            yield best.assign(reject_reason=None)
        if not seen:
            state.update((True,))
        state.setTimeoutTimestamp(int(run_end.timestamp() * 1000))

    return route


def tagged_stream(records: DataFrame, order: list[str], lateness: str = LATENESS) -> DataFrame:
    """A stream of records with ``run_end`` -> the same rows with ``reject_reason``."""
    cols = [*_FIELDS, *order, RUN_END]
    kinds = {f.name: f for f in records.schema.fields}
    out = T.StructType([T.StructField(c, kinds[c].dataType) for c in cols] + [T.StructField("reject_reason", T.StringType())])
    records = records.select(*cols)
    bad = records.where(Q.missing_required()).withColumn("reject_reason", F.lit(Q.MISSING))
    good = (records.where(~Q.missing_required()).withWatermark(RUN_END, lateness)
            .groupBy(RUN_END, "product_id")
            .applyInPandasWithState(_router(order), out, "seen boolean", "append", GroupStateTimeout.EventTimeTimeout))
    return good.unionByName(bad)


def close_run(spark: SparkSession, landing: str, run_end, lateness: str = LATENESS) -> None:
    """Lands a marker that ends every run up to ``run_end``: the stream's next
    run drops their state."""
    kinds = spark.read.parquet(landing).schema
    after = F.lit(run_end).cast("timestamp") + F.expr(f"INTERVAL {lateness}") + F.expr("INTERVAL 1 second")
    marker = {RUN_END: after, "product_id": F.lit(_CLOSED), "product_name": F.lit(_CLOSED)}
    spark.range(1).select(*[marker.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds]) \
        .coalesce(1).write.mode("append").parquet(landing)


def run_reject_stream(spark: SparkSession, landing: str, out: str, checkpoint: str, order: list[str],
                      files_per_trigger: int | None = None, lateness: str = LATENESS, audit: str | None = None) -> dict[str, int]:
    """availableNow run over what has landed; returns ``state_rows`` left and ``rows``
    read.  With ``audit``, every micro-batch leaves its counts under that folder."""
    ensure_conf(spark)
    ensure_streaming_conf(spark)
    reader = spark.readStream.schema(spark.read.parquet(landing).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    tagged = tagged_stream(reader.parquet(landing), order, lateness)
    if audit is not None:
        tagged = audited(tagged)
    with StreamAudit(spark, audit) if audit is not None else nullcontext() as log:
        q = (tagged.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        if log is not None:
            log.wait(q)
    ops = [o for p in q.recentProgress for o in p["stateOperators"]]
    late = sum(o["numRowsDroppedByWatermark"] for o in ops)
    if late:
        raise RuntimeError(f"{late} records came after their run had ended; rerun from a new checkpoint with more than {lateness}")
    return {"state_rows": ops[-1]["numRowsTotal"] if ops else 0, "rows": sum(p["numInputRows"] for p in q.recentProgress)}


def read_clean(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).where(F.col("reject_reason").isNull()).drop("reject_reason")


def read_rejects(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).where(F.col("reject_reason").isNotNull()).select(
        F.col("reject_reason").alias("reason"), F.col("product_id").alias("item_id"),
        F.col("product_name").alias("item_name"), F.col("request_url").alias("item_url"), F.col("_source"), RUN_END)
