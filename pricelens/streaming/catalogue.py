"""The catalogue job as a Structured Streaming query over landed pages.

Page files land in a directory; each micro-batch is shredded and extracted
exactly like the batch job.  First-seen state per product id lives in the
state store (a streaming aggregation of ``min(struct(order, record))``), and
every micro-batch of changed keys is written to its own folder (idempotent
on replay).  ``read_catalogue_view`` gives the published catalogue: the
survivor per id over everything emitted, i.e. the batch result.

Variants: ``stream_catalogue_lean`` keeps only ids and order keys in state
(records go to an append-only table, joined at read time by
``read_lean_view``); ``stream_catalogue_bounded`` bounds state with an
event-time watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.plans.catalogue import extract_records
from pricelens.schema import PRODUCT_COLS
from pricelens.sources.pages import read_pages_stream
from pricelens.session import ensure_streaming_conf
from pricelens.streaming.dedup import run_update_stream

ORDER = ["fetched_at", "page_id"]


def stream_catalogue(spark: SparkSession, landing: str, adapter, out: str, checkpoint: str,
                     site: str | None = None, files_per_trigger: int | None = None) -> None:
    """availableNow run: landed pages -> per-batch first-seen updates."""
    pages = read_pages_stream(spark, landing, max_files_per_trigger=files_per_trigger)
    recs = extract_records(pages, adapter, site)
    good = recs.filter(F.col("extract_error").isNull() & ~Q.missing_required())
    others = [c for c in PRODUCT_COLS if c != "product_id"]
    packed = F.struct(*[F.col(c) for c in ORDER], *[F.col(c) for c in others])
    updates = good.groupBy("product_id").agg(F.min(packed).alias("_w"))
    run_update_stream(updates, out, checkpoint)


def stream_catalogue_bounded(spark: SparkSession, landing: str, adapter, out: str, checkpoint: str,
                             within: str, site: str | None = None,
                             files_per_trigger: int | None = None) -> None:
    """Variant for endless streams: first-seen dedup with state bounded by
    an event-time watermark on ``fetched_at``.

    A product id is dropped when it was already seen less than ``within``
    earlier in event time; state older than the watermark is evicted, so
    memory no longer grows with the number of ids ever seen.  Records go to
    a plain parquet file sink in append mode (exactly-once through the sink
    log).  Trade-off, by Spark's definition: among duplicates arriving in
    the same micro-batch the survivor is not specified, and repeats further
    apart than ``within`` are kept.
    """
    ensure_streaming_conf(spark)
    pages = read_pages_stream(spark, landing, max_files_per_trigger=files_per_trigger)
    recs = extract_records(pages, adapter, site)
    good = (recs.filter(F.col("extract_error").isNull() & ~Q.missing_required())
            .withWatermark("fetched_at", within)
            .dropDuplicatesWithinWatermark(["product_id"]))
    q = (good.select(*PRODUCT_COLS).writeStream.format("parquet").outputMode("append")
         .option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def read_catalogue_view(spark: SparkSession, out: str) -> DataFrame:
    emitted = spark.read.parquet(out)
    best = emitted.groupBy("product_id").agg(F.min("_w").alias("_w"))
    return best.select("product_id", *[F.col("_w")[c].alias(c) for c in PRODUCT_COLS if c != "product_id"]) \
        .select(*PRODUCT_COLS)


def stream_catalogue_lean(spark: SparkSession, landing: str, adapter, out: str, checkpoint: str,
                          site: str | None = None, files_per_trigger: int | None = None) -> None:
    """The catalogue stream with lean state (ids and order keys only).

    1. pages -> shred -> extract -> every record with its pre-dedup reject
       reason (extraction failure, missing id/name), appended to
       ``out/records`` (file sink: exactly-once through its log; the
       shredder runs once per page);
    2. a second stream over that table keeps ``product_id -> min(fetched_at,
       page_id)`` of the complete records in the state store (about 40
       bytes per id instead of the whole record) and writes each
       micro-batch's changed winners to ``out/winners``.
    ``read_lean_view`` / ``read_lean_rejects`` join the two: the same clean
    catalogue and rejects as the batch job.
    """
    ensure_streaming_conf(spark)
    pages = read_pages_stream(spark, landing, max_files_per_trigger=files_per_trigger)
    recs = extract_records(pages, adapter, site)
    err = F.col("extract_error")
    reason = (F.when(err.isNotNull(), F.concat(F.lit("extract_error:"), err))
              .when(Q.missing_required(), F.lit(Q.MISSING)))
    tagged = recs.select(*PRODUCT_COLS, *ORDER, reason.alias("reject_reason"))
    q = (tagged.writeStream.format("parquet").outputMode("append")
         .option("path", f"{out}/records").option("checkpointLocation", f"{checkpoint}/records")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    stored = spark.readStream.schema(tagged.schema).parquet(f"{out}/records")
    winners = (stored.filter(F.col("reject_reason").isNull())
               .groupBy("product_id").agg(F.min(F.struct(*ORDER)).alias("_w")))
    run_update_stream(winners, f"{out}/winners", f"{checkpoint}/winners")


def _lean_winners(spark: SparkSession, out: str) -> DataFrame:
    return (spark.read.parquet(f"{out}/winners").groupBy("product_id").agg(F.min("_w").alias("_w"))
            .select("product_id", *[F.col("_w")[c].alias(c) for c in ORDER]))


def read_lean_view(spark: SparkSession, out: str) -> DataFrame:
    """The clean catalogue of a lean stream run."""
    records = spark.read.parquet(f"{out}/records").filter(F.col("reject_reason").isNull())
    return records.join(_lean_winners(spark, out), ["product_id", *ORDER], "left_semi").select(*PRODUCT_COLS)


def read_lean_rejects(spark: SparkSession, out: str) -> DataFrame:
    """The rejects of a lean stream run: failed or incomplete records, and
    complete ones that lost to an earlier record of the same id."""
    records = spark.read.parquet(f"{out}/records")
    failed = records.filter(F.col("reject_reason").isNotNull())
    lost = (records.filter(F.col("reject_reason").isNull()).select("product_id", *ORDER, "product_name",
                                                                     "request_url", "_source")
            .join(_lean_winners(spark, out), ["product_id", *ORDER], "left_anti")
            .withColumn("reject_reason", F.lit(Q.DUPLICATE)))
    cols = [F.col("reject_reason").alias("reason"), F.col("product_id").alias("item_id"),
            F.col("product_name").alias("item_name"), F.col("request_url").alias("item_url"), F.col("_source")]
    return failed.select(*cols).unionByName(lost.select(*cols))
