"""Appendable catalog tables whose files are bucketed and sorted by product.

Rows of a product lie in the same bucket of every run, so the append's check
for known keys, price history, run diffs and the latest snapshot read the table
without an exchange: only a new batch is shuffled, to the table's buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.operators import compare as C
from pricelens.schema import PRODUCT_COLS
from pricelens.session import ensure_conf
from pricelens.sinks.publish import one_per_key, snapshot_day

BUCKET_KEY = "product_id"
KEYS = ("product_id", "_created_date")


def append_bucketed(df: DataFrame, table: str, buckets: int, keys=KEYS, path: str | None = None) -> None:
    """Appends the batch's rows whose key the table does not have, one a key.
    ``buckets`` (and ``path``, where the files go) hold for the table's first load;
    later loads must name the same number."""
    spark = df.sparkSession
    ensure_conf(spark)
    batch = one_per_key(df.select(*PRODUCT_COLS).withColumn("snapshot_date", snapshot_day()), keys)
    if spark.catalog.tableExists(table):
        known = spark.table(table).select(*keys)
        rest = [c for c in keys if c != BUCKET_KEY]
        same = (batch[BUCKET_KEY] == known[BUCKET_KEY])
        for c in rest:
            same = same & batch[c].eqNullSafe(known[c])
        batch = batch.join(known, same, "left_anti")
    # one task a bucket, so that a load adds one sorted file to each
    out = batch.repartition(buckets, BUCKET_KEY).write.mode("append").bucketBy(buckets, BUCKET_KEY).sortBy(*KEYS).format("parquet")
    (out if path is None else out.option("path", path)).saveAsTable(table)


def _prices(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).select(BUCKET_KEY, "snapshot_date", "_created_date", C.current_price("price").alias("price"))


def latest(spark: SparkSession, table: str) -> DataFrame:
    """The newest price of every product."""
    return C.latest_per_key(_prices(spark, table).drop("snapshot_date"), [BUCKET_KEY], ["_created_date"])


def run_diff(spark: SparkSession, table: str, a: str, b: str) -> DataFrame:
    """New, delisted, repriced and same products between two days."""
    return C.snapshot_diff_one_pass(_prices(spark, table), BUCKET_KEY, "snapshot_date", a, b, "price")


def history(spark: SparkSession, table: str) -> DataFrame:
    """Every product's price by day, with the day before it that has one."""
    return C.price_history(_prices(spark, table), BUCKET_KEY, F.col("snapshot_date"), "price")

