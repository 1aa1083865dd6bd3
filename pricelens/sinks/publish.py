"""Publishing the clean catalogue: JSON lines, date-partitioned files and
appendable tables.  Every write is idempotent, so a retried task, stage or
whole job never loads a record twice; failures are raised, not swallowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.text import date_parts
from pricelens.schema import PRODUCT_COLS
from pricelens.session import ensure_conf

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
PARTITION_COLS = ["_source", "year", "month", "day"]


def to_json_lines(df: DataFrame) -> DataFrame:
    """One JSON text per record, fixed key order, nulls written as null."""
    return df.select(F.to_json(F.struct(*PRODUCT_COLS),
                               {"ignoreNullFields": "false", "timestampFormat": STAMP_FORMAT})
                     .alias("value"))


def write_json_lines(df: DataFrame, path: str) -> None:
    """Overwrite a JSON-lines folder (one object per line, nulls kept;
    stamps written as UTC text)."""
    ensure_conf(df.sparkSession)
    (df.select(*PRODUCT_COLS).write.mode("overwrite")
     .option("ignoreNullFields", "false")
     .option("timestampFormat", STAMP_FORMAT)
     .json(path))


def with_partition_cols(df: DataFrame, ts_col: str = "_created_date") -> DataFrame:
    return df.select("*", *date_parts(F.col(ts_col)))


def write_partitioned(df: DataFrame, root: str, fmt: str = "json") -> None:
    """Hive-style ``_source=/year=/month=/day=`` layout (UTC dates).

    Dynamic partition overwrite: a same-day rerun replaces exactly the
    partitions it produces and leaves every other day alone.  Rows are
    rebalanced by partition (the REBALANCE hint): each task writes few
    directories, and AQE splits a big (source, day) -- typically the whole
    run -- into advisory-sized tasks instead of one task per day.
    """
    ensure_conf(df.sparkSession)
    out = with_partition_cols(df.select(*PRODUCT_COLS))
    (out.hint("rebalance", *PARTITION_COLS)
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .option("ignoreNullFields", "false")
     .option("timestampFormat", STAMP_FORMAT)
     .partitionBy(*PARTITION_COLS)
     .format(fmt).save(root))


def read_partitioned(spark: SparkSession, root: str, fmt: str = "json") -> DataFrame:
    """Read the partitioned layout back; partition values stay strings."""
    from pyspark.sql import types as T
    from pricelens.schema import PRODUCT_SCHEMA
    schema = T.StructType([f for f in PRODUCT_SCHEMA.fields if f.name != "_source"] +
                          [T.StructField(c, T.StringType()) for c in PARTITION_COLS])
    r = spark.read.schema(schema).option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return r.format(fmt).load(root)


TABLE_PARTITIONS = ["_source", "snapshot_date"]


def snapshot_day():
    """The UTC day of a record's stamp; a record without a stamp has a day of
    its own name (a blank one would be read back as null)."""
    return F.coalesce(F.nullif(F.concat_ws("-", *date_parts(F.col("_created_date"))), F.lit("")), F.lit("undated"))


def one_per_key(df: DataFrame, keys) -> DataFrame:
    """One row per key: of several, the smallest by its other columns in order."""
    others = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_r"))
            .select(*[F.col(c) if c in keys else F.col("_r")[c].alias(c) for c in df.columns]))


def _new_rows(df: DataFrame, existing: DataFrame | None, keys) -> DataFrame:
    """The batch's rows, one per key, whose key ``existing`` does not have.

    ``existing`` is narrowed to the partitions the batch touches (a semi join
    on partition columns, which dynamic partition pruning turns into a
    partition filter at the scan) and read with the key columns only."""
    batch = one_per_key(df.select(*PRODUCT_COLS).withColumn(
        "snapshot_date", F.concat_ws("-", *date_parts(F.col("_created_date")))), [*keys, *TABLE_PARTITIONS])
    if existing is None:
        return batch
    touched = batch.select(*TABLE_PARTITIONS).distinct()
    known = existing.select(*keys, *TABLE_PARTITIONS).join(touched, TABLE_PARTITIONS, "left_semi")
    same = [batch[c].eqNullSafe(known[c]) for c in [*keys, *TABLE_PARTITIONS]]
    return batch.join(known, same, "left_anti")


def append_idempotent(df: DataFrame, path: str, keys=("product_id", "_created_date"),
                      fmt: str = "parquet") -> None:
    """Append only rows whose key is not in the table yet, one per key.

    Loading the same batch twice (a retried load, a replayed job), or a batch
    that repeats a key, leaves one row per key.  The table is partitioned by
    source and UTC snapshot date, so an append costs the batch's days, not
    the whole history.
    """
    spark = df.sparkSession
    ensure_conf(spark)
    try:
        existing = spark.read.format(fmt).load(path)
    except Exception as e:  # first load: nothing there yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e) \
                and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        existing = None
    (_new_rows(df, existing, keys).hint("rebalance", *TABLE_PARTITIONS)
     .write.mode("append").partitionBy(*TABLE_PARTITIONS).format(fmt).save(path))


def append_table(df: DataFrame, table: str, keys=("product_id", "_created_date")) -> None:
    """Same idempotent append into a catalog table, partitioned alike."""
    spark = df.sparkSession
    ensure_conf(spark)
    existing = spark.table(table) if spark.catalog.tableExists(table) else None
    (_new_rows(df, existing, keys).hint("rebalance", *TABLE_PARTITIONS)
     .write.mode("append").partitionBy(*TABLE_PARTITIONS).saveAsTable(table))
