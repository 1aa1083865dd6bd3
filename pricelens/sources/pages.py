"""Stored-page and catalogue sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.schema import PAGE_SCHEMA, PRODUCT_SCHEMA


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet",
               sites: list[str] | None = None, page_types: list[str] | None = None,
               seeds: list[str] | None = None) -> DataFrame:
    """Stored pages, narrowed at the scan (the filters are pushed down).

    Narrow here, before shredding: nothing can be pushed through the Python
    shredder.
    """
    df = spark.read.format(fmt).load(path)
    if sites is not None:
        df = df.filter(F.col("site").isin(sites))
    if page_types is not None:
        df = df.filter(F.col("page_type").isin(page_types))
    if seeds is not None:
        df = df.filter(F.col("url").isin(seeds))
    return df


def read_pages_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Landing directory of page files as a stream (schema fixed, never inferred)."""
    r = spark.readStream.schema(PAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_catalogue(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON-lines catalogue under the explicit nested schema (no inference:
    without it the stamp would come back as a string)."""
    return (spark.read.schema(PRODUCT_SCHEMA)
            .option("mode", mode)
            .option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
            .json(path))


def parse_catalogue_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """JSON text column -> typed record (from_json under the same schema)."""
    return lines.select(F.from_json(F.col(col), PRODUCT_SCHEMA,
                                    {"timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}).alias("r")).select("r.*")
