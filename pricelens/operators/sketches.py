"""Mergeable summaries a (source, day), and rollups that read no records.

``day_sketches`` is one hash-partitioned aggregate over the records of the days
it is given: a row a (source, day) with exact sums (rows, smallest, largest and
sum of the value) and two sketches, HLL for distinct keys and KLL for quantiles
of the value.  ``rollup`` merges such rows into any coarser groups: a year of a
source reads some hundred rows, and a distinct count expands nothing.

Error bounds, as the sketches state them:

* distinct: relative standard error 1.04 / sqrt(2 ** lg_k); ``DISTINCT_BOUND`` is
  four of them (1.6 % x 4 at lg_k = 12), plus one half for rounding.
* quantiles: the value's rank among all values is off by about 1.33 % of the rows
  at k = 200, with 99 % confidence; ``RANK_BOUND`` is twice that.

A merged sketch has the bounds of one made from the records at once.  Null keys
count in no distinct count, null values in no quantile.  A day written again
replaces its row (``write_days``), so late records cost their day alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 200
DISTINCT_BOUND = 4 * 1.04 / (1 << LG_K) ** 0.5
RANK_BOUND = 2 * 0.0133

_SUMS = ("n_rows", "n_values", "value_min", "value_max")


def day_sketches(records: DataFrame, source: str, stamp: str, key: str, value: str) -> DataFrame:
    """A row a (``_source``, ``day``): exact sums, ``keys`` (HLL) and ``dist`` (KLL)."""
    x = F.col(value).cast("double")
    return records.groupBy(F.col(source).alias("_source"), F.to_date(stamp).alias("day")).agg(
        F.count("*").alias("n_rows"), F.count(x).alias("n_values"), F.min(x).alias("value_min"), F.max(x).alias("value_max"),
        F.hll_sketch_agg(F.col(key).cast("string"), LG_K).alias("keys"), F.kll_sketch_agg_double(x, KLL_K).alias("dist"))


def write_days(sketches: DataFrame, path: str) -> None:
    """Store sketches by source and day; days present are replaced, others stay."""
    # a day is one row: one file of a few KB a (source, day)
    (sketches.withColumn("_day", F.col("day").cast("string")).repartition("_source", "_day")
     .write.partitionBy("_source", "_day").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def read_days(spark, path: str) -> DataFrame:
    """Stored sketches; filters on ``_source`` and ``_day`` prune folders."""
    return spark.read.parquet(path).drop("day").withColumn("day", F.to_date("_day"))


def rollup(sketches: DataFrame, *by, quantiles: dict[str, float] | None = None) -> DataFrame:
    """Merged rows by the columns ``by``: ``n_rows``, ``n_values``, ``value_min``,
    ``value_max``, ``n_distinct``, a column for each of ``quantiles`` (null without
    values), and the merged sketches to merge on."""
    merged = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("value_min").alias("value_min"), F.max("value_max").alias("value_max"),
        F.hll_union_agg("keys").alias("keys"), F.kll_merge_agg_double("dist").alias("dist"))
    names = [c for c in merged.columns if c not in (*_SUMS, "keys", "dist")]
    asked = [F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("dist", F.lit(float(q)))).alias(name) for name, q in (quantiles or {}).items()]
    return merged.select(*names, *_SUMS, F.hll_sketch_estimate("keys").alias("n_distinct"), *asked, "keys", "dist")


def with_bounds(rolled: DataFrame, records: DataFrame, source: str, key: str, value: str, quantile: str, q: float) -> DataFrame:
    """``rolled`` by source beside exact figures from the records: the audit of the
    sketches, two aggregates over all records.  ``distinct_ok`` and ``quantile_ok``
    tell whether the estimates keep their bounds."""
    x = F.col(value).cast("double")
    keys = records.where(F.col(key).isNotNull()).select(F.col(source).alias("_source"), F.col(key).alias("_k")).distinct().groupBy("_source").agg(F.count("*").alias("exact_distinct"))
    ranks = records.select(F.col(source).alias("_source"), x.alias("_x")).where("_x is not null") \
        .join(rolled.select("_source", F.col(quantile).alias("_q")), "_source") \
        .groupBy("_source").agg(F.count_if(F.col("_x") < F.col("_q")).alias("_below"), F.count_if(F.col("_x") <= F.col("_q")).alias("_upto"), F.count("*").alias("_n"))
    # equal values share a span of ranks: the bound holds if the span comes near enough
    near = (F.col("_below") <= (q + RANK_BOUND) * F.col("_n")) & (F.col("_upto") >= (q - RANK_BOUND) * F.col("_n"))
    return rolled.join(keys, "_source", "left").join(ranks, "_source", "left").select(
        *rolled.columns, F.coalesce("exact_distinct", F.lit(0).cast("bigint")).alias("exact_distinct"),
        (F.abs(F.col("n_distinct") - F.coalesce("exact_distinct", F.lit(0))) <= F.coalesce("exact_distinct", F.lit(0)) * DISTINCT_BOUND + 0.5).alias("distinct_ok"),
        F.coalesce(near, F.lit(True)).alias("quantile_ok"))
