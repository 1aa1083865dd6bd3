"""Mixing sources to target weights by systematic sampling.

Within each source the documents stand in order of size; each one's expected
copies (its source's target over its source's size) are prefix-summed, one
random offset a source is added, and a document is emitted once for each
integer boundary its step crosses.  Because neighbours in the order have
nearly the same size, the taken words stay within the largest document's size
of the target.  No document is emitted more than ``cap`` times.

The prefix sum is distributed: a range partitioning by (source, size, id)
splits a hot source over many tasks, each task ranks its own run, and the runs
of a source (at most one a partition) are summed up.  All steps are fixed-point
integers, so reruns and any partitioning give the same result.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; null ids come first among equal sizes; repeated rows are rows of
their own; an empty table gives an empty table; without any words all targets
are 0 and nothing is taken; input columns named like an output give way to it.
The table of sources has one row a source and its windows run in one task: a
mixture's sources are named and weighed by hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import slots, stage

WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"
# fixed-point bits of a copy
SHIFT = 24
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text):
    """Number of words of a text; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets of (source, source_size): all words shared by weight, each
    target at most ``cap`` times its source, the excess reshared by weight.

    Ordered by cap over weight, the capped sources come first; the level is
    what the rest share per unit of weight at the first source below its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sources.withColumn("weight", w).withColumn("cap", F.col("source_size").cast("double") * float(cap)) \
        .withColumn("ratio", F.col("cap") / F.col("weight")).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    t = t.withColumn("level", (F.col("total") - before) / rest)
    t = t.withColumn("open", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))).over(everything)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("open") * F.col("weight"), F.col("cap")))
    return t.select("source", "source_size", target.alias("target"))


def _copies(rows: DataFrame, weights, cap: int, seed: str) -> DataFrame:
    """Copies of each of (row, id, source, size), a stored table."""
    n = slots(rows.sparkSession)
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    step = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * float(1 << SHIFT))).otherwise(0).cast("bigint")
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), name)), 1, SHIFT // 4), 16, 10).cast("bigint")
    sources = sources.withColumns({"step": step, "offset": offset})
    # stored, so that both uses below see one and the same partitioning
    runs = stage(rows.repartitionByRange(n, F.col("source"), F.col("size"), F.col("id"), F.col("row")).withColumn("run", F.spark_partition_id()), "mix-runs")
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    totals = runs.groupBy("source", "run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("key", key) \
        .join(sources.withColumn("skey", key).drop("source"), F.col("key") == F.col("skey")) \
        .select(F.col("run").alias("_run"), "key", "start", "source_size", "target", "step", "offset")
    rank = F.row_number().over(Window.partitionBy("run", "source").orderBy("size", F.col("id"), F.col("row")))
    ranked = runs.withColumn("rank", rank).withColumn("rkey", key).join(starts, (F.col("run") == F.col("_run")) & (F.col("rkey") == F.col("key")))
    upto = lambda k: F.shiftright(k * F.col("step") + F.col("offset"), SHIFT)
    at = F.col("start") + F.col("rank")
    return ranked.select("row", "id", "source", "size", "source_size", "target", (upto(at) - upto(at - 1)).alias("copies"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """Every document's id with ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken``."""
    rows = stage(df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
                           word_count(F.col(f"`{text_col}`")).alias("size")).withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    out = _copies(rows, weights, cap, seed)
    return out.select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixture itself: ``df``'s rows, each as often as it was taken."""
    rows = stage(df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("payload"), F.col(f"`{id_col}`").alias("id"),
                           F.col(f"`{source_col}`").alias("source"), word_count(F.col(f"`{text_col}`")).alias("size"))
                 .withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    taken = _copies(rows.drop("payload"), weights, cap, seed).where("copies > 0").select(F.col("row").alias("_row"), F.col("copies").cast("int"))
    return rows.join(taken, F.col("row") == F.col("_row")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))) \
        .select("payload.*")
