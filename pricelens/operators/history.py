"""Prices over time: the price in force at any moment, and validity intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.operators.partitioning import slots
from pricelens.session import stage


# ---- D-10 / D-03: the price in force (as-of join) ---------------------------------
def price_in_force(asked: DataFrame, prices: DataFrame, key: str, at: str, price: str = "price") -> DataFrame:
    """``asked`` with ``in_force``, the latest price of its ``key`` published at
    or before ``at``, and ``since``, when that was; both null if there is none.

    Both frames go into one, sorted over all tasks by key, time and kind and so
    cut into slices; a key that holds most rows lies over many of them.  Within a
    slice the last price is carried along by a window.  Only the last key of a
    slice can go on in a later one: its last price, one row a slice, is carried
    over to the slices that begin with that key.

    Prices without a value, a key or a time are no prices; of several at one
    time the least holds.  A question without a key or a time has no answer.
    Columns other than ``key``, ``at`` and ``price`` of ``prices`` are ignored;
    ``asked`` must not have columns ``in_force`` or ``since``.
    """
    spark, kept = asked.sparkSession, asked.columns
    known = prices.where(F.col(key).isNotNull() & F.col(at).isNotNull() & F.col(price).isNotNull()).groupBy(key, at).agg(F.min(price).alias("_p"))
    questions = asked.select(F.struct(*kept).alias("_row"), F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(None).cast(prices.schema[price].dataType).alias("_p"), F.lit(1).alias("_ask"))
    facts = known.select(F.lit(None).cast(asked.select(F.struct(*kept).alias("r")).schema["r"].dataType).alias("_row"), F.col(key).alias("_k"), F.col(at).alias("_t"), "_p", F.lit(0).alias("_ask"))
    # the number parts rows that are alike, of which there may be many
    both = facts.unionByName(questions).withColumn("_n", F.monotonically_increasing_id())
    order = ["_k", "_t", "_ask", "_n"]
    rows = stage(both.repartitionByRange(slots(spark), *order).sortWithinPartitions(*order)
                 .withColumns({"_slice": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()}), "in-force")
    fact = F.when(F.col("_ask") == 0, F.struct(F.col("_t").alias("t"), F.col("_p").alias("p")))
    here = Window.partitionBy("_slice", "_k").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = rows.select("_row", "_ask", "_slice", "_k", "_t", F.last(fact, ignorenulls=True).over(here).alias("_here")).where("_ask = 1")
    # one row a slice: its first key, its last key and that key's last price
    ends = rows.groupBy("_slice").agg(F.min_by("_k", "_pos").alias("first"), F.max_by("_k", "_pos").alias("last"))
    last = rows.where("_ask = 0").join(ends.select("_slice", F.col("last").alias("_k")), ["_slice", "_k"]).groupBy("_slice", "_k").agg(F.max_by(fact, "_pos").alias("f"))
    steps = last.select("_k", "_slice", F.lit(1).alias("kind"), "f").unionByName(
        ends.select(F.col("first").alias("_k"), "_slice", F.lit(0).alias("kind"), F.lit(None).cast(last.schema["f"].dataType).alias("f")))
    before = Window.partitionBy("_k").orderBy("_slice", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = steps.withColumn("_over", F.last("f", ignorenulls=True).over(before)).where("kind = 0").select("_slice", "_k", "_over")
    answer = F.when(F.col("_k").isNotNull() & F.col("_t").isNotNull(), F.coalesce("_here", "_over"))
    return carried.join(over, ["_slice", "_k"], "left").select("_row.*", answer["p"].alias("in_force"), answer["t"].alias("since"))


# ---- D-10 / D-11: validity intervals ------------------------------------------------
def _runs(snapshots: DataFrame, run: str) -> DataFrame:
    """Every run with its number, from 1, and the run after it: one row a run."""
    w = Window.orderBy(run)
    return snapshots.select(run).where(F.col(run).isNotNull()).distinct().select(F.col(run).alias("_run"), F.row_number().over(w).alias("_no"), F.lead(run).over(w).alias("_next"))


def price_intervals(snapshots: DataFrame, key: str, run: str, price: str) -> DataFrame:
    """Snapshots (one row a key and run) as rows (key, valid_from, valid_to,
    price): consecutive runs with one price become one interval, which ends
    before the first run with another price or without the product and is open
    (null) if it reaches the last run.

    The least price of a key and run counts; a product listed without a price
    has an interval without one.  Rows without a key or run are left out."""
    at = snapshots.where(F.col(key).isNotNull() & F.col(run).isNotNull()).groupBy(key, run).agg(F.min(price).alias("_p"))
    at = at.join(_runs(snapshots, run), F.col(run) == F.col("_run"))
    w = Window.partitionBy(key).orderBy("_no")  # one row a run
    begins = F.coalesce((F.lag("_no").over(w) != F.col("_no") - 1) | ~F.lag("_p").over(w).eqNullSafe(F.col("_p")), F.lit(True))
    island = at.withColumn("_new", begins.cast("int")).withColumn("_island", F.sum("_new").over(w))
    return island.groupBy(key, "_island").agg(F.min("_run").alias("valid_from"), F.max(F.struct("_no", "_next")).alias("_end"), F.first("_p").alias("price")) \
        .select(key, "valid_from", F.col("_end._next").alias("valid_to"), "price")


def extend_intervals(intervals: DataFrame, snapshot: DataFrame, key: str, run_value, price: str) -> DataFrame:
    """``intervals`` after one more run, of which ``snapshot`` is the content:
    open intervals go on, end or begin; closed ones pass through untouched.
    The result equals ``price_intervals`` of all snapshots."""
    now = F.lit(run_value).cast(intervals.schema["valid_from"].dataType)
    listed = snapshot.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(price).alias("_p")).withColumn("_in", F.lit(True))
    opened = intervals.where("valid_to is null").select(key, "valid_from", "price").withColumn("_open", F.lit(True))
    met = opened.join(listed, key, "full_outer")
    goes_on = F.col("_open").isNotNull() & F.col("_in").isNotNull() & F.col("price").eqNullSafe(F.col("_p"))
    old = F.when(F.col("_open").isNotNull(), F.struct("valid_from", F.when(~goes_on, now).alias("valid_to"), F.col("price").alias("price")))
    new = F.when(F.col("_in").isNotNull() & ~goes_on, F.struct(now.alias("valid_from"), F.lit(None).cast(intervals.schema["valid_to"].dataType).alias("valid_to"), F.col("_p").alias("price")))
    rows = met.select(key, F.explode(F.filter(F.array(old, new), lambda x: x.isNotNull())).alias("_r")).select(key, "_r.valid_from", "_r.valid_to", "_r.price")
    return intervals.where("valid_to is not null").select(key, "valid_from", "valid_to", "price").unionByName(rows)
