"""Rejects routed inside the stream, and the end of a run's state."""

import pytest
from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.streaming import rejects as R

DAY1, DAY2 = "2024-01-02 00:00:00", "2024-01-03 00:00:00"
SCHEMA = "product_id string, product_name string, request_url string, _source string, n long"


def _land(spark, path, rows, run_end):
    (spark.createDataFrame(rows, SCHEMA).withColumn(R.RUN_END, F.lit(run_end).cast("timestamp"))
     .coalesce(1).write.mode("append").parquet(path))


def _row(pid, n, name="x"):
    return (pid, name, f"u{n}", "S", n)


def test_runs_and_state(spark, tmp_path):
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    run = lambda: R.run_reject_stream(spark, landing, out, ck, ["n"])
    _land(spark, landing, [_row("a", 2), _row("a", 1), _row("b", 3), _row(None, 4), _row("c", 5, ""), _row(" ", 6)], DAY1)
    assert run()["state_rows"] == 3
    rejected = lambda: sorted((r.reason, str(r.item_id), r.item_url) for r in R.read_rejects(spark, out).collect())
    first = [(Q.DUPLICATE, "a", "u2"), (Q.MISSING, "None", "u4"), (Q.MISSING, "c", "u5")]
    assert rejected() == first
    # a repeat in a later micro-batch of the run leaves as a reject at once
    _land(spark, landing, [_row("b", 7), _row("c", 8)], DAY1)
    run()
    assert rejected() == sorted(first + [(Q.DUPLICATE, "b", "u7")])
    # the next run knows nothing of this one, and ends it
    _land(spark, landing, [_row("b", 9)], DAY2)
    assert run()["state_rows"] == 1
    assert sorted(r.n for r in R.read_clean(spark, out).collect()) == [1, 3, 6, 8, 9]
    R.close_run(spark, landing, DAY2)
    assert run()["state_rows"] == 0
    assert R.read_clean(spark, out).count() + R.read_rejects(spark, out).count() == 9


def test_late_rows_raise(spark, tmp_path):
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    _land(spark, landing, [_row("a", 1)], DAY2)
    R.run_reject_stream(spark, landing, out, ck, ["n"])
    _land(spark, landing, [_row("a", 0)], DAY1)
    with pytest.raises(RuntimeError, match="1 records came after"):
        R.run_reject_stream(spark, landing, out, ck, ["n"])


def test_hot_id_over_many_arrow_batches(spark, tmp_path):
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    n = 6000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), (F.col("id") % 50).cast("string"))).alias("product_id"),
                               F.lit("x").alias("product_name"), F.lit("u").alias("request_url"), F.lit("S").alias("_source"),
                               (n - F.col("id")).alias("n"), F.lit(DAY1).cast("timestamp").alias(R.RUN_END))
    df.repartition(3).write.parquet(landing)
    R.run_reject_stream(spark, landing, out, ck, ["n"])
    good, bad = Q.split_quality(df, order=["n"])
    assert sorted(R.read_clean(spark, out).select("product_id", "n").collect()) == sorted(good.select("product_id", "n").collect())
    assert R.read_rejects(spark, out).count() == bad.count() == n - good.count()
