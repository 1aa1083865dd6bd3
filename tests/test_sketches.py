"""Sketches a day: merged estimates within their bounds, days replaced, plans."""

from pyspark.sql import functions as F

from pricelens.operators import sketches as S


def _records(spark, n=60_000, hot=True):
    i = F.col("id")
    # one source in a third of the rows or more
    source = F.when(i % 3 < 2, "hot").otherwise(F.concat(F.lit("s"), (i % 5).cast("string"))) if hot else F.lit("a")
    return spark.range(n).select(source.alias("src"), (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=(i % 700).cast("int"))).alias("ts"),
                                 (F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("user"), (F.pmod(F.hash("id"), F.lit(1000)) / 10).alias("price"))


def test_merged_days_keep_their_bounds(spark):
    recs = _records(spark)
    days = S.day_sketches(recs, "src", "ts", "user", "price")
    rolled = S.rollup(days, "_source", quantiles={"median": 0.5})
    rows = S.with_bounds(rolled, recs, "src", "user", "price", "median", 0.5).collect()
    assert len(rows) == 6
    assert all(r.distinct_ok and r.quantile_ok for r in rows)
    exact = {r.src: r for r in recs.groupBy("src").agg(F.count("*").alias("n"), F.min("price").alias("lo"), F.max("price").alias("hi")).collect()}
    assert {r._source: (r.n_rows, r.value_min, r.value_max) for r in rows} == {k: (v.n, v.lo, v.hi) for k, v in exact.items()}
    # the bound is not so wide that anything keeps it
    assert max(r.exact_distinct for r in rows) > 10_000


def test_the_rollup_reads_no_records_and_expands_nothing(spark, tmp_path):
    S.write_days(S.day_sketches(_records(spark, 5000), "src", "ts", "user", "price"), str(tmp_path / "d"))
    stored = S.read_days(spark, str(tmp_path / "d"))
    plan = S.rollup(stored.where("_source = 'hot'"), F.date_trunc("month", "day").alias("month"))._jdf.queryExecution().toString()
    assert "Expand" not in plan and "PartitionFilters: [isnotnull(_source" in plan


def test_a_day_written_again_replaces_its_row_alone(spark, tmp_path):
    path = str(tmp_path / "d")
    recs = _records(spark, 4000, hot=False)
    S.write_days(S.day_sketches(recs, "src", "ts", "user", "price"), path)
    before = {(r._source, r.day): r.n_rows for r in S.read_days(spark, path).collect()}
    day = F.to_date("ts") == F.lit("2024-01-03")
    late = recs.where(day).unionByName(recs.where(day))
    S.write_days(S.day_sketches(late, "src", "ts", "user", "price"), path)
    after = {(r._source, r.day): r.n_rows for r in S.read_days(spark, path).collect()}
    assert before.keys() == after.keys() and len(before) > 20
    changed = {k for k in before if before[k] != after[k]}
    assert [str(d) for _, d in changed] == ["2024-01-03"]
    assert all(after[k] == 2 * before[k] for k in changed)


def test_nulls_and_empty(spark):
    rows = spark.createDataFrame([("a", "2024-01-01", None, None), ("a", "2024-01-02", None, None), (None, None, "k", 1.5)], "src string, ts string, user string, price double")
    rolled = S.rollup(S.day_sketches(rows.withColumn("ts", F.col("ts").cast("timestamp")), "src", "ts", "user", "price"), "_source", quantiles={"median": 0.5})
    got = {r._source: (r.n_rows, r.n_values, r.n_distinct, r.median) for r in rolled.collect()}
    assert got == {"a": (2, 0, 0, None), None: (1, 1, 1, 1.5)}
    empty = rows.limit(0).withColumn("ts", F.col("ts").cast("timestamp"))
    assert S.rollup(S.day_sketches(empty, "src", "ts", "user", "price"), "_source", quantiles={"median": 0.5}).collect() == []
