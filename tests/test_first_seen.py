"""First seen in two phases: packed order keys, plans, and the same rows as a struct minimum."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.session import stage

SCHEMA = ("product_id string, product_name string, request_url string, _source string, fetched_at timestamp, page_id long, "
          "extract_error string, payload string")


def _records(spark, n=4000):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        pid = rng.choice(["hot", "hot", None, "", *[f"p{k}" for k in range(900)]])
        at = rng.choice([None, dt.datetime(1, 1, 2), dt.datetime(9999, 12, 30), *[dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=k) for k in range(40)]])
        rows.append((pid, rng.choice(["n", "n", "n", None]), f"u{i}", "S", at, i - n // 2 if rng.random() < 0.99 else None, rng.choice([None] * 9 + ["price"]), f"x{i}"))
    return spark.createDataFrame(rows, SCHEMA)


def test_packed_order_sorts_like_the_fields(spark):
    df = _records(spark)
    packed = Q.packed_order(df, ["fetched_at", "page_id"])
    by = lambda c: [r.request_url for r in df.where("page_id is not null").orderBy(*c).collect()]
    assert by([packed]) == by(["fetched_at", "page_id"])
    wide = spark.createDataFrame([(2**63 - 1, dt.datetime(9999, 12, 31, 23, 59, 59)), (-2**63, dt.datetime(1, 1, 1))], "page_id long, fetched_at timestamp")
    assert wide.select(Q.packed_order(wide, ["fetched_at", "page_id"]).alias("k")).where("k is null").count() == 0
    assert Q.packed_order(df, ["product_id"]) is None and Q.packed_order(wide, ["page_id", "page_id"]) is None


def test_two_phases_equal_struct_minimum(spark):
    df = _records(spark).where("page_id is not null")
    stored = stage(Q.with_row_id(df.repartition(7)), "records")
    order = ["fetched_at", "page_id"]
    good, bad = Q.split_quality(stored, order)
    want_good, want_bad = Q.split_quality(df, order)
    rows = lambda d: sorted(map(str, d.collect()))
    assert good.columns == want_good.columns
    assert rows(good) == rows(want_good) and rows(bad) == rows(want_bad)


def test_plan_aggregates_by_hash_and_moves_no_records(spark):
    stored = stage(Q.with_row_id(_records(spark)), "records")
    good, _ = Q.split_quality(stored, ["fetched_at", "page_id"])
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    # what is shuffled: keys and order fields, then words; never the payload
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("payload" in line for line in shuffles)
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "payload" not in below


def test_site_catalogue_plan(spark):
    from pricelens.plans import queries
    plan = queries.site_a_catalogue(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_order_without_a_packed_key_keeps_the_struct_minimum(spark):
    df = _records(spark).where("page_id is not null")
    stored = stage(Q.with_row_id(df), "records")
    good, _ = Q.split_quality(stored, ["request_url"])
    assert sorted(r.payload for r in good.collect()) == sorted(r.payload for r in Q.split_quality(df, ["request_url"])[0].collect())


def test_nothing_stored(spark):
    stored = stage(Q.with_row_id(_records(spark).where("false")), "records")
    good, bad = Q.split_quality(stored, ["fetched_at", "page_id"])
    assert good.where(F.lit(True)).collect() == [] and bad.collect() == []
