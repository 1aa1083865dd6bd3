"""Versioned tables (concurrent writers, old versions, pruning) and bucketed ones (no exchange)."""

import datetime as dt
import os
import threading
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pricelens.schema import PRODUCT_SCHEMA
from pricelens.session import scratch_dir
from pricelens.sinks import bucketed as B
from pricelens.sinks.versioned import Conflict, VersionedTable


def _batch(spark, ids, day=1, price=2.0, source="S"):
    rows = [(f"p{i:04d}", f"name {i}", None, None, "", f"u{i}", [("c", "")], "", [(1, "normal", price)], source, dt.datetime(2024, 1, day, 1)) for i in ids]
    return spark.createDataFrame(rows, PRODUCT_SCHEMA)


def _ids(df):
    return Counter(r.product_id for r in df.select("product_id").collect())


def test_versions_and_retries(spark):
    t = VersionedTable(spark, scratch_dir(spark, "versioned"))
    assert t.versions() == [] and t.read().collect() == []
    assert t.append(_batch(spark, range(10))) == 0
    assert t.append(_batch(spark, range(10))) is None  # a retry adds nothing
    assert t.append(_batch(spark, [*range(5, 15), 12])) == 1
    assert t.append(_batch(spark, range(3), day=2)) == 2
    assert [h["rows"] for h in t.history()] == [10, 5, 3]
    assert _ids(t.read(0)) == Counter(f"p{i:04d}" for i in range(10))
    assert _ids(t.read(1)) == Counter(f"p{i:04d}" for i in range(15))
    assert t.read().count() == 18 and t.read().schema.names == [*PRODUCT_SCHEMA.names, "snapshot_date"]
    with pytest.raises(ValueError):
        t.read(7)
    with pytest.raises(Conflict):
        t.put(1, {"version": 1, "add": []})
    assert t.append(_batch(spark, [])) is None


def test_files_outside_the_range_are_not_opened(spark):
    t = VersionedTable(spark, scratch_dir(spark, "versioned"))
    t.append(_batch(spark, range(10)))
    t.append(_batch(spark, range(50, 60)))
    t.append(_batch(spark, range(10), day=3))
    t.append(_batch(spark, range(10), source="T"))
    opened = lambda df: len(df.inputFiles())
    assert opened(t.read()) >= 4
    one = t.read(products=("p0052", "p0055"))
    assert opened(one) == 1 and _ids(one) == Counter(f"p{i:04d}" for i in range(52, 56))
    assert opened(t.read(days=("2024-01-03", "2024-01-09"))) == 1
    assert t.read(sources=["T"], days=("2024-01-01", "2024-01-01")).count() == 10


@pytest.mark.parametrize("overlap", [True, False])
def test_two_writers_leave_one_row_a_key(spark, monkeypatch, overlap):
    root = scratch_dir(spark, "versioned")
    VersionedTable(spark, root).append(_batch(spark, range(3)))
    meet, put = threading.Barrier(2), VersionedTable.put
    first = threading.local()

    def put_together(self, version, manifest):
        if not getattr(first, "done", False):
            first.done = True
            meet.wait(60)  # both have written their files and read version 0
        put(self, version, manifest)

    monkeypatch.setattr(VersionedTable, "put", put_together)
    batches = [_batch(spark, range(20)), _batch(spark, range(20) if overlap else range(20, 40))]
    got = []
    threads = [threading.Thread(target=lambda b=b: got.append(VersionedTable(spark, root).append(b))) for b in batches]
    for th in threads:
        th.start()
    for th in threads:
        th.join()
    monkeypatch.undo()
    t = VersionedTable(spark, root)
    assert _ids(t.read()) == Counter(f"p{i:04d}" for i in range(20 if overlap else 40))
    # the same batch twice: the loser has nothing left to add
    assert sorted(got, key=str) == ([1, None] if overlap else [1, 2])
    assert not [f for f in os.listdir(f"{root}/log") if f.endswith(".tmp")]


def _bucketed(spark):
    table, path = f"t_{uuid.uuid4().hex[:8]}", scratch_dir(spark, "bucketed")
    for day, ids in ((1, range(30)), (1, range(30)), (2, range(20, 40))):
        B.append_bucketed(_batch(spark, ids, day, price=float(day)), table, 4, path=path)
    return table


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange")


def test_bucketed_table_is_read_without_an_exchange(spark):
    table = _bucketed(spark)
    assert spark.table(table).count() == 50
    for df in (B.latest(spark, table), B.run_diff(spark, table, "2024-01-01", "2024-01-02"), B.history(spark, table)):
        assert _exchanges(df) == 0
    assert {r.product_id: r.price for r in B.latest(spark, table).collect()} == {f"p{i:04d}": 1.0 if i < 20 else 2.0 for i in range(40)}
    assert Counter(r.status for r in B.run_diff(spark, table, "2024-01-01", "2024-01-02").collect()) == {"delisted": 20, "repriced": 10, "new": 10}
    # a further load shuffles the batch alone
    known = spark.table(table).select("product_id")
    batch = _batch(spark, range(35, 45)).select("product_id")
    plan = batch.hint("merge").join(known, "product_id", "left_anti")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan" in line)
    deep = lambda line: len(line) - len(line.lstrip(" :+-"))
    above = [line for i, line in enumerate(lines[:at]) if "Exchange" in line and all(deep(x) > deep(line) for x in lines[i + 1:at + 1])]
    assert not above


def test_bucketed_query_plans(spark):
    from pricelens.plans import queries
    for q in (queries.table_latest_snapshot, queries.bucketed_run_diff):
        assert _exchanges(q(spark, "/root/testdata/sf0.001")) == 0


def test_null_stamps_are_keys_too(spark):
    t = VersionedTable(spark, scratch_dir(spark, "versioned"))
    df = _batch(spark, range(4)).withColumn("_created_date", F.when(F.col("product_id") != "p0001", F.col("_created_date")))
    assert t.append(df) == 0 and t.append(df) is None
    assert t.read().count() == 4
