"""Page archives: splits inside files, round trips, other writers, streams."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F

from pricelens.schema import PAGE_SCHEMA
from pricelens.sources import archive as A


def _rows(n, salt=""):
    stamp = dt.datetime(2024, 1, 1, 12, 0, 0, 123456)
    return [(i, f"http://shop.example/{salt}{i}?q=a b", f"<p>{salt}{i} " + os.urandom(700).hex() + "</p>", stamp, "A", "product") for i in range(n)]


def _sorted(df):
    return sorted(df.collect(), key=str)


def test_round_trip_with_nulls_and_line_ends(spark, tmp_path):
    rows = _rows(3) + [(None, None, None, None, None, None), (9, "http://x/\r\nContent-Length: 0", "", None, "Ж", ""),
                       (10, "u", "\r\n\r\nWARC/1.0\r\nContent-Length: 1\r\n\r\n\u0000中", None, None, None), (9, "u", "<b>", None, None, None),
                       (9, "u", "<b>", None, None, None), (11, "long", "x" * 3_000_000, None, None, None)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(2)
    A.write_archive(pages, str(tmp_path / "a"))
    back = A.read_archive(spark, str(tmp_path / "a"))
    assert back.schema == PAGE_SCHEMA
    assert _sorted(back) == _sorted(pages)
    # a file URI names the same folder
    assert A.read_archive(spark, f"file:{tmp_path}/a").count() == len(rows)


@pytest.mark.parametrize("size", [1, 700, 4096, 100_000])
def test_splits_of_a_file_share_its_members(spark, tmp_path, size):
    rows = _rows(60)
    A.write_archive(spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(1), str(tmp_path / "a"))
    (name, n), = A.archive_files(str(tmp_path / "a"))
    parts = A.splits([(name, n)], size)
    assert len(parts) == -(-n // size) and len(parts) >= (1 if size == 100_000 else 2)
    if size == 1:
        # every byte is a split of its own: each member begins in exactly one
        with A.store_of(str(tmp_path))[0].open_input_file(f"{tmp_path}/a/{name}") as f:
            starts = [p.start for p in parts if A.first_member(f, p.start, p.end) is not None]
        assert len(starts) == 60 and starts[0] == 0
        return
    back = A.read_archive(spark, str(tmp_path / "a"), size)
    assert back.rdd.getNumPartitions() == len(parts)
    assert sorted(r.page_id for r in back.select("page_id").collect()) == list(range(60))


def test_records_of_other_writers(spark, tmp_path):
    def member(kind, body, extra=""):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Date: 2024-03-01T10:00:00Z\r\n{extra}Content-Length: {len(body)}\r\n\r\n"
        return gzip.compress(head.encode() + body + b"\r\n\r\n")
    http = "WARC-Target-URI: http://x/1\r\nContent-Type: application/http; msgtype=response\r\n"
    os.mkdir(tmp_path / "a")
    (tmp_path / "a" / ("x" + A.SUFFIX)).write_bytes(
        member("warcinfo", b"software: x") + member("request", b"GET / HTTP/1.1\r\n\r\n", http)
        + member("response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<h1>hi</h1>\r\n\r\nmore \xff", http))
    row, = A.read_archive(spark, str(tmp_path / "a")).select("page_id", "url", "html", F.unix_seconds("fetched_at").alias("s")).collect()
    assert tuple(row) == (None, "http://x/1", "<h1>hi</h1>\r\n\r\nmore �", 1709287200)


def test_empty_and_damaged(spark, tmp_path):
    assert A.read_archive(spark, str(tmp_path / "none")).count() == 0
    A.write_archive(spark.createDataFrame([], PAGE_SCHEMA), str(tmp_path / "e"))
    assert A.read_archive(spark, str(tmp_path / "e")).count() == 0
    A.write_archive(spark.createDataFrame(_rows(5), PAGE_SCHEMA).coalesce(1), str(tmp_path / "a"))
    (name, n), = A.archive_files(str(tmp_path / "a"))
    whole = (tmp_path / "a" / name).read_bytes()
    (tmp_path / "a" / name).write_bytes(whole[:-40])
    with pytest.raises(Exception, match="ends inside the record"):
        A.read_archive(spark, str(tmp_path / "a")).count()
    with pytest.raises(Exception, match="only grows"):
        spark.createDataFrame(_rows(1), PAGE_SCHEMA).write.format(A.FORMAT).mode("overwrite").save(str(tmp_path / "a"))


def test_a_failed_load_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "a")
    A.write_archive(spark.createDataFrame(_rows(4), PAGE_SCHEMA), path)
    bad = spark.createDataFrame(_rows(40, "b"), PAGE_SCHEMA).repartition(4).withColumn(
        "html", F.when(F.col("page_id") == 33, F.raise_error(F.lit("boom")).cast("string")).otherwise(F.col("html")))
    with pytest.raises(Exception, match="boom"):
        A.write_archive(bad, path)
    assert A.read_archive(spark, path).count() == 4
    left = os.listdir(tmp_path / "a" / "_temporary") if os.path.isdir(tmp_path / "a" / "_temporary") else []
    assert left == []


def test_a_task_that_outlives_a_failed_load_leaves_nothing(tmp_path, monkeypatch):
    import pyarrow as pa
    import pyspark

    class Task:
        get = classmethod(lambda cls: cls())
        partitionId = taskAttemptId = lambda self: 0  # noqa: N815

    monkeypatch.setattr(pyspark, "TaskContext", Task)
    rows = pa.RecordBatch.from_pylist([{"page_id": 1, "html": "<p>"}] * 2)
    writer = A._Writer(str(tmp_path / "a"))

    def late(first):
        # the driver gives the load up while the task is at work
        yield from first
        writer.abort([])
        yield rows

    # a file opened after the load was given up
    with pytest.raises(OSError):
        writer.write(late([]))
    assert os.listdir(tmp_path / "a" / "_temporary") == []
    # one opened before
    writer = A._Writer(str(tmp_path / "a"))
    writer.write(late([rows]))
    assert os.listdir(tmp_path / "a" / "_temporary") == []
    # a load without rows
    writer = A._Writer(str(tmp_path / "a"))
    writer.commit([writer.write(iter(()))])
    assert os.listdir(tmp_path / "a" / "_temporary") == []
    assert A.archive_files(str(tmp_path / "a")) == []


def test_stream_restarts_from_its_offset(spark, tmp_path):
    path, out = str(tmp_path / "a"), str(tmp_path / "out")

    def run():
        q = (A.read_archive_stream(spark, path, 4096).writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    A.write_archive(spark.createDataFrame(_rows(20, "a"), PAGE_SCHEMA).coalesce(2), path)
    assert run() == 20
    assert run() == 0
    A.write_archive(spark.createDataFrame(_rows(7, "b"), PAGE_SCHEMA), path)
    assert run() == 7
    assert spark.read.parquet(out).count() == 27
