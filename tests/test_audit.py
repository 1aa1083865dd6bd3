"""Audit rows equal what the sink holds, over restarts and repeated batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.streaming import audit as A
from pricelens.streaming import rejects as R

DAY = "2024-01-02 00:00:00"


def _land(spark, path, ids):
    rows = spark.createDataFrame([(p, "x", f"u{n}", "S", n) for p, n in ids], "product_id string, product_name string, request_url string, _source string, n long")
    rows.withColumn(R.RUN_END, F.lit(DAY).cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def _sums(spark, path):
    row = A.read_audit(spark, path).agg(*[F.sum(c).alias(c) for c in A._COUNTS]).first()
    return row.asDict()


def test_audit_of_a_stream_over_a_restart(spark, tmp_path):
    landing, out, ck, log = (str(tmp_path / x) for x in ("in", "out", "ck", "audit"))

    def check():
        rows = spark.read.parquet(out)
        reason = F.col("reject_reason")
        want = rows.agg(F.count("*").alias("n_rows"), F.count_if(reason.isNull()).alias("n_clean"), F.count_if(reason == Q.MISSING).alias("n_missing"),
                        F.count_if(reason == Q.DUPLICATE).alias("n_duplicate")).first().asDict()
        assert _sums(spark, log) == {**want, "n_failed": 0}
        return want

    _land(spark, landing, [("a", 1), ("a", 2), (None, 3)])
    R.run_reject_stream(spark, landing, out, ck, ["n"], audit=log)
    assert check() == {"n_rows": 3, "n_clean": 1, "n_missing": 1, "n_duplicate": 1}
    # a restart goes on with the same query and the next batch ids
    _land(spark, landing, [("a", 4), ("b", 5)])
    R.run_reject_stream(spark, landing, out, ck, ["n"], audit=log)
    assert check() == {"n_rows": 5, "n_clean": 2, "n_missing": 1, "n_duplicate": 2}
    rows = A.read_audit(spark, log).collect()
    assert len({r.query_id for r in rows}) == 1 and len({r.batch_id for r in rows}) == len(rows) >= 2
    assert A.missing_batches(spark, log).count() == 0
    # a batch that is run again replaces its row
    first = min(rows, key=lambda r: r.batch_id)
    A.put_row(log, first.query_id, first.batch_id, first.asDict())
    assert check()["n_rows"] == 5
    # and one whose row is lost is named
    os.remove(glob.glob(f"{log}/*/{first.batch_id:012d}.json")[0])
    assert [r.batch_id for r in A.missing_batches(spark, log).collect()] == [first.batch_id]


def test_audit_of_a_batch_run(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, Q.MISSING), (3, Q.DUPLICATE), (4, "extract_error:html"), (5, None)], "id long, reject_reason string")
    for _ in range(2):
        got = A.audit_batch(rows, lambda df: df.write.mode("overwrite").parquet(str(tmp_path / "out")), str(tmp_path / "log"), "run-1")
    assert got["n_clean"] == 2
    assert _sums(spark, str(tmp_path / "log")) == {"n_rows": 5, "n_clean": 2, "n_missing": 1, "n_duplicate": 1, "n_failed": 1}


def test_a_row_that_cannot_be_written_raises(spark, tmp_path):
    landing, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    (tmp_path / "file").write_text("")
    _land(spark, landing, [("a", 1)])
    with pytest.raises(RuntimeError, match="audit rows not written"):
        R.run_reject_stream(spark, landing, out, ck, ["n"], audit=str(tmp_path / "file" / "log"))
