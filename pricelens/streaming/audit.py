"""A durable audit: one row a micro-batch of a stream, one row a batch run.

Counts come from ``observe`` on the checked rows, in the job that writes them: no
second pass.  A stream's rows are written by a ``StreamingQueryListener`` as its
micro-batches commit, under a name made of the query's id (which its checkpoint
keeps over restarts) and the batch id: a micro-batch that is run again replaces
its row.  So the sum over the audit is what the sink holds.

    with StreamAudit(spark, path) as audit:
        q = audited(rows).writeStream...start()
        q.awaitTermination()
        audit.wait(q)
    read_audit(spark, path)

Events come after the commit.  If the driver dies between the two, that
micro-batch's row is missing, not wrong: ``missing_batches`` names it.
Each row is a file; fold old ones into a table with ``read_audit`` when they are many.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import uuid

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from pricelens.operators import quality as Q
from pricelens.sources.archive import store_of

METRICS = "audit"
SCHEMA = "query_id string, batch_id long, written_at string, n_rows long, n_clean long, n_missing long, n_duplicate long, n_failed long"
_COUNTS = ["n_rows", "n_clean", "n_missing", "n_duplicate", "n_failed"]


def _counts() -> list:
    reason = F.col("reject_reason")
    return [F.count("*").alias("n_rows"), F.count_if(reason.isNull()).alias("n_clean"), F.count_if(reason == Q.MISSING).alias("n_missing"),
            F.count_if(reason == Q.DUPLICATE).alias("n_duplicate"), F.count_if(reason.startswith("extract_error:")).alias("n_failed")]


def audited(rows: DataFrame, name: str | Observation = METRICS) -> DataFrame:
    """``rows`` with ``reject_reason``, counted as they pass."""
    return rows.observe(name, *_counts())


def put_row(path: str, query_id: str, batch_id: int, counts: dict) -> None:
    """Write the row of (query, batch), replacing it: whole or not at all."""
    store, root = store_of(path)
    row = {"query_id": query_id, "batch_id": batch_id, "written_at": dt.datetime.now(dt.timezone.utc).isoformat(), **{c: int(counts.get(c) or 0) for c in _COUNTS}}
    folder = f"{root}/{query_id}"
    store.create_dir(folder, recursive=True)
    # names that open with a dot are not read
    tmp = f"{folder}/.{batch_id:012d}-{uuid.uuid4().hex}"
    with store.open_output_stream(tmp) as out:
        out.write((json.dumps(row) + "\n").encode())
    final = f"{folder}/{batch_id:012d}.json"
    if not isinstance(store, pafs.LocalFileSystem) and store.get_file_info(final).type == pafs.FileType.File:
        # a rename does not replace everywhere
        store.delete_file(final)
    store.move(tmp, final)


class StreamAudit(StreamingQueryListener):
    """Writes the audit rows of the session's audited streams while it is open."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._errors: list[str] = []
        self._lock = threading.Lock()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def __enter__(self) -> StreamAudit:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *exc) -> bool:
        self.spark.streams.removeListener(self)
        return False

    def wait(self, query, seconds: float = 60) -> None:
        """Until all events of the query's run have come; raises if a row was not written."""
        if not self._end(str(query.runId)).wait(seconds):
            raise TimeoutError("the stream's last event has not come")
        if self._errors:
            raise RuntimeError(f"audit rows not written: {self._errors}")

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        counts = p.observedMetrics.get(METRICS)
        if counts is None:
            return
        try:
            put_row(self.path, str(p.id), p.batchId, counts.asDict())
        except Exception as e:  # the listener bus would only log it
            self._errors.append(f"batch {p.batchId}: {e}")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()


def audit_batch(rows: DataFrame, write, path: str, run: str) -> dict:
    """Run ``write(rows)`` with the rows counted as they pass; its audit row is
    (``run``, 0), so a run repeated under its name replaces the row."""
    seen = Observation(f"{METRICS}-{uuid.uuid4().hex}")
    write(audited(rows, seen))
    put_row(path, run, 0, seen.get)
    return seen.get


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """All audit rows."""
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").json(path)


def missing_batches(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, batch_id) between a query's batches that have no audit row."""
    rows = read_audit(spark, path)
    # one row a query, then as many as it has batches
    due = rows.groupBy("query_id").agg(F.max("batch_id").alias("_last")).select("query_id", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("batch_id"))
    return due.join(rows, ["query_id", "batch_id"], "left_anti")
