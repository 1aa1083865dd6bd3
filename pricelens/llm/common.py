"""Helpers shared by the training-data operators: scratch tables on the
shared folder, and zero-copy views of Arrow text columns as byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pricelens.session import checkpoint_root, scratch_dir, share_package, stage

__all__ = ["stage", "scratch_dir", "checkpoint_root", "add_columns", "bound_batches", "byte_slices", "gather", "text_bytes", "words",
           "mix64", "slots", "SPACES"]

# The separators of a word, ``[\x20\x09-\x0D]``.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def bound_batches(spark) -> None:
    """Arrow batches of at most 500 rows and 4 MB: texts are long, and a batch
    is held several times over, by the executor and by its workers."""
    share_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def slots(spark) -> int:
    """The session's shuffle partition count, the unit for dealing work out."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def add_columns(df, columns: dict):
    """``df`` with ``columns`` last; an input column of the same name
    (whatever its case) gives way to the operator's."""
    names = {c.lower() for c in columns}
    kept = [c for c in df.columns if c.lower() not in names]
    from pyspark.sql import functions as F
    return df.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in columns.items()])


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as (its UTF-8 bytes end to end, n + 1 offsets); null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    col = col.cast(pa.large_binary())
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """``batch`` cut into runs of rows of about ``limit`` text bytes, one row at
    least, so that working memory follows the limit and the longest text alone."""
    _, offs = text_bytes(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, side="right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = min(to, n)
    # a worker that waits for its next task should not hold what this one used
    pa.default_memory_pool().release_unused()


def gather(batches, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches joined up to about ``limit`` text bytes, for work that is
    cheaper on more texts at once."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def words(col: pa.Array) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of every text with A-Z in lower case,
    end to end, and the number of words of each text."""
    buf, offs = text_bytes(col)
    inside = _IS_WORD[buf]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    heads = offs[:-1][offs[:-1] < len(buf)]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    packed = _LOWER[buf[inside]]
    # a start's place among the word bytes: its offset less the separators before it
    gaps = np.flatnonzero(~inside)
    places = np.append(starts - np.searchsorted(gaps, starts), len(packed)).astype(np.int64)
    counts = np.diff(np.searchsorted(starts, offs))
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    return arr, counts


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))
