"""Dealing out CPU-heavy narrow work.

Large inputs arrive in many file splits and need nothing.  Where an input is
packed into fewer splits than there are cores (one file, one row group), the
session setting ``pricelens.partitions`` deals it out to that many tasks by a
round-robin shuffle before a costly step.  It is a choice of the caller's:
unset, a step runs on the splits as they are read.  The exception is narrow
rows that each bring a costly page (``deal_rows``): their file splits say
nothing of the work, millions fit in one, so they are dealt out by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

SETTING = "pricelens.partitions"


def spread(df: DataFrame) -> DataFrame:
    """``df`` in ``pricelens.partitions`` partitions, if that is set."""
    n = df.sparkSession.conf.get(SETTING, None)
    return df if n is None or df.isStreaming else df.repartition(int(n))


ROWS_PER_TASK = 2500


def tasks_for(df: DataFrame) -> int:
    """Tasks of about ``ROWS_PER_TASK`` rows that ``df`` makes, a table as it is
    read (the count comes from the file footers)."""
    return max(1, -(-df.count() // ROWS_PER_TASK))


def deal_rows(df: DataFrame) -> DataFrame:
    """``df``, a table as it is read, in ``tasks_for`` tasks, or in
    ``pricelens.partitions``, if that is set."""
    if df.isStreaming or df.sparkSession.conf.get(SETTING, None) is not None:
        return spread(df)
    return df.repartition(tasks_for(df))


def slots(spark) -> int:
    """The session's shuffle partition count, the unit for dealing work out."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
