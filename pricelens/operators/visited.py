"""The frontier across runs: URLs that no walk has requested yet.

A visited set is a folder all runs share.  Every run adds one part: its URL keys
and, as a filter, the cells their hashes fall into, 64 cells to a row.  A new
run's links look their cells up first: those in a cell of their own are new for
certain and meet nothing else; only the rest (revisits, and one in some
thousand of the new) are compared with the stored keys themselves, of which the
hash buckets they fall into are read.  So the cost of a run follows its new
links and its revisits, not all URLs ever seen.
"""

from __future__ import annotations

from dataclasses import dataclass
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.functions.text import canonical_url
from pricelens.session import stage

# Cells of a run's filter for each of its URLs, and hash buckets of the stored keys.
CELLS_A_URL = 1024
BUCKETS = 64


def _hash(column: str = "url_key"):
    return F.xxhash64(column)


def _cell(column: str, bits):
    """A hash's cell in a filter of ``2 ** bits`` cells."""
    return F.call_function("shiftrightunsigned", _hash(column), F.lit(64) - bits)


def _bit(cell):
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (cell % 64).cast("int"))


@dataclass
class VisitedSet:
    spark: SparkSession
    root: str

    def runs(self) -> list[tuple[str, int]]:
        """(folder, bits of its filter) of every run whose part is complete."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/filter")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
        # the filter is written last: without it a part does not count
        return [(n[4:], int(n.rsplit("-", 1)[1])) for n in names if n.startswith("run=") and fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.root}/filter/{n}/_SUCCESS"))]

    def _maybe(self, keys: DataFrame) -> DataFrame:
        """``keys`` with ``_maybe``: whether a run's filter holds their cell."""
        out = keys.withColumn("_maybe", F.lit(False))
        for name, bits in self.runs():
            words = self.spark.read.parquet(f"{self.root}/filter/run={name}")
            cell = _cell("url_key", F.lit(bits))
            hit = F.coalesce(F.col("_bits").bitwiseAND(_bit(cell)) != 0, F.lit(False))
            out = out.join(words, F.shiftright(cell, 6) == F.col("_word"), "left").withColumn("_maybe", F.col("_maybe") | hit).drop("_word", "_bits")
        return out

    def unseen(self, links: DataFrame) -> DataFrame:
        """(url_key, url) of the links' URLs that no run has, one a canonical URL."""
        keys = links.groupBy(canonical_url(F.col("url")).alias("url_key")).agg(F.min("url").alias("url")).where("url_key is not null")
        runs = self.runs()
        if not runs:
            return keys
        marked = stage(self._maybe(keys), "visited-marked")
        doubt = marked.where("_maybe").select("url_key", "url", F.pmod(_hash(), F.lit(BUCKETS)).cast("int").alias("bucket"))
        known = self.spark.read.schema("url_key string, run string, bucket int").parquet(f"{self.root}/urls").where(F.col("run").isin([n for n, _ in runs]))
        # the buckets in doubt reach the scan as a partition filter
        new = doubt.join(known.select("url_key", "bucket"), ["bucket", "url_key"], "left_anti")
        return marked.where("not _maybe").select("url_key", "url").unionByName(new.select("url_key", "url"))

    def add(self, urls: DataFrame) -> str:
        """Adds a run's requested URLs (column url_key) as one part; its folder."""
        keys = stage(urls.select("url_key").where("url_key is not null").distinct(), "visited-new")
        bits = max(6, (max(1, keys.count()) * CELLS_A_URL - 1).bit_length())
        name = f"{len(self.runs()):06d}-{uuid.uuid4().hex[:8]}-{bits}"
        keys.withColumn("bucket", F.pmod(_hash(), F.lit(BUCKETS)).cast("int")).hint("rebalance", "bucket") \
            .write.partitionBy("bucket").parquet(f"{self.root}/urls/run={name}")
        cell = _cell("url_key", F.lit(bits))
        keys.groupBy(F.shiftright(cell, 6).alias("_word")).agg(F.bit_or(_bit(cell)).alias("_bits")).write.parquet(f"{self.root}/filter/run={name}")
        return name
