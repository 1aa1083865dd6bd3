"""A published table with numbered versions and safe concurrent appends.

Data files are written by Spark below ``data/``, each attempt into a folder of
its own; a version is a small manifest ``log/<number>.json`` that lists the
files it adds with their partition, row count and least and greatest values.
A version exists once its manifest does, and putting a manifest fails if one of
that number is there: of two writers one wins, the other reads what was added
meanwhile, leaves out the rows that are in it, and tries the next number.  So
one key is never published twice, whoever retries or writes at the same time,
and readers see whole versions, the newest or any older one.

The driver handles manifests only (one entry a file); rows stay in Spark jobs.
A key filter per file is not kept: a candidate file is read by its key columns
alone, which costs less than probing a filter of its size.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.schema import PRODUCT_COLS, PRODUCT_SCHEMA
from pricelens.session import ensure_conf
from pricelens.sinks.publish import TABLE_PARTITIONS, one_per_key, snapshot_day

KEYS = ("product_id", "_created_date")
STAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"
ATTEMPTS = 50


class Conflict(Exception):
    """Another writer has put this version."""


@dataclass
class VersionedTable:
    """``root`` is a folder all executors and writers share."""
    spark: SparkSession
    root: str

    # ---- manifests ---------------------------------------------------------------
    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifest(self, version: int) -> str:
        return f"{self.root}/log/{version:012d}.json"

    def versions(self) -> list[int]:
        p, fs = self._fs(f"{self.root}/log")
        if not fs.exists(p):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(p))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _read(self, version: int) -> dict:
        p, fs = self._fs(self._manifest(version))
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, version: int, manifest: dict) -> None:
        """Puts a manifest whole, or raises ``Conflict`` if the number is taken."""
        p, fs = self._fs(self._manifest(version))
        fs.mkdirs(p.getParent())
        part, _ = self._fs(f"{self.root}/log/.{uuid.uuid4().hex}.tmp")
        out = fs.create(part, False)
        try:
            out.write(bytearray(json.dumps(manifest).encode()))
        finally:
            out.close()
        try:
            if fs.getScheme() == "file":
                # a local or mounted folder: linking fails if the name is there
                os.link(part.toUri().getPath(), p.toUri().getPath())
            elif fs.exists(p) or not fs.rename(part, p):
                raise Conflict(str(version))
        except FileExistsError:
            raise Conflict(str(version)) from None
        finally:
            fs.delete(part, False)

    def files(self, version: int | None = None, after: int = -1) -> list[dict]:
        """The files of a version (the newest unless given), of those put after ``after``."""
        known = self.versions()
        if version is not None and version not in known:
            raise ValueError(f"no version {version} in {self.root}")
        return [f for v in known if after < v <= (known[-1] if version is None else version) for f in self._read(v)["add"]]

    # ---- reading -----------------------------------------------------------------
    def _load(self, files: list[dict]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], PRODUCT_SCHEMA).withColumn("snapshot_date", F.lit(None).cast("string"))
        schema = PRODUCT_SCHEMA.fields
        df = self.spark.read.schema(type(PRODUCT_SCHEMA)([f for f in schema if f.name != "_source"])).option("basePath", f"{self.root}/data").parquet(
            *[f"{self.root}/data/{f['path']}" for f in files])
        return df.select(*PRODUCT_COLS, F.col("snapshot_date").cast("string"))

    def read(self, version: int | None = None, sources: list[str] | None = None, days: tuple[str, str] | None = None,
             products: tuple[str, str] | None = None) -> DataFrame:
        """The table at a version.  Files outside ``sources``, ``days`` or
        ``products`` (first, last) are not opened: their manifest entries tell."""
        files = [f for f in self.files(version) if (sources is None or f["_source"] in sources)
                 and (days is None or days[0] <= f["snapshot_date"] <= days[1])
                 and (products is None or (f["max"]["product_id"] >= products[0] and f["min"]["product_id"] <= products[1]))]
        df = self._load(files)
        if sources is not None:
            df = df.where(F.col("_source").isin(sources))
        if days is not None:
            df = df.where(F.col("snapshot_date").between(*days))
        return df if products is None else df.where(F.col("product_id").between(*products))

    # ---- writing -----------------------------------------------------------------
    def _write(self, rows: DataFrame) -> list[dict]:
        """Writes rows into a folder of their own; the manifest entries of its files."""
        folder = uuid.uuid4().hex
        path = f"{self.root}/data/attempt={folder}"
        rows.hint("rebalance", *TABLE_PARTITIONS).sortWithinPartitions("product_id").write.partitionBy(*TABLE_PARTITIONS).parquet(path)
        p, fs = self._fs(path)
        if not any(s.isDirectory() for s in fs.listStatus(p)):
            return []
        written = self.spark.read.parquet(path)
        stats = written.groupBy(F.col("_metadata.file_path").alias("path"), *TABLE_PARTITIONS).agg(
            F.count(F.lit(1)).alias("rows"), F.min("product_id").alias("lo"), F.max("product_id").alias("hi"),
            F.date_format(F.min("_created_date"), STAMP).alias("first"), F.date_format(F.max("_created_date"), STAMP).alias("last")).collect()
        marker = f"attempt={folder}/"
        return [{"path": marker + r["path"].split(marker, 1)[1], "_source": r["_source"], "snapshot_date": str(r["snapshot_date"]), "rows": r["rows"],
                 "min": {"product_id": r["lo"], "_created_date": r["first"]}, "max": {"product_id": r["hi"], "_created_date": r["last"]}} for r in stats]

    def _without(self, rows: DataFrame, files: list[dict], keys) -> DataFrame:
        """``rows`` whose key is in none of the files, which are read by their keys."""
        if not files:
            return rows
        known = self._load(files).select(*keys, *TABLE_PARTITIONS)
        return rows.join(known, [rows[c].eqNullSafe(known[c]) for c in [*keys, *TABLE_PARTITIONS]], "left_anti")

    @staticmethod
    def _meeting(files: list[dict], mine: list[dict]) -> list[dict]:
        """The files that may hold a key of mine: same partition, overlapping products."""
        return [f for f in files if any(f["_source"] == m["_source"] and f["snapshot_date"] == m["snapshot_date"]
                                        and f["min"]["product_id"] <= m["max"]["product_id"] and f["max"]["product_id"] >= m["min"]["product_id"] for m in mine)]

    def append(self, df: DataFrame, keys=KEYS) -> int | None:
        """Publishes the batch's rows whose key the table does not have, one a
        key, as one version; its number, or null if there was nothing to add."""
        ensure_conf(self.spark)
        batch = one_per_key(df.select(*PRODUCT_COLS).withColumn("snapshot_date", snapshot_day()), [*keys, *TABLE_PARTITIONS])
        known = self.versions()
        seen = known[-1] if known else -1
        # one row a partition of the batch
        span = batch.groupBy(*TABLE_PARTITIONS).agg(F.min("product_id").alias("lo"), F.max("product_id").alias("hi")).collect()
        spans = [{"_source": r["_source"], "snapshot_date": r["snapshot_date"], "min": {"product_id": r["lo"]}, "max": {"product_id": r["hi"]}} for r in span if r["lo"] is not None]
        mine = self._write(self._without(batch, self._meeting(self.files(seen), spans) if known else [], keys))
        for _ in range(ATTEMPTS):
            if not mine:
                return None
            try:
                self.put(seen + 1, {"version": seen + 1, "add": mine})
                return seen + 1
            except Conflict:
                newer = [v for v in self.versions() if v > seen]
                added = self._meeting(self.files(newer[-1], after=seen), mine)
                seen = newer[-1]
                if added:  # only rows that the other writers did not add go on
                    mine = self._write(self._without(self._load(mine), added, keys))
        raise RuntimeError(f"no version could be put in {ATTEMPTS} attempts: {self.root}")

    def history(self) -> list[dict]:
        """Of every version: its number, files and rows."""
        return [{"version": v, "files": len(m["add"]), "rows": sum(f["rows"] for f in m["add"])} for v in self.versions() for m in [self._read(v)]]
