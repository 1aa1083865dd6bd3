"""The catalogue job: stored product pages -> clean catalogue + rejects.

    pages scan (filtered to the site's product pages at the scan)
      -> shred (Python, per partition, Arrow batches)
      -> adapter.extract (native Columns, narrow) + stamp + run metrics
      -> [staged when several consumers read the records]
      -> split_quality: clean = first-seen aggregate, rejects = narrow join
      -> sinks (JSON lines, day layout, idempotent table)

The chain of record steps is a list of ``DataFrame -> DataFrame`` functions
(the extension surface): each may add columns or drop rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.operators.shred import shred
from pricelens.schema import PRODUCT, PRODUCT_COLS
from pricelens.session import stage
from pricelens.sinks import publish as P

Step = Callable[[DataFrame], DataFrame]


def product_pages(pages: DataFrame, site: str | None = None) -> DataFrame:
    """Only what the shredder needs, narrowed before the Python step."""
    df = pages
    if site is not None and "site" in df.columns:
        df = df.filter(F.col("site") == site)
    if "page_type" in df.columns:
        df = df.filter(F.col("page_type") == PRODUCT)
    # a plain page table (id, URL, markup) has no fetch time
    fetched = F.col("fetched_at") if "fetched_at" in df.columns else F.lit(None).cast("timestamp")
    return df.select("page_id", "url", fetched.alias("fetched_at"), "html")


def extract_records(pages: DataFrame, adapter, site: str | None = None,
                    run_ts=None, observation=None) -> DataFrame:
    """Product fields + extract_error + _created_date for every product page.

    The record stamp is the page's fetch time (repeatable), or ``run_ts`` if
    given; never ``current_timestamp()`` inside tests.
    """
    recs = adapter.extract(shred(product_pages(pages, site)))
    stamp = F.col("fetched_at") if run_ts is None else F.lit(run_ts).cast("timestamp")
    # Run metrics (pages, extraction failures) for the run audit.  The
    # metrics node also keeps later filters on extract_error from being
    # pushed below the extraction, which would evaluate every selector twice.
    # Pass a pyspark.sql.Observation to read them after the first action.
    name = observation or f"extract:{getattr(adapter, 'source', 'site')}:{uuid.uuid4().hex[:8]}"
    return recs.withColumn("_created_date", stamp).observe(
        name, F.count(F.lit(1)).alias("pages"), F.count("extract_error").alias("extract_errors"))


def run_chain(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def build_catalogue(pages: DataFrame, adapter, site: str | None = None,
                    steps: Iterable[Step] = (), run_ts=None, staged: bool = True) -> DataFrame:
    """Tagged records: ``reject_reason`` null for the clean catalogue.

    The extracted records are staged (written once under the shared
    checkpoint folder): the quality split reads them three times (complete
    rows, the survivor aggregate, rejects), and the shredder must run once.
    """
    recs = run_chain(extract_records(pages, adapter, site, run_ts), steps)
    if staged:
        recs = stage(recs, "records")
    return Q.tag_quality(recs, order=["fetched_at", "page_id"])


def build_catalogue_split(pages: DataFrame, adapter, site: str | None = None,
                          steps: Iterable[Step] = (), run_ts=None,
                          staged: bool = True, observation=None,
                          staging=None, columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean catalogue, rejects): the scale path.  Records are stored once with
    a row number; the first of each id are found over narrow columns by hash and
    kept by number, so whole records are not shuffled.  A caller that only needs
    the clean catalogue's few columns may pass ``staged=False``: the pages are
    read once and nothing is stored, but records ride in a sort-based aggregate
    (the metrics node in ``extract_records`` keeps that single read from
    evaluating the selectors twice).  ``columns`` names the record fields the
    caller needs: the others are dropped before the dedup moves whole records."""
    recs = run_chain(extract_records(pages, adapter, site, run_ts, observation), steps)
    if columns is not None:
        keep = {*columns, "product_id", "product_name", "request_url", "_source", "fetched_at", "page_id", "extract_error"}
        recs = recs.select(*[c for c in recs.columns if c in keep])
    if staged:
        recs = Q.with_row_id(recs)
        recs = staging.stage(recs, "records") if staging is not None else stage(recs, "records")
    return Q.split_quality(recs, order=["fetched_at", "page_id"])


def publish(clean_df: DataFrame, rejects_df: DataFrame, out_root: str,
            table_path: str | None = None, staging=None) -> None:
    """Write the clean catalogue (JSON lines, date-partitioned layout,
    optional idempotent table append) and the rejects.

    The clean catalogue is staged once under the shared checkpoint folder;
    the three sinks re-read that table instead of recomputing it.
    """
    clean = clean_df.select(*PRODUCT_COLS)
    good = staging.stage(clean, "clean") if staging is not None else stage(clean, "clean")
    P.write_json_lines(good, f"{out_root}/jsonl")
    P.write_partitioned(good, f"{out_root}/by_day")
    rejects_df.write.mode("overwrite").json(f"{out_root}/rejects")
    if table_path:
        P.append_idempotent(good, table_path)


def build_all(pages: DataFrame, registry, sites: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Every registered site in one catalogue (same contract, union by name).

    ``sites`` maps source name -> value of the pages' ``site`` column (the
    source name itself by default).  Each site's pages are narrowed at the
    scan and extracted by its own adapter; the loop is over adapters, never
    over data."""
    goods, bads = [], []
    for source, adapter in registry.adapters.items():
        good, bad = build_catalogue_split(pages, adapter, site=(sites or {}).get(source, source))
        goods.append(good.select(*PRODUCT_COLS))
        bads.append(bad)
    good, bad = goods[0], bads[0]
    for g, b in zip(goods[1:], bads[1:]):
        good, bad = good.unionByName(g), bad.unionByName(b)
    return good, bad
