"""Command line: run the catalogue job for one site.

    python -m pricelens catalogue --pages PATH --layout a --source SHOP --out DIR [--table DIR]
    python -m pricelens stream    --landing DIR --layout a --source SHOP --out DIR
    python -m pricelens links     --pages PATH --layout a --seed URL [--depth N] --out DIR

``--pages`` is a parquet table of stored pages (page_id, url, html,
fetched_at, site, page_type); ``--site`` narrows it at the scan.  The
session comes from spark-submit; scratch space is ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pricelens.plans.sites import LayoutA, LayoutB
from pricelens.session import build_session


def _adapter(args):
    if args.layout == "a":
        return LayoutA(source=args.source)
    return LayoutB(source=args.source, link_host=args.link_host)


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="pricelens")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("catalogue", "stream", "links"):
        s = sub.add_parser(name)
        s.add_argument("--layout", choices=["a", "b"], required=True)
        s.add_argument("--source", default="SITE")
        s.add_argument("--link-host", default="https://www.example.com")
        s.add_argument("--site", default=None)
        s.add_argument("--out", required=True)
    sub.choices["catalogue"].add_argument("--pages", required=True)
    sub.choices["catalogue"].add_argument("--table", default=None)
    sub.choices["stream"].add_argument("--landing", required=True)
    sub.choices["stream"].add_argument("--files-per-trigger", type=int, default=None)
    sub.choices["links"].add_argument("--pages", required=True)
    sub.choices["links"].add_argument("--seed", action="append", required=True)
    sub.choices["links"].add_argument("--depth", type=int, default=None, help="default: the layout's")
    args = p.parse_args(argv)

    spark = build_session(master=None, shuffle_partitions=None)
    adapter = _adapter(args)
    if args.cmd == "catalogue":
        from pyspark.sql import Observation
        from pricelens.plans.catalogue import build_catalogue_split, publish
        from pricelens.session import Staging
        pages = spark.read.parquet(args.pages)
        run = Observation("extract")
        with Staging(spark) as st:  # staged tables are removed once published
            good, bad = build_catalogue_split(pages, adapter, site=args.site, observation=run, staging=st)
            publish(good, bad, args.out, table_path=args.table, staging=st)
        print(f"{args.source}: {run.get}")
    elif args.cmd == "stream":
        from pricelens.plans.catalogue import publish
        from pricelens.session import Staging
        from pricelens.streaming.catalogue import read_lean_rejects, read_lean_view, stream_catalogue_lean
        # lean state (ids and order keys); a stable checkpoint next to the
        # output, so a restarted run resumes; published at the end of the run
        stream_catalogue_lean(spark, args.landing, adapter, args.out, f"{args.out}/_checkpoint",
                              site=args.site, files_per_trigger=args.files_per_trigger)
        with Staging(spark) as st:
            publish(read_lean_view(spark, args.out), read_lean_rejects(spark, args.out),
                    f"{args.out}/published", staging=st)
    else:
        from pricelens.operators.links import frontier, walk
        pages = spark.read.parquet(args.pages)
        if args.site:
            pages = pages.filter(pages.site == args.site)
        from pricelens.session import Staging
        with Staging(spark) as st:
            reached, links = walk(pages, adapter, args.seed, args.depth, staging=st)
            reached.write.mode("overwrite").parquet(f"{args.out}/reached")
            frontier(links, pages).write.mode("overwrite").parquet(f"{args.out}/frontier")


if __name__ == "__main__":
    main()
