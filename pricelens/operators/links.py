"""Link resolution over stored pages (the walk, without fetching).

A followed link becomes the stored page with that URL; each URL is taken
once.  The walk has a fixed depth per layout, so it is a short, unrolled
chain of joins (a loop over levels on the driver, never over data).  Pages
are shredded once into an edge table; the hops join small (url, type)
frames, never page content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.functions.text import canonical_url
from pricelens.schema import HOME, LISTING, PAGINATION, PRODUCT, SUBCATEGORY


def first_link_per_url(links: DataFrame) -> DataFrame:
    """One link per canonical URL: the earliest (src_page_id, ord);
    partial-aggregated.  ``url`` keeps the link's own text, ``url_key`` is
    the canonical form pages are matched on."""
    w = F.min(F.struct("src_page_id", "ord", "url", "page_type", "cate_url", "subcate_url"))
    return (links.groupBy(canonical_url(F.col("url")).alias("url_key")).agg(w.alias("_l"))
            .select("url_key", "_l.url", "_l.src_page_id", "_l.ord", "_l.page_type", "_l.cate_url",
                    "_l.subcate_url"))


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.withColumn("url_key", canonical_url(F.col("url")))


def resolve(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages reached by a link, typed and with lineage from that link."""
    first = first_link_per_url(links).drop("src_page_id", "ord", "url")
    return _keyed(pages.drop(*[c for c in ("page_type", "cate_url", "subcate_url") if c in pages.columns])) \
        .join(first, "url_key", "inner").drop("url_key")


def frontier(links: DataFrame, pages: DataFrame) -> DataFrame:
    """Linked URLs with no stored page yet (what a fetcher would get next),
    one per canonical URL."""
    wanted = (links.groupBy(canonical_url(F.col("url")).alias("url_key"))
              .agg(F.min("url").alias("url")))
    return (wanted.join(_keyed(pages.select("url")).select("url_key"), "url_key", "left_anti")
            .select("url"))


# Members of one array while counting: 2 ** 21 longs, so that three rounds
# reach every 64-bit number and no row holds more than 16 MB.
COUNT_BLOCK = 1 << 21


def count_to(df: DataFrame, n: str, out: str) -> DataFrame:
    """One row per number from 1 to the bigint column ``n`` (none for null or
    less than 1), in column ``out``.  The range is cut into blocks, and those
    again, so a page count taken from a link never builds one huge array."""
    kept = [c for c in df.columns if c != n]
    df = df.select(*kept, F.lit(0).cast("bigint").alias("_lo"), (F.col(n) - 1).alias("_hi")).where("_hi >= 0")
    for block in (COUNT_BLOCK * COUNT_BLOCK, COUNT_BLOCK):
        parts = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_hi - _lo) div {block}L"))
        df = df.select(*kept, "_lo", "_hi", F.explode(parts).alias("_part")) \
            .select(*kept, (F.col("_lo") + F.col("_part") * block).alias("_lo"),
                    F.least(F.col("_hi"), F.col("_lo") + F.col("_part") * block + (block - 1)).alias("_hi"))
    return df.select(*kept, F.explode(F.sequence("_lo", "_hi")).alias("_i")).select(*kept, (F.col("_i") + 1).alias(out))


def seed(pages: DataFrame, seeds: list[str]) -> DataFrame:
    """The home pages a walk starts from."""
    return (pages.filter(F.col("url").isin(seeds))
            .withColumn("page_type", F.lit(HOME))
            .withColumn("cate_url", F.lit(None).cast("string"))
            .withColumn("subcate_url", F.lit(None).cast("string")))


def link_graph(pages: DataFrame, adapter, types: list[str]) -> DataFrame:
    """Every page's outgoing links under each page type it could have.

    One narrow pass over the shredded pages, each repeated per candidate type
    after the shredder (selectors only, no shuffle of page content).  Lineage used to *build* URLs (the
    category / subcategory URL a page was reached by) is the page's own URL,
    which is what a fetched page at that step is."""
    typed = pages.select("page_id", "url", "nodes", F.explode(F.array(*[F.lit(t) for t in types])).alias("page_type"),
                         F.col("url").alias("cate_url"), F.col("url").alias("subcate_url"))
    # a link's type is the step after its page's
    src_type = F.lit(None).cast("string")
    for step, after in zip(adapter.steps, adapter.steps[1:]):
        src_type = F.when(F.col("page_type") == after, F.lit(step)).otherwise(src_type)
    return adapter.links(typed).select("src_page_id", "ord", F.col("url").alias("dst_url"), F.col("page_type").alias("dst_type"), src_type.alias("src_type"))


WALK_TYPES = [HOME, SUBCATEGORY, PAGINATION, LISTING]


def walk(pages: DataFrame, adapter, seeds: list[str], depth: int | None = None,
         staging=None) -> tuple[DataFrame, DataFrame]:
    """(reached pages with page_type + lineage, followed links) after
    ``depth`` hops, walking the link graph rather than the pages.

    ``pages`` are stored pages (page_id, url, html).  They are shredded
    once into a staged edge table; each hop is then a join of the small
    frontier (page, type, lineage) with the edges, a first-link-per-URL
    aggregate and a join with ``(url, page_id)`` -- no page content moves.
    """
    from pricelens.operators.shred import shred
    from pricelens.session import stage
    depth = depth if depth is not None else adapter.walk_depth
    nonlinks = pages.filter(F.coalesce(F.col("page_type") != PRODUCT, F.lit(True))) \
        if "page_type" in pages.columns else pages
    graph = link_graph(shred(nonlinks.select("page_id", "url", "html")), adapter, WALK_TYPES)
    edges = staging.stage(graph, "edges") if staging is not None else stage(graph, "edges")
    ids = _keyed(pages.select("url", "page_id"))
    keep = (lambda df, name: staging.stage(df, name)) if staging is not None else stage
    level = keep(seed(pages.select("page_id", "url"), seeds)
                 .select("page_id", "url", "page_type", "cate_url", "subcate_url"), "level")
    # every level is stored, so a hop's plan reads tables and does not grow
    reached, visited, followed = level, _keyed(level.select("url")).select("url_key"), None
    for _ in range(depth):
        hop = keep(level.alias("f").join(edges.alias("e"),
                                         (F.col("f.page_id") == F.col("e.src_page_id"))
                                         & (F.col("f.page_type") == F.col("e.src_type")))
                   .select(F.col("e.src_page_id"), F.col("e.ord"), F.col("e.dst_url").alias("url"),
                           F.col("e.dst_type").alias("page_type"),
                           F.when(F.col("e.src_type") == HOME, F.col("e.dst_url"))
                           .otherwise(F.col("f.cate_url")).alias("cate_url"),
                           F.when(F.col("e.src_type") == SUBCATEGORY, F.col("e.dst_url"))
                           .otherwise(F.col("f.subcate_url")).alias("subcate_url")), "hop")
        followed = hop if followed is None else followed.unionByName(hop)
        # a URL is requested once in a walk: what earlier levels reached goes
        first = first_link_per_url(hop).drop("src_page_id", "ord", "url").join(visited, "url_key", "left_anti")
        found = keep(first.join(ids, "url_key"), "level")
        level = found.select("page_id", "url", "page_type", "cate_url", "subcate_url")
        visited = visited.unionByName(found.select("url_key"))
        reached = reached.unionByName(level)
    return reached, followed
