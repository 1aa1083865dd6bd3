"""Walking stored pages: link extraction per page type, resolution, frontier."""

from pricelens.operators.links import frontier, walk
from pricelens.plans.sites import LayoutA, LayoutB
from tests.fixtures import HOST_A, HOST_B, LINK_HOST_B


def test_walk_layout_a(pages_a):
    reached, links = walk(pages_a.drop("page_type"), LayoutA(), [f"{HOST_A}/"], depth=3)
    by_type = {}
    for r in reached.select("url", "page_type", "cate_url").collect():
        by_type.setdefault(r.page_type, set()).add(r.url)
    cat1 = f"{HOST_A}/index.php?route=product/category&path=1"
    cat2 = f"{HOST_A}/index.php?route=product/category&path=2"
    assert by_type["pagination"] == {cat1, cat2}  # first category link skipped
    assert by_type["listing"] == {f"{cat1}&page=1", f"{cat1}&page=2", f"{cat1}&page=3", f"{cat2}&page=1"}
    assert len(by_type["product"]) == 7  # product 1 linked twice, reached once
    lineage = {r.url: r.cate_url for r in reached.filter("page_type = 'listing'").collect()}
    assert lineage[f"{cat1}&page=3"] == cat1
    assert frontier(links, pages_a).collect() == []  # every followed link is stored


def test_walk_layout_b(pages_b):
    reached, links = walk(pages_b.drop("page_type"), LayoutB(link_host=LINK_HOST_B), [f"{HOST_B}/home"])
    types = {r.url: r.page_type for r in reached.collect()}
    assert types[f"{HOST_B}/cat?c=1"] == "subcategory"  # http:// + host of the page + href
    assert types[f"{LINK_HOST_B}/sub?c=1"] == "pagination"
    assert types[f"{LINK_HOST_B}/sub?c=1&page=1"] == "listing"
    assert types[f"{LINK_HOST_B}/product/detail?itemno=101"] == "product"
    pag = {r.url for r in links.filter("page_type = 'listing'").collect()}
    # page 1 plus every pager link with text; the empty-text one is skipped
    assert pag == {f"{LINK_HOST_B}/sub?c=1&page=1", f"{LINK_HOST_B}/sub?c=1&page=2",
                   f"{LINK_HOST_B}/sub?c=1&page=4"}
    prods = {r.url for r in links.filter("page_type = 'product'").collect()}
    # second <a> of each <li>; an <li> with one <a> gives nothing
    assert prods == {f"{LINK_HOST_B}/product/detail?itemno={n}" for n in (101, 102, 103)}
    todo = {r.url for r in frontier(links, pages_b).collect()}
    assert todo == {f"{LINK_HOST_B}/sub?c=1&page=4"}


def test_category_hook_limits_the_walk(pages_a):
    cat2 = f"{HOST_A}/index.php?route=product/category&path=2"
    reached, _ = walk(pages_a.drop("page_type"), LayoutA(categories=[cat2]), [f"{HOST_A}/"], depth=3)
    got = {r.url for r in reached.filter("page_type = 'pagination'").collect()}
    assert got == {cat2}
    assert reached.filter("page_type = 'product'").count() == 3


def test_single_hop_resolve_takes_first_link(spark, pages_a):
    from pricelens.operators.links import resolve
    links = spark.createDataFrame(
        [(9, 1, f"{HOST_A}/index.php?route=product/category&path=1", "pagination", "c-late", None),
         (3, 0, f"{HOST_A}/index.php?route=product/category&path=1", "pagination", "c-first", None),
         (3, 1, f"{HOST_A}/not-stored", "pagination", "c", None)],
        "src_page_id long, ord int, url string, page_type string, cate_url string, subcate_url string")
    got = resolve(links, pages_a.select("page_id", "url")).collect()
    assert [(r.page_type, r.cate_url) for r in got] == [("pagination", "c-first")]


def test_cli_links(spark, pages_a):
    from pricelens.__main__ import main
    from pricelens.session import scratch_dir
    src = scratch_dir(spark, "cli-links-pages")
    pages_a.drop("page_type").write.parquet(src)
    out = scratch_dir(spark, "cli-links-out")
    main(["links", "--pages", src, "--layout", "a", "--seed", f"{HOST_A}/", "--depth", "3", "--out", out])
    assert spark.read.parquet(out + "/reached").count() == 1 + 2 + 4 + 7
    assert spark.read.parquet(out + "/frontier").count() == 0


def test_walk_requests_each_url_once(spark):
    from pricelens.schema import PAGE_SCHEMA
    from tests.fixtures import T0, a_home, a_listing, a_pagination
    cat = f"{HOST_A}/c?path=1"
    rows = [(1, f"{HOST_A}/", a_home([f"{HOST_A}/skip", cat]), T0, "A", None),
            (2, cat, a_pagination(None), T0, "A", None),
            # the listing links back to the category page, already requested
            (3, f"{cat}&page=1", a_listing([cat, f"{HOST_A}/p?product_id=1"]), T0, "A", None),
            (4, f"{HOST_A}/p?product_id=1", "<html></html>", T0, "A", None)]
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).drop("page_type")
    reached, _ = walk(pages, LayoutA(), [f"{HOST_A}/"], depth=3)
    got = sorted((r.url, r.page_type) for r in reached.collect())
    assert got == sorted([(f"{HOST_A}/", "home"), (cat, "pagination"), (f"{cat}&page=1", "listing"),
                          (f"{HOST_A}/p?product_id=1", "product")])


def test_walk_layout_b_lineage(pages_b):
    reached, _ = walk(pages_b.drop("page_type"), LayoutB(link_host=LINK_HOST_B), [f"{HOST_B}/home"])
    rows = {r.url: r for r in reached.collect()}
    listing = rows[f"{LINK_HOST_B}/sub?c=1&page=1"]
    assert listing.subcate_url == f"{LINK_HOST_B}/sub?c=1" and listing.cate_url == f"{HOST_B}/cat?c=1"
    product = rows[f"{LINK_HOST_B}/product/detail?itemno=101"]
    assert product.subcate_url == f"{LINK_HOST_B}/sub?c=1"


def test_count_to_builds_no_huge_array(spark, monkeypatch):
    from pricelens.operators import links as L
    monkeypatch.setattr(L, "COUNT_BLOCK", 3)
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0), ("d", None), ("e", 9)], "k string, n bigint")
    got = sorted(map(tuple, L.count_to(df, "n", "i").collect()))
    assert got == [("a", i) for i in range(1, 26)] + [("b", 1)] + [("e", i) for i in range(1, 10)]
    monkeypatch.undo()
    big = spark.createDataFrame([(9_999_999_999,)], "n bigint")
    assert L.count_to(big, "n", "i").limit(3).count() == 3


def test_walk_parses_once_and_joins_once_a_hop(spark):
    from pricelens.operators import links as L
    from pricelens.operators.shred import shred
    from pricelens.plans import derived_sites as D
    from pricelens.plans.sites import LayoutA
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    pages = D.walk_pages_a(part)
    plan = L.link_graph(shred(pages), LayoutA(), L.WALK_TYPES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    reached, _ = L.walk(pages, LayoutA(), [D.HOST_A + "/"])
    plan = reached._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Scan parquet") == LayoutA().walk_depth + 1
    assert reached.where("page_type = 'product'").count() == part.count()
