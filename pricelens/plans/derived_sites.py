"""Product pages rendered from the ``part`` table, one per row, per layout.

The driver tables hold no shop markup, so these render it with Column string
functions (the narrow rows are dealt out first: a page is some hundred times
as large, and the tasks that render pages shred them), covering every branch of the adapters: error
pages, blank ids, category text without CJK or Latin letters, missing
brand, missing old price, malformed and blank bulk-discount lines, RRP and
look-alike keys, several name spans, and ids repeated across rows.  The
catalogue job then runs on them unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.operators.partitioning import deal_rows

HOST_A = "http://shop-a.example"
HOST_B = "https://web.shop-b.example"
PAGE_EPOCH_US = 1704067200000000  # records are fetched one second apart from here


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _when(cond: Column, html) -> Column:
    return F.when(cond, html if isinstance(html, Column) else F.lit(html)).otherwise(F.lit(""))


def site_a_title() -> Column:
    nm, sz, t = F.col("p_name"), _s("p_size"), F.col("p_type")
    ln, bl = _s(F.char_length("p_name")), _s(F.char_length("p_brand"))
    return (F.when((t == "ECONOMY") & F.col("p_size").between(4, 8), F.concat(F.lit("X"), sz, F.lit("ml x 2")))
            .when(t == "SMALL", F.concat(nm, F.lit(" "), sz, F.lit("ml x "), ln))
            .when(t == "LARGE", F.concat(nm, F.lit(" "), sz, F.lit(".5L x "), bl))
            .when(t == "PROMO", F.concat(nm, sz, F.lit("g x"), ln))
            .when(t == "ECONOMY", F.concat(nm, F.lit(" "), sz, F.lit("ml X 6")))
            .when(t == "MEDIUM", F.concat(sz, F.lit("ml x "), ln, F.lit(" "), nm))
            .otherwise(F.concat(nm, F.lit(" "), sz, F.lit("cl  x  "), sz)))


def site_a_pages(part: DataFrame) -> DataFrame:
    t, sz = F.col("p_type"), F.col("p_size")
    pid = (F.when(t == "PROMO", F.concat(F.lit("P"), _s(sz)))
           .when((t == "STANDARD") & (sz == 50), F.lit(""))
           .otherwise(_s("p_partkey")))
    url = F.concat(F.lit(HOST_A + "/index.php?route=product/product&path="), _s(sz), F.lit("&product_id="), pid)
    cate = (F.when(t == "SMALL", F.lit("小號 Small")).when(t == "LARGE", F.lit("Large 大號"))
            .when((t == "MEDIUM") & (sz > 40), F.lit("123 456")).otherwise(t))
    title = site_a_title()
    new = _money(F.col("p_retailprice").cast("decimal(18,2)") - sz)
    old = _money(F.col("p_retailprice"))
    bulk = _money(F.col("p_retailprice").cast("decimal(18,2)") - sz * 2)
    discounts = F.concat(
        _when(sz > 10, F.concat(F.lit('<div class="discount">'), _s(F.char_length("p_name")),
                                F.lit(" or more HKD"), bulk, F.lit("</div>"))),
        _when(sz > 30, '<div class="discount">  </div>'),
        _when((t == "SMALL") & (sz > 47), '<div class="discount">6 or more</div>'))
    product = F.concat(
        F.lit('<html><head><title>'), title, F.lit('</title></head><body>'),
        F.lit('<div class="breadcrumb"><a href="/"><span itemprop="title">Home</span></a> &gt; '
              '<a href="/c"><span itemprop="title">'), cate, F.lit('</span></a></div>'),
        F.lit('<div id="content"><div class="product-info split-60-40">'),
        F.lit('<div class="left"><div class="image"><a href="http://img.example/p/'), _s("p_partkey"),
        F.lit(' 1.jpg" title="'), title, F.lit('"><img src="t.jpg"></a></div></div>'),
        F.lit('<div class="right"><div class="product-options">'),
        F.when(t == "LARGE", F.lit('<div class="description">no brand</div>')).otherwise(
            F.concat(F.lit('<div class="description"><a href="/brand">'), F.col("p_brand"),
                     F.lit(' </a></div>'))),
        F.lit('<div class="price"><span class="price-new">HKD'), new, F.lit('</span>'),
        _when(~((t == "STANDARD") & sz.between(45, 49)),
              F.concat(F.lit('<span class="price-old">HKD'), old, F.lit('</span>'))),
        F.lit('</div>'), discounts, F.lit('</div></div></div>'),
        F.when(t == "PROMO", F.lit('<div id="tab-description"><p>text only</p></div>')).otherwise(
            F.concat(F.lit('<div id="tab-description"><p><img src="http://img.example/d/'), _s("p_partkey"),
                     F.lit('.jpg"></p></div>'))),
        F.lit('</div></body></html>'))
    error = F.lit('<html><body><div id="content"><h1>Product not found!</h1></div></body></html>')
    html = F.when((t == "ECONOMY") & (sz <= 3), error).otherwise(product)
    return deal_rows(part).select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html"),
                       F.timestamp_micros(F.lit(PAGE_EPOCH_US) + F.col("p_partkey") * F.lit(1000000)).alias("fetched_at"),
                       F.lit("A").alias("site"), F.lit("product").alias("page_type"))


def site_b_pages(part: DataFrame) -> DataFrame:
    t, sz = F.col("p_type"), F.col("p_size")
    pid = F.when(t == "LARGE", F.concat(F.lit("L"), _s(sz))).otherwise(_s("p_partkey"))
    url = F.concat(F.lit(HOST_B + "/product/detail?itemno="), pid)
    brand = _when(t != "MEDIUM", F.concat(F.lit('<a href="/brand/list?brandId=7">'), F.col("p_brand"), F.lit('</a>')))
    last_cate = (F.when((t == "ECONOMY") & (sz < 4), F.concat(F.lit('<a href="/cate/list?x=1">'), t, F.lit('</a>')))
                 .when((t == "SMALL") & (sz > 45), F.concat(F.lit('<a href="/cate/list?categoryId='), _s(sz),
                                                           F.lit('"></a>')))
                 .otherwise(F.concat(F.lit('<a href="/cate/list?categoryId='), _s(sz), F.lit('">'), t, F.lit('</a>'))))
    spans = F.when(t == "STANDARD", F.concat(F.lit("<span>New</span><span>"), F.col("p_name"), F.lit("</span>"))) \
        .otherwise(F.concat(F.lit("<span>"), F.col("p_name"), F.lit("</span>")))
    lines = F.concat(
        F.lit("<div>specification: "), _s(sz), F.lit("ml </div>"),
        _when(t.isin("PROMO", "SMALL"), F.concat(F.lit("<div>RRP: HKD"), _money(F.col("p_retailprice")), F.lit("</div>"))),
        _when(t == "LARGE", "<div> RRP: 1</div>"),
        _when((t == "MEDIUM") & (sz > 45), "<div>RRP: n/a</div>"),
        F.lit("<div>colour: "), F.substring_index("p_name", " ", 1), F.lit("</div>"))
    now = _money(F.col("p_retailprice").cast("decimal(18,2)") - sz)
    html = F.concat(
        F.lit('<html><body><div class="margin"><div class="location"><a href="/">Home</a>'), brand,
        F.lit('<a href="/cate/list?categoryId=1">All</a>'), last_cate, F.lit('</div>'),
        F.lit('<div class="detail-info mt-10"><div class="left">'),
        F.when(t == "PROMO", F.lit("<div>no image</div>")).otherwise(
            F.concat(F.lit('<div><img src="/img/'), _s("p_partkey"), F.lit('.jpg"></div>'))),
        F.lit('</div><div class="right"><div class="title"><a href="#">'), spans, F.lit('</a></div>'),
        F.lit('<div class="content">'), lines, F.lit('<div>Price: <big>HKD'), now, F.lit('</big></div></div>'),
        F.lit('</div></div></div>'),
        F.lit('<div id="Detail"><div class="right"><div class="detail-item" id="chapter-2"><div class="content">'),
        F.lit('<p>'), F.col("p_name"), F.lit('</p><p>'), t, F.lit('</p></div></div></div></div></body></html>'))
    return deal_rows(part).select(F.col("p_partkey").alias("page_id"), url.alias("url"), html.alias("html"),
                       F.timestamp_micros(F.lit(PAGE_EPOCH_US) + F.col("p_partkey") * F.lit(1000000)).alias("fetched_at"),
                       F.lit("B").alias("site"), F.lit("product").alias("page_type"))


# ---- stored pages of a whole walk -------------------------------------------
PAGE_SPAN = 200  # product keys a listing page spans, so a page holds at most so many


def _pages(df: DataFrame, kind: int, url: Column, html: Column) -> DataFrame:
    """Pages with ids of their own per kind."""
    return df.select(F.pmod(F.xxhash64(url, F.lit(kind)), F.lit(1 << 62)).alias("page_id"), url.alias("url"), html.alias("html"))


def _joined(items: str, sep: str = "") -> Column:
    return F.array_join(F.array_sort(F.collect_list(items)), sep)


def walk_pages_a(part: DataFrame) -> DataFrame:
    """Layout A: home, one category per size with a last-page link, listing
    pages of the category's products by key range, and the product pages."""
    cat = F.concat(F.lit(HOST_A + "/index.php?route=product/category&path="), _s("p_size"))
    product = F.concat(F.lit(HOST_A + "/index.php?route=product/product&product_id="), _s("p_partkey"))
    rows = part.select("p_partkey", "p_size", cat.alias("cat"), product.alias("product"),
                       (F.floor(F.col("p_partkey") / PAGE_SPAN) + 1).cast("bigint").alias("no"))
    cats = rows.groupBy("cat").agg(F.max("no").alias("last"))
    # one row a category, of which there are as many as sizes
    home = cats.select(F.concat(F.lit('<li><a href="'), "cat", F.lit('">c</a></li>')).alias("li")).agg(_joined("li").alias("lis"))
    home = _pages(home, 0, F.lit(HOST_A + "/"), F.concat(
        F.lit('<html><body><div class="box-category"><ul><li><a href="/">All</a></li>'), "lis", F.lit("</ul></div></body></html>")))
    pager = _pages(cats, 1, F.col("cat"), F.concat(
        F.lit('<html><body><div class="pagination"><div><a href="'), "cat", F.lit('&page=2">2</a><a href="'), "cat", F.lit("&page="),
        _s("last"), F.lit('">&gt;|</a></div></div></body></html>')))
    item = F.concat(F.lit('<div class="product-list-item"><div><a href="'), "product", F.lit('">p</a></div></div>'))
    lists = rows.select("cat", "no", item.alias("item")).groupBy("cat", "no").agg(_joined("item").alias("items"))
    listing = _pages(lists, 2, F.concat("cat", F.lit("&page="), _s("no")), F.concat(F.lit("<html><body>"), "items", F.lit("</body></html>")))
    return home.unionByName(pager).unionByName(listing).unionByName(_pages(rows, 3, F.col("product"), F.lit("<html></html>")))


def walk_pages_b(part: DataFrame) -> DataFrame:
    """Layout B: home, a category per type, its sub-categories per size, the
    sub-category's further pages, listing pages and product pages; relative
    links, one pager link without text, and product links that come second."""
    host = HOST_B.replace("https://", "http://")
    cat = F.concat(F.lit("/cate/list?c="), F.lower("p_type"))
    sub_ = F.concat(F.lit("/cate/list?s="), F.lower("p_type"), F.lit("-"), _s("p_size"))
    product = F.concat(F.lit("/product/detail?itemno="), _s("p_partkey"))
    rows = part.select("p_partkey", cat.alias("cat"), sub_.alias("sub"), product.alias("product"),
                       (F.floor(F.col("p_partkey") / PAGE_SPAN) + 1).cast("bigint").alias("no"))
    cats = rows.select("cat").distinct()
    home = _pages(cats.select(F.concat(F.lit('<div class="category_expand_item"><a href="'), "cat", F.lit('">c</a></div>')).alias("x"))
                  .agg(_joined("x").alias("xs")), 0, F.lit(host + "/"), F.concat(F.lit("<html><body>"), "xs", F.lit("</body></html>")))
    subs = rows.select("cat", F.concat(F.lit('<dl><dt><a href="'), "sub", F.lit('">s</a></dt></dl>')).alias("x")).distinct() \
        .groupBy("cat").agg(_joined("x").alias("xs"))
    category = _pages(subs, 1, F.concat(F.lit(host), "cat"), F.concat(
        F.lit('<html><body><div class="box_catalog"><div class="content">'), "xs", F.lit("</div></div></body></html>")))
    pages = rows.select("sub", "no").distinct()
    more = pages.where("no > 1").select("sub", F.concat(F.lit('<a href="'), "sub", F.lit("&page="), _s("no"), F.lit('">n</a>')).alias("x")) \
        .groupBy("sub").agg(_joined("x").alias("xs"))
    pager = rows.select("sub").distinct().join(more, "sub", "left")
    pager = _pages(pager, 2, F.concat(F.lit(HOST_B), "sub"), F.concat(
        F.lit('<html><body><div class="pages">'), F.coalesce("xs", F.lit("")), F.lit('<a href="/none"></a></div></body></html>')))
    item = F.concat(F.lit('<li><a href="/img">i</a><a href="'), "product", F.lit('">p</a></li>'))
    lists = rows.select("sub", "no", item.alias("item")).groupBy("sub", "no").agg(_joined("item").alias("items"))
    listing = _pages(lists, 3, F.concat(F.lit(HOST_B), "sub", F.lit("&page="), _s("no")), F.concat(
        F.lit('<html><body><div class="box_list"><ul>'), "items", F.lit("</ul></div></body></html>")))
    return home.unionByName(category).unionByName(pager).unionByName(listing) \
        .unionByName(_pages(rows, 4, F.concat(F.lit(HOST_B), "product"), F.lit("<html></html>")))
