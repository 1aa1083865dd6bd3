"""Site adapters: shredded product pages -> product records.

Two page layouts are supported, one adapter each.  Every adapter maps a frame
``(page_id, url, fetched_at, nodes)`` to the product fields plus
``extract_error`` (the first field that could not be extracted, null when the
record is whole).  A page the reference would lose to an exception keeps its
row here, with the reason, so nothing vanishes silently.

All extraction is native Column work over the ``nodes`` array: one narrow
stage, no shuffle, no Python per row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.functions import select as S
from pricelens.functions import text as X
from pricelens.operators.links import count_to
from pricelens.schema import (HOME, LISTING, PAGINATION, PRODUCT, SUBCATEGORY)

# ---------------------------------------------------------------------------
# These must equal the reference's, or the same pages give
# different records.  Listed in page order, layout A then layout B.
# ---------------------------------------------------------------------------
# price rung status words
NORMAL, ORIGINAL, DISCOUNT = "normal", "original", "discount"

# layout A
A_ID_PARAM = "product_id"
A_ERROR_PAGE = "#content > h1"
A_CRUMB_TAG, A_CRUMB_ATTR, A_CRUMB_VALUE = "span", "itemprop", "title"
A_IMAGE_LINK = ".product-info.split-60-40 .left .image > a"
A_BRAND = ".right .product-options .description > a"
A_PRICE_SPAN = ".right .product-options .price > span"
A_PRICE_NEW, A_PRICE_OLD = "price-new", "price-old"
A_DISCOUNT = ".discount"
A_DESC_IMAGE = "#tab-description > p > img"
A_CATEGORY_LINKS = "div.box-category > ul > li > a"
A_PAGER_LINKS, A_LAST_PAGE_TEXT, A_PAGE_PARAM = "div.pagination > div > a", ">|", "page"
A_LIST_LINKS = ".product-list-item > div > a"

# layout B
B_ID_PARAM, B_CATEGORY_PARAM = "itemno", "categoryId"
B_BANNER_LINKS = "div.margin div.location > a"
B_BRAND_HREF, B_CATEGORY_HREF = "brand", "cate"
B_DETAIL = "div.margin div.detail-info.mt-10"
B_IMAGE = B_DETAIL + " div.left > div > img"
B_NAME = B_DETAIL + " div.right div.title > a > span"
B_ATTR_LINES = B_DETAIL + " div.right div.content > div"
B_PRICE = B_DETAIL + " div.right div.content > div > big"
B_DESC = "div#Detail div.right div.detail-item#chapter-2 div.content > p"
B_SPEC_KEY, B_RRP_KEY = "specification", "RRP"
B_CATEGORY_LINKS = "div.category_expand_item > a"
B_SUBCATEGORY_LINKS = "div.box_catalog div.content > dl > dt > a"
B_PAGER_LINKS = "div.pages > a"
B_LIST_LINKS, B_LIST_LINK_POS = "div.box_list > ul > li > a", 2
# ---------------------------------------------------------------------------


def _first_error(checks: list[tuple[str, Column]]) -> Column:
    """Name of the first failing check (checks are (field, ok) in order)."""
    out = F.lit(None).cast("string")
    for name, ok in reversed(checks):
        out = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def _rung(unit, status: str, price) -> Column:
    return F.struct(F.lit(unit).cast("bigint").alias("unit") if not isinstance(unit, Column)
                    else unit.cast("bigint").alias("unit"),
                    F.lit(status).alias("CU_status"),
                    price.cast("double").alias("price"))


@dataclass
class LayoutA:
    """Category box -> pagination -> product list -> product page.

    Product page: breadcrumb ``span[itemprop=title]``, image box with the
    titled link, options pane with brand, new/old price spans, bulk-discount
    texts, description image.
    """
    source: str = "SITE_A"
    error_page_selector: str = A_ERROR_PAGE
    categories: list | None = None  # optional category URL filter (hook)
    id_param: str = A_ID_PARAM
    steps: tuple = (HOME, PAGINATION, LISTING, PRODUCT)
    walk_depth: int = 3

    # ---- product pages -------------------------------------------------
    def extract(self, pages: DataFrame) -> DataFrame:
        n = F.col("nodes")
        # 1) every selector runs once over the nodes
        sel = pages.select(
            "page_id", "url", "fetched_at", n.isNotNull().alias("_parsed"),
            S.texts_of(S.select(n, self.error_page_selector)).alias("_h1"),
            S.texts_of(F.filter(n, lambda x: (x["tag"] == A_CRUMB_TAG)
                                & S.attr_equals(A_CRUMB_ATTR, A_CRUMB_VALUE)(x)))
            .alias("_crumbs"),
            S.select(n, A_IMAGE_LINK).alias("_image_a"),
            S.texts_of(S.select(n, A_BRAND)).alias("_brand"),
            S.select(n, A_PRICE_SPAN).alias("_prices"),
            S.texts_of(S.select(n, A_DISCOUNT)).alias("_discounts"),
            S.attrs_of(S.select(n, A_DESC_IMAGE), "src").alias("_desc"))
        # 2) fields from the selections
        old_text = S.first(S.texts_of(F.filter("_prices", S.attr_equals("class", A_PRICE_OLD))))
        new_text = S.first(S.texts_of(F.filter("_prices", S.attr_equals("class", A_PRICE_NEW))))
        discounts = F.filter(F.transform("_discounts", X.strip), lambda d: d != "")
        out = sel.select(
            "page_id", "url", "fetched_at", "_parsed",
            (F.size("_h1") > 0).alias("_error_page"),
            X.query_param("url", self.id_param).alias("_raw_id"),
            F.size("_crumbs").alias("_n_crumbs"), X.cjk_else_latin(S.nth(F.col("_crumbs"), 1)).alias("_cate"),
            S.first(S.attrs_of(F.col("_image_a"), "href")).alias("product_image"),
            S.first(S.attrs_of(F.col("_image_a"), "title")).alias("_title"),
            F.coalesce(S.first(F.col("_brand")), F.lit("")).alias("brand_name"),
            X.first_number(old_text).alias("_old"), X.first_number(new_text).alias("_new"),
            F.transform(discounts, lambda d: _rung(X.first_int(d), NORMAL,
                                                   X.tagged_price(d))).alias("_bulk"),
            S.first(F.col("_desc")).alias("product_desc"))
        bulk_ok = ~F.exists("_bulk", lambda r: r["unit"].isNull() | r["price"].isNull())
        err = _first_error([
            ("html", F.col("_parsed")),
            ("product_id", F.col("_raw_id").isNotNull()),
            ("product_category", (F.col("_n_crumbs") >= 2) & F.col("_cate").isNotNull()),
            ("product_image", F.col("product_image").isNotNull()),
            ("product_name", F.col("_title").isNotNull()),
            ("price", F.col("_old").isNotNull() & F.col("_new").isNotNull() & bulk_ok),
        ])
        return out.select(
            "page_id", "fetched_at",
            X.namespaced(self.source, F.col("_raw_id")).alias("product_id"),
            X.name_before_spec(F.col("_title")).alias("product_name"),
            "brand_name", "product_desc", "product_image",
            F.col("url").alias("request_url"),
            F.array(F.struct(F.col("_cate").alias("name"), F.lit("").alias("code"))).alias("product_category"),
            X.pack_spec(F.col("_title")).alias("product_spec"),
            F.concat(F.array(_rung(1, NORMAL, F.col("_new")), _rung(1, ORIGINAL, F.col("_old"))),
                     F.col("_bulk")).alias("price"),
            F.lit(self.source).alias("_source"),
            F.when(F.col("_error_page"), F.lit("error_page")).otherwise(err).alias("extract_error"))

    # ---- walk pages -> links ------------------------------------------
    def links(self, pages: DataFrame) -> DataFrame:
        """Links each non-product page leads to, typed by the next step."""
        n = F.col("nodes")
        home = S.tail(S.attrs_of(S.select(n, A_CATEGORY_LINKS), "href"), 1)
        if self.categories is not None:
            home = F.filter(home, lambda u: u.isin(list(self.categories)))
        last_page = S.first(S.attrs_of(S.select(n, A_PAGER_LINKS,
                                                S.first_text_contains(A_LAST_PAGE_TEXT)), "href"))
        n_pages = F.greatest(F.coalesce(X.query_param(last_page, A_PAGE_PARAM).try_cast("bigint"), F.lit(1)),
                             F.lit(1))
        listing = S.attrs_of(S.select(n, A_LIST_LINKS), "href")
        pt = F.col("page_type")
        urls = (F.when(pt == HOME, home).when(pt == PAGINATION, F.array("cate_url"))
                .when(pt == LISTING, listing).otherwise(F.array().cast("array<string>")))
        next_type = (F.when(pt == HOME, F.lit(PAGINATION)).when(pt == PAGINATION, F.lit(LISTING))
                     .otherwise(F.lit(PRODUCT)))
        exploded = pages.select("page_id", "page_type", "cate_url", "subcate_url", F.posexplode(urls).alias("ord", "url"),
                                F.when(pt == PAGINATION, n_pages).otherwise(F.lit(1)).cast("bigint").alias("_n"))
        # a category's listing pages are counted up as rows: a page count read
        # from a link may be any number
        exploded = count_to(exploded, "_n", "_page").select(
            "page_id", "page_type", "cate_url", "subcate_url", (F.col("ord") + F.col("_page") - 1).alias("ord"),
            F.when(pt == PAGINATION, F.concat("url", F.lit(f"&{A_PAGE_PARAM}="), F.col("_page").cast("string"))).otherwise(F.col("url")).alias("url"))
        return exploded.select(
            F.col("page_id").alias("src_page_id"), F.col("ord").cast("bigint").alias("ord"), "url",
            next_type.alias("page_type"),
            F.when(pt == HOME, F.col("url")).otherwise(F.col("cate_url")).alias("cate_url"),
            F.col("subcate_url"))


@dataclass
class LayoutB:
    """Expanded category menu -> subcategory catalog -> pages -> list ->
    product page with a location banner, detail pane, attribute lines and a
    description chapter.  Relative links are prefixed with ``link_host``."""
    source: str = "SITE_B"
    link_host: str = "https://www.example.com"
    categories: list | None = None
    id_param: str = B_ID_PARAM
    category_param: str = B_CATEGORY_PARAM
    check_error_page: bool = False  # the reference disables it on this layout
    steps: tuple = (HOME, SUBCATEGORY, PAGINATION, LISTING, PRODUCT)
    walk_depth: int = 4

    def extract(self, pages: DataFrame) -> DataFrame:
        n = F.col("nodes")
        # 1) every selector runs once over the nodes
        sel = pages.select(
            "page_id", "url", "fetched_at", n.isNotNull().alias("_parsed"),
            S.select(n, B_BANNER_LINKS).alias("_banner"),
            S.attrs_of(S.select(n, B_IMAGE), "src").alias("_images"),
            S.texts_of(S.select(n, B_NAME)).alias("_names"),
            S.texts_of(S.select(n, B_ATTR_LINES)).alias("_lines"),
            S.texts_of(S.select(n, B_PRICE)).alias("_big"),
            S.texts_of(S.select(n, B_DESC)).alias("_desc"),
            S.texts_of(S.select(n, A_ERROR_PAGE)).alias("_h1"))
        # 2) fields from the selections
        cate_links = F.filter("_banner", S.attr_contains("href", B_CATEGORY_HREF))
        mid = sel.select(
            "page_id", "url", "fetched_at", "_parsed",
            ((F.size("_h1") > 0) & F.lit(self.check_error_page)).alias("_error_page"),
            X.query_param("url", self.id_param).alias("_raw_id"),
            S.first(S.texts_of(F.filter("_banner", S.attr_contains("href", B_BRAND_HREF)))).alias("brand_name"),
            cate_links.alias("_cate_links"),
            S.first(F.col("_images")).alias("product_image"), S.last(F.col("_names")).alias("product_name"),
            X.kv_map(F.col("_lines")).alias("_attrs"), X.first_number(S.first(F.col("_big"))).alias("_now"),
            F.array_join("_desc", " ").alias("product_desc"))
        out = mid.select(
            "*", S.last(S.texts_of(F.col("_cate_links"))).alias("_cate"),
            X.query_param(S.last(S.attrs_of(F.col("_cate_links"), "href")), self.category_param).alias("_code"))
        has_rrp = F.map_contains_key("_attrs", F.lit(B_RRP_KEY))
        rrp = X.first_number(F.col("_attrs").getItem(B_RRP_KEY))
        err = _first_error([
            ("html", F.col("_parsed")),
            ("product_id", F.col("_raw_id").isNotNull()),
            ("product_category", F.col("_cate").isNotNull() & F.col("_code").isNotNull()),
            ("product_name", F.col("product_name").isNotNull()),
            ("price", F.col("_now").isNotNull() & (~has_rrp | rrp.isNotNull())),
        ])
        price = (F.when(has_rrp, F.array(_rung(1, ORIGINAL, rrp), _rung(1, DISCOUNT, F.col("_now"))))
                 .otherwise(F.array(_rung(1, NORMAL, F.col("_now")))))
        return out.select(
            "page_id", "fetched_at",
            X.namespaced(self.source, F.col("_raw_id")).alias("product_id"),
            "product_name", "brand_name", "product_desc", "product_image",
            F.col("url").alias("request_url"),
            F.array(F.struct(F.col("_cate").alias("name"), F.col("_code").alias("code"))).alias("product_category"),
            X.map_get_or("_attrs", B_SPEC_KEY).alias("product_spec"),
            price.alias("price"),
            F.lit(self.source).alias("_source"),
            F.when(F.col("_error_page"), F.lit("error_page")).otherwise(err).alias("extract_error"))

    def links(self, pages: DataFrame) -> DataFrame:
        n = F.col("nodes")
        host = F.lit(self.link_host)
        home = F.transform(S.attrs_of(S.select(n, B_CATEGORY_LINKS), "href"),
                           lambda h: F.concat(F.lit("http://"), X.url_host(F.col("url")), h))
        if self.categories is not None:
            home = F.filter(home, lambda u: u.isin(list(self.categories)))
        subcats = F.transform(S.attrs_of(S.select(n, B_SUBCATEGORY_LINKS), "href"),
                              lambda h: F.concat(host, h))
        pager = F.transform(S.attrs_of(S.select(n, B_PAGER_LINKS, S.first_text_nonempty()), "href"),
                            lambda h: F.concat(host, h))
        paged = F.concat(F.array(F.concat(F.col("subcate_url"), F.lit(f"&{A_PAGE_PARAM}=1"))), pager)
        listing = F.transform(S.attrs_of(S.select(n, B_LIST_LINKS, S.nth_of_type(B_LIST_LINK_POS)), "href"),
                              lambda h: F.concat(host, h))
        pt = F.col("page_type")
        urls = (F.when(pt == HOME, home).when(pt == SUBCATEGORY, subcats)
                .when(pt == PAGINATION, paged).when(pt == LISTING, listing)
                .otherwise(F.array().cast("array<string>")))
        next_type = (F.when(pt == HOME, F.lit(SUBCATEGORY)).when(pt == SUBCATEGORY, F.lit(PAGINATION))
                     .when(pt == PAGINATION, F.lit(LISTING)).otherwise(F.lit(PRODUCT)))
        exploded = pages.select("page_id", "page_type", "cate_url", "subcate_url",
                                F.posexplode(urls).alias("ord", "url"))
        return exploded.select(
            F.col("page_id").alias("src_page_id"), F.col("ord").cast("bigint").alias("ord"), "url",
            next_type.alias("page_type"),
            F.when(pt == HOME, F.col("url")).otherwise(F.col("cate_url")).alias("cate_url"),
            F.when(pt == SUBCATEGORY, F.col("url")).otherwise(F.col("subcate_url")).alias("subcate_url"))


@dataclass
class Registry:
    """Source name -> adapter; every adapter returns the same contract."""
    adapters: dict = field(default_factory=dict)

    def register(self, adapter) -> "Registry":
        self.adapters[adapter.source] = adapter
        return self

    def get(self, source: str):
        return self.adapters[source]
