"""Both site adapters on hand-written pages, including every way to lose a record."""

from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.plans.catalogue import build_catalogue
from pricelens.plans.sites import LayoutA, LayoutB
from tests.fixtures import LINK_HOST_B


def _by_id(rows):
    return {r["request_url"].split("=")[-1]: r for r in rows}


def test_layout_a_records(pages_a):
    tagged = build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A").cache()
    rows = _by_id(tagged.collect())
    r1 = rows["1"]
    assert r1["product_id"] == "SHOPA/1"
    assert r1["product_name"] == "可口 汽水" and r1["product_spec"] == "500ml x 20"
    assert r1["brand_name"] == "可口 "
    assert r1["product_category"][0].asDict() == {"name": "飲品", "code": ""}
    assert r1["product_image"] == "http://img/p 1.jpg" and r1["product_desc"] == "http://img/desc.jpg"
    assert [tuple(p) for p in r1["price"]] == [(1, "normal", 128.0), (1, "original", 135.0),
                                                (6, "normal", 120.0), (12, "normal", 110.0)]
    assert r1["reject_reason"] is None
    r2 = rows["2"]  # no brand, no desc image, spec glued to the name, Latin category
    assert (r2["brand_name"], r2["product_desc"], r2["product_spec"], r2["product_name"]) == ("", None, "330mlx24", "Cola")
    assert r2["product_category"][0]["name"] == "NEW"
    assert rows["3"]["reject_reason"] == "extract_error:error_page"
    assert rows["4"]["reject_reason"] == "extract_error:price"       # malformed discount
    assert rows["5"]["reject_reason"] == "extract_error:product_category"  # digits only
    assert rows["6"]["reject_reason"] == "extract_error:price"       # no old price
    r7 = rows["7"]  # class list in another order; decimal damages the title
    assert (r7["product_name"], r7["product_spec"], r7["reject_reason"]) == ("水 1", "25L x 12", None)
    tagged.unpersist()


def test_layout_b_records(pages_b):
    tagged = build_catalogue(pages_b, LayoutB(source="SHOPB", link_host=LINK_HOST_B), site="B")
    rows = _by_id(tagged.collect())
    r = rows["101"]
    assert r["product_id"] == "SHOPB/101" and r["brand_name"] == "BrandX"
    assert r["product_category"][0].asDict() == {"name": "Face Cream", "code": "12"}
    assert r["product_spec"] == "50ml" and r["product_desc"] == "Line one Line two"
    assert [tuple(p) for p in r["price"]] == [(1, "original", 120.0), (1, "discount", 99.5)]
    assert r["product_image"] == "/img/b1.jpg"
    r2 = rows["102"]  # no brand; ' RRP' key is not 'RRP'; full-width colon ignored
    assert r2["brand_name"] is None
    assert [tuple(p) for p in r2["price"]] == [(1, "normal", 45.0)]
    assert r2["product_spec"] == "30ml"
    r3 = rows["103"]  # last cate link has no text: name and code come from different links
    assert r3["product_category"][0].asDict() == {"name": "Skin", "code": "12"}


def test_rejects_and_counts(pages_a):
    tagged = build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A").cache()
    clean, rej = Q.clean(tagged), Q.rejects(tagged)
    assert clean.count() + rej.count() == tagged.count() == 7
    reasons = sorted(r["reason"] for r in rej.collect())
    assert reasons == ["extract_error:error_page", "extract_error:price", "extract_error:price",
                       "extract_error:product_category"]
    tagged.unpersist()


def test_dedup_first_seen_and_missing_never_claims(spark):
    rows = [("X/1", "", "u1", 1), ("X/1", "a", "u2", 2), ("X/1", "b", "u3", 3),
            (None, "n", "u4", 4), ("X/2", " ", "u5", 5), ("X/2", "c", "u6", 6)]
    df = spark.createDataFrame(rows, "product_id string, product_name string, request_url string, page_id long") \
        .withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn("_source", F.lit("X"))
    t = Q.tag_quality(df)
    got = {r["request_url"]: r["reject_reason"] for r in t.collect()}
    assert got == {"u1": Q.MISSING, "u2": None, "u3": Q.DUPLICATE, "u4": Q.MISSING,
                   "u5": None, "u6": Q.DUPLICATE}
    # idempotent: dedup of the clean output changes nothing
    again = Q.tag_quality(Q.clean(t))
    assert again.filter(F.col("reject_reason").isNotNull()).count() == 0


def test_catalogue_profile(pages_a):
    tagged = build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A")
    p = Q.catalogue_profile(Q.clean(tagged)).first()
    assert p.n_rows == 3 and p.duplicate_ids == 0
    assert {r.ladder_len: r.n for r in Q.ladder_histogram(Q.clean(tagged)).collect()} == {4: 1, 2: 2}
    assert abs(p.product_desc__null_rate - 1 / 3) < 1e-12


def test_split_quality_equals_tagging(pages_a, pages_b):
    from pricelens.plans.catalogue import build_catalogue_split
    for pages, ad, site in [(pages_a, LayoutA(source="SHOPA"), "A"),
                            (pages_b, LayoutB(source="SHOPB", link_host=LINK_HOST_B), "B")]:
        tagged = build_catalogue(pages, ad, site=site)
        good, bad = build_catalogue_split(pages, ad, site=site)
        assert sorted(good.collect()) == sorted(Q.clean(tagged).select(*good.columns).collect())
        assert sorted(bad.collect()) == sorted(Q.rejects(tagged).collect())


def test_lost_record_matrix(spark):
    """Every 'record lost' cell of the mandatory-field matrix gives a reject
    with the field name; optional fields fall back to '' / null."""
    from pricelens.schema import PAGE_SCHEMA
    from tests.fixtures import T0, a_product, b_product
    a_cases = {
        "one_crumb": a_product(crumbs=["Home"]),
        "no_image_link": a_product(image=None),
        "no_title": a_product(title=None),
        "no_new_price": a_product(new=None),
        "bad_old_price": a_product(old="HKD."),
        "no_id": None,
    }
    rows = []
    for i, (k, html) in enumerate(a_cases.items()):
        url = f"http://a/p?route=x&product_id={i}&case={k}" if html else "http://a/p?case=no_id"
        rows.append((i, url, html or a_product(), T0, "A", "product"))
    got = {r.item_url.split("case=")[1]: r.reason for r in
           Q.rejects(build_catalogue(spark.createDataFrame(rows, PAGE_SCHEMA), LayoutA(), site="A")).collect()}
    assert got == {"one_crumb": "extract_error:product_category", "no_image_link": "extract_error:product_image",
                   "no_title": "extract_error:product_name", "no_new_price": "extract_error:price",
                   "bad_old_price": "extract_error:price", "no_id": "extract_error:product_id"}
    b_cases = {
        "no_cate": b_product(cate_links=()),
        "no_code": b_product(cate_links=(("Skin", ""),)),
        "no_name": b_product(name_spans=()),
        "no_big": b_product(price_big=None),
        "rrp_no_number": b_product(lines=("RRP: n/a",)),
        "optional_missing": b_product(brand=None, image=None, lines=(), desc=()),
    }
    rows = [(i, f"http://b/detail?itemno={i}&case={k}", html, T0, "B", "product")
            for i, (k, html) in enumerate(b_cases.items())]
    tagged = build_catalogue(spark.createDataFrame(rows, PAGE_SCHEMA), LayoutB(link_host="http://b"), site="B")
    got = {r.request_url.split("case=")[1]: r for r in tagged.collect()}
    assert {k: v.reject_reason for k, v in got.items()} == {
        "no_cate": "extract_error:product_category", "no_code": "extract_error:product_category",
        "no_name": "extract_error:product_name", "no_big": "extract_error:price",
        "rrp_no_number": "extract_error:price", "optional_missing": None}
    ok = got["optional_missing"]
    assert (ok.brand_name, ok.product_image, ok.product_spec, ok.product_desc) == (None, None, "", "")


def test_record_chain_steps(pages_a):
    """Extension surface: steps run in order, each may add columns or drop rows."""
    steps = [lambda df: df.withColumn("brand_name", F.upper("brand_name")),
             lambda df: df.filter(F.col("product_spec") != "330mlx24")]
    tagged = build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A", steps=steps)
    good = Q.clean(tagged).collect()
    assert len(good) == 2 and all(r.brand_name == r.brand_name.upper() for r in good)


def test_registry_builds_all_sites(pages_a, pages_b):
    from pricelens.plans.catalogue import build_all
    from pricelens.plans.sites import Registry
    reg = Registry().register(LayoutA(source="SHOPA")).register(LayoutB(source="SHOPB", link_host=LINK_HOST_B))
    good, bad = build_all(pages_a.unionByName(pages_b), reg, sites={"SHOPA": "A", "SHOPB": "B"})
    counts = {r._source: r.n for r in good.groupBy("_source").agg(F.count("*").alias("n")).collect()}
    assert counts == {"SHOPA": 3, "SHOPB": 3}
    assert bad.count() == 4


def test_dedup_scope_is_one_run(spark):
    """R-80: the seen-set lives for one run; the same id in two runs is kept once per run."""
    rows = [("r1", "X/1", "a", "u1", 1), ("r1", "X/1", "b", "u2", 2), ("r2", "X/1", "c", "u3", 3)]
    df = spark.createDataFrame(rows, "run_id string, product_id string, product_name string, "
                                     "request_url string, page_id long") \
        .withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn("_source", F.lit("X"))
    good, bad = Q.split_quality(df, run_cols=["run_id"])
    assert sorted(r.request_url for r in good.collect()) == ["u1", "u3"]
    assert [(r.item_url, r.reason) for r in bad.collect()] == [("u2", Q.DUPLICATE)]


def test_record_stamp_is_fetch_time_or_run_stamp(pages_a):
    """R-12: records carry their page's fetch time, or one given run stamp."""
    from datetime import datetime
    good, _ = Q.split_quality(build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A")
                              .filter(F.col("reject_reason").isNull()).drop("reject_reason"))
    fetched = {r.page_id: r.fetched_at for r in pages_a.collect()}
    assert all(r._created_date == fetched[r.page_id] for r in good.collect())
    run = datetime(2024, 5, 1, 12, 0, 0)
    stamped = build_catalogue(pages_a, LayoutA(source="SHOPA"), site="A", run_ts=run)
    assert {r._created_date for r in Q.clean(stamped).collect()} == {run}


def test_pages_are_rendered_in_tasks_of_bounded_rows(spark, tmp_path):
    """Millions of part rows lie in one file split; each brings a page to shred."""
    from pricelens.plans import derived_sites as D
    part = spark.range(7000).select(
        F.col("id").alias("p_partkey"), F.lit("old ring").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("SMALL").alias("p_type"), F.lit(7).alias("p_size"), F.lit(900.0).alias("p_retailprice"))
    part.coalesce(1).write.parquet(str(tmp_path / "part"))
    part = spark.read.parquet(str(tmp_path / "part"))
    for pages in (D.site_a_pages(part), D.site_b_pages(part)):
        sizes = [r["count"] for r in pages.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 7000 and len(sizes) == 3 and max(sizes) <= 2500
