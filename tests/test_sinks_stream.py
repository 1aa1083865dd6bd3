"""Contract round trip, partitioned layout, idempotent append, streaming = batch."""

import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from pricelens.operators import quality as Q
from pricelens.plans.catalogue import build_catalogue, build_catalogue_split, publish
from pricelens.plans.sites import LayoutA
from pricelens.schema import PAGE_SCHEMA, PRODUCT_COLS, PRODUCT_SCHEMA
from pricelens.session import scratch_dir
from pricelens.sinks import publish as P
from pricelens.sources.pages import read_catalogue
from pricelens.streaming.catalogue import read_catalogue_view, stream_catalogue
from tests.fixtures import site_a_pages

LINES = [
    {"product_id": "S/1", "product_name": "水", "brand_name": "牌 ", "product_desc": None,
     "product_image": "http://i/a b.jpg", "request_url": "http://h/?product_id=1",
     "product_category": [{"name": "NEW", "code": ""}], "product_spec": "500ml x 1",
     "price": [{"unit": 1, "CU_status": "normal", "price": 1.5}, {"unit": 1, "CU_status": "original", "price": 2.0}],
     "_source": "S", "_created_date": "2031-02-08 14:05:09.120034"},
    {"product_id": "S/2", "product_name": "茶", "brand_name": "", "product_desc": "http://d",
     "product_image": "x", "request_url": "http://h/?product_id=2",
     "product_category": [{"name": "飲品", "code": ""}], "product_spec": "",
     "price": [{"unit": 1, "CU_status": "normal", "price": 3.0}], "_source": "S",
     "_created_date": "2031-02-09 00:00:00"},
]


def _write_lines(tmp):
    p = os.path.join(tmp, "in.jl")
    with open(p, "w") as f:
        for r in LINES:
            f.write(json.dumps(r) + "\n")
    return p


def test_contract_roundtrip(spark, tmp_path):
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    assert src.schema == PRODUCT_SCHEMA and src.count() == 2
    assert src.filter(F.col("_created_date").isNull()).count() == 0
    out = scratch_dir(spark, "rt")
    P.write_json_lines(src, out)
    text = spark.read.text(out).collect()
    assert all('"product_desc":null' in r.value or '"product_desc":"http://d"' in r.value for r in text)
    back = read_catalogue(spark, out)
    assert sorted(back.collect()) == sorted(src.collect())


def test_partitioned_layout_and_dynamic_overwrite(spark, tmp_path):
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    root = scratch_dir(spark, "parts")
    P.write_partitioned(src, root)
    dirs = sorted(d for d, _, files in os.walk(root.replace("file:", "")) if any(f.endswith(".json") for f in files))
    assert [d.split("_source=")[1] for d in dirs] == ["S/year=2031/month=02/day=08", "S/year=2031/month=02/day=09"]
    # rerun of one day replaces that day only
    P.write_partitioned(src.filter(F.col("product_id") == "S/1"), root)
    back = P.read_partitioned(spark, root)
    assert back.count() == 2
    assert {r.month for r in back.select("month").collect()} == {"02"}  # stays a string


def test_idempotent_append(spark, tmp_path):
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    path = scratch_dir(spark, "tbl")
    for _ in range(3):
        P.append_idempotent(src, path)
    assert spark.read.parquet(path).count() == 2


def test_publish_job(spark, pages_a):
    out = scratch_dir(spark, "publish-job")
    good, bad = build_catalogue_split(pages_a, LayoutA(source="SHOPA"), site="A")
    publish(good, bad, out, table_path=out + "/table")
    clean = read_catalogue(spark, out + "/jsonl")
    assert clean.count() == 3
    assert spark.read.json(out + "/rejects").count() == 4
    assert spark.read.parquet(out + "/table").count() == 3


def test_stream_equals_batch(spark, pages_a):
    base = scratch_dir(spark, "stream-cat")
    landing = base + "/landing"
    # land the pages in three files, in fetch order, plus a late duplicate
    rows = site_a_pages()
    dup = list(rows[7])
    dup[0], dup[3] = 100, datetime(2024, 3, 2)
    rows.append(tuple(dup))
    for i, chunk in enumerate([rows[:5], rows[5:10], rows[10:]]):
        spark.createDataFrame(chunk, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    adapter = LayoutA(source="SHOPA")
    stream_catalogue(spark, landing, adapter, base + "/out", base + "/ckpt", site="A", files_per_trigger=1)
    streamed = read_catalogue_view(spark, base + "/out")
    batch = Q.clean(build_catalogue(spark.read.parquet(landing), adapter, site="A")).select(*PRODUCT_COLS)
    assert sorted(streamed.collect()) == sorted(batch.collect())
    assert streamed.count() == 3
    # a second availableNow run over the same checkpoint emits nothing new
    stream_catalogue(spark, landing, adapter, base + "/out", base + "/ckpt", site="A")
    assert sorted(read_catalogue_view(spark, base + "/out").collect()) == sorted(batch.collect())


def test_cli_catalogue(spark, pages_a, capsys):
    from pricelens.__main__ import main
    src = scratch_dir(spark, "cli-pages")
    pages_a.write.parquet(src)
    out = scratch_dir(spark, "cli-out")
    main(["catalogue", "--pages", src, "--layout", "a", "--source", "SHOPA", "--site", "A", "--out", out])
    assert "'pages': 7" in capsys.readouterr().out
    assert read_catalogue(spark, out + "/jsonl").count() == 3
    assert spark.read.json(out + "/rejects").count() == 4


def test_hot_key_dedup(spark):
    """One id holds a third of the rows: same answer, no row lost."""
    n = 3000
    rows = [("HOT" if i % 3 == 0 else f"K{i}", f"name{i}", f"u{i}", i) for i in range(n)]
    df = spark.createDataFrame(rows, "product_id string, product_name string, request_url string, page_id long") \
        .withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn("_source", F.lit("X"))
    good, bad = Q.split_quality(df.repartition(8))
    assert good.count() == 1 + (n - n // 3)
    assert good.filter("product_id = 'HOT'").first().page_id == 0
    assert bad.count() == n // 3 - 1
    assert good.count() + bad.count() == n


def test_stream_bounded_state(spark):
    from pricelens.streaming.catalogue import stream_catalogue_bounded
    from tests.fixtures import a_product
    base = scratch_dir(spark, "stream-bounded")
    url = "http://a/p?product_id={}"
    # id 1 repeats after 10 s (dropped).  Batch 3 moves the watermark past the
    # bound, batch 4 evicts id 1's state (eviction follows the batch's input),
    # so the repeat 3 days on is kept
    batches = [[(1, url.format(1), a_product(), datetime(2024, 3, 1, 8), "A", "product"),
                (2, url.format(2), a_product(), datetime(2024, 3, 1, 8, 0, 5), "A", "product")],
               [(3, url.format(1), a_product(), datetime(2024, 3, 1, 8, 0, 10), "A", "product")],
               [(5, url.format(5), a_product(), datetime(2024, 3, 3, 8), "A", "product")],
               [(6, url.format(6), a_product(), datetime(2024, 3, 3, 9), "A", "product")],
               [(4, url.format(1), a_product(), datetime(2024, 3, 4, 8), "A", "product")]]
    for chunk in batches:
        spark.createDataFrame(chunk, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(base + "/landing")
    stream_catalogue_bounded(spark, base + "/landing", LayoutA(source="S"), base + "/out", base + "/ckpt",
                             within="1 hour", site="A", files_per_trigger=1)
    got = sorted((r.product_id, r._created_date) for r in spark.read.parquet(base + "/out").collect())
    assert got == [("S/1", datetime(2024, 3, 1, 8)), ("S/1", datetime(2024, 3, 4, 8)),
                   ("S/2", datetime(2024, 3, 1, 8, 0, 5)), ("S/5", datetime(2024, 3, 3, 8)),
                   ("S/6", datetime(2024, 3, 3, 9))]


def test_catalog_table_append_is_idempotent(spark, tmp_path):
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    name = "pricelens_test_catalogue"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    for _ in range(2):
        P.append_table(src, name)
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_failed_load_raises(spark, tmp_path):
    """Unlike a swallowed retry loop, a broken target surfaces as an error."""
    import pytest
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    path = scratch_dir(spark, "broken")
    spark.createDataFrame([(1,)], "product_id int").write.parquet(path)  # incompatible table
    with pytest.raises(Exception):
        P.append_idempotent(src, path)


def test_json_text_roundtrip(spark, tmp_path):
    from pricelens.sources.pages import parse_catalogue_lines
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    lines = P.to_json_lines(src)
    assert all('"product_desc":' in r.value for r in lines.collect())  # nulls kept
    back = parse_catalogue_lines(lines)
    assert sorted(back.collect()) == sorted(src.collect())


def test_read_pages_pushes_filters(spark, pages_a):
    from pricelens.sources.pages import read_pages
    path = scratch_dir(spark, "pages-src")
    pages_a.write.parquet(path)
    df = read_pages(spark, path, sites=["A"], page_types=["product"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "site" in plan.split("PushedFilters")[1][:300]
    assert df.count() == 7


def test_staging_scope_removes_its_tables(spark, pages_a):
    from pricelens.session import Staging
    out = scratch_dir(spark, "staged-run")
    with Staging(spark) as st:
        good, bad = build_catalogue_split(pages_a, LayoutA(source="SHOPA"), site="A", staging=st)
        publish(good, bad, out, staging=st)
        staged = list(st.paths)
    assert len(staged) == 2
    assert all(not os.path.exists(p.replace("file:", "")) for p in staged)
    assert read_catalogue(spark, out + "/jsonl").count() == 3


def test_reads_the_reference_published_layout(spark, tmp_path):
    """Existing output in the reference's key layout (upper-case _SOURCE in
    the path, _source in the body) reads back as one string column."""
    root = tmp_path / "project=price-comparison"
    day = root / "_SOURCE=S" / "year=2031" / "month=02" / "day=08"
    day.mkdir(parents=True)
    with open(day / "shop-output-ls.jl", "w") as f:
        for r in LINES:
            f.write(json.dumps(r, ensure_ascii=True) + "\n")
    back = P.read_partitioned(spark, str(root))
    rows = back.select("product_id", "_source", "year", "month", "day").orderBy("product_id").collect()
    assert [tuple(r) for r in rows] == [("S/1", "S", "2031", "02", "08"), ("S/2", "S", "2031", "02", "08")]
    assert back.filter(F.col("product_desc").isNull()).count() == 1


def test_lean_stream_equals_batch(spark, pages_a):
    from pricelens.streaming.catalogue import read_lean_view, stream_catalogue_lean
    base = scratch_dir(spark, "stream-lean")
    rows = site_a_pages()
    early = list(rows[7])
    early[0], early[3] = 100, datetime(2024, 2, 1)  # a late file holding an earlier fetch of product 1
    rows.append(tuple(early))
    for chunk in [rows[:5], rows[5:10], rows[10:]]:
        spark.createDataFrame(chunk, PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(base + "/landing")
    adapter = LayoutA(source="SHOPA")
    stream_catalogue_lean(spark, base + "/landing", adapter, base + "/out", base + "/ckpt", site="A",
                          files_per_trigger=1)
    got = read_lean_view(spark, base + "/out")
    tagged = build_catalogue(spark.read.parquet(base + "/landing"), adapter, site="A")
    batch = Q.clean(tagged).select(*PRODUCT_COLS)
    assert sorted(got.collect()) == sorted(batch.collect())
    from pricelens.streaming.catalogue import read_lean_rejects
    assert sorted(read_lean_rejects(spark, base + "/out").collect()) == sorted(Q.rejects(tagged).collect())
    one = got.filter("product_id = 'SHOPA/1'").first()
    assert one._created_date == datetime(2024, 2, 1)  # the earlier fetch wins, arriving late


def test_cli_stream_resumes(spark, pages_a):
    from pricelens.__main__ import main
    from pricelens.streaming.catalogue import read_lean_view
    landing, out = scratch_dir(spark, "cli-landing"), scratch_dir(spark, "cli-stream")
    rows = site_a_pages()
    spark.createDataFrame(rows[:9], PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    args = ["stream", "--landing", landing, "--layout", "a", "--source", "SHOPA", "--site", "A", "--out", out]
    main(args)
    first = read_lean_view(spark, out).count()
    spark.createDataFrame(rows[9:], PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    main(args)  # restart: only the new file is processed
    assert (first, read_lean_view(spark, out).count()) == (2, 3)
    assert spark.read.parquet(out + "/records").count() == 7  # every page once, nothing twice
    assert read_catalogue(spark, out + "/published/jsonl").count() == 3
    assert spark.read.json(out + "/published/rejects").count() == 4


def test_first_seen_stream_with_many_landed_files(spark):
    """Many files and micro-batches still give the batch first-seen result."""
    from pricelens.operators.quality import first_seen
    from pricelens.streaming import dedup as D
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "user_id", "event_type", "ts", "event_id", "value")
    base = scratch_dir(spark, "many-files")
    n = D.land_in_order(ev, base + "/landing", ["ts", "event_id"], slices=9)
    assert n == 9
    stream = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", max(1, n // 4))
              .parquet(base + "/landing"))
    D.run_update_stream(D.first_seen_updates(stream, ["user_id", "event_type"], ["ts", "event_id"]),
                        base + "/out", base + "/ckpt")
    got = D.read_first_seen(spark, base + "/out", ["user_id", "event_type"], ev.columns).select(*ev.columns)
    want = first_seen(ev, ["user_id", "event_type"], ["ts", "event_id"])
    assert sorted(got.collect()) == sorted(want.collect())


def test_json_lines_key_order(spark, tmp_path):
    """R-04/R-10: eleven keys in the published order; rung keys unit, CU_status, price."""
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    out = scratch_dir(spark, "key-order")
    P.write_json_lines(src, out)
    line = spark.read.text(out).first().value
    keys = [k for k, _ in json.loads(line, object_pairs_hook=list)]
    assert keys == PRODUCT_COLS and len(keys) == 11
    rung = json.loads(line)["price"][0]
    assert list(rung) == ["unit", "CU_status", "price"]


def test_partition_date_is_utc_in_any_session_zone(spark, tmp_path):
    from pricelens.functions.text import date_parts
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([(1,)], "i int").select(
            F.timestamp_micros(F.lit(1704151800000000)).alias("t"))  # 2024-01-01 23:30 UTC
        r = df.select(*date_parts(F.col("t"))).first()
        assert (r.year, r.month, r.day) == ("2024", "01", "01")  # Tokyo wall clock is already the 2nd
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_appends_keep_one_row_per_key(spark, tmp_path):
    """A batch that repeats keys, loaded twice, into a path and a catalog table."""
    src = read_catalogue(spark, _write_lines(str(tmp_path)))
    n = src.select("product_id", "_created_date").distinct().count()
    twice = src.unionByName(src)
    path = scratch_dir(spark, "repeat") + "/table"
    table = "t" + path.rsplit("/", 2)[1].replace("-", "_")
    for _ in range(2):
        P.append_idempotent(twice, path)
        P.append_table(twice, table)
    try:
        for t in (spark.read.parquet(path), spark.table(table)):
            assert t.count() == t.select("product_id", "_created_date").distinct().count() == n
    finally:
        spark.sql(f"DROP TABLE {table}")


def test_more_pages_land_in_more_files(spark, tmp_path, monkeypatch):
    """A file is a task at most: four files kept four tasks busy at any size."""
    from pricelens.plans import queries as PQ
    from pricelens.streaming import dedup as D
    landed = []
    land = D.land_in_order
    monkeypatch.setattr(D, "land_in_order", lambda df, path, *a, **k: landed.append(path) or land(df, path, *a, **k))
    monkeypatch.setattr("pricelens.operators.partitioning.ROWS_PER_TASK", 200)
    spark.range(1700).select(
        F.col("id").alias("p_partkey"), F.lit("old ring").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
        F.lit("SMALL").alias("p_type"), F.lit(7).alias("p_size"), F.lit(900.0).alias("p_retailprice")) \
        .coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    assert PQ.stream_catalogue(spark, str(tmp_path)).count() == 1700
    sizes = [r["count"] for r in spark.read.parquet(landed[0]).groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) == 9 and sum(sizes) == 1700
