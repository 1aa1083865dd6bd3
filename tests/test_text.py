"""Expression cases, expected values worked out from the reference rules."""

from pyspark.sql import functions as F

from pricelens.functions import text as X


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_pack_spec_split(spark):
    cases = [
        ("海山 蜜桃味 烏龍茶 480ml x 15", "480ml x 15", "海山 蜜桃味 烏龍茶"),
        ("500ml x 20", "500ml x 20", "500ml x 2"),
        ("A500ml x 20", "500ml x 20", ""),
        (" 500ml x 20", "500ml x 20", ""),
        ("水 1.25L x 12", "25L x 12", "水 1"),
        ("梅酒275mlx18", "275mlx18", "梅"),
        ("竹園  410m  x9 (新)", "410m  x9", "竹園 "),
        ("A 5ml x 1 5ml x 1", "5ml x 1", "A"),
        ("茶 500ml X 6", "", "茶 500ml X 6"),
        ("Old Mill 700ml / 樽", "", "Old Mill 700ml / 樽"),
        ("x", "", "x"),
        ("😀 500ml x 1", "500ml x 1", "😀"),
        ("𠀀茶500ml x 2", "500ml x 2", "𠀀"),
    ]
    titles = [c[0] for c in cases]
    assert _eval(spark, titles, X.pack_spec) == [c[1] for c in cases]
    assert _eval(spark, titles, X.name_before_spec) == [c[2] for c in cases]


def test_query_param(spark):
    urls = [
        "http://h/shop?view=item&aisle=18&product_id=9057",
        "http://h/a b?product_id=1",
        "http://h/?product_id=a%20b+c",
        "http://h/?product_id=",
        "http://h/?x=1",
        "http://h/?product_id=1&product_id=2",
        "http://h/?a|b=1&product_id=3",
        "http://h/?product_id=%zz",
        "http://h/?product_id=&product_id=9",
        "http://h/?xproduct_id=5",
        "http://h/p?product_id=7#frag",
    ]
    want = ["9057", "1", "a b c", None, None, "1", "3", "%zz", "9", None, "7"]
    assert _eval(spark, urls, lambda c: X.query_param(c, "product_id")) == want


def test_first_number(spark):
    vals = ["HKD1,200.00", ".", "1.", ".5", "1.2.3", "", None, "HK$ 35.5 each"]
    assert _eval(spark, vals, X.first_number) == [1.0, None, 1.0, 0.5, None, None, None, 35.5]


def test_discount_text(spark):
    vals = ["6 or more HKD7.00", "HKD7 for 6", "6 or more", "HKD. for 2"]
    assert _eval(spark, vals, X.first_int) == [6, 7, 6, 2]
    assert _eval(spark, vals, X.tagged_price) == [7.0, 7.0, None, None]


def test_cjk_else_latin(spark):
    assert _eval(spark, ["NEW 新品 abc", "12 NEW", "123", "飲品 Drinks", None],
                 X.cjk_else_latin) == ["新品", "NEW", None, "飲品", None]


def test_strip_unicode(spark):
    assert _eval(spark, ["　 a b \t", "  ", "x"], X.strip) == ["a b", "", "x"]


def test_kv_map(spark):
    df = spark.createDataFrame(
        [(["specification: 50ml ", "a:b:c", "none", "k: 1", "k: 2", " RRP: 5", "w：1"],)], "lines array<string>")
    m = df.select(X.kv_map("lines").alias("m")).first()["m"]
    assert m == {"specification": "50ml", "a": "b:c", "k": "2", " RRP": "5"}


def test_stamp_and_date_parts(spark):
    df = spark.createDataFrame([(1,)], "i int").select(
        F.to_timestamp(F.lit("2031-02-08 14:05:09.5")).alias("t"))
    r = df.select(X.stamp_text("t").alias("s"), *X.date_parts(F.col("t"))).first()
    assert (r.s, r.year, r.month, r.day) == ("2031-02-08 14:05:09.500000", "2031", "02", "08")


def test_norm_key(spark):
    assert _eval(spark, ["Brand#13 ", "Coca-Cola, Zero!", "可口　可樂。"], X.norm_key) == [
        "brand13", "cocacolazero", "可口可樂"]


def test_url_host(spark):
    vals = ["http://Shop.Example:8080/a?b=1", "https://user:pw@h.example/x", "ftp://h", "no-scheme/x"]
    assert _eval(spark, vals, X.url_host) == ["shop.example", "h.example", "h", None]


def test_strip_matches_python_whitespace(spark):
    """Every code point Python's str.strip() removes is removed here too."""
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    vals = [f"{w}a{w}" for w in spaces] + ["​b​"]  # zero-width space is not whitespace
    assert _eval(spark, vals, X.strip) == [v.strip() for v in vals]


def test_canonical_url(spark):
    vals = ["HTTP://Shop.Example/P?b=2&a=1#top", "http://shop.example/P?a=1&b=2", "http://h/x?", "/rel?z=1&y=", None]
    assert _eval(spark, vals, X.canonical_url) == [
        "http://shop.example/P?a=1&b=2", "http://shop.example/P?a=1&b=2", "http://h/x", "/rel?y=&z=1", None]
