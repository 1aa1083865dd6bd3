"""Comparison operators on small frames, checked by hand or by brute force."""

import itertools
import re

from pyspark.sql import functions as F

from pricelens.operators import compare as C
from pricelens.schema import LADDER_TYPE


def _ladders(spark):
    rows = [
        (1, [(1, "normal", 128.0), (1, "original", 135.0), (6, "normal", 120.0), (12, "normal", 110.0)]),
        (2, [(1, "original", 120.0), (1, "discount", 99.5)]),
        (3, [(1, "normal", 45.0)]),
        (4, [(1, "original", 0.0), (1, "normal", 0.0)]),
    ]
    return spark.createDataFrame(rows, f"id int, price {LADDER_TYPE.simpleString()}")


def test_list_current_discount(spark):
    df = _ladders(spark)
    lp, cp = C.list_price("price"), C.current_price("price")
    got = {r.id: (r.lp, r.cp, r.amt, r.rate) for r in df.select(
        "id", lp.alias("lp"), cp.alias("cp"), C.discount_amount(lp, cp).alias("amt"),
        C.discount_rate(lp, cp).alias("rate")).collect()}
    assert got[1] == (135.0, 128.0, 7.0, 7.0 / 135.0)
    assert got[2] == (120.0, 99.5, 20.5, 20.5 / 120.0)
    assert got[3] == (45.0, 45.0, 0.0, 0.0)
    assert got[4][3] is None  # list price 0 -> no rate


def test_price_at_quantity_matches_current_at_one(spark):
    df = _ladders(spark)
    got = {r.id: (r.q1, r.q7, r.q20) for r in df.select(
        "id", C.price_at_quantity("price", 1).alias("q1"), C.price_at_quantity("price", 7).alias("q7"),
        C.price_at_quantity("price", 20).alias("q20")).collect()}
    assert got[1] == (128.0, 120.0, 110.0)
    assert got[2] == (99.5, 99.5, 99.5)
    cur = {r.id: r.c for r in df.select("id", C.current_price("price").alias("c")).collect()}
    assert all(got[i][0] == cur[i] for i in (1, 2, 3))


def test_pack_parse(spark):
    df = spark.createDataFrame([("500ml x 20", 100.0), ("330m  x24", 10.0), ("1L x 6", 60.0), ("", 1.0)],
                               "spec string, price double")
    r = df.select("spec", *C.pack_parse("spec"), "price").select(
        "spec", "volume", "measure", "pack_count",
        *C.unit_prices(F.col("price"), F.col("volume"), F.col("pack_count"), F.col("factor"))).collect()
    assert (r[0].volume, r[0].measure, r[0].pack_count, r[0].price_per_item, r[0].price_per_100) == (
        500, "ml", 20, 5.0, 100.0 / 10000 * 100)
    assert r[1].price_per_100 is None and r[1].measure == "m"
    assert r[2].price_per_100 == 60.0 / 6000 * 100
    assert r[3].volume is None and r[3].price_per_item is None


def _jac(a, b):
    ta, tb = set(re.findall(r"[a-z0-9]+", a.lower())), set(re.findall(r"[a-z0-9]+", b.lower()))
    return len(ta & tb) / len(ta | tb)


def test_similar_names_equals_brute_force(spark):
    names = ["red plate", "red plate", "red widget", "big red plate", "blue widget", "small blue widget gear",
             "gear", "plate red", "green bolt", "green bolt nut", "a b c d e f", "a b c d e g", "z"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for t in (0.3, 0.5, 0.8):
        got = {(r.name_a, r.name_b): r.jaccard for r in C.similar_names(df, "name", t).collect()}
        want = {}
        for a, b in itertools.combinations(sorted(set(names)), 2):
            j = _jac(a, b)
            if j >= t:
                want[(a, b)] = j
        assert got == want, t


def test_cjk_tokens(spark):
    df = spark.createDataFrame([("樂天 青檸味 Soda",)], "t string")
    toks = df.select(C.tokens("t").alias("k")).first().k
    assert set(toks) == {"soda", "樂天", "青檸", "檸味"}


def test_exact_match_groups_and_latest(spark):
    df = spark.createDataFrame([(1, "A", "Coca-Cola", "Zero 330ml"), (2, "B", "coca cola", "zero 330 ML"),
                                (3, "B", "Pepsi", "Max")], "id int, src string, brand string, name string")
    g = {r.id: (r.n_products, r.n_sources) for r in C.exact_match_groups(
        df, "id", "src", C.match_key(F.col("brand"), F.col("name"))).collect()}
    assert g == {1: (2, 2), 2: (2, 2), 3: (1, 1)}
    ev = spark.createDataFrame([(1, 10, "a"), (1, 20, "b"), (2, 5, "c")], "k int, ts int, v string")
    assert sorted(tuple(r) for r in C.latest_per_key(ev, ["k"], ["ts"]).collect()) == [(1, 20, "b"), (2, 5, "c")]


def test_snapshot_diff_and_history(spark):
    a = spark.createDataFrame([(1, 5.0), (2, 6.0), (3, 7.0)], "k int, p double")
    b = spark.createDataFrame([(2, 6.0), (3, 8.0), (4, 1.0)], "k int, p double")
    got = {r.k: r.status for r in C.snapshot_diff(a, b, "k", "p").collect()}
    assert got == {1: "delisted", 2: "same", 3: "repriced", 4: "new"}
    o = spark.createDataFrame([(1, "2024-01", 5.0), (1, "2024-01", 4.0), (1, "2024-03", 6.0)],
                              "k int, m string, p double")
    h = [tuple(r) for r in C.price_history(o, "k", F.col("m"), "p").orderBy("period").collect()]
    assert h == [(1, "2024-01", 4.0, None, None), (1, "2024-03", 6.0, 4.0, 2.0)]


def test_similar_names_boundary_in_floating_point(spark):
    """0.28 * 25 is 7.000000000000001 in doubles: a 7-word name inside a
    25-word name has Jaccard exactly 0.28 and must still be found."""
    words = [f"w{i:02d}" for i in range(25)]
    big, small = " ".join(words), " ".join(words[:7])
    df = spark.createDataFrame([(big,), (small,), ("x y z",)], "name string")
    got = {(r.name_a, r.name_b) for r in C.similar_names(df, "name", 0.28).collect()}
    assert got == {tuple(sorted((small, big)))}


def test_null_price_is_never_cheapest(spark):
    from pricelens.operators.compare import cheapest_source
    offers = spark.createDataFrame([("p", "a", None), ("p", "b", 5.0), ("q", "a", None)], "k string, s string, price double")
    got = {r.k: (r.cheapest_source, r.cheapest_price, r.spread, r.n_offers) for r in cheapest_source(offers, "k", "s", "price").collect()}
    assert got == {"p": ("b", 5.0, 0.0, 2), "q": (None, None, None, 1)}


def test_snapshot_diff_tells_absent_from_unpriced(spark):
    from pricelens.operators.compare import snapshot_diff, snapshot_diff_one_pass
    rows = [("a", "1", None), ("a", "2", 3.0), ("b", "1", None), ("b", "2", None), ("c", "1", 4.0), ("d", "2", None), ("e", "1", 2.0), ("e", "2", None)]
    df = spark.createDataFrame(rows, "k string, s string, price double")
    want = {"a": "repriced", "b": "same", "c": "delisted", "d": "new", "e": "repriced"}
    assert {r.k: r.status for r in snapshot_diff_one_pass(df, "k", "s", "1", "2", "price").collect()} == want
    a, b = df.where("s = '1'"), df.where("s = '2'")
    assert {r.k: r.status for r in snapshot_diff(a, b, "k", "price").collect()} == want


def test_huge_pack_sizes_give_null_not_a_failed_job(spark):
    from pyspark.sql import functions as F
    from pricelens.operators.compare import pack_parse, unit_prices
    df = spark.createDataFrame([("9999999999999999kg x 99",), ("500ml x 2",)], "spec string").select("spec", *pack_parse("spec"))
    got = {r.spec: r.price_per_100 for r in df.select("spec", *unit_prices(F.lit(10.0), F.col("volume"), F.col("pack_count"), F.col("factor"))).collect()}
    assert got == {"9999999999999999kg x 99": None, "500ml x 2": 1.0}


def test_brand_rollup_average_discount(spark):
    from pricelens.operators.compare import brand_rollup
    df = spark.createDataFrame([("s", "b", 10.0, 8.0), ("s", "b", 10.0, None), ("s", "c", 4.0, 3.0)], "src string, brand string, lp double, cp double")
    got = {(r.src, r.brand): r.avg_discount for r in brand_rollup(df, "src", "brand", "lp", "cp").collect()}
    assert got == {("s", "b"): 2.0, ("s", "c"): 1.0, ("s", None): 1.5, (None, None): 1.5}


def test_similar_names_with_a_word_in_every_name(spark):
    """Three-word names that share one word match nobody, and do not even meet."""
    from pricelens.operators.compare import similar_names
    rows = [(f"hot a{i} b{i}",) for i in range(1500)] + [("hot a1 c1",)]
    out = similar_names(spark.createDataFrame(rows, "name string"), "name", 0.3)
    assert sorted((r.name_a, r.name_b, r.n_shared) for r in out.collect()) == [("hot a1 b1", "hot a1 c1", 2)]
    # rows of every join, as counted while it ran
    joins, todo = [], [out._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        for inner in ("executedPlan", "plan"):
            if hasattr(node.getClass(), "getMethods") and any(m.getName() == inner and m.getParameterCount() == 0 for m in node.getClass().getMethods()):
                todo.append(getattr(node, inner)())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
            joins.append(node.metrics().apply("numOutputRows").value())
    assert joins and max(joins) < 20 * len(rows)


def test_products_without_a_key_match_nothing(spark):
    from pyspark.sql import functions as F
    from pricelens.operators.compare import exact_match_groups, match_key
    df = spark.createDataFrame([(1, "a", None, " "), (2, "b", "", "-"), (3, "a", "X", "y"), (4, "b", "x", "Y ")], "id long, src string, brand string, name string")
    got = {r.id: (r.n_products, r.n_sources) for r in exact_match_groups(df, "id", "src", match_key(F.col("brand"), F.col("name"))).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (2, 2), 4: (2, 2)}
