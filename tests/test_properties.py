"""Property tests: texts are built from known parts, and the Column helpers
must find the parts again (one Spark job per generated batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricelens.functions import text as X

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def _spark_eval(spark, values, *fns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.orderBy("i").select(*[fn(F.col("v")).alias(f"c{k}") for k, fn in enumerate(fns)]).collect()
    return [tuple(r) for r in rows]


# a product name without digits, then any one character, then a pack spec
names = st.lists(st.sampled_from(list("ab Z水茶.")), max_size=8).map("".join)
specs = st.tuples(st.integers(0, 9999), st.sampled_from(["", " ", "  "]), st.sampled_from(["ml", "L", "kg"]),
                  st.sampled_from(["", " "]), st.sampled_from(["x", "x ", "x  "]), st.integers(0, 99)) \
    .map(lambda p: f"{p[0]}{p[1]}{p[2]}{p[3]}{p[4]}{p[5]}")
titles = st.lists(st.tuples(names, st.sampled_from(list(" /水-")), specs, st.sampled_from(["", " new", "水"])), min_size=1, max_size=40)


@SETTINGS
@given(titles)
def test_name_and_spec_are_found_again(spark, parts):
    got = _spark_eval(spark, ["".join(p) for p in parts], X.pack_spec, X.name_before_spec)
    assert got == [(spec, name) for name, _, spec, _ in parts]


@SETTINGS
@given(st.lists(names, min_size=1, max_size=40))
def test_title_without_spec_is_the_name(spark, values):
    assert _spark_eval(spark, values, X.pack_spec, X.name_before_spec) == [("", v) for v in values]


numbers = st.one_of(st.integers(0, 10**6).map(str), st.tuples(st.integers(0, 999), st.integers(0, 99)).map(lambda p: f"{p[0]}.{p[1]:02d}"))
num_texts = st.lists(st.tuples(st.sampled_from(["", "HKD", "HK$ ", "-", "now "]), numbers, st.sampled_from(["", ",000", " each", " 7", "-8.5"])),
                     min_size=1, max_size=40)


@SETTINGS
@given(num_texts)
def test_first_number_is_found(spark, parts):
    got = [r[0] for r in _spark_eval(spark, ["".join(p) for p in parts], X.first_number)]
    assert got == [float(n) for _, n, _ in parts]


# the asked-for value stands among other parameters and blank ones of its own
others = st.lists(st.sampled_from(["x=1", "idx=2", "aid=3", "id=", "y"]), max_size=3)
urls = st.lists(st.tuples(others, st.sampled_from(["7", "a+b", "a%20b", "%zz", "ü"]), others, st.sampled_from(["", "&id=later", "#id=9"])),
                min_size=1, max_size=30)
DECODED = {"7": "7", "a+b": "a b", "a%20b": "a b", "%zz": "%zz", "ü": "ü"}


@SETTINGS
@given(urls)
def test_query_param_is_found(spark, parts):
    values = ["http://h/p?" + "&".join([*before, f"id={v}", *after]) + end for before, v, after, end in parts]
    got = [r[0] for r in _spark_eval(spark, values, lambda c: X.query_param(c, "id"))]
    assert got == [DECODED[v] for _, v, _, _ in parts]


def test_query_param_key_is_literal(spark):
    assert _spark_eval(spark, ["http://h/?aXb=1&a.b=2"], lambda c: X.query_param(c, "a.b")) == [("2",)]


entries = st.lists(st.tuples(st.sampled_from(["a", "b", " a", "RRP", ""]), st.sampled_from(["", "x", "x:y", "水 z"]),
                             st.sampled_from(["", " ", "  "])), max_size=6)


@SETTINGS
@given(st.lists(entries, min_size=1, max_size=20))
def test_kv_map_keeps_each_keys_last_value(spark, batches):
    lines = [[f"{k}:{pad}{v}{pad}" for k, v, pad in es] + ["no colon", "全：角"] for es in batches]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v array<string>")
    got = [r[0] for r in df.orderBy("i").select(X.kv_map("v")).collect()]
    assert got == [{k: v for k, v, _ in es} for es in batches]


# ---- selectors: regex over css_path == structural CSS matching -------------
from pricelens.functions.select import selector_regex  # noqa: E402
from pricelens.operators.shred import parse_nodes  # noqa: E402

TAGS = ["div", "ul", "li", "a", "span", "p"]
CLASSES = ["a", "b", "mt-10", "mt-100", "x.y"]


@st.composite
def trees(draw, depth=0):
    n_children = draw(st.integers(0, 3 if depth < 4 else 0))
    out = ""
    for _ in range(n_children):
        tag = draw(st.sampled_from(TAGS))
        cls = draw(st.lists(st.sampled_from(CLASSES), max_size=2, unique=True))
        ident = draw(st.sampled_from([None, "c1", "chapter-2"]))
        attrs = (f' class="{" ".join(cls)}"' if cls else "") + (f' id="{ident}"' if ident else "")
        out += f"<{tag}{attrs}>t{draw(trees(depth + 1))}</{tag}>"
    return out


compound = st.tuples(st.sampled_from(TAGS + [None]), st.lists(st.sampled_from(["a", "b", "mt-10"]), max_size=2),
                     st.sampled_from([None, "c1"])).filter(lambda c: c[0] or c[1] or c[2])
selectors = st.lists(st.tuples(compound, st.sampled_from([" ", " > "])), min_size=1, max_size=3)


def _css(sel):
    parts = []
    for (tag, cls, ident), comb in sel:
        parts.append((tag or "") + (f"#{ident}" if ident else "") + "".join("." + c for c in cls))
        parts.append(comb)
    return "".join(parts[:-1])


def _matches(node, comp):
    tag, cls, ident = comp
    attrs = dict(node["attrs"])
    have = set(attrs.get("class", "").split())
    return ((tag is None or node["tag"] == tag) and set(cls) <= have
            and (ident is None or attrs.get("id") == ident))


def _structural(nodes, sel):
    comps = [c for c, _ in sel]
    combs = [k.strip() for _, k in sel][:-1]

    def up(i, k):  # does node i match compounds[0..k] with node i matching comps[k]?
        if not _matches(nodes[i], comps[k]):
            return False
        if k == 0:
            return True
        p = nodes[i]["parent"]
        if combs[k - 1] == ">":
            return p >= 0 and up(p, k - 1)
        while p >= 0:
            if up(p, k - 1):
                return True
            p = nodes[p]["parent"]
        return False
    return [n["ord"] for n in nodes if up(n["ord"], len(comps) - 1)]


@settings(max_examples=60, deadline=None)
@given(trees(), selectors)
def test_selector_regex_equals_structural_match(html, sel):
    nodes = parse_nodes("<html><body>" + html + "</body></html>")
    rx = re.compile(selector_regex(_css(sel)))
    assert [n["ord"] for n in nodes if rx.search(n["css_path"])] == _structural(nodes, sel)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(trees(), min_size=1, max_size=4), st.lists(selectors, min_size=4, max_size=8))
def test_select_equals_structural_match(spark, htmls, sels):
    from pyspark.sql import functions as F
    from pricelens.functions import select as S
    from pricelens.operators.shred import shred
    pages = ["<html><body>" + h + "</body></html>" for h in htmls]
    df = shred(spark.createDataFrame(list(enumerate(pages)), "page_id int, html string"))
    cols = [F.transform(S.select(F.col("nodes"), _css(sel)), lambda n: n["ord"]).alias(f"s{i}") for i, sel in enumerate(sels)]
    for r in df.select("page_id", *cols).collect():
        nodes = parse_nodes(pages[r.page_id])
        assert [r[f"s{i}"] for i in range(len(sels))] == [_structural(nodes, sel) for sel in sels]


# ---- similar names: prefix + size filtering is exact ---------------------
from pricelens.operators.compare import similar_names  # noqa: E402

WORDS = ["red", "blue", "plate", "gear", "bolt", "small", "big", "nut"]
name_lists = st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=5).map(" ".join),
                      min_size=2, max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(name_lists, st.sampled_from([0.2, 0.34, 0.5, 0.67, 0.9]))
def test_similar_names_exact(spark, names, t):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {(r.name_a, r.name_b) for r in similar_names(df, "name", t).collect()}
    want = set()
    uniq = sorted(set(names))
    for i, a in enumerate(uniq):
        for b in uniq[i + 1:]:
            ta, tb = set(a.split()), set(b.split())
            if len(ta & tb) / len(ta | tb) >= t:
                want.add((a, b))
    assert got == want


# ---- one bad page must not fail a task, and never loses markup silently ----
from pricelens.operators.shred import _nodes_array  # noqa: E402

junk = st.lists(st.sampled_from(
    ["<", ">", "</", "/>", "<div", "<p>", "</p>", "<a href=", "'", '"', "=", "&", "&amp;", "&#xD800;",
     "&#1114112;", "&#0;", "<!--", "-->", "<![CDATA[", "<script>", "</script>", "<?x", "\x00", "﻿",
     "text", " ", "\n", "<br/>", "<li>", "<table><td>", "class='a b'", "id=x"]), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(junk, st.text(max_size=80), st.none()), min_size=1, max_size=6))
def test_shredder_never_raises(pages):
    arr = _nodes_array(pages)
    assert len(arr) == len(pages)


closed_junk = st.lists(st.sampled_from(["<![x[", "<![if gte]>", "<!-- c -->", "<!x>", "<?pi?>", "a < b", "</p>", "&#xD800;", "<br/>", "&bogus;"]),
                       max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(closed_junk)
def test_nodes_after_junk_survive(j):
    nodes = parse_nodes(f"<div>{j}></div><h1>end</h1>")
    assert nodes[-1]["tag"] == "h1" and nodes[-1]["texts"] == ["end"]


# ---- the quality split: first eligible record of each id stays -------------
from pricelens.operators.quality import DUPLICATE, MISSING, split_quality  # noqa: E402

records = st.lists(st.tuples(st.sampled_from([None, "", "S/1", "S/2", "S/3"]),
                             st.sampled_from([None, "", " ", "n"]),
                             st.sampled_from([None, None, "price"])), min_size=1, max_size=30)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(records)
def test_split_quality(spark, rows):
    df = spark.createDataFrame(
        [(i, pid, name, err, f"u{i}") for i, (pid, name, err) in enumerate(rows)],
        "page_id long, product_id string, product_name string, extract_error string, request_url string") \
        .withColumn("fetched_at", F.lit(None).cast("timestamp")).withColumn("_source", F.lit("S"))
    good, bad = split_quality(df)
    clean = {r.page_id: r.product_id for r in good.collect()}
    reason = {int(r.item_url[1:]): r.reason for r in bad.collect()}
    # every record goes one way
    assert sorted([*clean, *reason]) == list(range(len(rows)))
    # an id stays once, on its earliest whole record
    assert len(set(clean.values())) == len(clean)
    for i, (pid, name, err) in enumerate(rows):
        whole = not err and bool(pid) and bool(name)
        if i in clean:
            assert whole and not any(clean.get(j) == pid for j in range(i))
        elif err:
            assert reason[i] == f"extract_error:{err}"
        elif not whole:
            assert reason[i] == MISSING
        else:
            assert reason[i] == DUPLICATE and any(clean.get(j) == pid for j in range(i))
