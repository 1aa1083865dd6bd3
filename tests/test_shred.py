"""Tree-building rules of the shredder and selector semantics."""

import re

import pytest
from pyspark.sql import functions as F

from pricelens.functions import select as S
from pricelens.operators.shred import parse_nodes, shred


def _by(nodes, css):
    rx = S.selector_regex(css)
    return [n for n in nodes if re.search(rx, n["css_path"])]


def test_unclosed_p_and_void_and_script():
    h = ('<html><body><article><h1>T &amp; U</h1><p><b>bold<br><p>second</p>'
         '<script>var t="</p>";</script></article></body></html>')
    ns = parse_nodes(h)
    ps = _by(ns, "article > p")
    assert len(ps) == 2 and ps[1]["texts"] == ["second"]
    assert _by(ns, "h1")[0]["texts"] == ["T & U"]
    assert _by(ns, "script")[0]["texts"] == ['var t="</p>";']
    br = _by(ns, "br")[0]
    assert ns[br["parent"]]["tag"] == "b"


def test_text_nodes_split_by_children_and_comments():
    ns = parse_nodes("<div class='d'>a<span>x</span>b<!-- c -->c</div>")
    assert _by(ns, "div.d")[0]["texts"] == ["a", "b", "c"]


def test_end_tag_closes_to_match_and_unmatched_ignored():
    ns = parse_nodes("<div id='o'><ul><li>1<li>2</ul></span><p>after</div><p>out</p>")
    lis = _by(ns, "#o > ul > li")
    assert [n["texts"] for n in lis] == [["1"], ["2"]]
    assert [n["texts"] for n in _by(ns, "div#o > p")] == [["after"]]
    assert len(_by(ns, "p")) == 2


def test_classes_any_order_and_boundaries():
    ns = parse_nodes('<div class="mt-10 detail-info"><div class="right">r</div></div>'
                     '<div class="mt-100 detail-info"><div class="right">no</div></div>'
                     '<div class="marginal"><div class="right">no</div></div>')
    hits = _by(ns, "div.detail-info.mt-10 div.right")
    assert [n["texts"] for n in hits] == [["r"]]
    assert _by(ns, "div.margin div.right") == []


def test_sibling_positions_and_ids():
    ns = parse_nodes('<ul><li><a href="1">a</a><a href="2">b</a></li></ul><div id="x.y"><p>q</p></div>')
    second = [n for n in _by(ns, "ul > li > a") if n["sib_tag_pos"] == 2]
    assert dict(second[0]["attrs"])["href"] == "2"
    # '.' inside an id is escaped in the path, so '#x.y' (id x, class y) does not match it
    assert _by(ns, "div#x.y > p") == []
    assert any(n["css_path"].endswith("/div#x%2Ey") for n in ns)


def test_bad_selector():
    with pytest.raises(ValueError):
        S.selector_regex("div[attr]")


def test_shred_in_spark_keeps_columns(spark):
    df = spark.createDataFrame([(1, "u", "<p>x</p>"), (2, "v", None)], "page_id long, url string, html string")
    out = shred(df).orderBy("page_id").collect()
    assert out[0]["url"] == "u" and out[0]["nodes"][0]["texts"] == ["x"]
    assert out[1]["nodes"] is None
    first = shred(df).select(S.first(S.texts_of(S.select(F.col("nodes"), "p"))).alias("t")).first()
    assert first["t"] == "x"


def test_self_closing_slash_ignored_on_non_void():
    ns = parse_nodes('<div class="k"/>inside</div><br/>after')
    assert _by(ns, "div.k")[0]["texts"] == ["inside"]
    assert [n["tag"] for n in ns] == ["div", "br"]


def test_output_runs_bounded_by_rows_and_node_bytes():
    from pricelens.operators.shred import _node_bytes, _runs
    pages = [parse_nodes_raw(f"<p>{'x' * n}</p>") for n in (1, 1, 500, 1, 1)] + [None]
    size = _node_bytes(pages[0])
    runs = list(_runs(iter(pages), 2, 10 ** 6))
    assert [(at, len(r)) for at, r in runs] == [(0, 2), (2, 2), (4, 2)]
    runs = list(_runs(iter(pages), 10, 3 * size))
    assert [(at, len(r)) for at, r in runs] == [(0, 2), (2, 1), (3, 3)]
    assert list(_runs(iter([]), 3, 10)) == [] and _node_bytes(None) == 0


def parse_nodes_raw(html):
    from pricelens.operators.shred import _build
    return _build(html)


def test_deep_page_is_read(spark):
    deep = "<div class='l'>" * 5000 + "<ul><li><a href='x'>deep</a></li></ul>" + "</div>" * 4990 + "<a href='y'>up</a>"
    df = spark.createDataFrame([(1, "u", deep)], "page_id long, url string, html string")
    n = F.col("nodes")
    got = shred(df).select(F.size(S.select(n, "div")).alias("divs"), S.attrs_of(S.select(n, "div.l div.l li > a"), "href").alias("links"),
                           S.attrs_of(S.select(n, "div.l > a"), "href").alias("up"), F.size(S.select(n, "div div")).alias("inner")).first()
    assert tuple(got) == (5000, ["x"], ["y"], 4999)


def test_nodes_hold_intervals_and_no_paths(spark):
    ns = parse_nodes("<div><p>a<b>c</b><p>d<br><img></div><ul><li>1<li>2")
    inside = {n["ord"]: {m["ord"] for m in ns if n["ord"] < m["ord"] <= n["last"]} for n in ns}
    for n in ns:  # exactly the nodes whose chain of parents leads here
        want = set()
        for m in ns:
            p = m["parent"]
            while p >= 0:
                if p == n["ord"]:
                    want.add(m["ord"])
                p = ns[p]["parent"]
        assert inside[n["ord"]] == want
    df = shred(spark.createDataFrame([(1, "u", "<p>x</p>")], "page_id long, url string, html string"))
    assert "css_path" not in df.schema["nodes"].dataType.elementType.names
    plan = df.select(S.select(F.col("nodes"), "div.a p > b"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper()


def test_many_containers(spark):
    h = "<div class='c'><p><a href='1'></a></p></div><i><a href='2'></a></i>" * 300
    df = shred(spark.createDataFrame([(1, "u", h)], "page_id long, url string, html string"))
    assert df.select(S.attrs_of(S.select(F.col("nodes"), ".c a"), "href").alias("x")).first().x == ["1"] * 300


def test_unknown_marked_section_keeps_the_rest():
    ns = parse_nodes("<p>a</p><![foo[x]]><h1>b</h1>")
    assert [(n["tag"], n["texts"]) for n in ns] == [("p", ["a"]), ("h1", ["b"])]


def test_unparsed_page_is_rejected(spark):
    from pricelens.plans.sites import LayoutA, LayoutB
    pages = spark.createDataFrame([(1, "http://h/?product_id=1&itemno=1", None, None)],
                                  "page_id long, url string, html string, fetched_at timestamp")
    for adapter in (LayoutA(), LayoutB()):
        assert adapter.extract(shred(pages)).first().extract_error == "html"


def test_page_the_parser_gives_up_on_has_no_nodes(monkeypatch):
    from pricelens.operators import shred as M

    def fail(self, data):
        raise AssertionError("beyond repair")

    monkeypatch.setattr(M._TreeBuilder, "feed", fail)
    assert parse_nodes("<p>a</p>") is None


def test_links_and_headings_do_not_nest():
    ns = parse_nodes('<ul><li><a href="1">img<a href="2">name</li></ul><h2>one<h3>two</h3>')
    links = _by(ns, "ul > li > a")
    assert [dict(n["attrs"])["href"] for n in links] == ["1", "2"]
    assert [n["sib_tag_pos"] for n in links] == [1, 2]
    assert [n["css_path"] for n in ns if n["tag"] in ("h2", "h3")] == ["/h2", "/h3"]


def test_spread_follows_the_setting_alone(spark):
    from pricelens.operators.partitioning import SETTING, spread
    df = spark.read.parquet("/root/testdata/sf0.01/part.parquet")
    assert spread(df) is df
    spark.conf.set(SETTING, "3")
    try:
        assert "RoundRobinPartitioning(3)" in spread(df)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(SETTING)
