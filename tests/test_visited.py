"""The frontier across runs."""

from pyspark.sql import functions as F

from pricelens.operators import visited
from pricelens.session import scratch_dir


def _links(spark, ids, host="http://h"):
    return spark.createDataFrame([(f"{host}/p?b=2&a={i}",) for i in ids] or [(None,)], "url string")


def _n(df):
    return sorted(int(r.url_key.rsplit("a=", 1)[1].split("&")[0]) for r in df.select("url_key").collect())


def test_each_url_is_requested_in_one_run(spark):
    seen = visited.VisitedSet(spark, scratch_dir(spark, "visited"))
    first = seen.unseen(_links(spark, [*range(50), 3, 3]))
    assert _n(first) == list(range(50))
    seen.add(first)
    assert seen.unseen(_links(spark, range(50))).count() == 0
    second = seen.unseen(_links(spark, [*range(40, 70)]).unionByName(spark.createDataFrame([("HTTP://H/p?a=5&b=2#x",), ("HTTP://H/p?a=99&b=2#x",), (None,)], "url string")))
    assert _n(second) == [*range(50, 70), 99]
    seen.add(second)
    assert len(seen.runs()) == 2 and _n(seen.unseen(_links(spark, range(60, 72)))) == [70, 71]


def test_a_full_filter_is_still_exact(spark, monkeypatch):
    monkeypatch.setattr(visited, "CELLS_A_URL", 1)
    seen = visited.VisitedSet(spark, scratch_dir(spark, "visited"))
    seen.add(seen.unseen(_links(spark, range(0, 400, 2))))
    maybe = seen._maybe(seen.unseen(_links(spark, range(1, 400, 2))).select("url_key")).where("_maybe").count()
    assert maybe > 0  # cells are shared, the stored keys decide
    assert _n(seen.unseen(_links(spark, range(400)))) == list(range(1, 400, 2))


def test_new_urls_meet_no_stored_key(spark):
    seen = visited.VisitedSet(spark, scratch_dir(spark, "visited"))
    seen.add(seen.unseen(_links(spark, range(500))))
    new = seen.unseen(_links(spark, range(500), host="http://other")).select("url_key")
    assert new.count() == 500 and seen._maybe(new).where("_maybe").count() < 25


def test_a_part_without_its_filter_does_not_count(spark):
    seen = visited.VisitedSet(spark, scratch_dir(spark, "visited"))
    assert seen.runs() == [] and _n(seen.unseen(_links(spark, [1]))) == [1]
    spark.createDataFrame([("k",)], "url_key string").write.parquet(f"{seen.root}/urls/run=000000-broken-10/bucket=1")
    assert seen.runs() == [] and _n(seen.unseen(_links(spark, [1]))) == [1]
    seen.add(_links(spark, []).select(F.col("url").alias("url_key")))
    assert len(seen.runs()) == 1 and _n(seen.unseen(_links(spark, [1]))) == [1]
