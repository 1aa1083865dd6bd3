"""Price in force, validity intervals and groups of similar products against brute force."""

import random
from collections import Counter

from pyspark.sql import functions as F

from pricelens.operators import history as H
from pricelens.operators.groups import match_groups, similar_groups


def _in_force(asked, prices):
    best = {}
    for k, t, p in prices:
        if None not in (k, t, p):
            best[(k, t)] = min(p, best.get((k, t), p))
    out = []
    for n, k, t in asked:
        at = max((x for kk, x in best if kk == k and t is not None and x <= t), default=None)
        out.append((n, best.get((k, at)), at))
    return Counter(out)


def test_price_in_force_with_a_hot_key(spark):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", "c", "only asked", None])
    at = lambda: rng.choice([None, *range(3000)])
    prices = [(key(), at(), rng.choice([None, 1.0, 2.5, 7.0])) for _ in range(900)] + [("early", 1, 3.0)]
    prices = [p for p in prices if p[0] != "only asked"]
    # the hot key's prices come first, then questions that fill slices of their own
    asked = [(i, key(), at()) for i in range(1200)] + [(i, "early", 2 + i % 7) for i in range(1200, 3200)] + [(0, "hot", 5)] * 3
    df = spark.createDataFrame(asked, "n int, k string, t long")
    facts = spark.createDataFrame([(*p, "x") for p in prices], "k string, t long, price double, n string")
    got = H.price_in_force(df, facts, "k", "t")
    assert got.columns == ["n", "k", "t", "in_force", "since"]
    rows = got.collect()
    assert Counter((r.n, r.in_force, r.since) for r in rows) == _in_force(asked, prices)


def test_hot_key_lies_over_slices(spark, monkeypatch):
    seen = []
    true_stage = H.stage
    monkeypatch.setattr(H, "stage", lambda df, name: seen.append(true_stage(df, name)) or seen[-1])
    asked = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("t"), F.col("id").alias("n"))
    facts = spark.createDataFrame([("hot", 10, 1.0), ("hot", 3990, 2.0)], "k string, t long, price double")
    got = H.price_in_force(asked, facts, "k", "t").groupBy("in_force").count().collect()
    assert {r.in_force: r["count"] for r in got} == {None: 10, 1.0: 3980, 2.0: 10}
    sizes = [r["count"] for r in seen[0].groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_price_in_force_of_nothing(spark):
    asked = spark.createDataFrame([(1, "a", 5)], "n int, k string, t long")
    none = spark.createDataFrame([], "k string, t long, price double")
    assert H.price_in_force(asked, none, "k", "t").first().in_force is None
    assert H.price_in_force(asked.where("false"), none, "k", "t").collect() == []


SNAP = "pid string, run string, price double"


def _intervals(rows):
    runs = sorted({r for _, r, _ in rows if r is not None})
    at = {}
    for pid, run, price in rows:
        if pid is not None and run is not None:
            old = at.get((pid, run), (None,))[0]
            at[(pid, run)] = (price if old is None else old if price is None else min(price, old),)
    out = Counter()
    for pid in {p for p, _ in at}:
        start = None
        for i, run in enumerate(runs + [None]):
            now = at.get((pid, run)) if run is not None else None
            before = at.get((pid, runs[i - 1])) if i else None
            if before is not None and (run is None or now != before):
                out[(pid, start, run, before[0])] += 1
            if now is not None and now != before:
                start = run
    return out


def _snapshots():
    rng = random.Random(6)
    rows = [(f"p{i}", f"2024-0{m}", rng.choice([1.0, 1.0, 1.0, 2.0, None])) for i in range(80) for m in range(1, 9) if rng.random() < 0.8]
    return rows + rows[:40] + [(None, "2024-01", 1.0), ("p0", None, 1.0)]


def test_intervals_and_increments(spark):
    rows = _snapshots()
    df = spark.createDataFrame(rows, SNAP)
    want = _intervals(rows)
    tup = lambda d: Counter(tuple(r) for r in d.collect())
    assert tup(H.price_intervals(df, "pid", "run", "price")) == want
    out = H.price_intervals(df.where("run <= '2024-03'"), "pid", "run", "price")
    for m in range(4, 9):
        out = H.stage(H.extend_intervals(out, df.where(F.col("run") == f"2024-0{m}"), "pid", f"2024-0{m}", "price"), "intervals")
    assert tup(out) == want
    empty = H.price_intervals(df.where("false"), "pid", "run", "price")
    assert empty.collect() == []
    first = H.extend_intervals(empty, df.where("run = '2024-01'"), "pid", "2024-01", "price")
    assert tup(first) == _intervals([r for r in rows if r[1] == "2024-01"])


def test_match_groups(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(300)] + [(rng.randint(2000, 2300), rng.randint(2000, 2300)) for _ in range(120)]
    pairs += [(5, 5), (7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        if b is not None:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.grp for r in match_groups(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert match_groups(spark.createDataFrame([], "a long, b long")).collect() == []


def test_similar_groups_chain(spark):
    rows = [(1, "red steel plate big"), (2, "red steel plate"), (3, "red steel"), (4, "blue nut"), (5, "red steel plate"), (6, None), (7, "!!!")]
    got = {r.id: r.grp for r in similar_groups(spark.createDataFrame(rows, "id long, name string"), "id", "name", 0.6).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 1, 6: 6, 7: 7}


def _components(nodes, edges):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(least[a], least[b])
            changed |= least[a] != m or least[b] != m
            least[a] = least[b] = m
    return least


def test_similar_groups_equal_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    names = [" ".join(rng.sample(words[:9], rng.randint(1, 6))) for _ in range(60)] + ["", "--", None]
    # names too long for subsets: chains that differ by a few words
    base = rng.sample(words, 22)
    for _ in range(25):
        base = [rng.choice(words) if rng.random() < 0.12 else w for w in base]
        names.append(" ".join(dict.fromkeys(base)))
    rows = list(enumerate(names, 100))
    sets = {i: set((n or "").split()) - {"--"} for i, n in rows}
    for t in (0.3, 0.5, 0.6, 0.9):
        edges = [(i, j) for i in sets for j in sets if i < j and (sets[i] & sets[j] or (names[i - 100] is not None and names[i - 100] == names[j - 100]))
                 and (names[i - 100] == names[j - 100] or len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= t)]
        got = {r.id: r.grp for r in similar_groups(spark.createDataFrame(rows, "id long, name string"), "id", "name", t).collect()}
        assert got == _components(sets, edges)


def test_similar_groups_links_grow_with_the_names(spark, monkeypatch):
    seen = []
    monkeypatch.setattr("pricelens.operators.groups.match_groups", lambda links: seen.append(links.count()) or match_groups(links))
    names = spark.range(300).select("id", F.concat(F.lit("old blue ring s7 lot"), "id").alias("name"))
    groups = similar_groups(names, "id", "name", 0.6)
    assert [tuple(r) for r in groups.groupBy("grp").count().collect()] == [(0, 300)]
    assert seen[0] < 300 * 5  # of 44,850 pairs


def test_similar_groups_broadcast_no_names(spark, capsys):
    names = spark.range(50).select("id", F.concat(F.lit("old blue ring s7 lot"), "id").alias("name"))
    similar_groups(names, "id", "name", 0.6).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
