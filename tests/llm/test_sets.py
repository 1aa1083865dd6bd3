"""Exact and near dedup, suffix dedup and mixing against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import exact_dedup, mixing, near_dedup, suffix_dedup
from pricelens.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows], DOCS)


def _word(rng):
    return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    rows = []
    for i in range(60):
        rows.append((i, " ".join(_word(rng) for _ in range(rng.randint(1, 160))), f"s{i % 3}" if i % 7 else None))
    base = [t for _, t, _ in rows]
    for i in range(60, 90):  # near copies: a word or two changed
        w = base[i % 20].split()
        for _ in range(rng.randint(0, 2)):
            w[rng.randrange(len(w))] = _word(rng)
        rows.append((i, " ".join(w), "s0"))
    passage = " ".join(_word(rng) for _ in range(120))
    for i in range(90, 100):  # a shared passage
        rows.append((i, f"{_word(rng)} {passage[:rng.randint(450, len(passage))]} {_word(rng)}", "s1"))
    rows += [(100, None, "s2"), (101, "", None), (102, " \n\t", "s2"), (103, "one", "s1"), (104, "One", "s1"), (105, "ab" * 900, "s2"),
             (106, "é" * 700, "s0"), (107, "é" * 700, "s0"), (107, "é" * 700, "s0")]
    return rows


def test_exact_dedup(spark, corpus):
    got = exact_dedup.exact_dedup(_docs(spark, corpus)).collect()
    groups = {}
    for i, t, _ in corpus:
        groups.setdefault(t or "", []).append(i)
    want = Counter((i, max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in corpus)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == want


def test_exact_dedup_saturated_filter_is_still_exact(spark, corpus):
    docs = _docs(spark, corpus)
    key = lambda d: sorted(map(tuple, d.select("doc_id", "keep_id", "group_size").collect()))
    assert key(exact_dedup.exact_dedup(docs, bits=8)) == key(exact_dedup.exact_dedup(docs))


def test_exact_dedup_bitmaps_grow_with_repeats_not_with_rows(spark):
    # 60,000 rows have far more cells than the bitmaps have bits; 40 of the texts repeat
    docs = spark.range(60000).selectExpr("id doc_id", "concat('text ', if(id >= 59960, id - 59960, id)) text")
    most = 32768
    maybe = exact_dedup.marked(docs, "doc_id", "text", most=most).where("_maybe").select("_id").collect()
    assert {r._id for r in maybe} >= {*range(40), *range(59960, 60000)} and len(maybe) < 100
    got = exact_dedup.exact_dedup(docs, most=most)
    assert got.where("group_size = 2").count() == 80 and got.where("kept").count() == 59960
    # a filter that more repeats than its bits fill is still exact
    twice = docs.unionByName(docs)
    assert exact_dedup.exact_dedup(twice, most=8).where("group_size < 2").count() == 0


def test_exact_dedup_clashing_names_and_null_ids(spark):
    d = spark.createDataFrame([(1, "a", "x", 5), (None, "a", "y", 6), (None, "b", "z", 7)], "doc_id long, text string, Kept string, _row int")
    out = exact_dedup.exact_dedup(d)
    assert out.columns == ["doc_id", "text", "_row", "keep_id", "group_size", "kept", "text_sha256"]
    got = {r["_row"]: (r["keep_id"], r["group_size"], r["kept"]) for r in out.collect()}
    assert got == {5: (1, 2, True), 6: (1, 2, False), 7: (None, 1, True)}


def _shingles(t, width):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


@pytest.mark.parametrize("width", [2, 5])
def test_near_dedup(spark, corpus, width):
    rows = list({(i, t) for i, t, _ in corpus})
    got = {r.doc_id: r for r in near_dedup.near_dedup(_docs(spark, corpus), width=width).collect()}
    sets = {i: _shingles(t, width) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for i in ids:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i), i


def test_near_dedup_null_ids_and_large_nodes(spark, monkeypatch):
    rng = random.Random(5)
    words = [_word(rng) + str(k) for k in range(60)]
    rows = [(None, " ".join(words), "s"), (None, None, "s")]
    for i in range(80):  # a family of near copies, above the node size
        w = words[:]
        w[rng.randrange(60)] = f"x{i}"
        rows.append((i, " ".join(w), "s"))
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 16)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", 6)
    got = near_dedup.near_dedup(_docs(spark, rows)).collect()
    assert {r.component_id for r in got if r.doc_id is not None} == {0}
    assert all(r.component_id is None and not r.kept for r in got if r.doc_id is None)


def _family(n):
    """Documents alike at 158 / 200, but neighbours (2k, 2k + 1) at 160 / 198."""
    core = [f"c{k}" for k in range(158)]
    return [(i, " ".join(core + [f"p{i // 2}x{k}" for k in range(2)] + [f"d{i}x{k}" for k in range(19)]), "s") for i in range(n)]


def _neighbours(spark, n):
    got = near_dedup.near_dedup(_docs(spark, _family(n)), width=1).collect()
    return {r.doc_id: r.component_id for r in got}


def test_near_dedup_confirms_beyond_the_forests(spark, monkeypatch):
    for shingles in (1 << 21, 3000):
        monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", shingles, raising=False)
        assert _neighbours(spark, 60) == {i: i - i % 2 for i in range(60)}


def _blocks_of(nodes):
    """Node -> the pairs that meet in some block of it."""
    blocks, met = {}, {}
    for r in nodes.collect():
        blocks.setdefault((r.node, *(r[c] for c in nodes.columns if c not in ("node", "side", "rep"))), set()).add(r.rep)
    for (node, *_), reps in blocks.items():
        met.setdefault(node, set()).update(frozenset((a, b)) for a in reps for b in reps if a < b)
    return met


def test_near_dedup_compares_all_parts_of_a_large_node(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 8)
    monkeypatch.setattr(near_dedup, "MAX_DEPTH", near_dedup.DEPTH)
    assert _neighbours(spark, 60) == {i: i - i % 2 for i in range(60)}
    # in a node of equal signatures every pair meets
    reps = spark.createDataFrame([(k, b"abcd" * near_dedup.HASHES) for k in range(40)], "rep long, sig binary")
    every = {frozenset((a, b)) for a in range(40) for b in range(a)}
    assert all(pairs == every for pairs in _blocks_of(near_dedup._nodes(reps, 0.8, 0.9999)).values())


def test_near_dedup_recall_holds_in_deep_nodes(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "NODE_ROWS", 8)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 32, near_dedup.HASHES)
    # two rows agree in 0.8 of the places on average
    sigs = np.where(rng.random((200, near_dedup.HASHES)) < 0.1056, rng.integers(0, 1 << 32, (200, near_dedup.HASHES)), base).astype(np.uint32)
    reps = spark.createDataFrame([(k, s.tobytes()) for k, s in enumerate(sigs)], "rep long, sig binary")
    met = set()
    for pairs in _blocks_of(near_dedup._nodes(reps, 0.8, 0.9999)).values():
        met |= pairs
    want = {frozenset((a, b)) for a in range(200) for b in range(a) if (sigs[a] == sigs[b]).mean() >= 0.8}
    assert len(want) > 5000 and len(want - met) <= 0.0005 * len(want), len(want - met) / len(want)


def test_tree_count_reaches_recall():
    assert near_dedup.tree_count(0.8, 0.9999, 4) > near_dedup.tree_count(0.8, 0.9, 4)
    assert abs(near_dedup.survival(1.0, 5, 1.25) - 1) < 1e-12


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 480)] + [(1000, k) for k in range(1001, 1100)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}


def _covered(rows, length):
    seen = Counter(b[s:s + length] for b in rows for s in range(len(b) - length + 1))
    for b in rows:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = True
        yield gone


@pytest.mark.parametrize(("length", "gram", "piece", "key_rows"), [(400, 100, 1 << 20, 20_000), (40, 12, 600, 3), (16, 16, 100, 1)])
def test_suffix_dedup(spark, corpus, monkeypatch, length, gram, piece, key_rows):
    monkeypatch.setattr(suffix_dedup, "KEY_ROWS", key_rows)
    rows = [(k, t, s) for k, (_, t, s) in enumerate(corpus)]
    rows += [(len(rows), "xy " * 400, "s"), (len(rows) + 1, (corpus[5][1] + " ") * 3, "s")]
    if piece < 1 << 20:
        rows = rows[:40] + rows[85:]
    got = {r.doc_id: r for r in suffix_dedup.repeated_spans(_docs(spark, rows), length=length, gram=gram).collect()}
    data = [(i, (t or "").encode()) for i, t, _ in rows]
    for (i, b), gone in zip(data, _covered([b for _, b in data], length), strict=True):
        r = got[i]
        flags = np.zeros(len(b), bool)
        for s in r.spans:
            flags[s.start:s.end] = True
        assert r.n_bytes == len(b) and np.array_equal(flags, gone), i
        assert bytes(r.kept) == np.frombuffer(b, np.uint8)[~gone].tobytes()
        assert all(a.end < z.start for a, z in zip(r.spans, r.spans[1:]))


def test_suffix_pieces_overlap():
    # a long text in parts: every start is in one part, with its whole string
    rng = np.random.default_rng(0)
    offs = np.array([0, 50, 50, 1500, 1600])
    old, suffix_dedup.PIECE = suffix_dedup.PIECE, 200
    try:
        starts = [s for g in suffix_dedup._pieces(offs, 60) for _, a, b in g for s in range(a, b - 60 + 1)]
    finally:
        suffix_dedup.PIECE = old
    assert sorted(starts) == [*range(50, 1441), *range(1500, 1541)] and rng is not None


def test_suffix_index_levels():
    rng = np.random.default_rng(2)
    index, prints = suffix_dedup.SuffixIndex(), [rng.integers(0, 500, rng.integers(1, 40)).astype(np.uint64) for _ in range(13)]
    for p in prints:
        index.add(p)
    flat = np.concatenate(prints)
    count = Counter(flat.tolist())
    assert [bool(m) for m in index.matched] == [count[x] > 1 for x in flat.tolist()]
    assert [lvl is not None for lvl in index.levels] == [True, False, True, True]  # 13 = 1 + 4 + 8


def test_mixing(spark, corpus):
    rows = corpus[:-1]
    got = mixing.mix(_docs(spark, rows)).collect()
    again = mixing.mix(_docs(spark, rows).repartition(7)).collect()
    key = lambda rs: sorted((r.doc_id, r.copies, r.taken) for r in rs)
    assert key(got) == key(again)
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert all(r.size == size[r.doc_id] and r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in got)
    total = sum(size.values())
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r)
    assert sum(rs[0].target for rs in by.values()) == pytest.approx(total)
    names = sorted(s for s in by if s is not None) + [None]
    level = [rs[0].target / (1 + k % 3) for k, s in enumerate(names) if (rs := by[s])[0].target < 3 * rs[0].source_size - 1e-6]
    assert max(level) == pytest.approx(min(level))
    for rs in by.values():
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= max(r.size for r in rs)


def test_mix_rows_repeats_whole_rows(spark, corpus):
    rows = corpus[:-1]
    docs = _docs(spark, rows).withColumn("size", F.lit("mine"))
    out = mixing.mix_rows(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert Counter(r.doc_id for r in out.collect()) == Counter({i: c for i, c in copies.items() if c})


@pytest.mark.parametrize("run", [
    exact_dedup.exact_dedup, near_dedup.near_dedup, suffix_dedup.repeated_spans, mixing.mix, mixing.mix_rows])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], DOCS)).collect() == []
    blank = spark.createDataFrame([(1, None, None, None, None), (2, "", None, None, None)], DOCS)
    assert len(run(blank).collect()) == (0 if run is mixing.mix_rows else 2)
