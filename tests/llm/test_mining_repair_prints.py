"""Hard negatives, conversation repair and SimHash against brute force."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelens.llm import hard_negatives, repair, simhash
from pricelens.llm.queries import damaged

VECTORS = "vec_id long, embedding array<float>, label int, part int, blk string"


# ---- hard negatives -----------------------------------------------------------------
def _mined(rows, k=5):
    ok = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for i, v, lab in ok:
        if i % 3:
            continue
        scored = sorted((-dot(v, w), j, m) for j, w, m in ok if j != i)
        for s, j, m in [x for x in scored if x[2] == lab][:k]:
            p = -s
            for rank, (t, n, _) in enumerate([x for x in scored if x[2] != lab and 80 * p <= -100 * x[0] <= 100 * p][:k], 1):
                out[(i, j, rank, n, p, -t)] += 1
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_hard_negatives(spark, monkeypatch, clustered):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 8)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "PAGE_ZONES", 3)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12)) * 4
    rows = []
    for i in range(150):
        v = centres[i % 6] + rng.normal(size=12) * 0.2 if clustered else rng.normal(size=12)
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 4))))
    same = rows[4][1]
    rows += [(200 + i, same, i % 3) for i in range(40)]  # ties
    rows += [(300, None, 1), (303, [1.0, None], 1), (306, [float("nan")] * 12, 2), (309, [1.0] * 12, None), (None, [1.0] * 12, 1), (312, [2.0, 1.0], 1), (315, [], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = Counter(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") % 3 == 0).collect())
    assert got == _mined(rows) and got


def test_hard_negatives_repeated_ids_and_empty_table(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    got = sorted(tuple(r) for r in hard_negatives.mine(df, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 1, 2, 65536, 58880)] * 2
    assert hard_negatives.mine(df.where("false"), F.col("vec_id") % 3 == 0).collect() == []
    assert hard_negatives.mine(df, F.lit(False)).collect() == []


def test_hilbert_curve_visits_neighbours():
    side = range(8)
    cells = np.array(list(itertools.product(side, side, side)))
    keys = hard_negatives.hilbert_keys(cells, 3)
    assert len(set(keys)) == len(cells)
    walk = cells[sorted(range(len(cells)), key=lambda i: keys[i])]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_every_vector():
    rng = np.random.default_rng(1)
    v, a = rng.integers(-300, 300, (50, 7)), rng.integers(-300, 300, (9, 7))
    low, high = hard_negatives.bounds(a, v.min(axis=0)[None], v.max(axis=0)[None])
    s = a @ v.T
    assert (low[:, 0] <= s.min(axis=1)).all() and (high[:, 0] >= s.max(axis=1)).all()


def test_zone_maps_rule_out_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(2)
    # far apart clusters with labels of their own and, in each, a few strangers
    rows = [(i, [float(x) for x in np.eye(8)[i % 8] * 4 + rng.normal(size=8) * 0.05], i % 8 if i % 50 else 9, 1, "x") for i in range(4000)]
    seen = {}
    true_needed = hard_negatives._needed

    def needed(blocks, groups, n, dim, test, name):
        out = true_needed(blocks, groups, n, dim, test, name)
        seen[name] = (out.count(), blocks.count() * n)
        return out

    monkeypatch.setattr(hard_negatives, "_needed", needed)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", 4)
    got = hard_negatives.mine(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 100 == 0)
    assert Counter(tuple(r) for r in got.collect())
    assert all(read < 0.6 * every for read, every in seen.values())


# ---- conversation repair ----------------------------------------------------------------
def _fault(rows, i):
    role, text = rows[i]
    words = [c for c in text if c not in " \t\n\v\f\r"]
    if not words:
        return "blank"
    if (role, text) in rows[:i]:
        return "duplicate"
    return "truncated" if words[-1] not in ".!?" else "sound"


def _cheapest(rows):
    """(cost, audit, repaired) by trying every edit, turn by turn."""
    best = {"": (0, "", "")}

    def better(d, state, way):
        if state not in d or way < d[state]:
            d[state] = way

    def filled(states):
        d = dict(states)
        for _ in range(2):
            for st, (c, a, o) in list(d.items()):
                word = "assistant" if st == "u" else "user"
                better(d, word[0], (c + 3, a + "I", o + f"{word}:\n"))
        return d

    for i, (role, text) in enumerate(rows):
        fault, new = _fault(rows, i), {}
        stay = 3 if fault == "truncated" else 0
        for st, (c, a, o) in filled(best).items():
            better(new, st, (c + 4, a + "D", o))
            if fault in ("blank", "duplicate"):
                continue
            word = "assistant" if st == "u" else "user"
            better(new, word[0], (c + 3 + stay, a + "R", o + f"{word}:{text}\n"))
            if role[:1] == word[0] or (role[:1] == "s" and st == ""):
                better(new, role[:1], (c + stay, a + "K", o + f"{role}:{text}\n"))
        best = new
    return min(filled(best)[s] for s in ("", "a") if s in filled(best))


def _report(rows):
    """rows: (turn, role, text) of one conversation."""
    text = lambda x: " " if x is None else x
    rows = sorted(((t is not None, t or 0, text(r), hashlib.sha256(text(x).encode()).hexdigest(), text(x)) for t, r, x in rows))
    turns = [t for known, t, *_ in rows if known]
    said = [(r, x) for _, _, r, _, x in rows]
    faults = Counter(_fault(said, i) for i in range(len(said)))
    illegal = sum((a[0][:1], b[0][:1]) not in (("s", "u"), ("u", "a"), ("a", "u")) for a, b in zip(said, said[1:]))
    cost, audit, out = _cheapest(said)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
            hashlib.sha256(out[:-1].encode() if out else b"").hexdigest())


def _conversations():
    rng = random.Random(11)
    texts = ["Yes.", "No!", "why?", "cut off", "", " \t", None, "Yes. ", "é…", "a" * 3000 + "."]
    rows = []
    for conv in [None, *range(60)]:
        n = 300 if conv == 7 else rng.randint(1, 9)
        for turn in range(n):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 1, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(texts)))
    return rows + rows[:5]


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_repair(spark, monkeypatch, block_rows):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block_rows)
    rows = _conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, pos string, key int")
    report, turns = repair.repair(df)
    digest = {r["key"]: r["sha256"] for r in repair.digests(turns).collect()}
    got = {r.conv_id: tuple(r)[1:] for r in report.collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        want[conv] = _report([r[1:] for r in rows if r[0] == conv])
    assert {c: w[:-1] for c, w in want.items()} == got
    empty = hashlib.sha256(b"").hexdigest()
    assert {c: w[-1] for c, w in want.items()} == {c: digest.get("" if c is None else f"={c}", empty) for c in got}


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    report, turns = repair.repair(empty)
    assert report.collect() == [] and turns.collect() == [] and repair.digests(turns).collect() == []


def test_hirschberg_takes_the_ascii_least_audit():
    rng = random.Random(4)
    roles = {0: "x", 1: "system", 2: "user", 3: "assistant"}
    for _ in range(400):
        turns = [(rng.randint(0, 3), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 14))]
        audit = "".join(a for _, a in repair.hirschberg(turns, 0, repair.CLOSED))
        # every turn its own text, and its fault told apart by it
        said, kinds = [], {0: "sound", 1: "blank", 2: "duplicate", 3: "truncated"}
        for i, (initial, fault) in enumerate(turns):
            said.append((roles[initial], f"{i}.", kinds[fault]))
        best = {"": (0, "")}
        close = lambda d: {**{s: w for s, w in d.items()}}
        for role, _, fault in said:
            new = {}
            reach = close(best)
            for _ in range(2):
                for st, (c, a) in list(reach.items()):
                    to = "a" if st == "u" else "u"
                    if to not in reach or (c + 3, a + "I") < reach[to]:
                        reach[to] = (c + 3, a + "I")
            for st, (c, a) in reach.items():
                ways = [(st, 4, "D")]
                if fault in ("sound", "truncated"):
                    stay = 3 * (fault == "truncated")
                    to = "a" if st == "u" else "u"
                    ways.append((to, 3 + stay, "R"))
                    if role[0] == to or (role[0] == "s" and st == ""):
                        ways.append((role[0], stay, "K"))
                for to, c2, letter in ways:
                    if to not in new or (c + c2, a + letter) < new[to]:
                        new[to] = (c + c2, a + letter)
            best = new
        ends = [(c + {"": 0, "a": 0, "u": 3, "s": 6}[st], a + {"": "", "a": "", "u": "I", "s": "II"}[st]) for st, (c, a) in best.items()]
        closing = "I" * (min(ends)[1].count("I") - audit.count("I"))
        assert audit + closing == min(ends)[1]


def test_damage(spark):
    rows = [(i // 10, i % 10, "assistant", f"Text {i}. Yes!") for i in range(400)] + [(None, None, None, None)]
    got = Counter(tuple(r) for r in damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect())
    want = Counter()
    for c, t, r, x in rows:
        how = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if how:
            want[(c, t, "user" if how == 4 else r, "" if how == 1 else x.replace(".", "").replace("!", "").replace("?", "") if how == 2 else x)] += 2 if how == 3 else 1
    assert got == want


# ---- SimHash ---------------------------------------------------------------------------
def _docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, part string, rid int")


def test_edited_texts_and_likeness(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    rows = [(i * 3, " ".join(word() for _ in range(rng.randint(30, 200)))) for i in range(80)]
    rows += [(1, None), (2, ""), (4, " \n"), (5, "one"), (7, "x" * 40000), (8, rows[3][1]), (10, "ab " * 30000)]
    got = {r.doc_id: r for r in simhash.edited_fingerprints(_docs(spark, rows)).collect()}
    order = sorted(rows)
    prints = {r.id: r.fingerprint for r in simhash.simhash(_docs(spark, rows)).collect()}
    assert len(got) == len(rows)
    for (i, t), (j, u) in zip(order, order[1:] + order[:1]):
        t, u = t or "", u or ""
        k = len(t) // 4
        edited = t[:len(t) - k] + u[:k]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert f"{got[i].fp % 2**64:016x}" == prints[i] and got[i].next_fp == got[j].fp
    assert got[8].fp == got[9].fp and got[1].fp == got[2].fp == got[4].fp == 0
    differ = lambda a, b: bin((a ^ b) % 2**64).count("1")
    near = [differ(got[i].fp, got[i].edited_fp) for i, t in rows[:80]]
    far = [differ(got[i].fp, got[i].next_fp) for i, t in rows[:80]]
    assert sum(near) < 0.65 * sum(far)


def test_edited_texts_repeated_and_null_ids(spark):
    rows = [(5, f"text {i}") for i in range(300)] + [(None, f"none {i}") for i in range(100)] + [(9, "nine words")]
    got = simhash.edited_fingerprints(_docs(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    # every text is the next document of exactly one row
    assert Counter(r.next_fp for r in got) == Counter(r.fp for r in got)
    alone = simhash.edited_fingerprints(_docs(spark, [(3, "a b c d e f g h")])).first()
    assert alone.next_fp == alone.fp and alone.edited_sha256 == hashlib.sha256(b"a b c d e f a b").hexdigest()
    assert simhash.edited_fingerprints(_docs(spark, [])).collect() == []


def test_bits_are_the_weighted_majority(spark):
    text = "to be or not to be that is the question to be"
    w = spark.createDataFrame([(text,)], "text string").select(simhash._hashes(F.col("text")).alias("h")).first().h
    pairs = spark.createDataFrame(list(zip(w, w[1:])), "a long, b long").select(F.xxhash64("a", "b").alias("p")).collect()
    votes = [0] * 64
    for h, weight in [(x, 1) for x in w] + [(r.p, 3) for r in pairs]:
        for b in range(64):
            votes[b] += weight if h >> b & 1 else -weight
    want = sum(1 << b for b in range(64) if votes[b] > 0)
    got = simhash.simhash(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().fingerprint
    assert int(got, 16) == want


def test_within_radius_finds_all(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PACK_ROWS", 16)
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = [b ^ sum(1 << x for x in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(40)] + base[:3] * 50
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r.fp: r.n_near for r in simhash.within_radius(df.limit(100), df).collect()}
    assert got == {p: sum(bin((p ^ q) % 2**64).count("1") <= 3 for q in signed) for p in set(signed[:100])}


def test_simhash_query(spark, tmp_path):
    from pricelens.llm.queries import op13_simhash
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(300)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 120))) for _ in range(60)]
    rows = [(i, texts[i % 45] if i % 7 else texts[3]) for i in range(100)] + [(100, None), (120, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op13_simhash(spark, str(tmp_path)).collect()}
    prints = {i: int(got[i].fingerprint, 16) for i in got}
    alike = lambda a, b: 1 - bin(a ^ b).count("1") / 64
    for k, (i, t) in enumerate(rows):
        j, u = rows[(k + 1) % len(rows)]
        t, u = t or "", u or ""
        cut = len(t) // 4
        assert got[i].edited_sha256 == hashlib.sha256((t[:len(t) - cut] + u[:cut]).encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].near_edited == alike(prints[i], int(got[i].edited_fingerprint, 16)) and got[i].near_next == alike(prints[i], prints[j])
        near = sum(bin(prints[i] ^ p).count("1") <= 3 for p in prints.values()) - 1
        assert got[i].n_near == (near if i % 20 == 0 else None)
