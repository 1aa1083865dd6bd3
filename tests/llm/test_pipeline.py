"""The corpus pipeline's stages, each against a plain statement of its rule on its own input."""

import random
from collections import Counter

import pytest

import corpus_pipeline as P
from pricelens.llm import mixing
from pricelens.llm.queries import PIECES, tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(240):
        words = [word() for _ in range(rng.randint(30, 90))]
        if i % 6 == 0:
            words = [w + rng.choice(["%%%", "$$$", "###"]) for w in words]
        rows.append([i, " ".join(words), "en", f"s{i % 4}"])
    good = [r for r in rows if r[0] % 6]
    for i in range(240, 260):
        rows.append([i, good[i % 10][1], "en", "s1"])  # exact copies
    for i in range(260, 290):
        w = good[20 + i % 10][1].split()
        w[rng.randrange(len(w))] = word()
        rows.append([i, " ".join(w), "en", "s2"])  # near copies
    rows = [(*r, len(r[1])) for r in rows] + [(900, None, None, None, None), (901, "", "en", None, 0)]
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 6 != 0 or r[0] >= 240)) for r in rows if r[0] % 2 == 0 and r[0] < 900] + [(901, 1)], "doc_id long, quality int") \
        .write.parquet(f"{path}/labels.parquet")
    return path


def _shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_stages(spark, sf_dir):
    assert [n for n, _ in P.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames, at = [docs], docs
    for _, step in P.STAGES:
        at = step(spark, at, sf_dir)
        frames.append(at)
    rows = [f.collect() for f in frames]
    assert all(f.columns == docs.columns for f in frames[:-1])
    # the classifier rejects junk, and nothing else
    judged = {r.doc_id for r in rows[1]}
    assert {i for i in range(290) if i % 6 or i >= 240} <= judged
    assert not judged & {i for i in range(0, 240, 6)}
    # of equal texts the largest id stays
    best = {}
    for r in rows[1]:
        best[r.text or ""] = max(best.get(r.text or "", -1), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(best.values())
    # of each near-duplicate class the smallest id stays
    sets = {r.doc_id: _shingles(r.text) for r in rows[2]}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r.doc_id for r in rows[3]) == sorted(i for i in sets if find(i) == i)
    assert len(rows[3]) < len(rows[2]) < len(rows[1]) < len(rows[0])
    # documents are repeated or left out as the mixture says
    copies = {r.doc_id: r.copies for r in mixing.mix(frames[3]).collect()}
    assert Counter(r.doc_id for r in rows[4]) == Counter({i: c for i, c in copies.items() if c})
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECES))
    texts = {r.doc_id: r.text for r in rows[4]}
    assert len(rows[5]) == len(rows[4])
    assert all(r.same_text and list(r.ids) == sp.encode(texts[r.doc_id] or "") and r.n_pieces == len(r.ids) for r in rows[5])


def test_run_equals_its_stages(spark, sf_dir):
    once = P.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in P.STAGES:
        docs = step(spark, docs, sf_dir)
    key = lambda f: sorted((r.doc_id, r.n_pieces, list(r.ids)) for r in f.collect())
    assert key(once) == key(docs)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []


CLASHING = ["_cell", "_bucket", "_bits", "_maybe", "_gone", "_text", "_m0", "_M1"]


def test_columns_of_the_pipelines_own_names_stay(spark, sf_dir):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING})
    plain = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for stage in (P.quality_stage, P.near_stage):
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        rows = out.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in stage(spark, plain, sf_dir).collect())
        assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING)
