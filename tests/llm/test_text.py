"""Token files, SentencePiece, language model, quality, chat and kNN."""

import io
import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from pricelens.llm import chat, hmm, knn, quality, sentencepiece_text, token_files
from pricelens.llm.queries import PIECES, TOKENIZER, tokenizer_path

HARD = ["", "  a  b\n\tc　d ﬁ Ａ ", " ", "a", " a", "   ", " " * 9 + "x", " " * 40, "梦梦日本語", "<s></s><unk>", "\x00a\x00",
        "x" * 500, "ab " * 300, "éß", "\U0001f469‍\U0001f469 ok", "\n\n  \n", "http://a.b/c?d=e&f", "        return x", "   a\u0085 b", "don't I'll",
        "<|endoftext|>", "1 22  333", "é été  à", "a  b", None]


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# ------------------------------------------------------------- token files
def test_elias_fano():
    rng = np.random.default_rng(4)
    for values in ([], [0], [0, 0, 0], [5], list(np.sort(rng.integers(0, 10**12, 500))), list(np.sort(rng.integers(0, 300, 1000))), [0, 2**62]):
        seq = token_files.EliasFano.from_bytes(token_files.EliasFano.of(values).to_bytes())
        assert seq.all().tolist() == [int(v) for v in values]
        assert [seq[i] for i in range(len(values))] == [int(v) for v in values]
    with pytest.raises(IndexError):
        seq[2]


def test_token_file_reads_back():
    out = io.BytesIO()
    ids = [np.array([5, 6, 2]), np.array([2]), np.array([60000, 2])]
    names = np.array([-9, 0, 7])
    blocks = [(np.concatenate(ids[:2]), np.array([3, 1]), (names[:2], np.array([False, True]))), (ids[2], np.array([2]), (names[2:], np.array([True])))]
    token_files.write_file(out, iter(blocks), np.dtype("<u2"))
    f = token_files.TokenFile(pa.BufferReader(out.getvalue()))
    assert [f[i].tolist() for i in range(len(f))] == [x.tolist() for x in ids]
    assert f.doc_ids() == [f.doc_id(i) for i in range(3)] == [None, 0, 7]


def test_encoder_matches_the_library():
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(tokenizer_path(TOKENIZER))  # as the library reads it, nothing switched
    coder = token_files.Encoder(tokenizer_path(TOKENIZER))
    rng = random.Random(2)
    texts = HARD + ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", " x\n<|endoftext|>\n\n y ", "<|endoftext|", "é<|endoftext|>é" * 50] \
        + ["".join(rng.choice("ab é\n '1.<　\t") for _ in range(rng.randrange(60))) for _ in range(300)]
    for _ in range(2):  # the second time from memory
        ids, n = coder.encode(pa.array(texts))
        ends = np.cumsum(n)
        for t, a, b in zip(texts, ends - n, ends, strict=True):
            assert ids[a:b].tolist() == tok.encode(t or "", add_special_tokens=False).ids, t


def test_token_files(spark):
    texts = HARD * 3
    docs = _texts(spark, texts).withColumn("doc_id", F.col("doc_id") * 5 - 100).withColumn("start", F.lit("mine"))
    manifest = token_files.write_token_files(docs, tokenizer_path(TOKENIZER), token_files.token_folder(spark), files=3)
    assert 1 <= manifest.count() <= 3
    coder, at = token_files.Encoder(tokenizer_path(TOKENIZER)), 0
    got = {r.id: r for r in token_files.read_token_files(manifest).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        ids = np.append(coder.encode(pa.array([t], pa.string()))[0], 2).astype("<u4")
        r = got[i * 5 - 100]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids))
        at += len(ids)


def test_token_files_empty_and_null_ids(spark):
    write = lambda d: token_files.read_token_files(token_files.write_token_files(d, tokenizer_path(TOKENIZER), token_files.token_folder(spark)))
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert write(empty).collect() == []
    rows = write(spark.createDataFrame([(None, "a"), (3, "b"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.id is None, r.n_tokens) for r in rows) == [(False, 2), (True, 1), (True, 2)]


# ----------------------------------------------------------- SentencePiece
def test_sentencepiece_matches_the_library(spark):
    import sentencepiece
    path = tokenizer_path(PIECES)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = random.Random(7)
    texts = HARD + ["a▁b", "▁"] + ["".join(rng.choice("the andion  \n梦é1") for _ in range(rng.randrange(80))) for _ in range(300)]
    m = sentencepiece_text.Model(path)
    for _ in range(2):
        ids, n = m.encode(pa.array(texts))
        ends = np.cumsum(n)
        for t, a, b in zip(texts, ends - n, ends, strict=True):
            assert ids[a:b].tolist() == sp.encode(t or ""), t
        assert m.decode(ids, n) == [(t or "").replace("▁", " ") for t in texts]
    for t in texts[:60]:  # the heap and the lattice agree
        for unit in (t or "").split():
            if not unit.startswith(" ") and len(unit.encode()) < 90:
                assert m.merge(unit.encode())[0] == m.relax(np.frombuffer(unit.encode(), np.uint8), np.array([0, len(unit.encode())]))[0].tolist()


def test_sentencepiece_frames(spark):
    path = tokenizer_path(PIECES)
    docs = _texts(spark, HARD).withColumn("ids", F.lit("mine"))
    enc = sentencepiece_text.encode(docs, path)
    assert enc.columns == ["doc_id", "text", "ids"]
    out = {r.doc_id: r for r in sentencepiece_text.decode(enc, path).collect()}
    assert all(out[i].decoded == (t or "") for i, t in enumerate(HARD))
    assert sentencepiece_text.encode(docs.limit(0), path).collect() == []
    null = spark.createDataFrame([(None,)], "ids array<int>")
    assert sentencepiece_text.decode(null, path).first().decoded == ""


# ---------------------------------------------------------- language model
def _brute(model, classes):
    a, total = model.start, 0.0
    for t, c in enumerate(classes):
        a = (a if t == 0 else a @ model.move) * model.emit[:, c]
        total += math.log10(a.sum())
        a = a / a.sum()
    return total


def test_forward_and_expected_counts():
    rng = np.random.default_rng(1)
    mass = rng.uniform(0.1, 1, 100)
    model = hmm.Model.initial(mass / mass.sum(), 0.01)
    assert model.emit.sum(axis=1) == pytest.approx(1) and model.move.sum(axis=1) == pytest.approx(1)
    n = np.array([3, 1, 700, 40])
    obs = rng.integers(0, 50, n.sum())
    ends = np.cumsum(n)
    assert model.log10(obs, n) == pytest.approx([_brute(model, obs[a:b]) for a, b in zip(ends - n, ends, strict=True)])
    start, move, emit = model.expected(obs, n)
    # every token is emitted once; every token of a text but the first is moved to
    assert emit.sum() == pytest.approx(n.sum()) and start.sum() == pytest.approx(len(n))
    assert move.sum() == pytest.approx(n.sum() - len(n))
    assert np.bincount(obs, minlength=emit.shape[1]) == pytest.approx(emit.sum(axis=0))
    before = model.log10(obs, n).sum()
    assert hmm.Model.of_counts(start, move, emit[:, :-1], mass / mass.sum(), 0.01).log10(obs, n).sum() > before


def test_expected_counts_against_enumeration():
    mass = np.full(50, 1 / 50)
    model = hmm.Model.initial(mass, 0.01)
    obs = [4, 9, 4]
    want = np.zeros((hmm.STATES, hmm.STATES))
    total = 0.0
    for p in np.ndindex(*(hmm.STATES,) * 3):
        w = model.start[p[0]] * model.emit[p[0], obs[0]]
        for t in (1, 2):
            w *= model.move[p[t - 1], p[t]] * model.emit[p[t], obs[t]]
        total += w
        for t in (1, 2):
            want[p[t - 1], p[t]] += w
    assert model.expected(np.array(obs), np.array([3]))[1] == pytest.approx(want / total)


@pytest.mark.parametrize("length", [1, 255, 256, 257, 700, 1024])
def test_expected_counts_carry_across_segments(length):
    rng = np.random.default_rng(length)
    mass = rng.uniform(0.1, 1, 30)
    model = hmm.Model.initial(mass / mass.sum(), 0.01)
    model.move = rng.dirichlet(np.ones(hmm.STATES), hmm.STATES)  # forgets slowly or fast
    obs = rng.integers(0, 31, length)
    alpha, beta = np.empty((length, hmm.STATES)), np.ones((length, hmm.STATES))
    for t in range(length):
        alpha[t] = (model.start if t == 0 else alpha[t - 1] @ model.move) * model.emit[:, obs[t]]
        alpha[t] /= alpha[t].sum()
    for t in range(length - 2, -1, -1):
        beta[t] = model.move @ (model.emit[:, obs[t + 1]] * beta[t + 1])
        beta[t] /= beta[t].sum()
    gamma = alpha * beta
    gamma /= gamma.sum(axis=1, keepdims=True)
    move, emit = np.zeros((hmm.STATES, hmm.STATES)), np.zeros((hmm.STATES, 31))
    for t in range(length):
        emit[:, obs[t]] += gamma[t]
        if t:
            x = alpha[t - 1][:, None] * model.move * (model.emit[:, obs[t]] * beta[t])
            move += x / x.sum()
    # among other texts, whose segments are worked on side by side
    others = [rng.integers(0, 31, k) for k in (3, 600, 256)]
    got = model.expected(np.concatenate([others[0], obs, *others[1:]]), np.array([3, length, 600, 256]))
    rest = model.expected(np.concatenate(others), np.array([3, 600, 256]))
    for have, less, want in zip(got, rest, (gamma[0], move, emit), strict=True):
        assert have - less == pytest.approx(want, abs=1e-9)


def test_classes_grow_with_the_corpus(spark):
    sizes = []
    for n in (40, 4000):
        # a word in every second place, and words that occur once
        words = [("the", f"w{i}")[i % 2] for i in range(n)]
        totals = hmm.word_counts(hmm.encode_blocks(_texts(spark, [None, " ".join(words)]), "doc_id", "text", 1000))
        classes, mass, _, _ = hmm.class_counts(totals)
        assert mass.sum() == n + 2 and classes.buckets ** 2 >= n + 2 > classes.buckets ** 2 / 4
        the, end = classes.of(np.array([xxhash.xxh64_intdigest(b"the"), hmm.END_HASH], np.uint64)).tolist()
        assert the < len(classes.own) and end < len(classes.own) and mass[the] == n // 2 and mass[end] == 2
        sizes.append(classes.size)
    assert sizes[1] > 5 * sizes[0]


def test_states_help_on_held_out_texts(spark):
    rng = random.Random(8)
    # each text keeps to one of two vocabularies, of which every word is known
    texts = [" ".join(f"{'ab'[i % 2]}{rng.randrange(30)}" for _ in range(400)) for i in range(200)]
    rows = [r for r in hmm.score(_texts(spark, texts)).collect() if r.held_out]
    assert len(rows) > 10 and all(r.n_known == r.n_tokens for r in rows)
    # nothing comes from the unknown word's mass here
    gain = sum(r.score - r.base_score for r in rows) / sum(r.n_tokens for r in rows)
    assert gain > 0.1


def test_language_model(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["The", "the", "cat", "sat", "on", "a", "mat", f"w{rng.randrange(40)}"]) for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "the  \n cat\x0bé"]
    docs = _texts(spark, texts).withColumn("score", F.lit("mine"))
    got = {r.id: r for r in hmm.score(docs, rounds=2).collect()}
    words = [[*("".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")).split(), None] for t in texts]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    c = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(c.values()), len(c)
    for i, (ws, h) in enumerate(zip(words, held, strict=True)):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r.score < 0 and math.isfinite(r.score)


def test_language_model_edges(spark):
    assert hmm.score(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = hmm.score(spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")).collect()
    assert sorted((r.id, r.held_out, r.n_tokens) for r in rows) == [(None, False, 1), (None, False, 3)]
    only_held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = hmm.score(spark.createDataFrame([(i, "a b") for i in only_held], "doc_id long, text string")).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and math.isfinite(r.score) for r in rows)


# ------------------------------------------------------------------ quality
def _quality_rows(rng, n):
    for i in range(n):
        words = ["".join(rng.choice("etaoin") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(20, 80))]
        bad = i % 4 == 0
        yield i, " ".join(w + rng.choice(["%%%", "$$$"]) if bad else w for w in words), "en", f"s{i % 5}", len(words) * 5, int(not bad)


def test_quality_classifier(spark):
    rows = list(_quality_rows(random.Random(1), 400))
    docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % 2 == 0] + [(None, 1), (2, None), (99999, 0)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    held = [r for r in rows if r[0] % 2]
    assert np.mean([(got[r[0]] >= 0.5) == bool(r[5]) for r in held]) > 0.98
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(s >= 0.5 for s in got.values())


def test_quality_learns_from_all_unlabelled_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "CONFIDENT", 0.9)
    # labels show one mark of bad text; a source's documents bear another, one in 900 of the table
    rng = random.Random(4)
    rows = []
    for i in range(9000):
        bad, rare = i % 9 == 0, i >= 8990
        mark = "~~" if rare else "%%" if bad else ""
        rows.append((i, " ".join("".join(rng.choice("etaoin") for _ in range(4)) + mark for _ in range(8)), "en", "junk" if bad or rare else "fine", 40))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    labels = spark.createDataFrame([(i, int(i % 9 > 0)) for i in range(400)], "doc_id long, quality int")
    model = quality.fit(docs, labels, "doc_id", "text", "quality", list(quality.META), 1)
    # what the sources' names tell reaches the text view for every such document
    assert model.taught[-1][0] >= sum(r[3] == "junk" for r in rows[400:])


class _PlainPool:
    """The pool by brute force: each row's lesson is kept, not derived."""

    def __init__(self, views):
        self.views, self.said, self.known = views, [np.full(len(views[0]), -1), np.full(len(views[0]), -1)], 0

    def _learn(self, past):
        for teachers in past[self.known:]:
            for a, (line, high, low) in enumerate(teachers):
                for i, x in enumerate(self.views[a]):
                    at = float(x.astype(np.float64) @ line[:-1] + line[-1])
                    if self.said[1 - a][i] < 0 and (at >= high or at <= low):
                        self.said[1 - a][i] = int(at >= high)
        self.known = len(past)

    def confident(self, lines, past):
        self._learn(past)
        out = []
        for a, line in enumerate(lines):
            at = (self.views[a] @ line[:-1] + line[-1])[self.said[1 - a] < 0]
            out.append(np.bincount(quality._bin(at), minlength=quality.BINS))
        return out, len(self.views[0])

    def newton(self, lines, past):
        self._learn(past)
        out = []
        for v, said, line in zip(self.views, self.said, lines, strict=True):
            d = len(line)
            rows, s1, s2, g, h = 0, np.zeros(d - 1), np.zeros(d - 1), np.zeros(d), np.zeros((d, d))
            for x, y in zip(v[said >= 0].astype(np.float64), said[said >= 0], strict=True):
                z = np.append(x, 1.0)
                p = 1 / (1 + math.exp(-min(30, max(-30, z @ line))))
                rows, s1, s2, g, h = rows + 1, s1 + x, s2 + x * x, g + z * (y - p), h + np.outer(z, z) * (p * (1 - p) + 1e-9)
            out.append(np.concatenate(([rows], s1, s2, g, h[np.triu_indices(d)])))
        return out


def test_quality_equals_brute_force_cotraining(spark, monkeypatch):
    monkeypatch.setattr(quality, "CONFIDENT", 0.9)
    rows = list(_quality_rows(random.Random(5), 240))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([r[:5] for r in rows], schema).repartition(3)
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] < 80], "doc_id long, quality int")
    model = quality.fit(docs, labels, "doc_id", "text", "quality", list(quality.META), 2)
    views = [quality.text_features(pa.array([r[1] for r in rows])), quality.meta_features([pa.array([r[j] for r in rows]) for j in (2, 3, 4)])]
    plain = quality.CoTrained([v[:80] for v in views], np.array([r[5] for r in rows[:80]], np.float64), _PlainPool([v[80:] for v in views]), 2)
    assert model.taught == plain.taught and sum(map(sum, model.taught)) > 0
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels, rounds=2).collect()}
    assert [got[r[0]] for r in rows] == pytest.approx(plain.score(views)[0].tolist(), abs=1e-6)


@pytest.mark.parametrize("good, bad", [("日月火水木金土山川田", "口目耳手足車門馬鳥魚"), ("абвгдежзик", "лмнопрстуф"), ("กขคงจฉชซญฐ", "ดตถทธนบปผฝ")])
def test_quality_in_other_scripts(spark, good, bad):
    rng = random.Random(6)
    # nothing but the characters tells, in texts without spaces
    rows = [(i, "".join(rng.choice(bad if i % 4 == 0 else good) for _ in range(rng.randint(40, 90))), "xx", f"s{i % 3}", 60) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(0, 300, 1) if i % 2 or i % 8 == 0], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert all((got[i] >= 0.5) == (i % 4 > 0) for i in range(300) if not (i % 2 or i % 8 == 0))


def test_quality_learns_from_a_row_of_a_repeated_id(spark, monkeypatch):
    rows = list(_quality_rows(random.Random(1), 120))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([r[:5] for r in rows], schema)
    many = docs.unionByName(spark.range(20000).selectExpr("3L doc_id", "concat('%%% ', id) text", "'en' lang", "'s0' source", "9L n_chars"))
    labels = spark.createDataFrame([(r[0], r[5]) for r in rows if r[0] % 2 or r[0] % 8 == 0], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "CoTrained", lambda views, y, pool, rounds: seen.append(len(y)))
    quality.fit(many, labels, "doc_id", "text", "quality", list(quality.META), 1)
    assert seen == [labels.count()]


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (None, "a", "x", "y", 3), (1, "", None, None, -4)], "doc_id long, text string, lang string, source string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == [1.0] * 3
    one = spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    assert {r.score for r in quality.quality_scores(docs.withColumn("score", F.lit("mine")), one).collect()} == {0.0}
    assert quality.quality_scores(docs.limit(0), one).collect() == []


# --------------------------------------------------------------------- chat
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\\", "\\<|turn|>a<|text|>", "<\\|end|>", "", None, "a\nb\\n", "<<SYS>>x<</SYS>>[\\INST]", "<|", "<", "|end|>"]


def test_chat_round_trip(spark):
    rows = [(c, t, ["user", "assistant", "system", None, "we|ird\n<|text|>"][(t + c) % 5], NASTY[(t * 3 + c) % len(NASTY)]) for c in range(8) for t in range(c + 1)]
    rows += [(None, 0, "user", "x"), (3, 0, "assistant", "tie")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("head", F.lit(1))
    chats = chat.format_chats(chat.canonical_turns(table))
    got = {r.conv_id: r for r in chat.read_chats(chats).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns = [t[1:] for t in sorted(turns)]
        assert [tuple(t) for t in got[c].turns] == turns
        assert got[c].loss_text == "".join(x for r, x in turns if r == "assistant")
        for s in got[c].loss_spans:
            assert "<|" not in got[c].formatted[s.start:s.end]
    assert chat.format_chats(chat.canonical_turns(table.limit(0))).collect() == []


def test_chat_layouts(spark):
    want = [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    tables = [
        spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")], 5)], "conv_id long, messages array<struct<role:string,content:string>>, extra int"),
        spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "conv_id long, conversations array<struct<from:string,value:string>>"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, prompt string, completion string"),
        spark.createDataFrame([(1, "q", "a")], "conv_id long, instruction string, output string"),
        spark.createDataFrame([(1, "q", "", "a")], "conv_id long, instruction string, input string, output string"),
    ]
    for t in tables:
        assert sorted(map(tuple, chat.canonical_turns(t).collect())) == want
    with pytest.raises(ValueError, match="no known chat layout"):
        chat.canonical_turns(spark.createDataFrame([(1, "q")], "conv_id long, question string"))


def test_chat_layout_with_further_known_fields(spark):
    known = sorted({p.split("[")[0] for paths, _ in chat.LAYOUTS.values() for p in paths})
    turns = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes")], "conv_id long, turn long, role string, text string")
    want = [tuple(r) for r in chat.canonical_turns(turns).orderBy("turn").collect()]
    for name in known:
        if name not in ("turn", "role", "text"):
            more = turns.withColumn(name, F.lit("mine"))
            assert chat.layout_of(more) == "turn_rows" and [tuple(r) for r in chat.canonical_turns(more).orderBy("turn").collect()] == want
    assert chat.layout_of(turns.withColumns({n: F.lit("mine") for n in known if n not in turns.columns})) == "turn_rows"
    shouted = turns.toDF("CONV_ID", "Turn", "ROLE", "Text")
    assert [tuple(r) for r in chat.canonical_turns(shouted).orderBy("turn").collect()] == want
    # of several layouts that are there, the one with the most paths
    both = spark.createDataFrame([(1, "i", "x", "o", "p", "c")], "conv_id long, instruction string, input string, output string, prompt string, completion string")
    assert chat.layout_of(both) == "instruction_input_output"
    with pytest.raises(ValueError):
        chat.layout_of(turns.drop("role").withColumn("prompt", F.lit("p")))


def test_chat_json_records_with_further_fields(spark):
    rows = [(1, '{"system": "s", "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}'),
            (2, '{"prompt": "p", "response": "r", "input": ""}'), (3, '{"prompt": "p"}')]
    df = spark.createDataFrame(rows, "conv_id long, record string")
    assert {r.conv_id: r.layout for r in chat.json_layouts(df).collect()} == {1: "messages", 2: "prompt_response", 3: None}
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.json_turns(df).collect())
    assert got == [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "p"), (2, 1, "assistant", "r")]


def test_chat_json_records(spark):
    records = [{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "id": 3},
               {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, {"prompt": "q", "response": "a"},
               {"instruction": "q", "input": "more", "output": "a"}, {"question": "?"}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)] + [(8, "not json"), (9, None)], "conv_id long, record string")
    names = {r.conv_id: r.layout for r in chat.json_layouts(df).collect()}
    assert names == {0: "messages", 1: "from_value", 2: "prompt_response", 3: "instruction_input_output", 4: None, 8: None, 9: None}
    turns = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.json_turns(df).collect())
    assert turns == sorted((i, t, r, x) for i, q in ((0, "q"), (1, "q"), (2, "q"), (3, "q\n\nmore")) for t, r, x in ((0, "user", q), (1, "assistant", "a")))


def test_chat_json_records_with_nulls(spark):
    records = [{"prompt": None, "response": "a"}, {"messages": [{"role": "user", "content": None}, {"role": "assistant", "content": "a"}]},
               {"messages": [{"content": "q"}, {"role": "assistant", "content": "a"}]}, {"prompt": "q", "response": "a", "completion": None}, {"messages": None}, {"messages": ["x"]}]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(records)], "conv_id long, record string")
    names = {r.conv_id: r.layout for r in chat.json_layouts(df).collect()}
    assert names == {0: "prompt_response", 1: "messages", 2: "messages", 3: "prompt_response", 4: None, 5: None}
    turns = sorted((r.conv_id, r.turn, r.role or "", r.text or "") for r in chat.json_turns(df).collect())
    assert turns == [(0, 0, "user", ""), (0, 1, "assistant", "a"), (1, 0, "user", ""), (1, 1, "assistant", "a"),
                     (2, 0, "", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q"), (3, 1, "assistant", "a")]


# ---------------------------------------------------------------------- kNN
def _nearest(rows, k, every):
    ints = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, a in ints:
        if i % every == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in ints if j != i)[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(s)]
    return Counter(out)


def test_knn(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(3 * (i % 4 == d), 1) for d in range(6)]) for i in range(300)]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, None), (303, [1.0, None]), (304, [float("nan")] * 6), (305, [float("inf")] * 6), (310, []), (320, [2.0]),
             (None, [1.0] * 6), (330, [1e5] * 6), (340, [0.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit("mine"))
    for blocks in (8192, 37):
        monkeypatch.setattr(knn, "BLOCK_ROWS", blocks)
        monkeypatch.setattr(knn, "QUERY_BLOCK_ROWS", blocks)
        got = knn.knn_join(df, F.col("vec_id") % 10 == 0, pivots=12, query_pivots=4).collect()
        assert Counter(map(tuple, got)) == _nearest(rows, 5, 10)


def test_knn_far_groups_are_ruled_out(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(20.0 * (i % 5 == d), 0.2) for d in range(5)]) for i in range(200)]
    seen = []
    real = knn._ruled_out
    monkeypatch.setattr(knn, "_ruled_out", lambda *a: seen.append(real(*a)) or seen[-1])
    got = knn.knn_join(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 4 == 0, pivots=20, query_pivots=10).collect()
    assert Counter(map(tuple, got)) == _nearest(rows, 5, 4)
    assert max(seen) >= 100


def test_knn_edges(spark):
    kind = "vec_id long, embedding array<double>"
    assert knn.knn_join(spark.createDataFrame([], kind), F.col("vec_id") == 1).collect() == []
    few = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [1.0, 2.0])], kind)
    assert sorted(map(tuple, knn.knn_join(few, F.col("vec_id") == 2).collect())) == [(2, 1, 1, 5 * 65536), (2, 2, 3, 5 * 65536)]
    assert knn.knn_join(few, F.col("vec_id") == 9).collect() == []
    twice = spark.createDataFrame([(1, [1.0]), (1, [2.0]), (2, [1.0])], kind)
    assert Counter(map(tuple, knn.knn_join(twice, F.col("vec_id") == 1).collect())) == Counter([(1, 1, 2, 65536), (1, 1, 2, 131072)])
    big = spark.createDataFrame([(1, [2.0**54]), (2, [2.0**54])], kind)
    with pytest.raises(Exception, match="beyond 64 bits"):
        knn.knn_join(big, F.col("vec_id") == 1).collect()



def test_class_counts_over_blocks(spark):
    words = [f"w{i % 97}" for i in range(500)] + ["once", "twice", "twice"]
    docs = _texts(spark, [" ".join(words[i::7]) for i in range(7)] * 2 + [""]).repartition(5)
    blocks = hmm.encode_blocks(docs, "doc_id", "text", 10)
    totals = hmm.word_counts(blocks)
    got = {r.word: r.n for r in totals.collect()}
    held = {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 10 == 0}
    want = Counter(hmm._signed(xxhash.xxh64_intdigest(w)) for r in docs.collect() if r.doc_id not in held for w in [*(x.encode() for x in r.text.split()), b""])
    assert {k: n for k, n in got.items() if n} == want
    classes, mass, known, once = hmm.class_counts(totals)
    cls = classes.of(np.array([k % (1 << 64) for k in want], np.uint64))
    assert mass.tolist() == np.bincount(cls, list(want.values()), classes.size).tolist()
    assert known.tolist() == np.bincount(cls, minlength=classes.size).tolist()
    assert once == sum(n == 1 for n in want.values())
    sizes = {r.block: len(r.hashes) // 8 for r in blocks.collect()}
    found = {r.block: np.frombuffer(r.found, "<i8") for r in hmm.counts_of_blocks(blocks, totals).collect()}
    assert {b: len(c) for b, c in found.items()} == sizes
    for r in blocks.collect():
        assert found[r.block].tolist() == [got[h] for h in np.frombuffer(r.hashes, "<i8").tolist()]
