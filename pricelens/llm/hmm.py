"""Language-model scoring with a hidden Markov model over word classes.

Every word's count in the training documents gives the base (unigram) model.
With N training tokens there are C classes by hash, C the power of two at or
above the root of N; a word that makes up 1 / C of the tokens or more (there are
at most C such), the end of a text and the unknown word are classes of their own.
So the classes grow with the corpus, and the model's tables with its root.  The
model emits a class from a latent state and then a word from its class as the
base model would:

    log P(text) = log P_hmm(classes) + sum over tokens of
                  [log P_base(word) - log P_base(class)]

which is a probability over texts of known and unknown words.  Baum-Welch
trains the states: each task adds up its expected counts of starts,
transitions and emissions, and the counts are summed by ranges of classes across
partitions.  Scores come from the scaled forward recursion over whole texts.

The texts are read and cut into words once, into blocks of a bounded number of
bytes: a block's distinct words and its texts as indices into them.  Words'
counts are summed over all blocks by an aggregate on word hashes, and each block
gets its own words' counts back by a join, so texts do not travel and no task
holds the words of all blocks.  Training
works on segments of ``SEGMENT`` tokens side by side: each segment's product of
transitions and emissions carries the forward vector into the next one and the
backward vector into the one before, so the expected counts are those of whole
texts.

Defined results: a null text is empty and is the end token alone; a null id
scores like any other and, its crc32 being null, counts as training; repeated
rows are rows of their own; an empty table gives an empty table; other columns
are ignored.  Without training documents every word is unknown and the model
starts from its initial state.  Words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import byte_slices, slots, stage, words

STATES = 6
ROUNDS = 3
SEGMENT = 256
# segments worked on at once
SEGMENTS = 2048
BLOCK_BYTES = 8 << 20
ADD = 0.1
FOLDS = 10
# classes whose expected counts travel in one row
RANGE = 4096
# share of the class frequencies mixed into every state's emissions
PRIOR = 0.05
# the end token's place in the table of words (no word is empty)
END_HASH = xxhash.xxh64_intdigest(b"")

_BLOCKS = "block long, ids binary, null_ids binary, held_out binary, n_words binary, tokens binary, order binary, hashes binary, counts binary"


def _longs(x) -> bytes:
    return np.ascontiguousarray(x, "<i8").tobytes()


def _block(doc_ids: pa.Array, text: pa.Array, held: np.ndarray, block: int) -> dict:
    """A block's row: its texts as indices of its distinct words, and those
    words' hashes (ascending) and training counts."""
    arr, n = words(text)
    coded = arr.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()] + [END_HASH], np.uint64)
    hashes, place = np.unique(known, return_inverse=True)
    # each text's words, then the end
    ends = np.cumsum(n)
    tokens = np.insert(place[which], ends, place[-1]).astype("<u4")
    train = np.repeat(~held, n + 1)
    counts = np.bincount(tokens[train], minlength=len(hashes))
    # frequent words get small numbers, which compress
    order = np.argsort(-np.bincount(tokens, minlength=len(hashes)), kind="stable").astype("<u4")
    number = np.empty(len(order), "<u4")
    number[order] = np.arange(len(order))
    return {"block": block, "ids": _longs(doc_ids.fill_null(0).to_numpy(zero_copy_only=False)),
            "null_ids": np.packbits(doc_ids.is_null().to_numpy(zero_copy_only=False)).tobytes(),
            "held_out": np.packbits(held).tobytes(), "n_words": _longs(n + 1),
            "tokens": zlib.compress(_shuffled(number[tokens]), 1), "order": order.tobytes(), "hashes": hashes.astype("<u8").tobytes(), "counts": _longs(counts)}


def _shuffled(x: np.ndarray) -> bytes:
    """32-bit numbers by byte planes, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unshuffled(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def encode_blocks(df: DataFrame, id_col: str, text_col: str, folds: int) -> DataFrame:
    """``df``'s texts as blocks, stored."""
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                     (F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")), F.lit(folds)), F.lit(1)) == 0).alias("held"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, wait, size = TaskContext.get().partitionId() << 32, [], 0

        def out():
            t = pa.Table.from_batches(wait).combine_chunks()
            col = lambda n: t.column(n).combine_chunks() if t.column(n).num_chunks != 1 else t.column(n).chunk(0)
            return pa.RecordBatch.from_pylist([_block(col("id"), col("text"), col("held").to_numpy(zero_copy_only=False), block)], schema=kind)

        kind = pa.schema([(n, pa.int64() if t == "long" else pa.binary()) for n, t in (x.split() for x in _BLOCKS.split(", "))])
        for batch in batches:
            for piece in byte_slices(batch, "text", BLOCK_BYTES):
                nbytes = piece.column("text").nbytes
                if wait and size + nbytes > BLOCK_BYTES:
                    yield out()
                    block, wait, size = block + 1, [], 0
                wait.append(piece)
                size += nbytes
        if sum(p.num_rows for p in wait):
            yield out()

    return stage(docs.mapInArrow(encode, _BLOCKS), "hmm-blocks")


def word_entries(blocks: DataFrame) -> DataFrame:
    """A row a distinct word of each block: (block, at, word, n), ``at`` its place
    in the block and ``n`` its training count there."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashes, counts in zip(*(batch.column(i) for i in range(3)), strict=True):
                h = np.frombuffer(hashes.as_buffer(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), block.as_py())), pa.array(np.arange(len(h), dtype=np.int32)),
                                                  pa.array(h), pa.array(np.frombuffer(counts.as_buffer(), "<i8"))], ["block", "at", "word", "n"])

    return blocks.select("block", "hashes", "counts").mapInArrow(deal, "block long, at int, word long, n long")


def word_counts(blocks: DataFrame) -> DataFrame:
    """Every word's training count over all documents: (word, n), stored.

    A hash aggregate that combines in the map tasks and spills: no task holds more
    than its memory of a word range, however many blocks there are."""
    return stage(word_entries(blocks).groupBy("word").agg(F.sum("n").alias("n")), "hmm-words")


class Classes:
    """Words of their own class (hashes in ascending order), then ``buckets``
    classes by hash, a power of two; the unknown word comes after them."""

    def __init__(self, own: np.ndarray, buckets: int):
        self.own, self.buckets, self.size = own, buckets, len(own) + buckets

    def of(self, h: np.ndarray) -> np.ndarray:
        """Class of each word hash."""
        at = np.minimum(np.searchsorted(self.own, h), len(self.own) - 1)
        return np.where(self.own[at] == h, at, len(self.own) + (h & np.uint64(self.buckets - 1)).astype(np.int64))


def class_counts(totals: DataFrame) -> tuple[Classes, np.ndarray, np.ndarray, int]:
    """The classes, training count and number of known words of each, and how many
    words were seen once.

    With C buckets, words of 1 / C of all tokens or more number at most C, so at
    most 2 C + 1 rows come here, C being below twice the root of the tokens."""
    seen = totals.where("n > 0")
    total, once = (int(x or 0) for x in seen.agg(F.sum("n"), F.count_if(F.col("n") == 1)).first())
    buckets = 1 << ((max(total - 1, 0).bit_length() + 1) // 2)
    own = (F.col("n") >= -(-total // buckets)) | (F.col("word") == _signed(END_HASH))
    alone = seen.where(own).select("word", "n").toArrow()
    word = alone.column(0).to_numpy().astype(np.int64).view(np.uint64)
    classes = Classes(np.unique(np.append(word, np.uint64(END_HASH))), buckets)
    got = seen.where(~own).groupBy(F.col("word").bitwiseAND(F.lit(buckets - 1)).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toArrow()
    mass, known = np.zeros(classes.size), np.zeros(classes.size)
    at = classes.of(word)
    mass[at], known[at] = alone.column(1).to_numpy(), 1
    at = len(classes.own) + got.column(0).to_numpy()
    mass[at], known[at] = got.column(1).to_numpy(), got.column(2).to_numpy()
    return classes, mass, known, once


def counts_of_blocks(blocks: DataFrame, totals: DataFrame) -> DataFrame:
    """Per block the counts over all documents of its words, in their order."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            block, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.append(0, np.flatnonzero(np.diff(block)) + 1)
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)], strict=True):
                if held and block[a] != now:
                    yield pa.RecordBatch.from_pydict({"block": [now], "found": [_longs(np.concatenate(held))]})
                    held = []
                if b > a:
                    now = int(block[a])
                    held.append(n[a:b])
        if held:
            yield pa.RecordBatch.from_pydict({"block": [now], "found": [_longs(np.concatenate(held))]})

    # a word of every block is one row of ``totals``: a skewed join splits its entries
    found = word_entries(blocks).select("block", "at", "word").join(totals, "word").select("block", "at", "n")
    return found.repartition("block").sortWithinPartitions("block", "at").select("block", "n").mapInArrow(pack, "block long, found binary")


def _signed(h: int) -> int:
    """A 64-bit hash as Spark's long of the same bits."""
    return h - (1 << 64) if h >> 63 else h


# --------------------------------------------------------------- the model
class Model:
    """start [K], move [K, K], emit [K, classes + 1]; the last class is the unknown word."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, mass: np.ndarray, unseen: float) -> Model:
        """States near the class frequencies, told apart by a fixed perturbation."""
        rng = np.random.default_rng(9)
        move = np.full((STATES, STATES), 0.2 / (STATES - 1))
        np.fill_diagonal(move, 8.0)
        return cls.of_counts(np.ones(STATES), move, mass * rng.uniform(0.5, 1.5, (STATES, len(mass))), mass, unseen)

    @classmethod
    def of_counts(cls, start, move, emit, mass: np.ndarray, unseen: float) -> Model:
        """From expected counts of the known classes, mixed with the classes'
        frequencies; every state keeps ``unseen`` for the unknown word."""
        emit = (1 - PRIOR) * emit / np.maximum(emit.sum(axis=1, keepdims=True), 1e-300) + PRIOR * mass / mass.sum()
        emit = np.append(emit / emit.sum(axis=1, keepdims=True) * (1 - unseen), np.full((STATES, 1), unseen), axis=1)
        start, move = start + 0.1, move + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit)

    def log10(self, obs: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 probability of each class sequence (``n[i]`` of ``obs`` in
        turn) by the scaled forward recursion, longest sequences first."""
        order = np.argsort(-n, kind="stable")
        length, begin = n[order], (np.cumsum(n) - n)[order]
        active = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), side="left")
        out, table = np.zeros(len(n)), np.ascontiguousarray(self.emit.T)
        a = np.broadcast_to(self.start, (len(n), STATES))
        for t, k in enumerate(active.tolist()):
            a = (a[:k] if t == 0 else a[:k] @ self.move) * table[obs[begin[:k] + t]]
            s = a.sum(axis=1)
            out[:k] += np.log10(s)
            a = a / s[:, None]
        back = np.empty(len(n))
        back[order] = out
        return back

    def _across(self, obs: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of each segment the product of its emissions and the transitions between
        them, [n, K, K] and up to a factor: what a forward vector, predicted for
        its first token, becomes by its end."""
        out, table = np.empty((len(size), STATES, STATES)), np.ascontiguousarray(self.emit.T)
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(size), SEGMENTS):
            which = order[lo:lo + SEGMENTS]
            b, m = begin[which], size[which]
            active = np.searchsorted(-m, -np.arange(int(m[0])), side="left").tolist()
            a = np.eye(STATES) * table[obs[b]][:, None, :]
            for t, k in enumerate(active[1:], 1):
                x = (a[:k].reshape(-1, STATES) @ self.move).reshape(k, STATES, STATES) * table[obs[b[:k] + t]][:, None, :]
                # a factor a segment, often enough that nothing underflows
                a[:k] = x / x.sum(axis=(1, 2), keepdims=True) if t % 8 == 0 else x
            out[which] = a / a.sum(axis=(1, 2), keepdims=True)
        return out

    def _carried(self, obs: np.ndarray, begin: np.ndarray, size: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each segment (a text's in a row, ``parts`` of each text) the forward
        vector at the end of the one before and the backward vector at its own end."""
        before, after = np.ones((len(size), STATES)), np.ones((len(size), STATES))
        first = np.cumsum(parts) - parts
        order = np.argsort(-parts, kind="stable")
        order = order[parts[order] > 1]
        if not len(order):
            return before, after
        first, count = first[order], parts[order]
        # only the segments of texts of several
        long = np.repeat(parts > 1, parts)
        place = np.cumsum(long) - 1
        through = self._across(obs, begin[long], size[long])
        active = np.searchsorted(-count, -np.arange(int(count[0])), side="left").tolist()
        a = np.broadcast_to(self.start, (len(order), STATES))
        for j, k in enumerate(active[1:], 1):
            a = np.einsum("ni,nij->nj", a[:k], through[place[first[:k] + j - 1]])
            a = a / a.sum(axis=1, keepdims=True)
            before[first[:k] + j] = a
            a = a @ self.move
        b = np.ones((0, STATES))
        for j in range(len(active) - 1, 0, -1):
            k = active[j]
            b = np.concatenate((b, np.ones((k - len(b), STATES))))
            b = np.einsum("nij,nj->ni", through[place[first[:k] + j]], b) @ self.move.T
            b = b / b.sum(axis=1, keepdims=True)
            after[first[:k] + j - 1] = b
        return before, after

    def expected(self, obs: np.ndarray, n: np.ndarray):
        """Baum-Welch expected counts over the whole sequences, segment by segment."""
        begin = np.cumsum(n) - n
        parts = -(-n // SEGMENT)
        which = np.repeat(np.arange(len(n)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = begin[which] + nth * SEGMENT
        size = np.minimum(SEGMENT, n[which] - nth * SEGMENT)
        before, after = self._carried(obs, begin, size, parts)
        start, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, self.emit.shape[1]))
        table = np.ascontiguousarray(self.emit.T)
        order = np.argsort(-size, kind="stable")
        first = nth[order] == 0
        begin, size, before, after = begin[order], size[order], before[order], after[order]
        for lo in range(0, len(size), SEGMENTS):
            at = slice(lo, lo + SEGMENTS)
            b, m, f, prev, tail = begin[at], size[at], first[at], before[at], after[at]
            steps = int(m[0])
            active = np.searchsorted(-m, -np.arange(steps), side="left")
            alpha, scale, seen = [], [], []
            a = np.where(f[:, None], self.start, prev @ self.move)
            for t in range(steps):
                k = active[t]
                o = obs[b[:k] + t]
                e = table[o]
                a = (a[:k] if t == 0 else a[:k] @ self.move) * e
                s = a.sum(axis=1, keepdims=True)
                a = a / s
                alpha.append(a)
                scale.append(s)
                seen.append((o, e))

            def ending(t, k, alpha=alpha, tail=tail):
                """Backward vectors of the segments from row ``k`` on, which end at ``t``."""
                x = tail[k:len(alpha[t])]
                return x / (alpha[t][k:] * x).sum(axis=1, keepdims=True)

            beta = ending(steps - 1, 0)
            gammas, classes = [], []
            for t in range(steps - 1, -1, -1):
                g = alpha[t] * beta
                gammas.append(g)
                classes.append(seen[t][0])
                w = seen[t][1] * beta / scale[t]
                if t:
                    k = active[t]
                    move += alpha[t - 1][:k].T @ w
                    beta = np.concatenate((w @ self.move.T, ending(t - 1, k)))
                else:
                    # from the segment before
                    move += prev[~f].T @ w[~f]
            start += gammas[-1][f].sum(axis=0)
            g, c = np.concatenate(gammas), np.concatenate(classes)
            for k in range(STATES):
                emit[k] += np.bincount(c, g[:, k], emit.shape[1])
        return start, move * self.move, emit


def _sequences(row: dict):
    """A block's (ids, held out, tokens of each, token indices, hashes)."""
    n = np.frombuffer(row["n_words"], "<i8")
    held = np.unpackbits(np.frombuffer(row["held_out"], np.uint8), count=len(n)).astype(bool)
    tokens = np.frombuffer(row["order"], "<u4").astype(np.int64)[_unshuffled(zlib.decompress(row["tokens"]))]
    return n, held, tokens, np.frombuffer(row["hashes"], "<u8")


def train(blocks: DataFrame, classes: Classes, mass: np.ndarray, unseen: float, rounds: int) -> Model:
    """Baum-Welch over all training documents, ``rounds`` passes.

    A round's counts are a table of states by classes from each task; tasks are as
    many as the session's shuffle partitions at most, whatever the input."""
    model, spark = Model.initial(mass, unseen), blocks.sparkSession
    width = classes.size + 1 + STATES
    texts = blocks.select("n_words", "held_out", "tokens", "order", "hashes").coalesce(slots(spark))
    kind = "at int, v binary"
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            sums = None
            for batch in batches:
                for row in batch.to_pylist():
                    n, held, tokens, hashes = _sequences(row)
                    use = np.repeat(~held, n)
                    if use.any():
                        got = model.expected(classes.of(hashes)[tokens[use]], n[~held])
                        sums = got if sums is None else tuple(x + y for x, y in zip(sums, got, strict=True))
            if sums is not None:
                # the known classes, then the start and the moves
                all_ = np.concatenate((sums[2][:, :classes.size], sums[0][:, None], sums[1]), axis=1).astype("<f4")
                for at in range(0, width, RANGE):
                    yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "v": pa.array([all_[:, at:at + RANGE].tobytes()], pa.binary())})

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                for at, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    sums[at] = sums.get(at, 0) + np.frombuffer(v, "<f4").astype(np.float64)
            for at, v in sums.items():
                yield pa.RecordBatch.from_pydict({"at": pa.array([at], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})

        # a row a range of classes
        got = texts.mapInArrow(expect, kind).repartition(min(slots(spark), -(-width // RANGE)), "at").mapInArrow(merge, kind).toArrow()
        if not got.num_rows:
            return model
        all_ = np.zeros((STATES, width))
        for at, v in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
            all_[:, at:at + RANGE] = np.frombuffer(v).reshape(STATES, -1)
        model = Model.of_counts(all_[:, classes.size], all_[:, classes.size + 1:], all_[:, :classes.size], mass, unseen)
    return model


def score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS, rounds: int = ROUNDS) -> DataFrame:
    """Every document's id with ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities)."""
    blocks = encode_blocks(df, id_col, text_col, folds)
    totals = word_counts(blocks)
    classes, mass, known, once = class_counts(totals)
    total, vocab = int(mass.sum()), int(known.sum())
    space = total + ADD * (vocab + 1)
    # the share of words seen once estimates that of words not seen (Good-Turing)
    unseen = min(0.5, (once + ADD) / (total + 1))
    # base probability of each class and of the unknown word
    mass = (mass + ADD * known) / space
    unknown = ADD / space
    model = train(blocks, classes, mass, unseen, rounds) if total else Model.initial(np.full(classes.size, 1 / classes.size), unseen)
    full = blocks.select("block", "ids", "null_ids", "held_out", "n_words", "tokens", "order", "hashes").join(counts_of_blocks(blocks, totals), "block")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(divide="ignore"):
            class_log = np.log10(np.append(mass, unknown))
        for batch in batches:
            for row in batch.to_pylist():
                n, held, tokens, hashes = _sequences(row)
                c = np.frombuffer(row["found"], "<i8")
                cls = np.where(c > 0, classes.of(hashes), classes.size)
                base = np.log10((c + ADD) / space)
                ends = np.cumsum(n)
                add = lambda x: np.add.reduceat(x[tokens], ends - n)
                low = add(base)
                null = np.unpackbits(np.frombuffer(row["null_ids"], np.uint8), count=len(n)).astype(bool)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(np.frombuffer(row["ids"], "<i8"), mask=null), "held_out": pa.array(held), "n_tokens": pa.array(n),
                    "n_known": pa.array(add((c > 0).astype(np.int64))), "train_tokens": pa.array(np.full(len(n), total)),
                    "base_score": pa.array(low), "score": pa.array(low - add(class_log[cls]) + model.log10(cls[tokens], n))})

    return full.mapInArrow(read, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
