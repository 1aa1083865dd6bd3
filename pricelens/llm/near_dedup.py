"""MinHash near-dedup by a chosen-path set similarity join.

A document is the set of its word shingles; documents of equal sets collapse
to one representative.  Each of a number of independent trees branches the
representatives recursively: a node picks one or two of the minwise tokens
(1 / threshold on average; the choice depends on the node alone) and every
document follows the values it has there.  Two documents of similarity s share
a path with a probability that falls slowly with the depth, so a few trees
reach the recall aimed at (``recall``).  Nodes of one document die out; nodes
above ``NODE_ROWS`` branch deeper, and the documents they hold follow more
trees, as many as the recall takes at the depth reached; the others are
compared exhaustively by their minwise sketches.  What is still larger at the greatest depth (copies
alike all over) is cut into parts, and every two of them are compared.

Of a node's similar pairs, ``FORESTS`` edge-disjoint spanning forests are
confirmed on the full sets first, the most similar pairs first.  Where forests
left pairs out and their confirmed links do not make the node one component,
all its similar pairs across components are compared by their full sets, block
against block.  The connected components of all confirmed links are the classes.

Defined results: a null text is empty; a text with fewer words than a shingle
is one shingle of all its words; without words the set is empty and linked
with nothing; a null id is linked with nothing and has a null component and
``kept`` false; rows that repeat an id and text get the same result; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import byte_slices, mix64, slots, stage, words
from pricelens.llm.components import components
from pricelens.llm.filters import split_by_keys

THRESHOLD_PERCENT = 80
SHINGLE = 5
HASHES = 128
RECALL = 0.9999
DEPTH = 4
MAX_DEPTH = 16
NODE_ROWS = 4096
FORESTS = 4
# shingles of a block whose full sets are compared in one task with another's
BLOCK_SHINGLES = 1 << 21
# sketches this many standard deviations below the threshold are still compared in full
DEVIATIONS = 3.5
SLICE_BYTES = 4 << 20

_RNG = np.random.default_rng(80)
_FACTORS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


# ------------------------------------------------------------------- the sets
def shingle_sets(col: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Each text's set of shingle hashes, ascending."""
    arr, n = words(col)
    coded = arr.dictionary_encode()
    known = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    h = known[coded.indices.to_numpy(zero_copy_only=False)] if len(known) else np.zeros(0, np.uint64)
    rolled = h
    if len(h):
        rolled = np.full(len(h), width, np.uint64)
        for i in range(width):
            rolled = mix64(rolled ^ np.roll(h, -i))
    end = 0
    for k in n.tolist():
        begin, end = end, end + k
        if k >= width:
            yield np.unique(rolled[begin:end - width + 1])
        elif k:
            one = np.full(1, k, np.uint64)
            for i in range(begin, end):
                one = mix64(one ^ h[i])
            yield one
        else:
            yield np.zeros(0, np.uint64)


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minwise values (32 bits) of each non-empty set."""
    flat = np.concatenate(sets)
    at = np.cumsum([0] + [len(s) for s in sets[:-1]])
    out = np.empty((len(sets), HASHES), np.uint32)
    for i in range(HASHES):
        out[:, i] = np.minimum.reduceat((((flat ^ _SHIFTS[i]) * _FACTORS[i]) >> np.uint64(32)).astype(np.uint32), at)
    return out


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """(id, n, k1, k2, sig): set size, 128-bit set key and signature, stored."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in byte_slices(batch, "text", SLICE_BYTES):
                sets = list(shingle_sets(piece.column("text"), width))
                full = [i for i, s in enumerate(sets) if len(s)]
                sig, keys = [None] * len(sets), np.zeros((2, len(sets)), np.uint64)
                if full:
                    some = [sets[i] for i in full]
                    for i, s in zip(full, signatures(some), strict=True):
                        sig[i] = s.tobytes()
                    flat, at = np.concatenate(some), np.cumsum([0] + [len(s) for s in some[:-1]])
                    for j in (0, 1):
                        keys[j, full] = np.add.reduceat(mix64(flat ^ np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1)), at)
                yield pa.RecordBatch.from_pydict({"id": piece.column("id"), "n": pa.array([len(s) for s in sets], pa.int64()),
                                                  "k1": pa.array(keys[0].view(np.int64)), "k2": pa.array(keys[1].view(np.int64)),
                                                  "sig": pa.array(sig, pa.binary())})

    return stage(docs.mapInArrow(sign, "id long, n long, k1 long, k2 long, sig binary"), "near-signed")


# ------------------------------------------------------------------ the trees
def survival(similarity: float, depth: int, branches: float) -> float:
    """Probability that two documents of ``similarity`` share a path of
    ``depth``, when a node has one branch or, with the rest of ``branches``, two."""
    two, lost = branches - 1, 0.0
    for _ in range(depth):
        miss = 1 - similarity + similarity * lost
        lost = (1 - two) * miss + two * miss * miss
    return 1 - lost


def tree_count(threshold: float, recall: float, depth: int) -> int:
    """Trees to find a pair at the threshold with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(threshold, depth, 1 / threshold)))


def _branch(sig: np.ndarray, row: np.ndarray, path: np.ndarray, levels: int, threshold: float):
    """Follows every (row, path) ``levels`` deeper."""
    for _ in range(levels):
        r = mix64(path)
        # the share of nodes with a second branch makes 1 / threshold on average
        second = np.flatnonzero((r >> np.uint64(40)).astype(np.float64) < (1 / threshold - 1) * (1 << 24))
        row = np.concatenate((row, row[second]))
        path = np.concatenate((path, path[second]))
        pick = np.concatenate((r % np.uint64(HASHES), (r[second] % np.uint64(HASHES) + np.uint64(1) + (r[second] >> np.uint64(8)) % np.uint64(HASHES - 1)) % np.uint64(HASHES)))
        value = sig[row, pick.astype(np.int64)].astype(np.uint64)
        path = mix64(path ^ (pick << np.uint64(32)) ^ value * np.uint64(0x9E3779B97F4A7C15))
    return row, path


def _paths(reps: DataFrame, levels: int, threshold: float, trees: range | None = None) -> DataFrame:
    """(node, rep) of each path; from the trees' roots, or from a ``node`` column."""
    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                b = batch.slice(at, 2048)
                sig = np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint32).reshape(-1, HASHES)
                row = np.arange(len(sig))
                if trees:
                    path = np.repeat(mix64(np.array(trees, np.uint64)), len(sig))
                    row = np.tile(row, len(trees))
                else:
                    path = b.column("node").to_numpy().view(np.uint64)
                row, path = _branch(sig, row, path, levels, threshold)
                yield pa.RecordBatch.from_pydict({"node": pa.array(path.view(np.int64)), "rep": b.column("rep").take(pa.array(row))})

    return reps.mapInArrow(follow, "node long, rep long")


def _blocks(rows: DataFrame, parts) -> DataFrame:
    """Every two of a node's ``parts`` (dealt by hash) as a block (node, i, j);
    ``side`` is the row's own part."""
    dealt = rows.withColumn("side", F.pmod(F.xxhash64("node", "rep"), parts)) \
        .withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)))
    return dealt.withColumns({"i": F.least("side", "_other"), "j": F.greatest("side", "_other")}).drop("_other")


def _grown(reps: DataFrame, threshold: float, trees: range) -> tuple[DataFrame, DataFrame | None, int]:
    """Who meets where in ``trees``, in blocks (node, i, j, side, rep); the
    documents of nodes that went deeper than DEPTH; and the depth reached."""
    depth, done, deep = DEPTH, None, None
    paths = stage(_paths(reps.select("rep", "sig"), depth, threshold, trees), "near-paths")
    while True:
        # two rows of one node may be one document on two branches
        sizes = stage(paths.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("rep").alias("first"), F.max("rep").alias("last"))
                      .where("first < last").select("node", "size"), "near-sizes")
        met = paths.join(sizes.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).drop("_node")
        last = depth >= MAX_DEPTH or sizes.where(F.col("size") > NODE_ROWS).isEmpty()
        some = met if last else met.where(F.col("size") <= NODE_ROWS)
        parts = F.when(F.col("size") <= NODE_ROWS, F.lit(1).cast("bigint")).otherwise(F.ceil(F.col("size") * 2 / NODE_ROWS))
        some = _blocks(some.select("node", "rep", parts.alias("parts")), F.col("parts")).select("node", "i", "j", "side", "rep")
        done = some if done is None else done.unionByName(some)
        if last:
            return done, deep, depth
        large = met.where(F.col("size") > NODE_ROWS).select("node", "rep")
        if deep is None:
            deep = stage(large.select(F.col("rep").alias("_rep")).dropDuplicates(), "near-deep")
        more = large.join(reps.select(F.col("rep").alias("_rep"), "sig"), F.col("rep") == F.col("_rep"))
        paths = stage(_paths(more.select("node", "rep", "sig"), 2, threshold), "near-paths")
        depth += 2


def _nodes(reps: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, i, j, side, rep): who meets where, in blocks of NODE_ROWS or so."""
    trees = range(1, tree_count(threshold, recall, DEPTH) + 1)
    done, deep, depth = _grown(reps, threshold, trees)
    # fewer pairs survive to a greater depth: their documents follow more trees
    while deep is not None and (count := tree_count(threshold, recall, depth)) >= trees.stop:
        trees = range(trees.stop, count + 1)
        some, _, reached = _grown(reps.join(deep, F.col("rep") == F.col("_rep"), "left_semi"), threshold, trees)
        done, depth = done.unionByName(some), max(depth, reached)
    return done


# ---------------------------------------------------------- comparing a node
def forests(a: np.ndarray, b: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Edges of FORESTS successive edge-disjoint maximum spanning forests
    (each by rounds in which every tree takes its best edge to another)."""
    order = np.argsort(-weight.astype(np.int64), kind="stable")
    a, b, left, kept = a[order], b[order], np.arange(len(order)), []
    for _ in range(FORESTS):
        tree, used = np.arange(n), np.zeros(len(order), bool)
        live = left
        while len(live):
            x, y = tree[a[live]], tree[b[live]]
            apart = x != y
            live, x, y = live[apart], x[apart], y[apart]
            if not len(live):
                break
            # edges are numbered best first
            best = np.full(n, len(order))
            np.minimum.at(best, x, live)
            np.minimum.at(best, y, live)
            for e in np.unique(best[best < len(order)]).tolist():
                u, v = tree[a[e]], tree[b[e]]
                if u != v:
                    used[e] = True
                    tree[tree == v] = u
        kept.append(np.flatnonzero(used))
        left = left[~used[left]]
        if not len(left):
            break
    return order[np.concatenate(kept)]


def _meetings(side: np.ndarray) -> Iterator[tuple[int, int]]:
    """(row, the first row it is compared with) of a block in order of
    ``side``: with the other side, or all with all in a block of one."""
    other = int(np.searchsorted(side, side[-1]))
    return ((k, other or k + 1) for k in range(other or len(side) - 1))


def similar_pairs(rep: np.ndarray, side: np.ndarray, sketch: np.ndarray, low: int):
    """Pairs (a, b), a < b, of one block whose sketches agree in ``low`` places
    or more, thinned to forests, and whether that left any out."""
    at = np.unique(rep, return_index=True)[1]
    at = at[np.argsort(side[at], kind="stable")]
    rep, side, sketch = rep[at], side[at], sketch[at]
    n = len(rep)
    lists = []
    for i, later in _meetings(side):
        agree = (sketch[later:] == sketch[i]).sum(axis=1)
        j = np.flatnonzero(agree >= low)
        if len(j):
            lists.append((np.full(len(j), i), j + later, agree[j]))
    if not lists:
        return rep[:0], rep[:0], False
    a, b, w = (np.concatenate(x) for x in zip(*lists, strict=True))
    keep = forests(a, b, w, n) if n > 2 else np.arange(len(a))
    a, b, cut = rep[a[keep]], rep[b[keep]], len(keep) < len(a)
    return np.minimum(a, b), np.maximum(a, b), cut


def _least_agreement(threshold: float) -> int:
    """Places in which the sketches of a pair to be compared in full agree at least."""
    return math.floor((threshold - DEVIATIONS * math.sqrt(threshold * (1 - threshold) / HASHES)) * HASHES)


def _whole_groups(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[pa.Table]:
    """Rows in order of ``keys``, cut only where one of them changes."""
    held = None
    for batch in batches:
        t = pa.concat_tables(([held] if held is not None else []) + [pa.Table.from_batches([batch])])
        if not t.num_rows:
            continue
        values = [t.column(k).to_numpy() for k in keys]
        # the last group may go on in the next batch
        other = np.flatnonzero(np.any([v != v[-1] for v in values], axis=0))
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield t.slice(0, cut)
        held = t.slice(cut)
    if held is not None and held.num_rows:
        yield held


def _starts(t: pa.Table, *keys: str) -> np.ndarray:
    """Where the groups of equal ``keys`` begin, and the end."""
    values = [t.column(k).to_numpy() for k in keys]
    return np.concatenate(([0], np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1, [t.num_rows]))


def _candidates(nodes: DataFrame, reps: DataFrame, low: int) -> DataFrame:
    """Distinct (a, b), a < b, similar by their 8-bit sketches in some node; and
    rows without a and b for each ``node`` whose forests left pairs out."""
    sketches = reps.select(F.col("rep").alias("_rep"), "sketch")
    rows = nodes.join(sketches, F.col("rep") == F.col("_rep")).select("node", "i", "j", "side", "rep", "sketch")
    rows = rows.repartition(slots(reps.sparkSession), "node", "i", "j").sortWithinPartitions("node", "i", "j")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, "node", "i", "j"):
            node, side, rep = (t.column(c).to_numpy() for c in ("node", "side", "rep"))
            sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
            at = _starts(t, "node", "i", "j")
            begin, end = at[:-1], at[1:]
            two = np.flatnonzero(end - begin == 2)
            x = begin[two]
            ok = ((sketch[x] == sketch[x + 1]).sum(axis=1) >= low) & (rep[x] != rep[x + 1])
            pairs, thinned = [(np.minimum(rep[x], rep[x + 1])[ok], np.maximum(rep[x], rep[x + 1])[ok])], []
            for i, j in zip(begin.tolist(), end.tolist(), strict=True):
                if j - i > 2:
                    a, b, cut = similar_pairs(rep[i:j], side[i:j], sketch[i:j], low)
                    pairs.append((a, b))
                    thinned += [node[i]] if cut else []
            a, b = (np.concatenate(p) for p in zip(*pairs, strict=True))
            p = np.unique(np.stack((a, b)), axis=1) if len(a) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(p[0], pa.int64()), "b": pa.array(p[1], pa.int64()), "node": pa.nulls(p.shape[1], pa.int64())})
            none = pa.nulls(len(thinned), pa.int64())
            yield pa.RecordBatch.from_pydict({"a": none, "b": none, "node": pa.array(thinned, pa.int64())})

    return rows.mapInArrow(compare, "a long, b long, node long").dropDuplicates()


# ----------------------------------------------------------------- confirming
def _sets(wanted: DataFrame, rows: int, docs: DataFrame, width: int) -> DataFrame:
    """(id, s): the full sets of the documents in ``wanted`` (``rows`` of column want), stored."""
    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in byte_slices(batch, "text", SLICE_BYTES):
                sets = [s.tobytes() for s in shingle_sets(piece.column("text"), width)]
                yield pa.RecordBatch.from_pydict({"id": piece.column("id"), "s": pa.array(sets, pa.binary())})

    # whole texts of the candidates alone are shuffled
    near, _ = split_by_keys(docs, "id", wanted, rows)
    return stage(near.join(wanted, F.col("id") == F.col("want"), "left_semi").mapInArrow(to_sets, "id long, s binary"), "near-sets")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union on full sets."""
    wanted = stage(pairs.select(F.col("a").alias("want")).unionByName(pairs.select(F.col("b").alias("want"))).dropDuplicates(), "near-wanted")
    sets = _sets(wanted, pairs.count(), docs, width)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("s").alias("y")), "b").select("a", "b", "x", "y")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, big = (x, y) if len(x) <= len(y) else (y, x)
                common = int((big[np.minimum(np.searchsorted(big, small), len(big) - 1)] == small).sum())
                ok.append(100 * common >= percent * (len(x) + len(y) - common))
            at = pa.array(np.flatnonzero(ok), pa.int64())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(at) for c in ("a", "b")})

    return both.mapInArrow(confirm, "a long, b long")


def links_across(rep: np.ndarray, side: np.ndarray, label: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], low: int, percent: int):
    """Links of a block's rows (in order of ``side``) that join different
    labels; pairs of similar sketches are compared by their full sets."""
    size, out = np.array([len(s) for s in sets]), []
    flat, code = np.unique(np.concatenate(sets), return_inverse=True)
    codes, mark = np.split(code, np.cumsum(size)[:-1]), np.zeros(len(flat), bool)
    label = np.unique(label, return_inverse=True)[1]
    for k, later in _meetings(side):
        j = later + np.flatnonzero((sketch[later:] == sketch[k]).sum(axis=1) >= low)
        j = j[label[j] != label[k]]
        if not len(j):
            continue
        mark[codes[k]] = True
        common = np.add.reduceat(mark[np.concatenate([codes[x] for x in j])].astype(np.int64), np.cumsum(size[j]) - size[j])
        mark[codes[k]] = False
        real = j[100 * common >= percent * (size[k] + size[j] - common)]
        # one link to each component is enough
        for x in real[np.unique(label[real], return_index=True)[1]].tolist():
            out.append((rep[k], rep[x]))
            label[label == label[x]] = label[k]
    return out


def _left_out(nodes: DataFrame, thinned: DataFrame, reps: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int, low: int) -> DataFrame:
    """Links (a, b) between ``classes`` among all similar pairs of the nodes ``thinned``."""
    known = classes.select(F.col("node").alias("_rep"), "component")
    rows = nodes.join(thinned, "node", "left_semi").select("node", "rep").dropDuplicates()
    rows = rows.join(reps.select("rep", "n", "sketch"), "rep").join(known, F.col("rep") == F.col("_rep"), "left") \
        .select("node", "rep", "n", "sketch", F.coalesce("component", "rep").alias("label"))
    rows = stage(rows, "near-thinned")
    # a node of one component has nothing left to link
    mixed = rows.groupBy(F.col("node").alias("_node")).agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles"), F.min("label").alias("lo"), F.max("label").alias("hi")) \
        .where("lo < hi").select("_node", "size", "shingles")
    parts = F.when((F.col("size") <= NODE_ROWS) & (F.col("shingles") <= BLOCK_SHINGLES), F.lit(1).cast("bigint")) \
        .otherwise(F.greatest(F.ceil(F.col("size") * 2 / NODE_ROWS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)))
    rows = stage(rows.join(mixed, F.col("node") == F.col("_node")).withColumn("parts", parts).select("node", "rep", "sketch", "label", "parts"), "near-mixed")
    wanted = stage(rows.select(F.col("rep").alias("want")).dropDuplicates(), "near-wanted")
    sets = _sets(wanted, wanted.count(), docs, width)
    blocks = _blocks(rows.join(sets, F.col("rep") == F.col("id")), F.col("parts")).select("node", "i", "j", "side", "rep", "label", "sketch", "s")
    blocks = blocks.repartition(slots(reps.sparkSession), "node", "i", "j").sortWithinPartitions("node", "i", "j", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole_groups(batches, "node", "i", "j"):
            at, links = _starts(t, "node", "i", "j").tolist(), []
            for i, j in zip(at[:-1], at[1:], strict=True):
                g = t.slice(i, j - i)
                rep, side, label = (g.column(c).to_numpy() for c in ("rep", "side", "label"))
                sketch = np.frombuffer(b"".join(g.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in g.column("s")]
                links += links_across(rep, side, label, sketch, sets, low, percent)
            a, b = zip(*links, strict=True) if links else ((), ())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return stage(blocks.mapInArrow(compare, "a long, b long").dropDuplicates(), "near-links")


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
               percent: int = THRESHOLD_PERCENT, recall: float = RECALL) -> DataFrame:
    """Every document's id with ``n_shingles``, ``component_id`` (the smallest
    id it is linked with, over any number of links) and ``kept``."""
    docs, threshold = _documents(df, id_col, text_col), percent / 100
    signed = _signed(docs, width)
    usable = signed.where("n > 0 and id is not null")
    first = usable.groupBy("k1", "k2").agg(F.min(F.struct("id", "sig")).alias("m"), F.first("n").alias("n"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The low byte of each minwise value, for comparing within nodes."""
        for batch in batches:
            low = [np.frombuffer(s, np.uint32).astype(np.uint8).tobytes() for s in batch.column("sig").to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(low, pa.binary())], batch.schema.names + ["sketch"])

    reps = stage(first.select("k1", "k2", F.col("m.id").alias("rep"), F.col("m.sig").alias("sig"), "n")
                 .mapInArrow(sketch, "k1 long, k2 long, rep long, sig binary, n long, sketch binary"), "near-reps")
    nodes, low = _nodes(reps, threshold, recall), _least_agreement(threshold)
    found = stage(_candidates(nodes, reps, low), "near-pairs")
    links = stage(_confirmed(found.where("a is not null").select("a", "b"), docs, width, percent), "near-links")
    classes, thinned = components(links), found.where("a is null").select("node")
    if not thinned.isEmpty():
        more = _left_out(nodes, thinned, reps, classes, docs, width, percent, low)
        if not more.isEmpty():
            classes = components(links.unionByName(more))
    found = reps.select("k1", "k2", "rep").join(classes, F.col("rep") == F.col("node"), "left") \
        .select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.coalesce("component", "rep").alias("component"))
    rows = signed.select("id", "n", "k1", "k2")
    linked = rows.where("n > 0 and id is not null").join(found, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))) \
        .select("id", "n", "component")
    alone = rows.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
                                            F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
