"""Hard-negative mining over Hilbert-ordered blocks with zone maps.

All vectors are sorted along a Hilbert curve over their components of widest
spread and written to Parquet as blocks of ``BLOCK_ROWS`` neighbours.  Beside
its rows a block carries its zone map: the least and greatest value of every
component and the labels it holds.  Interval arithmetic on a zone map bounds
the scores that a block's rows can have with an anchor (each component adds
the lesser and the greater of its two products), so for each anchor only some
blocks are read:

1. while blocks are written, an anchor's best rows of its own label in its own
   block give a first bound on its k-th best positive;
2. positives are looked for in the blocks that hold the label and whose upper
   bound reaches that;
3. an anchor's positives give its windows of scores, and negatives are looked
   for in the blocks that hold another label and whose bounds meet a window.

Anchors go in groups of at most ``GROUP_ROWS`` neighbours, zone maps in pages of
``PAGE_ZONES``; a page meets each group once, and a block the groups that need
it.  No task holds more than a group, a page and a few blocks.

Scores are integer inner products of floor(scale * x) and exact; bounds are
exact integers too, or taken in floating point with a margin above its error.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; a shorter vector ends in zeros; a row never meets one
of its own id; ties go to the smaller id; rows that repeat an id are rows of
their own, and as anchors give results once for each; without positives, or
without negatives in a window, there is no row; other columns are ignored; an
empty table gives an empty table; scores beyond 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import slots, stage
from pricelens.llm.knn import _best, _integers, _matrix, _pack, products

SCALE = 256
BLOCK_ROWS = 512
GROUP_ROWS = 256
PAGE_ZONES = 256
HILBERT_DIMS = 32
HILBERT_BITS = 4
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hilbert_keys(x: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of points with components in [0, 2**bits),
    as bytes that sort like the places (axes to transposed index, vectorised
    over the points)."""
    x = x.astype(np.int64).T.copy()
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t, q = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while q > 1:
        t ^= np.where(x[-1] & q, q - 1, 0)
        q >>= 1
    x ^= t
    planes = np.stack([(x >> b) & 1 for b in range(bits - 1, -1, -1)])  # the curve's digits, highest first
    return [row.tobytes() for row in np.packbits(planes.reshape(bits * dims, -1).T.astype(np.uint8), axis=1)]


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: (least, greatest) inner product of each row of ``a``
    with any vector between ``lo`` and ``hi``, a row of each a zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)


def _pack_rows(m: np.ndarray) -> bytes:
    return _pack(m.ravel())


def _rows(blob: bytes, dim: int) -> np.ndarray:
    v = np.frombuffer(blob, "<i8", offset=1) if blob[:1] == b"8" else np.frombuffer(blob, "<i2", offset=1).astype(np.int64)
    return v.reshape(-1, dim) if dim else np.zeros((0, 0), np.int64)


def _ints(values) -> bytes:
    return np.asarray(values, "<i8").tobytes()


def _longs(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<i8")


_BLOCK = "blk long, n int, rows binary, ids binary, labels binary, v binary, lo binary, hi binary, kinds binary, anchors binary, reach binary"


def _blocks(ordered: DataFrame, dim: int, k: int) -> DataFrame:
    """The sorted vectors as blocks with zone maps; of the anchors in a block
    also ``reach``, a lower bound on the k-th best score of their own label."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(t: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            v = _matrix(t.column("v").to_pylist(), dim)
            ids, labels, rows = (t.column(c).to_numpy() for c in ("id", "label", "row"))
            anchors = np.flatnonzero(t.column("is_anchor").to_numpy(zero_copy_only=False))
            reach = []
            for a, s in zip(anchors, products(v[anchors], v) if len(anchors) else (), strict=True):
                own = s[(labels == labels[a]) & (ids != ids[a])]
                reach.append(np.partition(own, len(own) - k)[len(own) - k] if len(own) >= k else np.iinfo(np.int64).min)
            out = {"blk": (part << 32) + seq, "n": len(ids), "rows": _ints(rows), "ids": _ints(ids), "labels": _ints(labels), "v": _pack_rows(v),
                   "lo": _pack_rows(v.min(axis=0)), "hi": _pack_rows(v.max(axis=0)), "kinds": _ints(np.unique(labels)), "anchors": _ints(anchors), "reach": _ints(reach)}
            seq += 1
            return pa.RecordBatch.from_pylist([out], _SCHEMA)

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK_ROWS:
                t = pa.Table.from_batches(held)
                yield block(t.slice(0, BLOCK_ROWS))
                held = t.slice(BLOCK_ROWS).to_batches()
        if sum(b.num_rows for b in held):
            yield block(pa.Table.from_batches(held))

    return stage(ordered.mapInArrow(build, _BLOCK), "negatives-blocks")


_SCHEMA = pa.schema([("blk", pa.int64()), ("n", pa.int32())] + [(c, pa.binary()) for c in ("rows", "ids", "labels", "v", "lo", "hi", "kinds", "anchors", "reach")])
_ANCHOR = "part int, seq int, row long, id long, label long, v binary, reach long"


def _anchors(blocks: DataFrame, dim: int) -> tuple[DataFrame, int]:
    """Anchors in curve order with a group number from 0, and the number of groups."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for b in batch.to_pylist():
                at, v = _longs(b["anchors"]), _rows(b["v"], dim)
                place = np.arange(seq, seq + len(at))
                seq += len(at)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(len(at), part), pa.int32()), "seq": pa.array(place // GROUP_ROWS, pa.int32()), "row": _longs(b["rows"])[at], "id": _longs(b["ids"])[at],
                    "label": _longs(b["labels"])[at], "v": pa.array([_pack(v[i]) for i in at], pa.binary()), "reach": _longs(b["reach"])})

    found = stage(blocks.select("rows", "ids", "labels", "v", "anchors", "reach").where("length(anchors) > 0").mapInArrow(unpack, _ANCHOR), "negatives-anchors")
    # one row a partition
    counts = sorted((r["part"], r["n"]) for r in found.groupBy("part").agg((F.max("seq") + 1).alias("n")).collect())
    first, total = {}, 0
    for part, n in counts:
        first[part], total = total, total + n
    if not first:
        return found.withColumn("grp", F.lit(0)), 0
    offset = found.sparkSession.createDataFrame(sorted(first.items()), "part int, offset int")
    return found.join(offset, "part").select((F.col("offset") + F.col("seq")).alias("grp"), "row", "id", "label", "v", "reach"), total


def _needed(blocks: DataFrame, groups: DataFrame, n_groups: int, dim: int, test, name: str) -> DataFrame:
    """(blk, grp) of the blocks that any anchor of a group needs; ``test`` gets
    the group's row, the bounds of its anchors with some zones, and each zone's labels."""
    def paged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGE_ZONES):
                b = batch.slice(at, PAGE_ZONES)
                lo, hi = (np.concatenate([_rows(x, dim) for x in b.column(c).to_pylist()]) for c in ("lo", "hi"))
                yield pa.RecordBatch.from_pydict({"blks": [_ints(b.column("blk").to_numpy())], "los": [_pack_rows(lo)], "his": [_pack_rows(hi)],
                                                  "kinds": pa.array([b.column("kinds").to_pylist()], pa.list_(pa.binary()))})

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                low, high = bounds(_rows(r["v"], dim), _rows(r["los"], dim), _rows(r["his"], dim))
                need = test(r, low, high, [_longs(x) for x in r["kinds"]]).any(axis=0)
                blk = _longs(r["blks"])[need]
                yield pa.RecordBatch.from_pydict({"blk": blk, "grp": pa.array(np.full(len(blk), r["grp"]), pa.int32())})

    pages = blocks.select("blk", "lo", "hi", "kinds").mapInArrow(paged, "blks binary, los binary, his binary, kinds array<binary>")
    met = pages.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).join(groups, "grp")
    return stage(met.mapInArrow(choose, "blk long, grp int"), f"negatives-{name}")


def _grouped(anchors: DataFrame, dim: int, extra: list[str]) -> DataFrame:
    """One row a group: its anchors' columns packed."""
    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("row")
        out = {"grp": t.column("grp")[0].as_py(), "v": _pack_rows(_matrix(t.column("v").to_pylist(), dim))}
        for c in ("row", "id", "label"):
            out[c] = _ints(t.column(c).to_numpy())
        for c in extra:
            out[c] = [_ints(x) for x in t.column(c).to_pylist()] if pa.types.is_list(t.column(c).type) else [_ints([x]) for x in t.column(c).to_pylist()]
        kind = pa.schema([("grp", pa.int32()), *[(c, pa.binary()) for c in ("v", "row", "id", "label")], *[(c, pa.list_(pa.binary())) for c in extra]])
        return pa.Table.from_pylist([out], kind)

    return stage(anchors.groupBy("grp").applyInArrow(pack, "grp int, v binary, row binary, id binary, label binary" + "".join(f", {c} array<binary>" for c in extra)), "negatives-groups")


def _has(labels: np.ndarray, kinds: list[np.ndarray], other: bool) -> np.ndarray:
    """Whether a zone holds an anchor's label, or another one."""
    same = np.stack([np.isin(labels, k) for k in kinds], axis=1) if kinds else np.zeros((len(labels), 0), bool)
    return (np.array([len(k) for k in kinds])[None, :] > same) if other else same


def mine(df: DataFrame, is_anchor, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: int = SCALE,
         floor_pct: int = 80) -> DataFrame:
    """For every row with ``is_anchor`` (a boolean column) and each of its first
    ``k`` rows of the same label, the first ``k`` rows of another label that
    score from ``floor_pct`` to 100 percent of that positive."""
    spark = df.sparkSession
    usable = F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()
    table = df.where(usable).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{label_col}`").cast("bigint").alias("label"),
                                    F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def to_integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = _integers(batch.column("v"), scale)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(at) for c in ("id", "label", "is_anchor")} | {
                "v": pa.array([_pack(v) for v in vs], pa.binary()), "dim": pa.array([len(v) for v in vs], pa.int32())})

    vectors = stage(table.mapInArrow(to_integers, "id long, label long, is_anchor boolean, v binary, dim int").withColumn("row", F.monotonically_increasing_id()), "negatives-vectors")
    dim = vectors.agg(F.max("dim")).first()[0]
    if dim is None:
        return spark.createDataFrame([], RESULT)
    dim = max(1, dim)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v").to_pylist(), dim).astype(np.float64)
                yield pa.RecordBatch.from_pydict({"d": pa.array(np.arange(dim), pa.int32()), "n": np.full(dim, float(len(x))), "s": x.sum(axis=0), "ss": (x * x).sum(axis=0),
                                                  "lo": x.min(axis=0), "hi": x.max(axis=0)})

    # one row a component
    stats = vectors.select("v").mapInArrow(spread, "d int, n double, s double, ss double, lo double, hi double") \
        .groupBy("d").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")], F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    wide = sorted(stats, key=lambda r: (-(r["ss"] / r["n"] - (r["s"] / r["n"]) ** 2), r["d"]))[:HILBERT_DIMS]
    dims = np.array([r["d"] for r in wide])
    low, width = np.array([r["lo"] for r in wide]), np.array([max(1.0, r["hi"] - r["lo"] + 1) for r in wide])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v").to_pylist(), dim)[:, dims]
                cell = np.floor((x - low) / width * (1 << HILBERT_BITS)).clip(0, (1 << HILBERT_BITS) - 1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert_keys(cell, HILBERT_BITS), pa.binary())], names=[*batch.schema.names, "key"])

    order = ["key", "id", "row"]  # equal vectors lie on one place: their rows part them
    ordered = vectors.select("id", "label", "is_anchor", "v", "row").mapInArrow(keyed, "id long, label long, is_anchor boolean, v binary, row long, key binary") \
        .repartitionByRange(slots(spark), *order).sortWithinPartitions(*order).drop("key")
    blocks = _blocks(ordered, dim, k)
    anchors, n_groups = _anchors(blocks, dim)
    if not n_groups:
        return spark.createDataFrame([], RESULT)
    anchors = stage(anchors, "negatives-anchors")

    # positives
    groups = _grouped(anchors, dim, ["reach"])

    def may_hold(r, low, high, kinds):
        reach = np.array([_longs(x)[0] for x in r["reach"]])
        return (high >= reach[:, None]) & _has(_longs(r["label"]), kinds, False)

    def look(batches: Iterator[pa.RecordBatch], find) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                v, data = _rows(r["v"], dim), _rows(r["data"], dim)
                out = find(r, products(v, data), _longs(r["ids"]), _longs(r["labels"]))
                yield pa.RecordBatch.from_pydict({n: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64), pa.int64()) for n, x in out.items()})

    def same_label(r, s, ids, labels):
        out = {n: [] for n in ("row", "id", "score")}
        for i, (row, own, label, reach) in enumerate(zip(_longs(r["row"]), _longs(r["id"]), _longs(r["label"]), r["reach"], strict=True)):
            at = np.flatnonzero((labels == label) & (ids != own) & (s[i] >= _longs(reach)[0]))
            best = at[_best(s[i][at], ids[at], k)]
            out["row"].append(np.full(len(best), row))
            out["id"].append(ids[best])
            out["score"].append(s[i][best])
        return out

    read = blocks.select("blk", "ids", "labels", F.col("v").alias("data"))
    need = _needed(blocks, groups, n_groups, dim, may_hold, "near")
    found = need.join(read, "blk").join(groups, "grp").mapInArrow(lambda b: look(b, same_label), "row long, id long, score long")
    first = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    positives = stage(found.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k), "negatives-positives")

    # negatives in the windows of the positives
    windows = positives.groupBy("row").agg(F.sort_array(F.collect_list("score"), asc=False).alias("p"))
    with_windows = _grouped(anchors.join(windows, "row"), dim, ["p"])

    def window(p: int) -> tuple[int, int]:
        return -(-floor_pct * p // 100), p

    def meets(r, low, high, kinds):
        hit = np.zeros(low.shape, bool)
        for i, blob in enumerate(r["p"]):
            for p in set(_longs(blob).tolist()):
                a, b = window(p)
                hit[i] |= (high[i] >= a) & (low[i] <= b) & (a <= b)
        return hit & _has(_longs(r["label"]), kinds, True)

    def other_label(r, s, ids, labels):
        out = {n: [] for n in ("row", "positive_score", "id", "score")}
        for i, (row, own, label, blob) in enumerate(zip(_longs(r["row"]), _longs(r["id"]), _longs(r["label"]), r["p"], strict=True)):
            other = (labels != label) & (ids != own)
            for p in sorted(set(_longs(blob).tolist())):
                a, b = window(p)
                at = np.flatnonzero(other & (s[i] >= a) & (s[i] <= b))
                best = at[_best(s[i][at], ids[at], k)]
                for n, x in (("row", np.full(len(best), row)), ("positive_score", np.full(len(best), p)), ("id", ids[best]), ("score", s[i][best])):
                    out[n].append(x)
        return out

    need = _needed(blocks, with_windows, n_groups, dim, meets, "windows")
    found = need.join(read, "blk").join(with_windows, "grp").mapInArrow(lambda b: look(b, other_label), "row long, positive_score long, id long, score long")
    per = Window.partitionBy("row", "positive_score").orderBy(F.desc("score"), "id")
    negatives = found.withColumn("rank", F.row_number().over(per)).where(F.col("rank") <= k)
    return positives.select("row", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")) \
        .join(negatives.select("row", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["row", "positive_score"]) \
        .join(anchors.select("row", F.col("id").alias("anchor_id")), "row") \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
