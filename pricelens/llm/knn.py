"""Exact top-k search by a Voronoi kNN join.

Data vectors are grouped by their nearest of a bounded number of pivots;
queries by their nearest of fewer.  A summary of each data group (row count,
a bounded number of members) and of each query group (radius about its pivot)
gives every query a lower bound on its k-th best score, and a query group the
least of these.  A data vector x can only matter to a query group with pivot
p, radius r and bound t if  <p, x> + r |x| >= t  (Cauchy-Schwarz), so it is
replicated to those groups alone.  Query groups for which the bounds rule out
less than half of the data, cell by cell, gain nothing by standing apart: they
join into one group that gets every data vector once.  Each group is solved
locally in blocks of bounded size, and the blocks' best k merge.

Scores are exact integer inner products of floor(scale * x).  Bounds are taken
in floating point with a margin far above its error, on the side of keeping.

Defined results: vectors that are null, or hold a null or non-finite
component, or have a null id, take no part; vectors of unequal lengths count
as ending in zeros; ties go to the smaller id; a query never meets a row of
its own id; rows that repeat an id are candidates of their own, and as queries
give the ranks once for each; an empty table gives an empty table; other
columns are ignored.  A score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import stage

SCALE = 256
PIVOTS = 64
QUERY_PIVOTS = 16
MEMBERS = 32
BLOCK_ROWS = 8192
QUERY_BLOCK_ROWS = 2048
# of the bounds, relative to the vectors' lengths
MARGIN = 1e-9
# number of the group of query groups that the bounds do not help
JOINED = -1


def _integers(col: pa.Array, scale: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the usable vectors and their integer components."""
    offs = col.offsets.to_numpy()
    flat = col.values
    ok = flat.is_valid().to_numpy(zero_copy_only=False) if len(flat) else np.zeros(0, bool)
    x = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64) if len(flat) else np.zeros(0)
    ok &= np.isfinite(x)
    bad = np.concatenate(([0], np.cumsum(~ok)))
    rows = np.flatnonzero(col.is_valid().to_numpy(zero_copy_only=False) & (bad[offs[1:]] == bad[offs[:-1]]))
    y = np.floor(np.where(ok, x, 0.0) * scale)
    keep = np.zeros(len(y), bool)
    for i in rows:
        keep[offs[i]:offs[i + 1]] = True
    if keep.any() and np.abs(y[keep]).max() >= 2.0**63:
        raise ValueError("a component is beyond 64 bits")
    z = np.where(keep, y, 0.0).astype(np.int64)
    return rows, [z[offs[i]:offs[i + 1]] for i in rows]


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(blobs), dim), np.int64)
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, "<i8", offset=1) if b[:1] == b"8" else np.frombuffer(b, "<i2", offset=1)
        out[i, :len(v)] = v
    return out


def _pack(v: np.ndarray) -> bytes:
    """A vector as bytes: 2 a component where they fit, else 8, marked in front."""
    small = not len(v) or (v.min() >= -32768 and v.max() <= 32767)
    return b"2" + v.astype("<i2").tobytes() if small else b"8" + v.astype("<i8").tobytes()


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` with those of ``b``."""
    top = (int(np.abs(a).max()) if a.size else 0) * (int(np.abs(b).max()) if b.size else 0) * max(1, a.shape[1])
    if top < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if top < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    if exact.size and max(abs(x) for x in exact.ravel()) >= 1 << 63:
        raise OverflowError("a score is beyond 64 bits")
    return exact.astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k best of one row: highest score, then smallest id."""
    if len(scores) > 4 * k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))][:k]


def _ruled_out(group, query_centres: np.ndarray, cells, centres: np.ndarray) -> int:
    """Data vectors in cells of which no member can reach a query group's bound."""
    p, c = query_centres[group["grp"]], centres[[x["cell"] for x in cells]]
    r, n = np.array([x["r"] for x in cells]), np.array([x["n"] for x in cells])
    reach = c @ p + group["r"] * np.sqrt((c * c).sum(axis=1)) + r * (np.sqrt(p @ p) + group["r"])
    return int(n[reach * (1 + MARGIN) + MARGIN < group["t"]].sum())


def knn_join(df: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
             pivots: int = PIVOTS, query_pivots: int = QUERY_PIVOTS) -> DataFrame:
    """The ``k`` best rows for every row with ``is_query`` (a boolean column):
    query_id, rank, vec_id, score."""
    spark = df.sparkSession
    vectors = df.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(is_query, F.lit(False)).alias("is_query"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def to_integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vs = _integers(batch.column("v"), scale)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(at), "is_query": batch.column("is_query").take(at),
                                              "v": pa.array([_pack(v) for v in vs], pa.binary()), "dim": pa.array([len(v) for v in vs], pa.int32())})

    rows = stage(vectors.mapInArrow(to_integers, "id long, is_query boolean, v binary, dim int")
                 .withColumn("row", F.monotonically_increasing_id()), "knn-vectors")
    dim = rows.agg(F.max("dim")).first()[0]
    result = "query_id long, rank int, vec_id long, score long"
    if dim is None:
        return spark.createDataFrame([], result)
    # a bounded, fixed choice of pivots: the rows of smallest hash
    chosen = [bytes(r[0]) for r in rows.orderBy(F.xxhash64("id", "row"), "id", "row").limit(pivots).select("v").collect()]
    centres = np.unique(_matrix(chosen, dim), axis=0).astype(np.float64)
    query_centres = centres[:: max(1, len(centres) // query_pivots)][:query_pivots]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), dim).astype(np.float64)
            square = (x * x).sum(axis=1)

            def nearest(c):
                d = square[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
                at = d.argmin(axis=1)
                return at, np.sqrt(((x - c[at]) ** 2).sum(axis=1))

            (cell, dist), (group, away) = nearest(centres), nearest(query_centres)
            cols = {n: batch.column(n) for n in ("id", "is_query", "v", "row")}
            yield pa.RecordBatch.from_pydict(cols | {"cell": pa.array(cell, pa.int32()), "dist": pa.array(dist),
                                                     "grp": pa.array(group, pa.int32()), "away": pa.array(away)})

    placed = stage(rows.select("id", "is_query", "v", "row").mapInArrow(
        assign, "id long, is_query boolean, v binary, row long, cell int, dist double, grp int, away double"), "knn-placed")
    # summaries: at most pivots * MEMBERS vectors and one row a query group
    total = placed.count()
    ranked = placed.select("cell", "id", "v", F.xxhash64("row", F.lit(7)).alias("h"))
    members = ranked.groupBy("cell").agg(F.min_by(F.struct("id", "v"), "h").alias("m0"), *[
        F.min_by(F.struct("id", "v"), F.when(F.pmod("h", F.lit(MEMBERS)) == i, F.col("h"))).alias(f"m{i}") for i in range(1, MEMBERS)])
    known = [m for r in members.collect() for m in list(r)[1:] if m is not None and m["v"] is not None]
    known = list({(m["id"], bytes(m["v"])) for m in known})
    known_ids = np.array([i for i, _ in known], np.int64)
    known_v = _matrix([v for _, v in known], dim)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A lower bound on each query's k-th best score: its k-th best among the known members."""
        for batch in batches:
            if not batch.num_rows:
                continue
            s = products(_matrix(batch.column("v").to_pylist(), dim), known_v)
            own = batch.column("id").to_numpy()[:, None] == known_ids[None, :]
            low = np.where(own, np.iinfo(np.int64).min, s)
            kth = np.partition(low, len(known_ids) - k, axis=1)[:, len(known_ids) - k] if len(known_ids) >= k else np.full(len(low), np.iinfo(np.int64).min)
            yield pa.RecordBatch.from_pydict({"grp": batch.column("grp"), "away": batch.column("away"), "low": pa.array(kth, pa.int64())})

    queries = placed.where("is_query")
    bounds = queries.select("id", "v", "grp", "away").mapInArrow(bound, "grp int, away double, low long") \
        .groupBy("grp").agg(F.max("away").alias("r"), F.min("low").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    if not bounds:
        return spark.createDataFrame([], result)
    # at most one row a pivot
    cells = placed.groupBy("cell").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n")).collect()
    apart = [b for b in bounds if 2 * _ruled_out(b, query_centres, cells, centres) >= total]
    joined = [b for b in bounds if b not in apart]
    groups = np.array([b["grp"] for b in apart] + [JOINED] * bool(joined), np.int32)
    radius = np.array([b["r"] for b in apart] + [0.0] * bool(joined))
    low = np.array([float(b["t"]) for b in apart] + [-np.inf] * bool(joined))
    sizes = [b["n"] for b in apart] + [sum(b["n"] for b in joined)] * bool(joined)
    parts = np.array([-(-n // QUERY_BLOCK_ROWS) for n in sizes], np.int64)
    blocks = max(1, -(-total // BLOCK_ROWS))
    group_centres = np.concatenate((query_centres[groups[:len(apart)]], np.zeros((int(bool(joined)), dim))))

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v").to_pylist(), dim).astype(np.float64)
            size = np.sqrt((x * x).sum(axis=1))
            reach = x @ group_centres.T + size[:, None] * radius[None, :]
            slack = MARGIN * (1 + size[:, None] * (radius + np.sqrt((group_centres**2).sum(axis=1)))[None, :])
            row, g = np.nonzero(reach + slack >= low[None, :])
            copies = parts[g]
            at = np.repeat(np.arange(len(row)), copies)
            part = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
            take = pa.array(row[at], pa.int64())
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").take(take), "v": batch.column("v").take(take),
                                              "blk": batch.column("blk").take(take),
                                              "grp": pa.array(groups[g[at]], pa.int32()), "part": pa.array(part, pa.int64())})

    data = placed.select("id", "v", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(blocks)).cast("int").alias("blk")) \
        .mapInArrow(replicate, "id long, v binary, blk int, grp int, part long")
    group = F.when(F.col("grp").isin([b["grp"] for b in joined]), F.lit(JOINED)).otherwise(F.col("grp")) if joined else F.col("grp")
    n_parts = F.create_map(*[F.lit(x) for g, n in zip(groups.tolist(), parts.tolist(), strict=True) for x in (g, n)])
    asked = queries.select(F.col("id").alias("qid"), F.col("row").alias("qrow"), F.col("v").alias("qv"), group.alias("grp"),
                           F.pmod(F.xxhash64("row", F.lit(2)), F.element_at(n_parts, group)).alias("part")) \
        .withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def solve(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in ("qrow", "query_id", "vec_id", "score")}
        if left.num_rows and right.num_rows:
            ids = right.column("id").to_numpy()
            data_v = _matrix(right.column("v").to_pylist(), dim)
            q_ids, q_rows = left.column("qid").to_numpy(), left.column("qrow").to_numpy()
            q_v = _matrix(left.column("qv").to_pylist(), dim)
            for a in range(0, len(q_ids), 256):
                s = products(q_v[a:a + 256], data_v)
                for j in range(len(s)):
                    other = ids != q_ids[a + j]
                    row, name = (s[j], ids) if other.all() else (s[j][other], ids[other])
                    best = _best(row, name, k)
                    out["qrow"].append(np.full(len(best), q_rows[a + j]))
                    out["query_id"].append(np.full(len(best), q_ids[a + j]))
                    out["vec_id"].append(name[best])
                    out["score"].append(row[best])
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in out.items()})

    key = ["grp", "part", "blk"]
    part = asked.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(solve, "qrow long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("qrow").orderBy(F.desc("score"), "vec_id"))
    return part.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
