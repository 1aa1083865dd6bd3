"""Suffix-array dedup: bytes covered by a string of LENGTH bytes that also
starts anywhere else are found and cut out, exactly.

Comparing every suffix is not needed.  Each string of LENGTH bytes has an
anchor, the place of the smallest hash among its GRAM-byte substrings, which
its bytes alone decide, so equal strings have their anchors at the same place.
Strings in a row share an anchor; texts are sampled to one row an anchor, with
the GRAM's hash as key and the hash of everything its strings span.  Anchors
whose key occurs once are done, and anchors equal in all they span match as a
whole.  Only where keys meet but spans differ (the ends of a repeat, edited
copies) one row a distinct span goes on with its bytes.

There the strings' starts are suffixes, and each task keeps a logarithmic
family of suffix arrays: a new batch of spans gets an array of its suffixes,
ordered by the fingerprint of their first LENGTH bytes, is merge-scanned
against the existing levels for matches, and levels of equal size merge, so
each suffix is merged a logarithmic number of times.  Tasks are dealt by key; a
key with more than ``KEY_ROWS`` spans is dealt on by fingerprint, so no task
holds a hot key whole.  (Lexicographic order would bring equal suffixes
together just the same; fingerprints compare faster.)

Defined results: texts are UTF-8 bytes, null is empty; a text shorter than
LENGTH keeps all; matches never cross texts, may overlap and may lie in one
text; rows repeated as a whole are texts of their own and so match; null ids
and equal ids do no harm; an empty table gives an empty table; other columns
are ignored.  A text is worked on in pieces of ``PIECE`` bytes, so the longest
one does not decide the memory.  Equality is by 64-bit hashes of the spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import byte_slices, mix64, slots, stage, text_bytes
from pricelens.llm.filters import possibly_repeated, split_by_keys

LENGTH = 400
GRAM = 100
PIECE = 1 << 20
KEY_ROWS = 20_000
TASK_ROWS = 20_000
_PLACE = np.uint64((1 << 23) - 1)

_BYTE = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse, modulo 2 ** 64."""
    out = []
    for b in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(n, b, np.uint64)
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Hashes of any substring of ``buf`` (2 * PIECE bytes at most)."""

    def __init__(self, buf: np.ndarray):
        self.up, self.down = _powers(2 * PIECE + 4 * LENGTH)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(_BYTE[buf] * self.up[:len(buf)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        """Of every substring of ``size`` bytes."""
        return mix64((self.sums[size:] - self.sums[:-size]) * self.down[:len(self.sums) - size])


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row (running minima of blocks)."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:n], behind[width - 1:width - 1 + n])


def anchors(buf: np.ndarray, bounds: list[tuple[int, int]], length: int = LENGTH, gram: int = GRAM):
    """The anchors of all strings of ``length`` bytes within the pieces
    ``bounds`` of ``buf``: (first start, number of starts, key, span hash)."""
    none = np.zeros(0, np.int64)
    if len(buf) < length:
        return none, none, none.view(np.uint64), none.view(np.uint64)
    hashes = Hashes(buf)
    h = hashes.all(gram)
    place = _window_min((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & _PLACE
    inside = np.zeros(len(place), bool)
    for a, b in bounds:
        inside[a:max(a, b - length + 1)] = True
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none.view(np.uint64), none.view(np.uint64)
    at = place[starts]
    new = np.append(True, (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))
    first, at = starts[new], at[new].astype(np.int64)
    count = np.diff(np.append(np.flatnonzero(new), len(starts)))
    span = hashes.of(first, first + count - 1 + length) ^ mix64((at - first).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64))
    return first, count, h[at], span


def _pieces(offs: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Groups of (text, start, end), of PIECE bytes or so each: texts, or parts
    of a long one that overlap by ``length - 1``."""
    group, size = [], 0
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        if b - a < length:
            continue
        for s in range(a, b - length + 1, PIECE):
            e = min(b, s + PIECE + length - 1)
            if group and size + e - s > PIECE:
                yield group
                group, size = [], 0
            group.append((i, s, e))
            size += e - s
    if group:
        yield group


def _sampled(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """One row an anchor: (doc, start, n, key, span), stored."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 8 * PIECE):
                buf, offs = text_bytes(part.column("text"))
                name = part.column("doc").to_numpy()
                for group in _pieces(offs, length):
                    sizes = np.array([e - s for _, s, e in group])
                    ends = np.cumsum(sizes)
                    joined = np.concatenate([buf[s:e] for _, s, e in group])
                    first, n, key, span = anchors(joined, list(zip((ends - sizes).tolist(), ends.tolist(), strict=True)), length, gram)
                    which = np.searchsorted(ends, first, side="right")
                    texts = np.array([i for i, _, _ in group])
                    shift = np.array([s for _, s, _ in group]) - (ends - sizes) - offs[texts]
                    yield pa.RecordBatch.from_pydict({
                        "doc": pa.array(name[texts[which]]), "start": pa.array(first + shift[which], pa.int64()), "n": pa.array(n, pa.int32()),
                        "key": pa.array(key.view(np.int64)), "span": pa.array(span.view(np.int64))})

    return stage(docs.select("doc", "text").mapInArrow(sample, "doc long, start long, n int, key long, span long"), "suffix-samples")


# ------------------------------------------------- the logarithmic index family
class SuffixIndex:
    """Levels of suffix arrays; level i is empty or holds 2 ** i batches.

    An array is the ascending fingerprints of its suffixes' first bytes and
    the suffixes' numbers; ``matched`` tells for every suffix added whether
    another begins with the same bytes."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray] | None] = []
        self.matched = np.zeros(0, bool)

    def add(self, prints: np.ndarray) -> None:
        base = len(self.matched)
        self.matched = np.append(self.matched, np.zeros(len(prints), bool))
        order = np.argsort(prints, kind="stable")
        array, suffix = prints[order], order + base
        same = np.flatnonzero(array[1:] == array[:-1])
        self.matched[suffix[same]] = self.matched[suffix[same + 1]] = True
        for level in self.levels:
            if level is not None:
                self._scan(array, suffix, *level)
        self._insert((array, suffix))

    def _scan(self, array, suffix, other, other_suffix) -> None:
        """Marks what a batch and a level have in common.  Of equal suffixes in
        the level the first is enough: two or more are marked already."""
        at = np.minimum(np.searchsorted(other, array), len(other) - 1)
        hit = np.flatnonzero(other[at] == array)
        self.matched[suffix[hit]] = True
        self.matched[other_suffix[at[hit]]] = True

    def _insert(self, level) -> None:
        for i, held in enumerate(self.levels):
            if held is None:
                self.levels[i] = level
                return
            array = np.concatenate((held[0], level[0]))
            order = np.argsort(array, kind="stable")
            level = (array[order], np.concatenate((held[1], level[1]))[order])
            self.levels[i] = None
        self.levels.append(level)


def _prints(content: pa.Array, n: np.ndarray, length: int) -> np.ndarray:
    """Fingerprints of the strings that start at the first ``n`` places of each span."""
    buf, offs = text_bytes(content)
    hashes = Hashes(buf)
    starts = np.repeat(offs[:-1] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    return hashes.of(starts, starts + length)


def _runs(flags: np.ndarray, length: int) -> bytes:
    """Runs of set flags as (start, end) of the bytes their strings cover."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return np.stack((edge[::2], edge[1::2] - 1 + length), axis=1).astype("<i8").tobytes()


def _partial(spans: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(key, span, runs): what of each distinct span of ``spans`` (key, span,
    doc, start, n, rows) other spans of its key have too."""
    total = spans.count()
    wanted = spans.groupBy("doc").agg(F.collect_list(F.struct("key", "span", "start", "n", "rows")).alias("spans")).withColumnRenamed("doc", "_doc")
    near, _ = split_by_keys(docs.select("doc", "text"), "doc", wanted.select("_doc"), total)
    # a text that occurs more than once needs to give its bytes once only
    texts = near.join(wanted, F.col("doc") == F.col("_doc")).select("text", "spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", PIECE):
                buf, offs = text_bytes(part.column("text"))
                for i, spans_ in enumerate(part.column("spans").to_pylist()):
                    text = buf[offs[i]:offs[i + 1]]
                    out = [(s["key"], s["span"], s["n"], -(-s["rows"] // KEY_ROWS), text[s["start"]:s["start"] + s["n"] - 1 + length].tobytes()) for s in spans_]
                    cols = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()), strict=True)]
                    yield pa.RecordBatch.from_arrays(cols, ["key", "span", "n", "routes", "content"])

    cut_spans = texts.mapInArrow(cut, "key long, span long, n int, routes int, content binary")
    # of a hot key, every route gets the spans and looks at its own fingerprints
    routed = cut_spans.withColumn("route", F.explode(F.sequence(F.lit(0), F.col("routes") - 1)))
    parts = max(slots(docs.sparkSession), -(-total // TASK_ROWS))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, names, sizes, own = SuffixIndex(), [], [], []
        for batch in batches:
            for part in byte_slices(batch, "content", PIECE):
                n = part.column("n").to_numpy().astype(np.int64)
                prints = _prints(part.column("content"), n, length)
                routes = np.repeat(part.column("routes").to_numpy().astype(np.uint64), n)
                mine = (prints >> np.uint64(32)) % routes == np.repeat(part.column("route").to_numpy().astype(np.uint64), n)
                # what is another route's stands in no level here
                index.add(prints[mine])
                own.append(mine)
                names.append((part.column("key"), part.column("span")))
                sizes.append(n)
        at = 0
        for (key, span), n, mine in zip(names, sizes, own, strict=True):
            flags = np.zeros(len(mine), bool)
            flags[mine] = index.matched[at:at + int(mine.sum())]
            at += int(mine.sum())
            ends = np.cumsum(n)
            runs = [_runs(flags[a:b], length) for a, b in zip((ends - n).tolist(), ends.tolist(), strict=True)]
            t = pa.RecordBatch.from_pydict({"key": key, "span": span, "runs": pa.array(runs, pa.binary())})
            yield t.filter(pa.array([bool(r) for r in runs]))

    return stage(routed.repartition(parts, "key", "route").mapInArrow(match, "key long, span long, runs binary"), "suffix-matches")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Every document's id with ``n_bytes``, ``spans`` (the maximal byte ranges
    cut out) and ``kept`` (the remaining bytes)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("doc"))
    samples = _sampled(docs, length, gram)
    some = stage(possibly_repeated(samples, "key", samples.count()), "suffix-repeated")
    # one row a distinct span; copies combine before the shuffle
    spans = stage(some.groupBy("key", "span").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("doc", "start", "n")).alias("one")), "suffix-spans")
    keys = spans.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").withColumnRenamed("key", "_key")
    mixed = stage(spans.join(keys, F.col("key") == F.col("_key")).select("key", "span", "one.doc", "one.start", "one.n", "rows"), "suffix-mixed")
    partial = _partial(mixed, docs, length)
    whole = spans.where("copies > 1").select("key", "span")
    members = some.select("doc", "start", "n", "key", "span")
    as_bytes = lambda a, b: F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end"))
    full = members.join(whole, ["key", "span"]).select("doc", F.array(as_bytes(F.col("start"), F.col("start") + F.col("n") - 1 + length)).alias("cuts"))

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = [(np.frombuffer(r, "<i8").reshape(-1, 2) + s).tolist() for r, s in zip(batch.column("runs").to_pylist(), batch.column("start").to_pylist(), strict=True)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_pydict({"doc": batch.column("doc"), "cuts": pa.array([[{"start": a, "end": b} for a, b in c] for c in cuts], kind)})

    parts = members.join(partial, ["key", "span"]).select("doc", "start", "runs").mapInArrow(shift, "doc long, cuts array<struct<start:bigint,end:bigint>>")
    cuts = stage(full.unionByName(parts).groupBy("doc").agg(F.flatten(F.collect_set("cuts")).alias("cuts")).withColumnRenamed("doc", "_doc"), "suffix-cuts")
    near, clean = split_by_keys(docs, "doc", cuts.select("_doc"), cuts.count())
    hit = near.join(cuts, F.col("doc") == F.col("_doc"), "left").select("id", "text", "cuts")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", 4 * PIECE):
                buf, offs = text_bytes(part.column("text"))
                out = []
                lists = part.column("cuts")
                bounds, flat = lists.offsets.to_numpy(), lists.values
                start, end = (flat.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                for i in range(part.num_rows):
                    data = buf[offs[i]:offs[i + 1]]
                    a, b = (x[bounds[i]:bounds[i + 1]] if lists[i].is_valid else x[:0] for x in (start, end))
                    depth = np.zeros(len(data) + 1, np.int32)
                    np.add.at(depth, a, 1)
                    np.add.at(depth, b, -1)
                    gone = np.cumsum(depth[:-1]) > 0
                    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
                    spans_ = [{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                    out.append((len(data), spans_, data[~gone].tobytes()))
                n, spans_, kept = zip(*out, strict=True) if out else ((), (), ())
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "n_bytes": pa.array(n, pa.int64()),
                                                  "spans": pa.array(spans_, kind), "kept": pa.array(kept, pa.binary())})

    id_type = docs.schema["id"].dataType.simpleString()
    done = hit.mapInArrow(remove, f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary")
    same = clean.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                        F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"), F.col("text").cast("binary").alias("kept"))
    return done.unionByName(same).withColumnRenamed("id", id_col)
