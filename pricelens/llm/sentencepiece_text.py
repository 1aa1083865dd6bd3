"""SentencePiece encoding and decoding by suffix-array matching.

Encoding works on the distinct units of a batch (a run of spaces and the word
after it; no piece reaches over a unit's bounds).  Their text, end to end, is
indexed by a suffix array; every piece is binary-searched for the range of
suffixes that begin with it, which gives all its occurrences; the occurrences,
edges between text positions, are sorted by position and relaxed in ascending
order.

The model merges pairs by rank, so relaxing does not add scores: the encoding
of a prefix ends in the one edge that stays apart from the last piece of the
prefix before it, that is, whose boundary no merge of the right order would
have joined.  Units of unusual make (very long ones, and runs of spaces,
whose pieces share one rank) are merged pair by pair with a heap instead,
which gives the same pieces.

Decoding joins the pieces' bytes; a text decodes to itself, but for U+2581,
which the model takes for a space.

Defined results: a null or empty text has no ids and decodes to the empty
text; ids outside the vocabulary are an error; other columns are kept, one
named like an output gives way to it; an empty table gives an empty table.
Texts are worked on ``SLICE_BYTES`` at a time, one text at least.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from pricelens.llm.chunks import ChunkMemory
from pricelens.llm.common import byte_slices, gather, text_bytes

SLICE_BYTES = 2 << 20
# units longer than this are merged with a heap
LONG = 96
# units remembered from batch to batch in a worker
MEMORY_UNITS = 250_000
# of units' text indexed at once
RELAX_BYTES = 1 << 18
MARK = "▁"
_NEVER = np.iinfo(np.int64).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message."""
    def number(at: int) -> tuple[int, int]:
        x = shift = 0
        while True:
            x |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return x, at
    at = 0
    while at < len(data):
        key, at = number(at)
        if key & 7 == 0:
            value, at = number(at)
        elif key & 7 == 2:
            size, at = number(at)
            value, at = data[at:at + size], at + size
        else:
            size = 4 if key & 7 == 5 else 8
            value, at = data[at:at + size], at + size
        yield key >> 3, value


class Model:
    """The pieces of a model file, and what matching and relaxing need of them."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        parts = dict(_fields(sp.serialized_model_proto()))  # the last of each field; 2: trainer, 3: normalizer
        trainer, normalizer = dict(_fields(parts[2])), dict(_fields(parts[3]))
        if trainer.get(3) != 2 or normalizer.get(1) != b"identity" or normalizer.get(4, 1) or not trainer.get(35):
            raise ValueError("needs a BPE model with byte fallback and an identity normalizer that keeps spaces")
        self.prefix = bool(normalizer.get(3, 1))
        self.size = n = sp.get_piece_size()
        self.bytes_of, plain, scores = [b""] * n, [], {}
        self.byte_ids = np.zeros(256, np.int64)
        for i in range(n):
            if sp.is_byte(i):
                b = int(sp.id_to_piece(i)[3:5], 16)
                self.byte_ids[b], self.bytes_of[i] = i, bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.bytes_of[i] = sp.id_to_piece(i).replace(MARK, " ").encode()
                plain.append(i)
                scores[i] = sp.get_score(i)
        self.ids = {self.bytes_of[i]: i for i in plain}
        multi = [i for i in plain if len(self.bytes_of[i].decode()) > 1]
        # the order of merging; equal scores share one
        ranks = {s: k + 1 for k, s in enumerate(sorted({scores[i] for i in multi}, reverse=True))}
        self.time = np.zeros(n + 1, np.int64)
        for i in multi:
            self.time[i] = ranks[scores[i]]
        seen: dict[float, int] = {}
        for i in multi:
            seen[scores[i]] = seen.get(scores[i], 0) + 1
        self.tied = [self.bytes_of[i] for i in multi if seen[scores[i]] > 1]
        if any(p.strip(b" ") for p in self.tied) or any(b" " in p.lstrip(b" ") for p in self.ids):
            raise ValueError("pieces of equal rank, or with a space inside, are not supported")
        self.newline_alone = not any(b"\n" in p and len(p) > 1 for p in self.ids)
        # each piece's own last merge; a piece that does not merge to itself never occurs
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        singles = [i for i in plain if not self.time[i]]
        usable = singles[:]
        for i in sorted(multi, key=lambda i: self.time[i]):
            got, last = self.merge(self.bytes_of[i])
            if got == [i]:
                self.left[i], self.right[i] = last
                usable.append(i)
        made = np.flatnonzero(self.left >= 0)
        key = self.left[made] * (n + 1) + self.right[made]
        order = np.argsort(key)
        self.pair_key, self.pair_time = key[order], self.time[made][order]
        # search keys: pieces' first 8 bytes, and the end of their range
        self.usable = np.array(usable, np.int64)
        self.length = np.array([len(self.bytes_of[i]) for i in usable], np.int64)
        word = lambda b, fill: int.from_bytes(b[:8].ljust(8, fill), "big")
        self.low = np.array([word(self.bytes_of[i], b"\0") for i in usable], np.uint64)
        self.high = np.array([word(self.bytes_of[i], b"\xff") for i in usable], np.uint64)
        # the 8 bytes after those
        self.next = np.array([word(self.bytes_of[i][8:], b"\0") for i in usable], np.uint64)
        self.next_mask = np.array([word(b"\xff" * min(8, max(0, len(self.bytes_of[i]) - 8)), b"\0") for i in usable], np.uint64)
        # pieces' bytes end to end, for decoding
        self.piece_ends = np.cumsum([len(b) for b in self.bytes_of])
        self.piece_bytes = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.memory = ChunkMemory(self._encode_units, MEMORY_UNITS, np.int32)

    def merge(self, unit: bytes) -> tuple[list[int], tuple[int, int] | None]:
        """Ids of a unit by merging pairs, best rank first, then leftmost; and
        the last pair merged.  An unknown character gives its bytes' ids."""
        parts = [c.encode() for c in unit.decode()]
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(i: int) -> None:
            if i >= 0 and right[i] < len(parts):
                both = parts[i] + parts[right[i]]
                if both in self.ids:
                    heapq.heappush(heap, (int(self.time[self.ids[both]]), i, both))

        for i in range(len(parts) - 1):
            offer(i)
        last = None
        while heap:
            _, i, both = heapq.heappop(heap)
            j = right[i] if parts[i] else len(parts)
            if j >= len(parts) or parts[i] + parts[j] != both:
                continue
            last = (self.ids.get(parts[i], self.size), self.ids.get(parts[j], self.size))
            parts[i], parts[j] = both, b""
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            offer(i)
            offer(left[i])
        return [x for p in parts if p for x in ([self.ids[p]] if p in self.ids else self.byte_ids[list(p)].tolist())], last

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces ``a`` and ``b``, side by side, stay so: their merges
        are undone, latest first, and no pair then at the boundary may have a
        merge due before the one undone."""
        ok, live = np.ones(len(a), bool), np.arange(len(a))
        a, b, limit = a.copy(), b.copy(), np.full(len(a), _NEVER)
        while len(live):
            key = a * (self.size + 1) + b
            at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
            joined = (self.pair_key[at] == key) & (self.pair_time[at] < limit)
            ok[live[joined]] = False
            ta, tb = self.time[a], self.time[b]
            go = ~joined & ((ta > 0) | (tb > 0))
            live, a, b, ta, tb = live[go], a[go], b[go], ta[go], tb[go]
            # of equal merges the left one comes first
            first = ta > tb
            limit = np.where(first, ta, tb + 1)
            a, b = np.where(first, self.right[a], a), np.where(first, b, self.left[b])
        return ok

    # ------------------------------------------------------ matching a batch
    def edges(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces that occur in the units: (end, length, piece), by end and,
        for one end, longest first."""
        end = np.repeat(offs[1:], np.diff(offs))
        heads = np.flatnonzero((buf & 0xC0) != 0x80)
        wide = np.lib.stride_tricks.sliding_window_view(np.concatenate((buf, np.zeros(16, np.uint8))), 16)[heads].copy()
        wide[np.arange(16)[None, :] >= (end[heads] - heads)[:, None]] = 0
        words = wide.view(">u8").astype(np.uint64)
        # the suffix array, to 8 bytes
        order = np.argsort(words[:, 0])
        suffixes, array = heads[order], words[order, 0]
        lo, hi = np.searchsorted(array, self.low, "left"), np.searchsorted(array, self.high, "right")
        count = hi - lo
        upto = np.cumsum(count)
        nth = np.repeat(lo - (upto - count), count) + np.arange(upto[-1])
        at, which = suffixes[nth], np.repeat(np.arange(len(count)), count)
        k = self.length[which]
        # beyond the 8 bytes searched, the suffix must go on alike
        ok = at + k <= end[at]
        long = np.flatnonzero(ok & (k > 8))
        ok[long] = (words[order[nth[long]], 1] & self.next_mask[which[long]]) == self.next[which[long]]
        for e in np.flatnonzero(ok & (k > 16)).tolist():
            piece = self.bytes_of[self.usable[which[e]]]
            ok[e] = buf[at[e]:at[e] + len(piece)].tobytes() == piece
        at, k, piece = at[ok], k[ok], self.usable[which[ok]]
        order = np.argsort((at + k) * 64 - k)
        return (at + k)[order], k[order], piece[order]

    def relax(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units end to end, and where each unit's end.  Positions
        ascend, all units side by side."""
        stop, edge_length, edge_piece = self.edges(buf, offs)
        n, size = len(buf), np.diff(offs)
        first = np.searchsorted(stop, np.arange(1, n + 2))
        order = np.argsort(-size, kind="stable")
        begin, size_ = offs[:-1][order], size[order]
        # by end position: the last piece of the prefix that ends there, and its length
        piece, length = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        head = np.append((buf & 0xC0) != 0x80, True)
        for e in range(1, int(size_[0]) + 1):
            b = begin[:np.searchsorted(-size_, -e, side="right")]
            b = b[head[b + e] | (size_[:len(b)] == e)]
            edge, last = first[b + e - 1], first[b + e]
            lost = []
            while len(b):
                none = edge == last
                if none.any():
                    lost.append(b[none])
                    b, edge, last = b[~none], edge[~none], last[~none]
                p, k = edge_piece[edge], edge_length[edge]
                start = b + e - k
                good = start == b
                inner = np.flatnonzero(~good)
                before = piece[start[inner] - 1]
                good[inner] = (before >= 0) & self.apart(before, p[inner])
                done = b[good] + e - 1
                piece[done], length[done] = p[good], k[good]
                b, edge, last = b[~good], edge[~good] + 1, last[~good]
            b = np.concatenate(lost) if lost else b
            if len(b):
                # a character of no piece; it merges with nothing
                k = np.ones(len(b), np.int64)
                while (more := ~head[b + e - k]).any():
                    k += more
                piece[b + e - 1], length[b + e - 1] = self.size, k
        # back from the ends of the units
        out, counts = [], np.zeros(len(size), np.int64)
        at, unit, step = offs[1:].copy(), np.arange(len(size)), 0
        while len(unit):
            k = length[at - 1]
            out.append((unit, np.full(len(unit), step), piece[at - 1], at - k, k))
            at = at - k
            go = at > offs[unit]
            unit, at, step = unit[go], at[go], step + 1
        unit, step_, p, start, k = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((-step_, unit))
        unit, p, start, k = unit[order], p[order], start[order], k[order]
        # an unknown character becomes the pieces of its bytes
        width = np.where(p == self.size, k, 1)
        upto = np.cumsum(width)
        nth = np.arange(upto[-1]) - np.repeat(upto - width, width)
        ids = np.repeat(p, width)
        raw = ids == self.size
        ids[raw] = self.byte_ids[buf[np.repeat(start, width)[raw] + nth[raw]]]
        np.add.at(counts, unit, width)
        return ids, np.cumsum(counts)

    def _encode_units(self, units: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The units in some order, their ids end to end, and where each unit's end."""
        odd = [u for u in units if len(u) > LONG or (self.tied and u[:2] == b"  ")]
        skip = set(odd)
        plain = [u for u in units if u not in skip] if odd else units
        ids, ends = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if plain:
            # edges take some fifty times the units' text: few units at a time
            parts, sizes = [], np.cumsum([len(u) for u in plain])
            cuts = np.unique(np.searchsorted(sizes, np.arange(RELAX_BYTES, sizes[-1] + RELAX_BYTES, RELAX_BYTES)) + 1)
            for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                some = plain[a:b]
                if some:
                    parts.append(self.relax(np.frombuffer(b"".join(some), np.uint8), np.cumsum([0] + [len(u) for u in some])))
            base = np.cumsum([0] + [len(p[0]) for p in parts])
            ids = np.concatenate([p[0] for p in parts])
            ends = np.concatenate([p[1] + b for p, b in zip(parts, base.tolist(), strict=False)])
        merged = [self.merge(u)[0] for u in odd]
        if merged:
            ids = np.concatenate([ids] + [np.array(m, np.int64) for m in merged])
            ends = np.concatenate((ends, len(ids) - sum(map(len, merged)) + np.cumsum([len(m) for m in merged])))
        return plain + odd, ids.astype(np.int32), ends

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts end to end, and the number of each text's."""
        buf, offs = text_bytes(col)
        if MARK.encode() in buf.tobytes():
            col = pa.array([None if t is None else t.replace(MARK, " ") for t in col.to_pylist()], pa.string())
            buf, offs = text_bytes(col)
        full = np.flatnonzero(np.diff(offs))
        counts = np.zeros(len(offs) - 1, np.int64)
        if not len(full):
            return np.zeros(0, np.int32), counts
        if self.prefix:
            buf = np.insert(buf, offs[:-1][full], 0x20)
            offs = offs + np.concatenate(([0], np.cumsum(np.diff(offs) > 0)))
        cut = np.zeros(len(buf), bool)
        cut[1:] = (buf[1:] == 0x20) & (buf[:-1] != 0x20)
        if self.newline_alone:
            cut[1:] |= (buf[1:] == 0x0A) | (buf[:-1] == 0x0A)
        cut[offs[:-1][full]] = True
        starts = np.flatnonzero(cut)
        ids, begin = self.memory.look_up(buf, starts)
        return ids, np.diff(begin[np.searchsorted(starts, offs)])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of id lists end to end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("an id outside the vocabulary")
        ids = ids.astype(np.int64)
        end = self.piece_ends[ids]
        size = end - np.where(ids > 0, self.piece_ends[ids - 1], 0)
        upto = np.cumsum(size)
        data = self.piece_bytes[np.repeat(end - upto, size) + np.arange(upto[-1])].tobytes() if len(ids) else b""
        ends = np.concatenate(([0], upto))[np.cumsum(counts)].tolist()
        skip, out, at = int(self.prefix), [], 0
        for e in ends:
            text = data[at:e]
            out.append(text[skip:].decode("utf-8", "replace") if text[:1] == b" " else text.decode("utf-8", "replace"))
            at = e
        return out


@lru_cache(2)
def model(path: str) -> Model:
    """A worker's model, read once."""
    return Model(path)


def _with(df: DataFrame, made: dict[str, str], fn) -> DataFrame:
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in made}]
    kinds = {c: df.schema[c].dataType.simpleString() for c in kept} | made
    return df.mapInArrow(fn(kept), ", ".join(f"`{c}` {k}" for c, k in kinds.items()))


def encode(df: DataFrame, model_path: str, text_col: str = "text", output: str = "ids") -> DataFrame:
    """``df`` with ``output``: the ids of each text, array<int>."""
    return _encode(df, model_path, text_col, output, None)


def round_trip(df: DataFrame, model_path: str, text_col: str = "text", output: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``df`` with the ids and the texts they decode to."""
    return _encode(df, model_path, text_col, output, decoded)


def _encode(df: DataFrame, model_path: str, text_col: str, output: str, decoded: str | None) -> DataFrame:
    made = [output] + [decoded] * bool(decoded)
    def fn(kept):
        def one(piece: pa.RecordBatch) -> pa.RecordBatch:
            # a function of its own, so that nothing is held while the next batch is gathered
            ids, n = model(model_path).encode(piece.column(text_col))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32()), pa.array(ids, pa.int32()))
            more = [lists] + [pa.array(model(model_path).decode(ids, n), pa.string())] * bool(decoded)
            return pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + more, kept + made)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in gather(batches, text_col, SLICE_BYTES):
                yield from map(one, byte_slices(batch, text_col, SLICE_BYTES))
        return run
    return _with(df, dict(zip(made, ("array<int>", "string"))), fn)


def decode(df: DataFrame, model_path: str, ids_col: str = "ids", output: str = "decoded") -> DataFrame:
    """``df`` with ``output``: the text of each id list; null is empty."""
    def fn(kept):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    piece = batch.slice(at, 512)
                    col = piece.column(ids_col)
                    n = pa.compute.fill_null(pa.compute.list_value_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                    texts = model(model_path).decode(col.flatten().to_numpy(zero_copy_only=False), n)
                    yield pa.RecordBatch.from_arrays([piece.column(c) for c in kept] + [pa.array(texts, pa.string())], kept + [output])
        return run
    return _with(df, {output: "string"}, fn)
