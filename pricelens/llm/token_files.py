"""Token-id files with Elias-Fano document boundaries.

The documents are range-partitioned by id, tokenised, and each partition
writes one file: all its ids end to end (2 bytes each when the vocabulary
allows, else 4, little-endian), then the document boundaries and the document
ids as Elias-Fano sequences, then a fixed-size footer.  An Elias-Fano sequence
of n values below u takes about 2 + log2(u / n) bits a value; a sample of the
positions of every 64th one in its high bits is the select structure, so a
boundary is found by reading a few bytes and no table of 64-bit offsets is
stored.

A manifest (Parquet, written by Spark's committer) lists the files of the task
attempts that succeeded, so a lost executor leaves at most an unlisted file.
Files go through ``pyarrow.fs`` to the shared folder.

Defined results: a null text is empty and has the end id alone; null ids come
first; documents of equal id stay together in any order; an empty table writes
no file; other columns are ignored whatever their names.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.chunks import ChunkMemory
from pricelens.llm.common import byte_slices, gather, scratch_dir, slots, stage, text_bytes

MAGIC = b"TOKIDS01"
SAMPLE = 64
SLICE_BYTES = 8 << 20
# distinct chunks a worker remembers
MEMORY_CHUNKS = 800_000
_FOOTER = struct.Struct("<8sBxxxxxxxqqqqqqq")


# ---------------------------------------------------------------- Elias-Fano
class EliasFano:
    """A non-decreasing sequence of non-negative integers; ``seq[i]`` by select."""

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, marks: np.ndarray):
        self.n, self.bits, self.low, self.high, self.marks = n, bits, low, high, marks

    @classmethod
    def of(cls, values) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        bits = max(0, int(v[-1] // np.uint64(n)).bit_length() - 1) if n else 0
        low = np.packbits(((v[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
        ones = (v >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        raised = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        raised[ones] = 1
        return cls(n, bits, low, np.packbits(raised, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def to_bytes(self) -> bytes:
        head = struct.pack("<qqqqq", self.n, self.bits, len(self.low), len(self.high), len(self.marks))
        return head + self.low.tobytes() + self.high.tobytes() + self.marks.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data) -> EliasFano:
        n, bits, a, b, c = struct.unpack_from("<qqqqq", data)
        at = 40
        return cls(n, bits, np.frombuffer(data, np.uint8, a, at), np.frombuffer(data, np.uint8, b, at + a), np.frombuffer(data, "<u4", c, at + a + b))

    def _low(self, i: int) -> int:
        at = i * self.bits
        part = int.from_bytes(self.low[at >> 3:(at + self.bits + 7) >> 3].tobytes(), "little")
        return (part >> (at & 7)) & ((1 << self.bits) - 1)

    def __getitem__(self, i: int) -> int:
        """The i-th value: select the i-th one of the high bits from the nearest sample."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.marks[i // SAMPLE])
        left = i % SAMPLE
        byte = at >> 3
        bits = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
        bits = bits[bits >= (at & 7)]
        while left >= len(bits):
            left -= len(bits)
            byte += 1
            bits = np.flatnonzero(np.unpackbits(self.high[byte:byte + 1], bitorder="little"))
        return (byte * 8 + int(bits[left]) - i) << self.bits | self._low(i)

    def all(self) -> np.ndarray:
        """Every value at once."""
        if not self.n:
            return np.zeros(0, np.int64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        low = np.unpackbits(self.low, bitorder="little")[:self.n * self.bits].reshape(self.n, self.bits).astype(np.uint64)
        low = (low << np.arange(self.bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) if self.bits else np.zeros(self.n, np.uint64)
        return (((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.bits)) | low).astype(np.int64)


# ----------------------------------------------------------------- tokenising
def _solid(buf: np.ndarray) -> np.ndarray:
    """Bytes after which surely no white space goes on: ASCII 0x21-0x7E, or
    the end of a letter from U+00C0 to U+024F."""
    solid = (buf >= 0x21) & (buf <= 0x7E)
    if len(buf) > 1:
        solid[1:] |= (buf[1:] >= 0x80) & (buf[1:] < 0xC0) & (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xC9)
    return solid


def _cuts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Starts of chunks that tokenise alone as they do in their text: a text's
    start, and a space or newline after a solid byte.  A byte-level pre-token
    never goes on from a non-space into white space."""
    start = np.zeros(len(buf), bool)
    start[1:] = _solid(buf)[:-1] & ((buf[1:] == 0x20) | (buf[1:] == 0x0A))
    start[offs[:-1][offs[:-1] < len(buf)]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes text columns with a tokenizers file, each distinct chunk once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tok = Tokenizer.from_file(path)
        # strings that the library cuts texts at before anything else
        self.added = sorted({t["content"] for t in spec.get("added_tokens") or ()})
        pre = spec.get("pre_tokenizer") or {}
        self.byte_level = spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") \
            and pre.get("use_regex", True) and spec["model"].get("unk_token") in (None, "", "<|endoftext|>")
        size = self.tok.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        # a byte-level token's string has one character a byte
        self.length = np.zeros(size, np.int64)
        for s, i in self.tok.get_vocab(with_added_tokens=False).items():
            self.length[i] = len(s)
        self.memory = ChunkMemory(self._distinct, MEMORY_CHUNKS, self.dtype)

    def _batch(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts end to end, and the number of ids of each text."""
        buf, offs = text_bytes(col)
        n = len(offs) - 1
        if not len(buf):
            return np.zeros(0, self.dtype), np.zeros(n, np.int64)
        if not self.byte_level:
            ids = self._batch([b.decode() for b in (buf[offs[i]:offs[i + 1]].tobytes() for i in range(n))])
            return np.array([x for y in ids for x in y], self.dtype), np.array([len(y) for y in ids], np.int64)
        marked = self._marked(col)
        if marked.any():
            return self._mixed(col, marked)
        starts = _cuts(buf, offs)
        ids, begin = self.memory.look_up(buf, starts)
        return ids, np.diff(begin[np.searchsorted(starts, offs)])

    def _marked(self, col: pa.Array) -> np.ndarray:
        """The texts that hold an added token's string."""
        hit = np.zeros(len(col), bool)
        for s in self.added:
            hit |= pc.match_substring(col, s).fill_null(False).to_numpy(zero_copy_only=False)
        return hit

    def _mixed(self, col: pa.Array, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marked texts as the library encodes them whole, the others by chunks."""
        ids, n = self.encode(col.filter(pa.array(~marked)))
        whole = [np.array(x, self.dtype) for x in self._batch(col.filter(pa.array(marked)).to_pylist())]
        counts = np.zeros(len(col), np.int64)
        counts[~marked], counts[marked] = n, [len(x) for x in whole]
        own = np.repeat(marked, counts)
        out = np.zeros(len(own), self.dtype)
        out[own], out[~own] = np.concatenate(whole), ids
        return out, counts

    def _distinct(self, chunks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct chunks in another order, their ids end to end and where each one's end.

        Chunks that begin with white space and end solid are encoded joined
        up: the cuts fall between them again, found by the tokens' lengths."""
        data, ends = np.frombuffer(b"".join(chunks), np.uint8), np.cumsum([len(c) for c in chunks])
        begin = np.concatenate(([0], ends[:-1]))
        spaced = ((data[begin] == 0x20) | (data[begin] == 0x0A)) & _solid(data)[ends - 1]
        joined, alone = [chunks[i] for i in np.flatnonzero(spaced)], [chunks[i] for i in np.flatnonzero(~spaced)]
        texts = [b"".join(joined[i:i + 4000]).decode() for i in range(0, len(joined), 4000)] + [c.decode() for c in alone]
        parts, i = [], 0
        while i < len(texts):
            j, size = i, 0
            while j < len(texts) and size < 200_000:
                j, size = j + 1, size + len(texts[j])
            parts += [np.array(ids, np.int64) for ids in self._batch(texts[i:j])]
            i = j
        order = joined + alone
        sizes = np.cumsum([len(c) for c in order])
        ids = np.concatenate(parts)
        tok_ends = np.cumsum(self.length[ids])
        last = np.searchsorted(tok_ends, sizes)
        if tok_ends[-1] != sizes[-1] or not np.array_equal(tok_ends[last], sizes):
            raise ValueError("a token crosses a chunk boundary")
        return order, ids, last + 1


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """A worker's encoder, read once."""
    return Encoder(path)


# ---------------------------------------------------------------- the files
def write_file(out, blocks: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], dtype: np.dtype) -> tuple[int, int]:
    """Writes (ids, counts, document ids as masked longs) blocks; returns documents and ids."""
    counts, names, nulls, total = [], [], 0, 0
    out.write(MAGIC)
    for ids, n, (doc_ids, valid) in blocks:
        out.write(np.ascontiguousarray(ids, dtype).tobytes())
        total += len(ids)
        counts.append(n)
        nulls += int((~valid).sum())
        names.append(doc_ids[valid])
    n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
    ids = np.concatenate(names) if names else np.zeros(0, np.int64)
    base = int(ids[0]) if len(ids) else 0
    bounds = EliasFano.of(np.concatenate(([0], np.cumsum(n)))).to_bytes()
    # the difference of two longs fits an unsigned one
    docs = EliasFano.of(ids.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)).to_bytes()
    out.write(bounds)
    out.write(docs)
    out.write(_FOOTER.pack(MAGIC, dtype.itemsize, len(n), total, nulls, base, len(bounds), len(docs), 0))
    return len(n), total


class TokenFile:
    """A written file: ``len(f)`` documents, ``f[i]`` the ids of one, ``f.doc_id(i)``."""

    def __init__(self, source):
        size = source.size()
        source.seek(size - _FOOTER.size)
        magic, width, self.n, self.total, self.nulls, self.base, a, b, _ = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.source, self.dtype = source, np.dtype(f"<u{width}")
        source.seek(size - _FOOTER.size - a - b)
        tail = source.read(a + b)
        self.bounds, self.docs = EliasFano.from_bytes(tail[:a]), EliasFano.from_bytes(tail[a:])

    def __len__(self) -> int:
        return self.n

    def ids(self, start: int, end: int) -> np.ndarray:
        self.source.seek(len(MAGIC) + start * self.dtype.itemsize)
        return np.frombuffer(self.source.read((end - start) * self.dtype.itemsize), self.dtype)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ids(self.bounds[i], self.bounds[i + 1])

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.base + self.docs[i - self.nulls]

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + [self.base + x for x in self.docs.all().tolist()]


MANIFEST = "shard long, path string, n_docs long, n_ids long"


def write_token_files(df: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 2, files: int | None = None) -> DataFrame:
    """Writes ``df`` as token files under ``folder`` (a URI on a shared file
    system), ids ascending from file to file; returns the manifest."""
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        shard, coder = TaskContext.get().partitionId(), encoder(tokenizer_path)

        def blocks():
            for batch in gather(chain((first,), batches), "text", SLICE_BYTES):
                for piece in byte_slices(batch, "text", 2 * SLICE_BYTES):
                    ids, n = coder.encode(piece.column("text"))
                    ends = np.cumsum(n)
                    col = piece.column("id")
                    names = (col.fill_null(0).to_numpy(zero_copy_only=False), col.is_valid().to_numpy(zero_copy_only=False))
                    yield np.insert(ids, ends, end_id), n + 1, names

        store, path = pafs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        name = f"{path}/{shard:06d}-{uuid.uuid4().hex[:8]}.tok"
        with store.open_output_stream(name) as out:
            n_docs, n_ids = write_file(out, blocks(), coder.dtype)
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{folder}/{name.rsplit('/', 1)[1]}"], "n_docs": [n_docs], "n_ids": [n_ids]})

    ordered = docs.repartitionByRange(files or slots(df.sparkSession), F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: id, start (ids of all documents before
    it), n_tokens and ids_crc32 (of its ids as little-endian 32-bit integers)."""
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = manifest.withColumn("base", F.coalesce(before, F.lit(0)))  # one row a file

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist(), strict=True):
                store, at = pafs.FileSystem.from_uri(path)
                with store.open_input_file(at) as source:
                    f = TokenFile(source)
                    bounds, names, i = f.bounds.all(), f.doc_ids(), 0
                    while i < len(f):
                        to = max(i + 1, int(np.searchsorted(bounds, bounds[i] + (1 << 20), side="right")) - 1)
                        ids = f.ids(int(bounds[i]), int(bounds[to])).astype("<u4")
                        local = bounds[i:to + 1] - bounds[i]
                        crc = [zlib.crc32(ids[a:b]) for a, b in zip(local[:-1].tolist(), local[1:].tolist(), strict=True)]
                        yield pa.RecordBatch.from_pydict({"id": pa.array(names[i:to], pa.int64()), "start": pa.array(bounds[i:to] + base),
                                                          "n_tokens": pa.array(np.diff(local)), "ids_crc32": pa.array(crc, pa.int64())})
                        i = to

    return shards.repartition(slots(manifest.sparkSession), "shard").mapInArrow(read, "id long, start long, n_tokens long, ids_crc32 long")


def token_folder(spark) -> str:
    """A fresh folder for token files, as a URI, under the shared checkpoint folder."""
    path = scratch_dir(spark, "token-files")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
