"""Encoding each distinct chunk of text once, with a bounded memory."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class ChunkMemory:
    """Ids of chunks; remembers the first ``limit`` distinct ones.

    What comes first is frequent, so the memory fills up and then stays;
    chunks beyond it are encoded once a batch.  ``encode`` takes distinct
    chunks and returns them in some order, with their ids end to end and where
    each one's ids end."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[list[bytes], np.ndarray, np.ndarray]], limit: int, dtype):
        self.encode, self.limit = encode, limit
        self.number: dict[bytes, int] = {}
        self.ids, self.ends = np.zeros(0, dtype), np.zeros(1, np.int64)

    def look_up(self, buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the chunks of ``buf`` that begin at ``starts`` and fill it,
        end to end, and where each chunk's begin (one more at the end)."""
        bounds = np.append(starts, len(buf)).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(buf))]) \
            .dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        place = np.fromiter((self.number.get(c, -1) for c in distinct), np.int64, len(distinct))
        ids, ends = self.ids, self.ends
        new = np.flatnonzero(place < 0)
        if len(new):
            chunks, more, more_ends = self.encode([distinct[i] for i in new.tolist()])
            number = {c: i for i, c in enumerate(chunks, len(ends) - 1)}
            place[new] = [number[distinct[i]] for i in new.tolist()]
            ids, ends = np.concatenate((ids, more.astype(ids.dtype))), np.concatenate((ends, ends[-1] + more_ends))
            room = self.limit - len(self.number)
            if room > 0:
                keep = min(room, len(chunks))
                self.number.update((c, number[c]) for c in chunks[:keep])
                self.ends = ends[:len(self.ends) + keep].copy()
                self.ids = ids[:self.ends[-1]].copy()
        which = place[coded.indices.to_numpy(zero_copy_only=False)]
        count = ends[which + 1] - ends[which]
        upto = np.concatenate(([0], np.cumsum(count)))
        return ids[np.repeat(ends[which] - upto[:-1], count) + np.arange(upto[-1])], upto
