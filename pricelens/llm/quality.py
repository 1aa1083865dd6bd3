"""Quality classifier by co-training.

Two logistic classifiers see different views of a document: its text (how
often each ASCII byte, each pair of kinds of bytes and, hashed, each further
character and pair of such occurs in the whole text, and how its words and lines
repeat) and its page metadata (language, source,
declared length).  They start from labelled documents.  In each round both
label all unlabelled documents, and what one is confident of, by its
calibration, is added to what the other learns from.  At the end the calibrated views are
combined by weights fitted on labelled rows that neither learned from, and
score every document.

Fitting takes a bounded sample of labels, documented here: at most ``LABELLED``
labelled documents, those of smallest hash, a row each; the others count as
unlabelled.
Every unlabelled document is scored in each round, on the executors, which sum
what a Newton step takes over the confident ones; the driver sees matrices of
the features' size alone.  Scoring covers every document and whole texts.

Defined results: a null text is empty; null metadata is a value of its own; a
label is the majority of its id's rows (a tie counts as good), null labels and
labels of unknown ids are ignored; of a labelled id's documents the one whose
text and metadata have the least hash is learned from; without labels of both classes every
document has the share of good labels, or 1 without any, as its score, so
nothing is rejected blindly; null ids are scored but never learned from;
repeated rows are scored each; an empty table gives an empty table; other
columns are ignored or, in ``keep_good``, kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import byte_slices, mix64, slots, stage, text_bytes
from pricelens.llm.filters import fresh

LABELLED = 4000
ROUNDS = 4
CONFIDENT = 0.97
# of the unlabelled, about the most that one view teaches the other in a round and class
SHARE = 0.1
# steps between the logits that the share is cut by
BINS = 4096
RIDGE = 1e-2
META = ("lang", "source", "n_chars")
META_SIZE = 256
REJECT_BELOW = 0.5
SLICE_BYTES = 4 << 20

# Kinds of bytes: lower, upper, digit, space, line end, the rest of white space
# and controls, sentence marks, brackets and quotes, the other marks by eights,
# and the bytes of characters beyond ASCII.
_KIND = np.full(256, 15, np.int64)
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:?",
                             b"!", b"'\"()[]{}<>", b"#", b"$%", b"&*", b"|", b"+-=/\\_", b"@^`~")):
    _KIND[list(_chars)] = _k
_KIND[list(range(32))] = np.where(np.arange(32) == 10, 4, 14)
# places for characters beyond ASCII, and as many for pairs of neighbours
CHARS = 64
# ASCII bytes, pairs of kinds, five figures of the whole text, further characters and their pairs
TEXT_SIZE = 128 + 256 + 5 + 2 * CHARS


def _further(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the characters beyond ASCII and of neighbours among them, hashed to places."""
    at = np.flatnonzero(t >= 0xC0)
    lead, after = t[at].astype(np.uint64), np.append(t, np.zeros(3, np.uint8))[at[:, None] + np.arange(1, 4)].astype(np.uint64) & np.uint64(63)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    point = np.zeros(len(at), np.uint64)
    for k, mask in ((2, 31), (3, 15), (4, 7)):
        of = size == k
        x = lead[of] & np.uint64(mask)
        for j in range(k - 1):
            x = x << np.uint64(6) | after[of, j]
        point[of] = x
    one = mix64(point) % np.uint64(CHARS)
    near = at[1:] == at[:-1] + size[:-1]
    two = mix64(point[:-1][near] << np.uint64(32) | point[1:][near]) % np.uint64(CHARS)
    return tuple(np.bincount(x.astype(np.int64), minlength=CHARS) for x in (one, two))


def text_features(col: pa.Array) -> np.ndarray:
    """The content view of each text."""
    buf, offs = text_bytes(col)
    out = np.zeros((len(offs) - 1, TEXT_SIZE), np.float32)
    for i, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        if a == b:
            continue
        t = buf[a:b]
        kind = _KIND[t]
        row = out[i]
        # square roots of shares: rare marks count, common letters do not drown them
        row[:128] = np.sqrt(np.bincount(t, minlength=256)[:128] / len(t))
        row[128:384] = np.sqrt(np.bincount(kind[:-1] * 16 + kind[1:], minlength=256) / len(t))
        lines, words = t.tobytes().split(b"\n"), t.tobytes().split()
        again = sum(map(bytes.__eq__, words, words[1:]))
        row[384:389] = (len(set(lines)) / len(lines), len(set(words)) / max(1, len(words)), again / max(1, len(words)),
                        min(1.0, len(words) / len(t) * 4), np.log1p(len(t)) / 12)
        if (kind == 15).any():
            row[389:] = np.sqrt(np.concatenate(_further(t)) / len(t))
    return out


def meta_features(cols: list[pa.Array]) -> np.ndarray:
    """The metadata view: each column's value, numbers by size, hashed to a place."""
    n = len(cols[0]) if cols else 0
    out = np.zeros((n, META_SIZE), np.float32)
    for j, col in enumerate(cols):
        number = pa.types.is_integer(col.type) or pa.types.is_floating(col.type)
        for i, v in enumerate(col.to_pylist()):
            name = "null" if v is None else f"2^{max(0.0, float(v)).__int__().bit_length()}" if number else f"={v}"
            out[i, zlib.crc32(f"{j}{name}".encode()) % META_SIZE] = 1
    return out


class Logistic:
    """Ridge logistic regression on standardised features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None):
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale[self.scale < 1e-6] = np.inf  # a constant tells nothing
        z = np.column_stack(((x - self.mean) / self.scale, np.ones(len(x))))
        w, weight = np.zeros(z.shape[1]), np.ones(len(x)) if weight is None else weight
        ridge = np.full(len(w), RIDGE * len(x))
        ridge[-1] = 1e-6
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge), z.T @ (weight * (y - p)) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w

    def logit(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.w[:-1] + self.w[-1]

    def line(self) -> np.ndarray:
        """The logit's weights on the features as they are, the constant last."""
        v = self.w[:-1] / self.scale
        return np.append(v, self.w[-1] - self.mean @ v)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logit(x: np.ndarray, line: np.ndarray) -> np.ndarray:
    return x @ line[:-1] + line[-1]


def _newton_sums(x: np.ndarray, y: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Rows, sums, sums of squares, gradient and Hessian of ``line``, end to end."""
    z = np.column_stack((x.astype(np.float64), np.ones(len(x))))
    p = _sigmoid(z @ line)
    h = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z
    return np.concatenate(([len(x)], z[:, :-1].sum(axis=0), (z[:, :-1] ** 2).sum(axis=0), z.T @ (y - p), h[np.triu_indices(len(h))]))


def _newton_size(d: int) -> int:
    return 1 + 2 * d + (d + 1) + (d + 1) * (d + 2) // 2


class Newton:
    """Ridge logistic regression of one view, by steps from sums over all rows."""

    def __init__(self, line: np.ndarray, sums: np.ndarray):
        d = len(line) - 1
        n, self.d = sums[0], d
        mean = sums[1:1 + d] / n
        scale = np.sqrt(np.maximum(sums[1 + d:1 + 2 * d] / n - mean ** 2, 0))
        scale[scale < 1e-6] = np.inf
        # a row of standardised features is the row as it is times this
        self.to = np.diag(np.append(1 / scale, 1.0))
        self.to[-1, :-1] = -mean / scale
        self.w = np.append(np.where(np.isinf(scale), 0, line[:-1] * np.where(np.isinf(scale), 0, scale)), line[-1] + mean @ line[:-1])
        self.ridge = np.full(d + 1, RIDGE * n)
        self.ridge[-1] = 1e-6

    def step(self, sums: np.ndarray) -> tuple[np.ndarray, float]:
        """The line after a step, and the largest change of a weight."""
        d, h = self.d, np.zeros((self.d + 1, self.d + 1))
        g = sums[1 + 2 * d:2 + 3 * d]
        h[np.triu_indices(d + 1)] = sums[2 + 3 * d:]
        h = h + np.triu(h, 1).T
        step = np.linalg.solve(self.to.T @ h @ self.to + np.diag(self.ridge), self.to.T @ g - self.ridge * self.w)
        self.w += step
        return self.to @ self.w, float(np.abs(step).max())


def _said(views: list[np.ndarray], past: list) -> list[np.ndarray]:
    """For each view what the other has taught it so far of these rows: 1, 0
    or, where nothing, -1.  ``past`` has each round's (line, least logit of a
    good one, most of a bad one) of both views."""
    out = [np.full(len(v), -1) for v in views]
    for teachers in past:
        for a, (line, high, low) in enumerate(teachers):
            at, said = _logit(views[a], line), out[1 - a]
            fresh = said < 0
            said[fresh & (at >= high)] = 1
            said[fresh & (at <= low)] = 0
    return out


class Pool:
    """The features of all unlabelled documents, stored; sums over them are
    taken on the executors."""

    def __init__(self, features: DataFrame):
        self.features = features

    def _sum(self, size: int, of) -> np.ndarray:
        """The sum of the vectors ``of(views)`` of ``size`` numbers over all batches."""
        cut = 8192

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for batch in batches:
                if batch.num_rows:
                    total += of([text_bytes(batch.column(c))[0].view(np.float32).reshape(batch.num_rows, -1) for c in ("x", "m")])
            at = list(range(0, size, cut))
            yield pa.RecordBatch.from_pydict({"at": pa.array(at, pa.int32()), "v": pa.array([total[k:k + cut].tobytes() for k in at], pa.binary())})

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = {}
            for batch in batches:
                for at, v in zip(batch.column("at").to_pylist(), batch.column("v").to_pylist(), strict=True):
                    sums[at] = sums.get(at, 0) + np.frombuffer(v)
            yield pa.RecordBatch.from_pydict({"at": pa.array(list(sums), pa.int32()), "v": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

        parts = self.features.mapInArrow(add, "at int, v binary")
        found = parts.repartition(min(slots(parts.sparkSession), -(-size // cut)), "at").mapInArrow(merge, "at int, v binary").toArrow()
        out = np.zeros(size)
        for at, v in zip(found.column("at").to_pylist(), found.column("v").to_pylist(), strict=True):
            out[at:at + cut] = np.frombuffer(v)
        return out

    def confident(self, lines: list[np.ndarray], past: list) -> tuple[list[np.ndarray], int]:
        """For each view, how many rows it could teach the other by the step
        of their logit; and the number of all rows."""
        def of(views):
            said, out = _said(views, past), [np.array([len(views[0])], np.float64)]
            for a, line in enumerate(lines):
                at = _logit(views[a], line)[said[1 - a] < 0]
                out.append(np.bincount(_bin(at), minlength=BINS).astype(np.float64))
            return np.concatenate(out)

        sums = self._sum(1 + 2 * BINS, of)
        return [sums[1:1 + BINS], sums[1 + BINS:]], int(sums[0])

    def newton(self, lines: list[np.ndarray], past: list) -> list[np.ndarray]:
        """Each view's Newton sums over what it was taught."""
        sizes = [_newton_size(len(line) - 1) for line in lines]

        def of(views):
            said = _said(views, past)
            return np.concatenate([_newton_sums(v[s >= 0], s[s >= 0].astype(np.float64), line) for v, s, line in zip(views, said, lines, strict=True)])

        sums = self._sum(sum(sizes), of)
        return [sums[:sizes[0]], sums[sizes[0]:]]


def _bin(logit: np.ndarray) -> np.ndarray:
    return ((np.clip(logit, -30, 30) + 30) / 60 * (BINS - 1)).astype(np.int64)


def _cuts(count: np.ndarray, most: int) -> tuple[float, float]:
    """Logits from which and up to which rows are taught: the confident ones,
    and of these the surest steps that hold ``most``."""
    edge, sure = np.arange(BINS) * 60 / (BINS - 1) - 30, float(np.log(CONFIDENT / (1 - CONFIDENT)))
    up, down = np.cumsum(count[::-1])[::-1], np.cumsum(count)
    high = edge[np.flatnonzero(up >= most)[-1]] if up[0] >= most else -np.inf
    low = edge[min(BINS - 1, np.flatnonzero(down >= most)[0] + 1)] if down[-1] >= most else np.inf
    # the outermost steps hold all beyond
    return max(sure, min(high, 30.0)), min(-sure, max(low, -30.0))


class CoTrained:
    """The two views after co-training, and the weights that combine them."""

    def __init__(self, views: list[np.ndarray], y: np.ndarray, pool: Pool, rounds: int):
        # every fourth labelled row only calibrates
        hold = np.arange(len(y)) % 4 == 3
        if len(np.unique(y[hold])) < 2 or len(np.unique(y[~hold])) < 2:
            hold = np.zeros(len(y), bool)
        check = hold if hold.any() else ~hold
        self.lines = [Logistic(v[~hold], y[~hold]).line() for v in views]
        # the rounds' teachers, from which what was taught follows again
        self.past, self.taught = [], []
        for r in range(rounds + 1):
            self.scales = [Logistic(_logit(v[check], line)[:, None], y[check]) for v, line in zip(views, self.lines, strict=True)]
            if r == rounds:
                break
            sure = [scale.line()[0] * line + np.append(np.zeros(len(line) - 1), scale.line()[1]) for scale, line in zip(self.scales, self.lines, strict=True)]
            counts, n = pool.confident(sure, self.past)
            if not n:
                break
            self.past.append([(line, *_cuts(c, max(1, int(SHARE * n)))) for line, c in zip(sure, counts, strict=True)])
            fits = None
            for _ in range(12):
                learned = pool.newton(self.lines, self.past)
                sums = [a + _newton_sums(v[~hold], y[~hold], line) for a, v, line in zip(learned, views, self.lines, strict=True)]
                fits = fits or [Newton(line, s) for line, s in zip(self.lines, sums, strict=True)]
                self.lines, moved = zip(*[f.step(s) for f, s in zip(fits, sums, strict=True)], strict=True)
                # the error after a Newton step is of the order of its square
                if max(moved) < 1e-2:
                    break
            self.taught.append(tuple(int(a[0]) for a in learned))
        self.both = Logistic(self._calibrated([v[check] for v in views]), y[check])

    def _calibrated(self, views: list[np.ndarray]) -> np.ndarray:
        return np.column_stack([np.clip(s.logit(_logit(v, line)[:, None]), -12, 12) for s, line, v in zip(self.scales, self.lines, views, strict=True)])

    def score(self, views: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of good by both views, by content and by metadata."""
        c = self._calibrated(views)
        return _sigmoid(self.both.logit(c)), _sigmoid(c[:, 0]), _sigmoid(c[:, 1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, meta: list[str], rounds: int) -> CoTrained | float:
    """The classifier, or the share of good labels where there is nothing to tell apart."""
    named = labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull()) \
        .groupBy(F.col(f"`{id_col}`").alias("_id")).agg((F.avg(F.col(f"`{label_col}`").cast("double")) >= 0.5).cast("int").alias("_good"))
    known = named.orderBy(F.xxhash64("_id"), "_id").limit(LABELLED)
    known = stage(known, "quality-known")
    # at most LABELLED rows
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"m{j}") for j, c in enumerate(meta)]) \
        .where("id is not null").join(F.broadcast(known), F.col("id") == F.col("_id"), "left")

    def see(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                x = text_features(part.column("text"))
                m = meta_features([part.column(f"m{j}") for j in range(len(meta))]) if meta else np.zeros((len(x), META_SIZE), np.float32)
                yield pa.RecordBatch.from_pydict({"id": part.column("id"), "good": part.column("_good"),
                                                  "x": pa.array([r.tobytes() for r in x], pa.binary()), "m": pa.array([r.tobytes() for r in m], pa.binary())})

    kind = dict(rows.dtypes)["id"]
    schema = f"id {kind}, good int, x binary, m binary"
    # a row an id, chosen as the rows are read: at most LABELLED rows of some 3 KB come here
    own = [c for c in rows.columns if c != "id"]
    one = rows.where("_good is not null").groupBy("id").agg(F.min_by(F.struct(*own), F.xxhash64("text", *[c for c in own if c.startswith("m")])).alias("_one"))
    seen = one.select("id", "_one.*").mapInArrow(see, schema).orderBy("id").toArrow()
    views = [text_bytes(seen.column(c))[0].view(np.float32).reshape(seen.num_rows, -1) if seen.num_rows else np.zeros((0, 1), np.float32) for c in ("x", "m")]
    y = np.array(seen.column("good").to_pylist(), np.float64)
    if len(np.unique(y)) < 2:
        return float(y.mean()) if len(y) else 1.0
    pool = Pool(stage(rows.where("_good is null").mapInArrow(see, schema).select("x", "m"), "quality-pool"))
    return CoTrained(views, y, pool, rounds)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   meta: tuple[str, ...] = META, rounds: int = ROUNDS, keep: list[str] | None = None) -> DataFrame:
    """Every document's id (and the columns ``keep``) with ``score``, the
    probability that it is good, ``content_score`` and ``meta_score``."""
    used = [c for c in meta if c in docs.columns]
    model = fit(docs, labels, id_col, text_col, label_col, used, rounds)
    names = {"score", "content_score", "meta_score"}
    kept = [c for c in (keep or [id_col]) if c.lower() not in names]
    text, *metas = fresh(docs, "_text", *[f"_m{j}" for j in range(len(used))])
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(text), *[F.col(f"`{c}`").alias(m) for m, c in zip(metas, used, strict=True)])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, text, SLICE_BYTES):
                n = part.num_rows
                if isinstance(model, float):
                    scores = (np.full(n, model),) * 3
                else:
                    m = meta_features([part.column(m) for m in metas]) if used else np.zeros((n, META_SIZE), np.float32)
                    scores = model.score([text_features(part.column(text)), m])
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(s, pa.float64()) for s in scores],
                                                 kept + ["score", "content_score", "meta_score"])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)
    return rows.mapInArrow(judge, f"{schema}, score double, content_score double, meta_score double")


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
              meta: tuple[str, ...] = META, below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the documents scored under ``below``, its columns as they were."""
    scored = quality_scores(docs, labels, id_col, text_col, label_col, meta, keep=docs.columns)
    return scored.where(F.col("score") >= below).select(*[F.col(f"`{c}`") for c in docs.columns])
