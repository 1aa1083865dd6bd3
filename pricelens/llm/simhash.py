"""Document fingerprints by SimHash, in DataFrame functions only.

Terms are a text's words (weight 1) and pairs of neighbouring words (weight 3),
each as often as it occurs.  Every term's 64-bit hash votes on 64 signed bits
with its weight; a bit of the fingerprint is set where the ones outweigh the
zeros.  Votes are summed two bits to a long, so one hash aggregate with 32 sums
a text does it in generated code, and a text's terms never leave its task.

``within_radius`` finds all fingerprints within a Hamming radius of given ones
by permuted block tables: the bits are cut into ``BLOCKS`` blocks; if two
fingerprints differ in at most ``radius`` bits, ``BLOCKS - radius`` blocks agree
whole, so for each choice of so many blocks there is a table keyed by them.
Equal fingerprints are one row with a count, a key's fingerprints are dealt
into packs of about ``PACK_ROWS``, and a probe reads the packs of its keys: no
row is made for a candidate, and a pair that several tables show counts in the
first of them.

Defined results: a null text is empty; a text without words has the
fingerprint of no votes, all zeros; equal texts have equal fingerprints; the
next document is the one that follows by id (null ids first, rows that repeat
an id by the hash of their texts), after the last the first; a single document
follows itself; other columns are ignored; an empty table gives an empty table.
A text of over 500 million words is an error.
"""

from __future__ import annotations

from itertools import combinations
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.llm.common import slots, stage

BITS = 64
WORD = r"[^\x20\x09-\x0D]+"
WORD_WEIGHT, PAIR_WEIGHT = 1, 3
# one bit in each half of a long
LANES = 0x0000000100000001
RADIUS = 3
BLOCKS = 5
PACK_ROWS = 1024


# ---- fingerprints ---------------------------------------------------------------
def _hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _bits(sums: list[str], weight: str) -> Column:
    """The fingerprint: bit i and bit i + 32 from the two halves of sum i."""
    out = F.lit(0).cast("bigint")
    for i, s in enumerate(sums):
        for bit, votes in ((i, F.col(s).bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(s, 32))):
            value = (1 << bit) - (1 << BITS if bit == BITS - 1 else 0)
            out = out.bitwiseOR(F.when(votes * 2 > F.col(weight), F.lit(value).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return out


def fingerprints(rows: DataFrame, texts: dict[str, Column], rid: str, carried: list[str] = (), within: list[str] = ()) -> DataFrame:
    """``within``, ``rid``, ``carried`` (bigint columns) and the fingerprint of
    each of ``texts``, as bigints.  ``rid`` tells rows apart; if ``rows`` are
    partitioned by ``within``, nothing is shuffled."""
    arrays = rows.select(*within, rid, *carried, *[_hashes(t).alias(f"_h{i}") for i, t in enumerate(texts.values())])
    zipped = F.arrays_zip(*[x for i in range(len(texts)) for x in (F.col(f"_h{i}").alias(f"w{i}"), F.slice(f"_h{i}", 2, F.greatest(F.size(f"_h{i}"), F.lit(1))).alias(f"n{i}"))])
    one = arrays.select(*within, rid, *carried, F.explode_outer(zipped).alias("_t"))
    one = one.select(*within, rid, *carried, *[x for i in range(len(texts)) for x in (
        F.col(f"_t.w{i}").alias(f"_w{i}"), F.when(F.col(f"_t.n{i}").isNotNull(), F.xxhash64(f"_t.w{i}", f"_t.n{i}")).alias(f"_p{i}"))])
    zero = F.lit(0).cast("bigint")
    sums = []
    for i in range(len(texts)):
        word, pair = F.coalesce(f"_w{i}", zero), F.coalesce(f"_p{i}", zero)
        sums += [F.sum(F.shiftrightunsigned(word, j).bitwiseAND(F.lit(LANES)) * WORD_WEIGHT
                       + F.shiftrightunsigned(pair, j).bitwiseAND(F.lit(LANES)) * PAIR_WEIGHT).alias(f"_s{i}_{j}") for j in range(BITS // 2)]
        sums.append((F.count(f"_w{i}") * WORD_WEIGHT + F.count(f"_p{i}") * PAIR_WEIGHT).alias(f"_n{i}"))
    voted = one.groupBy(*within, rid).agg(*[F.max(c).alias(c) for c in carried], *sums)
    return voted.select(*within, rid, *carried, *[_bits([f"_s{i}_{j}" for j in range(BITS // 2)], f"_n{i}").alias(name) for i, name in enumerate(texts)])


def simhash(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, the fingerprint as 16 hex digits."""
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("rid"))
    return fingerprints(rows, {"fp": F.col("text")}, "rid", ["id"]).select("id", as_hex("fp").alias("fingerprint"))


def as_hex(fp) -> Column:
    return F.lpad(F.lower(F.hex(fp)), BITS // 4, "0")


def likeness(a, b) -> Column:
    """Share of the bits in which two fingerprints agree."""
    return 1.0 - F.bit_count(F.col(a).bitwiseXOR(F.col(b))) / float(BITS)


# ---- all fingerprints within a radius ---------------------------------------------
def tables(radius: int, blocks: int = BLOCKS) -> list[int]:
    """The masks of the tables' keys: every choice of ``blocks - radius`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    whole = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:])]
    return [m - (1 << BITS if m >> (BITS - 1) else 0) for m in (sum(c) for c in combinations(whole, blocks - radius))]


def within_radius(probes: DataFrame, rows: DataFrame, fp: str = "fp", radius: int = RADIUS) -> DataFrame:
    """For every distinct fingerprint in ``probes``: fp and ``n_near``, the number
    of rows whose fingerprint differs from it in at most ``radius`` bits."""
    masks = tables(radius)
    keyed = lambda df: df.select("*", F.inline(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col(fp).bitwiseAND(F.lit(m).cast("bigint")).alias("key")) for t, m in enumerate(masks)])))
    data = keyed(rows.groupBy(fp).agg(F.count(F.lit(1)).alias("n")))
    large = data.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > PACK_ROWS) \
        .select("t", "key", F.ceil(F.col("size") / PACK_ROWS).cast("int").alias("packs"))
    packs = F.coalesce("packs", F.lit(1))
    packed = data.join(large, ["t", "key"], "left").groupBy("t", "key", F.pmod(F.xxhash64(fp), packs).cast("int").alias("pack")) \
        .agg(F.collect_list(F.struct(F.col(fp).alias("f"), "n")).alias("members"))
    asked = keyed(probes.select(fp).distinct()).join(large, ["t", "key"], "left") \
        .select(fp, "t", "key", F.explode(F.sequence(F.lit(0), packs - 1)).alias("pack"))

    def counts(member: Column) -> Column:
        x = member["f"].bitwiseXOR(F.col(fp))
        first = F.lit(len(masks))
        for t in reversed(range(len(masks))):
            first = F.when(x.bitwiseAND(F.lit(masks[t]).cast("bigint")) == 0, F.lit(t)).otherwise(first)
        return (F.bit_count(x) <= radius) & (first == F.col("t"))

    near = F.aggregate(F.filter("members", counts), F.lit(0).cast("bigint"), lambda total, m: total + m["n"])
    return asked.join(packed, ["t", "key", "pack"]).select(fp, near.alias("n")).groupBy(fp).agg(F.sum("n").alias("n_near"))


# ---- edited texts -----------------------------------------------------------------
def _ordered_parts(docs: DataFrame, n: int) -> DataFrame:
    """``docs`` (order, h, ...) with ``part``, from 0: ranges of (order, h) that
    hold about as many rows each, however often a value of ``order`` occurs."""
    shares = [(i + 1) / n for i in range(n - 1)]
    found = docs.agg(F.percentile_approx("order", F.array(*[F.lit(s) for s in shares]), F.lit(max(10000, 10 * n)))).first()[0] if shares else []
    bounds = sorted(found or [])
    # a row finds its range in two steps of about sqrt(n) comparisons
    step = isqrt(len(bounds)) + 1
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    if not groups:
        return docs.withColumn("part", F.lit(0))
    long = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    ends, inner = long([g[-1] for g in groups]), F.array(*[long(g) for g in groups])
    below = lambda arr: F.size(F.filter(arr, lambda b: b < F.col("order")))
    docs = docs.withColumn("_g", below(ends))
    lower = F.col("_g") * step + F.coalesce(below(F.get(inner, F.col("_g"))), F.lit(0))
    same = {b: bounds.count(b) for b in set(bounds) if bounds.count(b) > 1}
    more = F.lit(0)
    if same:  # an id so frequent that it fills ranges: its rows are dealt to them by hash
        times = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in sorted(same.items()) for x in kv]), F.col("order")), F.lit(0).cast("bigint"))
        more = F.least(F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * (times + 1)), times).cast("int")
    return docs.withColumn("part", (lower + more).cast("int")).drop("_g")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """For every document: doc_id, n_chars, edited_sha256, and as bigints its
    fingerprint ``fp``, that of its edited text ``edited_fp`` (the last
    floor(n_chars / share) characters replaced by the first as many, or all, of
    the next document) and of the next document ``next_fp``; stored."""
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    docs = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), text.alias("text")) \
        .withColumns({"order": F.coalesce("id", F.lit(-(1 << 63)).cast("bigint")), "h": F.xxhash64("text")})
    n = slots(spark)
    docs = _ordered_parts(docs, n)
    # each range's first document also ends the range before: one row a range
    firsts = sorted((r["part"], r["lo"]["order"], r["lo"]["h"]) for r in docs.groupBy("part").agg(F.min(F.struct("order", "h")).alias("lo")).collect())
    if not firsts:
        firsts = [(0, 0, 0)]
    before = {p: firsts[i - 1][0] for i, (p, _, _) in enumerate(firsts)}
    heads = docs.where(F.col("id").isin(sorted({o for _, o, _ in firsts})) | F.col("id").isNull())
    place = spark.createDataFrame([(before[p], p, o, h) for p, o, h in firsts], "back int, part int, order long, h long")
    heads = heads.join(place, ["part", "order", "h"]).dropDuplicates(["part"]).select("id", "text", "order", "h", F.col("back").alias("part"), F.lit(1).alias("copy"))
    rows = docs.select("id", "text", "order", "h", "part", F.lit(0).alias("copy")).unionByName(heads).repartitionById(n, F.col("part"))
    along = Window.partitionBy("part").orderBy("copy", "order", "h", "text")
    rows = rows.withColumn("next", F.lead("text").over(along)).withColumn("rid", F.monotonically_increasing_id())
    chars = F.char_length("text")
    cut = F.floor(chars / share).cast("int")
    rows = rows.withColumn("edited", F.when(F.col("copy") == 0, F.concat(F.substring("text", F.lit(1), chars - cut), F.substring("next", F.lit(1), cut))))
    digest = F.sha2("edited", 256)
    carried = {"id": F.col("id"), "n_chars": chars.cast("bigint"), "copy": F.col("copy").cast("bigint"),
               **{f"d{i}": F.conv(F.substring(digest, 16 * i + 1, 16), 16, -10).cast("bigint") for i in range(4)}}
    rows = rows.select("part", "rid", "text", "edited", *[c.alias(k) for k, c in carried.items()])
    fps = fingerprints(rows, {"fp": F.col("text"), "edited_fp": F.coalesce("edited", F.lit(""))}, "rid", list(carried), ["part"])
    fps = fps.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("part").orderBy("rid"))).where("copy = 0")
    sha = F.concat(*[F.lpad(F.lower(F.hex(f"d{i}")), 16, "0") for i in range(4)])
    return stage(fps.select(F.col("id").alias("doc_id"), "n_chars", sha.alias("edited_sha256"), "fp", "edited_fp", "next_fp"), "simhash")
