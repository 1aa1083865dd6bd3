"""Exact dedup by two-pass Bloom filtering, in DataFrame functions only.

Pass 1 hashes every text to two cells of a filter and keeps the cells that
more than one row hits.  The filter has ``CELLS_A_ROW`` cells a row, however many
rows there are: its cells are counted by a shuffle of numbers, never held.  The
kept cells alone are folded into bitmaps of ``BITS_A_CELL`` bits a kept cell.
Pass 2 looks each row's cells up: a row with a cell of its own cannot have an
equal and passes straight through, with its payload, unshuffled.  Only the rest,
the possibly repeated, meet on the SHA-256 of their text, which decides.

The bitmaps have ``MAX_FILTER_BITS`` at most, so the broadcast never takes more
than ``MAX_FILTER_BITS / 8`` bytes.  They grow with the texts that repeat (and one
row in some 2,000 that shares a cell by chance); with more repeated texts than suits, more rows count as possibly
repeated and shuffle, and the result stays exact.

Defined results: a null text counts as empty; a null id never stays while
another does (if all are null, ``keep_id`` is null and all are kept); rows
that repeat both id and text carry the same verdict; an empty table gives an
empty table; input columns named like an output give way to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import stage

CELLS_A_ROW = 4096
BITS_A_CELL = 32
MAX_FILTER_BITS = 1 << 30
PROBES = 2
OUTPUTS = ["keep_id", "group_size", "kept", "text_sha256"]


def _cells(text, bits: int) -> list:
    """The filter cells of a text, numbered from 1."""
    h = F.xxhash64(text)
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(bits)) + 1 for i in range(PROBES)]


def repeated_cells(df: DataFrame, text_col: str, bits: int) -> DataFrame:
    """Pass 1: the cells hit by two rows or more."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    hits = df.select(F.explode(F.array_distinct(F.array(*_cells(text, bits)))).alias("cell")).groupBy("cell").count()
    return hits.where("count > 1").select("cell")


def _folded(cell, bits: int):
    """The place of a filter cell among ``bits``, numbered from 1."""
    return F.pmod(F.xxhash64(cell), F.lit(bits)) + 1


def bitmaps(cells: DataFrame, bits: int) -> DataFrame:
    """Cells folded into bitmaps of 32,768 places."""
    place = _folded(F.col("cell"), bits)
    return cells.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def _is_set(bitmap, cell):
    """Whether the bit of ``cell`` is set in its bitmap (false without one)."""
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0, F.lit(False))


def filter_bits(keys: int, each: int) -> int:
    """Cells of a filter for ``keys`` keys at ``each`` a key: whole bitmaps, a power of two."""
    return max(32768, 1 << (max(1, keys) * each - 1).bit_length())


def marked(df: DataFrame, id_col: str, text_col: str, bits: int | None = None, most: int = MAX_FILTER_BITS) -> DataFrame:
    """Every row as ``_row`` with its ``_id``, the ``_sha`` of its text and ``_maybe``,
    whether another row may have the same text (never false where one has)."""
    bits = bits or filter_bits(df.count(), CELLS_A_ROW)
    cells = stage(repeated_cells(df, text_col, bits), "repeated-cells")
    places = min(most, filter_bits(cells.count(), BITS_A_CELL))
    seen = stage(bitmaps(cells, places), "repeated-bitmaps")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{id_col}`").alias("_id"),
                     F.sha2(text, 256).alias("_sha"), *[_folded(c, places).alias(f"_cell{i}") for i, c in enumerate(_cells(text, bits))])
    maybe = F.lit(True)
    for i in range(PROBES):
        # at most ``most`` / 8 bytes, whatever the input
        maps = F.broadcast(seen.select(F.col("bucket").alias(f"_bucket{i}"), F.col("bits").alias(f"_bits{i}")))
        rows = rows.join(maps, F.bitmap_bucket_number(f"_cell{i}") == F.col(f"_bucket{i}"), "left")
        maybe = maybe & _is_set(F.col(f"_bits{i}"), F.col(f"_cell{i}"))
    return rows.select("_row", "_id", "_sha", maybe.alias("_maybe"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int | None = None, most: int = MAX_FILTER_BITS) -> DataFrame:
    """Every row of ``df`` with ``keep_id`` (the largest id of its equals),
    ``group_size``, ``kept`` and ``text_sha256``; ``where("kept")`` dedups."""
    rows = marked(df, id_col, text_col, bits, most)
    alone = rows.where("not _maybe").select("_row", "_sha", F.col("_id").alias("_keep"), F.lit(1).cast("bigint").alias("_size"), F.lit(True).alias("_kept"))
    some = rows.where("_maybe")
    # map-side combining leaves one row a task of a hot text here, and the
    # join below splits a hot text's rows (adaptive skew join)
    groups = some.groupBy("_sha").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")).withColumnRenamed("_sha", "_group")
    met = some.join(groups, F.col("_sha") == F.col("_group")) \
        .select("_row", "_sha", "_keep", "_size", F.col("_id").eqNullSafe(F.col("_keep")).alias("_kept"))
    out = alone.unionByName(met)
    spec = {"keep_id": F.col("_keep"), "group_size": F.col("_size"), "kept": F.col("_kept"), "text_sha256": F.col("_sha")}
    names = {c.lower() for c in OUTPUTS}
    kept = [c for c in df.columns if c.lower() not in names]
    return out.select(*[F.col("_row").getField(c).alias(c) for c in kept], *[v.alias(k) for k, v in spec.items()])
