"""One-probe Bloom filters as bitmap tables, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelens.llm.common import stage

BITS_A_ROW = 8
MAX_BITS = 1 << 30


def filter_bits(rows: int) -> int:
    """Bits for ``rows`` keys: a power of two, MAX_BITS (128 MB) at most; with
    more keys than that suits, more rows pass the filter, none is lost."""
    return min(MAX_BITS, max(32768, 1 << (max(1, rows) * BITS_A_ROW - 1).bit_length()))


def _cell(key, bits: int):
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


def _bitmaps(cells: DataFrame, name: str) -> DataFrame:
    return stage(cells.groupBy(F.bitmap_bucket_number("cell").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("_bits")), name)


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names like ``stems`` that ``df`` does not have, whatever their case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in stems:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _marked(df: DataFrame, key, bits: int, maps: DataFrame) -> tuple[DataFrame, str]:
    """``df`` with whether its key's cell is set, and that column's name."""
    c, bucket, word, maybe = fresh(df, "_cell", "_bucket", "_bits", "_maybe")
    maps = maps.select(F.col("_bucket").alias(bucket), F.col("_bits").alias(word))
    cell = F.col(c)
    at = F.bitmap_bit_position(cell)
    byte = F.conv(F.hex(F.substring(F.col(word), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    on = F.coalesce(byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (at % 8).cast("int"))) != 0, F.lit(False))
    # the bitmaps take bits / 8 bytes at most
    rows = df.withColumn(c, _cell(key, bits)).join(F.broadcast(maps), F.bitmap_bucket_number(cell) == F.col(bucket), "left")
    return rows.select(*[F.col(f"`{x}`") for x in df.columns], on.alias(maybe)), maybe


def possibly_repeated(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The rows whose key other rows may have too: none that has is missing."""
    bits = filter_bits(rows)
    hits = df.select(_cell(F.col(key), bits).alias("cell")).groupBy("cell").count().where("count > 1")
    marked, maybe = _marked(df, F.col(key), bits, _bitmaps(hits, "repeated-cells"))
    return marked.where(F.col(maybe)).drop(maybe)


def split_by_keys(df: DataFrame, key: str, keys: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """``df``'s rows whose key may be in the one-column ``keys``, and those whose surely is not."""
    bits = filter_bits(rows)
    cells = keys.select(_cell(F.col(keys.columns[0]), bits).alias("cell")).dropDuplicates()
    marked, maybe = _marked(df, F.col(key), bits, _bitmaps(cells, "key-cells"))
    return marked.where(F.col(maybe)).drop(maybe), marked.where(~F.col(maybe)).drop(maybe)
