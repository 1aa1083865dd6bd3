"""Record quality: required fields, first-seen dedup, rejects, audit, profile.

Dedup is skew-safe.  Over stored records (``split_first_seen``) a first pass
finds the winners by a packed order key, hash-aggregated over a few fixed-width
columns, and a second keeps them by row number; whole records do not move.
Over records that are not to be read twice, the survivor of each key is found with a
``min(struct(order..., row id))`` aggregate, which Spark combines map-side
(partial aggregation), so a key holding a third of all rows still ships one
row per map task.  ``split_quality`` returns that aggregate as the clean
catalogue (the record rides in the struct) and finds duplicates by joining
only the narrow reject fields to the one-row-per-key survivor table; AQE's
skew-join handling splits a hot key's partition on the large side.  No
window over the raw rows (a window would put the whole hot key into one
task).  ``tag_quality`` is the row-level variant (every row with its
reason) for small frames and tests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.schema import REJECT_COLS

# Fixed reason texts (as the reference reports them).
MISSING = "missing id or name"
DUPLICATE = "duplicate item found"


def missing_required(id_col: str = "product_id", name_col: str = "product_name") -> Column:
    """Reference truthiness: null and '' both fail, ' ' passes."""
    return ~(F.coalesce(F.length(id_col) > 0, F.lit(False))
             & F.coalesce(F.length(name_col) > 0, F.lit(False)))


def first_seen_flag(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add ``_first``: true for the first row per key in ``order``.

    ``order`` must end in a unique row id (full tie-break).
    """
    ordkey = F.struct(*[F.col(c) for c in order])
    winners = (df.groupBy(*keys).agg(F.min(ordkey).alias("_win")))
    tagged = df.withColumn("_ord", ordkey).join(winners, on=keys, how="inner")
    return tagged.withColumn("_first", F.col("_ord") == F.col("_win")).drop("_ord", "_win")


def first_seen(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row per key in ``order`` (deterministic, skew-safe).

    One aggregate carries the whole row inside the min struct, so there is
    no join at all: partial aggregation keeps the shuffle to one row per
    key per map task.
    """
    others = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(F.min(packed).alias("_w"))
            .select(*keys, *[F.col("_w")[c].alias(c) for c in order + others])
            .select(*df.columns))


# ---- first seen in two phases, over stored rows ---------------------------------
ROW_ID = "_row"
# Order fields a packed key takes, and the bits of each; one more tells null from
# all values.  A decimal of 38 digits holds 126 bits.
_PACKED = {"timestamp": 60, "timestamp_ntz": 60, "bigint": 64, "int": 32, "smallint": 16, "tinyint": 8, "date": 32}
_PACKED_BITS = 126


def with_row_id(df: DataFrame) -> DataFrame:
    """``df`` with a number for every row, to be stored with it."""
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def packed_order(df: DataFrame, order: list[str]) -> Column | None:
    """The order fields as one decimal that sorts like them (nulls first), or
    null if they are not numbers or times, or together too wide."""
    kinds = dict(df.dtypes)
    if any(kinds[c] not in _PACKED for c in order) or sum(_PACKED[kinds[c]] + 1 for c in order) > _PACKED_BITS:
        return None
    whole = lambda n: F.lit(str(n)).cast("decimal(38,0)")  # noqa: E731  a literal may be beyond 64 bits
    out = whole(0)
    for c in order:
        kind, bits = kinds[c], _PACKED[kinds[c]]
        number = F.unix_micros(F.col(c).cast("timestamp")) if kind.startswith("timestamp") else F.unix_date(c) if kind == "date" else F.col(c)
        place = number.cast("decimal(38,0)") + whole((1 << (bits - 1)) + 1)
        out = (out * whole(1 << (bits + 1)) + F.coalesce(place, whole(0))).cast("decimal(38,0)")
    return out


def winner_words(stored: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Phase 1, over keys, order fields and row numbers alone: which rows are the
    first of their key, 64 row numbers to a row (``word``, ``bits``).

    Both aggregates run on fixed-width buffers by hash: the packed order key with
    the row's number, then the numbers as bits."""
    packed = packed_order(stored, order)
    if packed is None or ROW_ID not in stored.columns:
        raise ValueError(f"no packed order key for {order}")
    first = stored.select(*keys, packed.alias("_o"), ROW_ID).groupBy(*keys).agg(F.min_by(ROW_ID, "_o").alias(ROW_ID))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col(ROW_ID) % 64).cast("int"))
    return first.groupBy(F.shiftright(ROW_ID, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits"))


def split_first_seen(stored: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Phase 2: (the first row of every key, all others).  ``stored`` rows are
    looked up by number in the words of phase 1: while those are small enough to
    broadcast (an eighth of a byte or more a row), no row moves."""
    words = winner_words(stored, keys, order)
    marked = stored.join(words, F.shiftright(stored[ROW_ID], 6) == words["_word"], "left") \
        .withColumn("_first", F.coalesce(F.getbit("_bits", (F.col(ROW_ID) % 64).cast("int")) == 1, F.lit(False)))
    rest = [c for c in stored.columns if c != ROW_ID]
    return marked.where("_first").select(*rest), marked.where("not _first").select(*rest)


def tag_quality(records: DataFrame, order: list[str] | None = None,
                run_cols: list[str] | None = None) -> DataFrame:
    """Add ``reject_reason`` (null = clean).

    Checks in reference order: extraction failure, then missing id/name,
    then duplicate id.  Incomplete or failed rows never claim an id, so a
    later complete row with the same id survives.
    """
    order = order or ["fetched_at", "page_id"]
    keys = (run_cols or []) + ["product_id"]
    has_err = "extract_error" in records.columns
    err = F.col("extract_error") if has_err else F.lit(None).cast("string")
    pre = records.withColumn(
        "reject_reason",
        F.when(err.isNotNull(), F.concat(F.lit("extract_error:"), err))
        .when(missing_required(), F.lit(MISSING)))
    ok = pre.filter(F.col("reject_reason").isNull())
    bad = pre.filter(F.col("reject_reason").isNotNull())
    dedup = first_seen_flag(ok, keys, order).withColumn(
        "reject_reason", F.when(~F.col("_first"), F.lit(DUPLICATE))).drop("_first")
    return dedup.unionByName(bad)


def split_quality(records: DataFrame, order: list[str] | None = None,
                  run_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean catalogue, rejects) without shuffling whole records.

    Stored records that carry a row number (``with_row_id``) are split in two
    phases, see ``split_first_seen``.  Others are not read twice: the clean catalogue is the first-seen aggregate itself (the record rides
    in the min struct; map-side combining ships one row per id per map
    task).  Rejects need only id, name and URL: the duplicate check joins
    that narrow projection with the survivors' order keys.  Same results as
    ``tag_quality`` + ``clean`` / ``rejects``.
    """
    order = order or ["fetched_at", "page_id"]
    keys = (run_cols or []) + ["product_id"]
    has_err = "extract_error" in records.columns
    err = F.col("extract_error") if has_err else F.lit(None).cast("string")
    reason = (F.when(err.isNotNull(), F.concat(F.lit("extract_error:"), err))
              .when(missing_required(), F.lit(MISSING)))
    pre = records.withColumn("reject_reason", reason)
    ok = pre.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    narrow = ["product_name", "request_url", "_source"]
    if ROW_ID in records.columns and packed_order(records, order) is not None:
        good, repeated = split_first_seen(ok.drop(*[c for c in ("extract_error",) if has_err]), keys, order)
        failed = pre.filter(F.col("reject_reason").isNotNull())
        return good, _reject_rows(failed).unionByName(_reject_rows(repeated.withColumn("reject_reason", F.lit(DUPLICATE))))
    good = first_seen(ok.drop(*[c for c in ("extract_error", ROW_ID) if c in ok.columns]), keys, order)
    ordkey = F.struct(*[F.col(c) for c in order])
    winners = ok.groupBy(*keys).agg(F.min(ordkey).alias("_win"))
    dups = (ok.select(*keys, *order, *narrow).join(winners, keys)
            .filter(ordkey != F.col("_win"))
            .withColumn("reject_reason", F.lit(DUPLICATE)))
    failed = pre.filter(F.col("reject_reason").isNotNull())
    return good, _reject_rows(failed).unionByName(_reject_rows(dups))


def _reject_rows(tagged: DataFrame) -> DataFrame:
    return tagged.select(F.col("reject_reason").alias("reason"), F.col("product_id").alias("item_id"),
                         F.col("product_name").alias("item_name"), F.col("request_url").alias("item_url"),
                         F.col("_source")).select(*REJECT_COLS)


def clean(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejects(tagged: DataFrame) -> DataFrame:
    return _reject_rows(tagged.filter(F.col("reject_reason").isNotNull()))


def run_audit(df: DataFrame, ts_col: str, group: str = "_source") -> DataFrame:
    """Per source: first and last stamp, elapsed time and record count."""
    return (df.groupBy(group)
            .agg(F.min(ts_col).alias("started_on"), F.max(ts_col).alias("stopped_on"),
                 F.count(F.lit(1)).alias("n_items"))
            .withColumn("worked_time", F.col("stopped_on") - F.col("started_on")))


def profile(df: DataFrame, cols: list[str], key: str | None = None) -> DataFrame:
    """One row of conditional counts: nulls and blanks per column."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append(F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}__nulls"))
        aggs.append(F.count(F.when(F.trim(F.col(c).cast("string")) == "", 1)).alias(f"{c}__blanks"))
    if key:
        aggs.append(F.count_distinct(key).alias(f"{key}__distinct"))
    return df.agg(*aggs)


def catalogue_profile(df: DataFrame) -> DataFrame:
    """Catalogue health in one aggregate: null/blank rate per field and
    duplicate ids (see ``ladder_histogram`` for ladder lengths)."""
    fields = ["product_id", "product_name", "brand_name", "product_desc", "product_image", "product_spec"]
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            (F.count(F.lit(1)) - F.count_distinct("product_id")).alias("duplicate_ids")]
    for c in fields:
        aggs.append(F.avg(F.when(F.col(c).isNull(), 1.0).otherwise(0.0)).alias(f"{c}__null_rate"))
        aggs.append(F.avg(F.when(F.trim(F.col(c)) == "", 1.0).otherwise(0.0)).alias(f"{c}__blank_rate"))
    return df.agg(*aggs)


def ladder_histogram(df: DataFrame) -> DataFrame:
    """Number of records per price-ladder length."""
    return df.groupBy(F.size("price").cast("bigint").alias("ladder_len")).agg(F.count(F.lit(1)).alias("n"))
