"""Price comparison over catalogue frames (the purpose the catalogue feeds).

Design rules used throughout:
  * "first / cheapest / newest per key" is a ``min``/``max`` over a struct
    (order fields first, full tie-break last): a declarative aggregate with
    map-side partial aggregation, so a hot key never lands whole in one task;
  * windows run only on pre-aggregated, per-key-bounded inputs (e.g. one row
    per product and month);
  * matching never emits all pairs of a group: exact matches are reported as
    group statistics per product; similarity joins collapse identical names
    first and generate candidates from rare-token prefixes only;
  * money sums run in decimal and are divided as doubles at the end.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelens.functions import text as X

ORIGINAL, NORMAL, DISCOUNT = "original", "normal", "discount"


# ---- D-01 ------------------------------------------------------------------
def union_catalogues(*frames: DataFrame) -> DataFrame:
    """All sources in one frame (same contract, matched by column name)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


# ---- D-02 ------------------------------------------------------------------
def rung_rows(df: DataFrame, keys: list[str], ladder: str = "price") -> DataFrame:
    """One row per price rung, with its position in the ladder."""
    return (df.select(*keys, F.posexplode(ladder).alias("pos", "_r"))
            .select(*keys, F.col("pos").cast("bigint").alias("pos"), "_r.unit", "_r.CU_status", "_r.price"))


# ---- D-03 / D-04 -----------------------------------------------------------
def unit1_price(ladder, status: str) -> Column:
    lad = F.col(ladder) if isinstance(ladder, str) else ladder
    return F.get(F.transform(F.filter(lad, lambda r: (r["unit"] == 1) & (r["CU_status"] == status)),
                             lambda r: r["price"]), 0)


def current_price(ladder) -> Column:
    """Unit-1 'discount' price if present, else unit-1 'normal'."""
    return F.coalesce(unit1_price(ladder, DISCOUNT), unit1_price(ladder, NORMAL))


def list_price(ladder) -> Column:
    """Unit-1 'original' price; the current price when there is none."""
    return F.coalesce(unit1_price(ladder, ORIGINAL), current_price(ladder))


def discount_amount(list_p: Column, current_p: Column) -> Column:
    return list_p - current_p


def discount_rate(list_p: Column, current_p: Column) -> Column:
    """(list - current) / list; null when the list price is 0 or missing."""
    return F.try_divide(list_p - current_p, F.nullif(list_p, F.lit(0.0)))


# ---- D-05 ------------------------------------------------------------------
def price_at_quantity(ladder, q) -> Column:
    """Price of the non-'original' rung with the largest unit <= q (ties: the
    lower price).  An as-of lookup inside the array; null if none applies."""
    lad = F.col(ladder) if isinstance(ladder, str) else ladder
    qc = q if isinstance(q, Column) else F.lit(q)
    eligible = F.filter(lad, lambda r: (r["CU_status"] != ORIGINAL) & (r["unit"] <= qc)
                        & r["price"].isNotNull())
    best = F.array_max(F.transform(eligible, lambda r: F.struct(r["unit"].alias("u"),
                                                                (-r["price"]).alias("np"))))
    return -best["np"]


def bulk_price(offers: DataFrame, key: str, qty: str, price: str, q: float) -> DataFrame:
    """Per key: the largest quantity <= q among offers and the lowest price at
    that quantity.  One partial-aggregated max over a struct."""
    best = F.max(F.struct(F.col(qty).alias("q"), (-F.col(price)).alias("np")))
    return (offers.filter(F.col(qty) <= q).groupBy(key).agg(best.alias("_b"))
            .select(key, F.col("_b.q").alias("at_quantity"), (-F.col("_b.np")).alias("bulk_price")))


# ---- D-06 ------------------------------------------------------------------
# Fixed measure table: measure -> (base measure, factor to base).
MEASURES = {"ml": ("ml", 1), "cl": ("ml", 10), "l": ("ml", 1000),
            "g": ("g", 1), "kg": ("g", 1000)}


def pack_parse(spec) -> list[Column]:
    """spec 'VOL MEASURE x COUNT' -> volume, measure, pack_count, base, factor.
    Malformed parts are null."""
    s = F.col(spec) if isinstance(spec, str) else spec
    vol = X.first_match(s, r"^([0-9]+)", 1).try_cast("bigint")
    meas = F.lower(X.first_match(s, r"^[0-9]+ *([a-zA-Z]+)", 1))
    cnt = X.first_match(s, r"([0-9]+)$", 1).try_cast("bigint")
    factor = F.lit(None).cast("bigint")
    base = F.lit(None).cast("string")
    for m, (b, f) in MEASURES.items():
        factor = F.when(meas == m, F.lit(f).cast("bigint")).otherwise(factor)
        base = F.when(meas == m, F.lit(b)).otherwise(base)
    return [vol.alias("volume"), meas.alias("measure"), cnt.alias("pack_count"),
            base.alias("base_measure"), factor.alias("factor")]


def unit_prices(price: Column, volume: Column, count: Column, factor: Column) -> list[Column]:
    """Price per pack item and per 100 base units (ml or g); null where a
    size is missing, zero or beyond 64 bits."""
    per_item = F.try_divide(price, count)
    base_units = F.try_multiply(F.try_multiply(count, volume), factor)  # null beyond 64 bits
    per_100 = F.try_divide(price, base_units) * F.lit(100)
    return [per_item.alias("price_per_item"), per_100.alias("price_per_100")]


# ---- D-07 ------------------------------------------------------------------
def exact_match_groups(df: DataFrame, id_col: str, source_col: str, key: Column) -> DataFrame:
    """Per product: its normalised match key, group size and number of
    sources in the group.  Group statistics, never the pairs of a group.
    Products without a key match nothing and stand alone."""
    keyed = df.select(id_col, source_col, key.alias("match_key"))
    stats = (keyed.filter(F.col("match_key").isNotNull()).groupBy("match_key")
             .agg(F.count(F.lit(1)).alias("n_products"),
                  F.count_distinct(source_col).alias("n_sources")))
    return keyed.join(stats, "match_key", "left").fillna(1, ["n_products", "n_sources"])


def match_key(brand, name, spec=None) -> Column:
    """Normalised brand, name and, if given, pack spec; null where brand and
    name are blank, which would lump unrelated products together."""
    parts = [X.norm_key(brand), X.norm_key(name)]
    blank = F.concat_ws("", *parts) == ""
    if spec is not None:
        parts.append(X.norm_key(spec))
    return F.when(~blank, F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts]))


# ---- D-08 ------------------------------------------------------------------
def tokens(text) -> Column:
    """Latin/digit words (lower case) plus CJK character bigrams, distinct."""
    t = F.lower(F.col(text) if isinstance(text, str) else text)
    words = F.regexp_extract_all(t, F.lit(r"[a-z0-9]+"), 0)
    runs = F.regexp_extract_all(t, F.lit("[一-龥]+"), 0)
    bigrams = F.flatten(F.transform(runs, lambda r: F.when(
        F.char_length(r) < 2, F.array(r)).otherwise(
        F.transform(F.sequence(F.lit(1), F.char_length(r) - 1), lambda i: F.substring(r, i, 2)))))
    return F.array_distinct(F.concat(words, bigrams))


def similar_names(df: DataFrame, name_col: str, threshold: float) -> DataFrame:
    """Pairs of distinct names whose token-set Jaccard >= threshold.

    Exact, without a cap on candidates.  Identical names are collapsed first
    (with their counts).  Two sets of n tokens together that share one token
    reach the threshold only if n <= 1 / t + 1, and then they do: such short
    names meet on single tokens.  All other pairs must share two tokens or
    more, so they meet on pairs of tokens: with tokens ordered rarest first,
    two sets that share k or more have two common tokens among their first
    |s| - k + 2, and k is at least 2 and t * |s|.  A word that most names hold
    thus brings no names together by itself.
    """
    names = (df.groupBy(F.col(name_col).alias("name")).agg(F.count(F.lit(1)).alias("n"))
             .withColumn("toks", tokens(F.col("name")))
             .filter(F.size("toks") > 0))
    tok = names.select("name", F.explode("toks").alias("tok"))
    freq = tok.groupBy("tok").agg(F.count(F.lit(1)).alias("df"))
    ranked = (tok.join(freq, "tok")
              .groupBy("name").agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("_o"))
              .select("name", F.size("_o").alias("len"), F.transform("_o", lambda x: x["tok"]).alias("ordered")))
    # t * |s| in doubles can land just above an integer (0.28 * 25): a small
    # tolerance keeps prefixes long enough and the size tests permissive; both
    # only ever add candidates, which the exact Jaccard check then drops.
    eps = F.lit(1e-9)
    together = F.floor(F.lit(1.0 / threshold + 1) + eps)
    single = ranked.filter(F.col("len") < together).select("name", "len", F.explode("ordered").alias("key"))
    k = F.greatest(F.lit(2), F.ceil(F.lit(threshold) * F.col("len") - eps))
    prefix = F.slice("ordered", F.lit(1), (F.col("len") - k + 2).cast("int"))
    both = F.flatten(F.transform(prefix, lambda x, i: F.transform(
        F.slice(prefix, (i + 2).cast("int"), F.size(prefix)), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    double = ranked.filter(F.col("len") >= 2).select("name", "len", F.explode(both).alias("key"))

    def met(keyed: DataFrame, short: bool) -> DataFrame:
        a, b = keyed.alias("a"), keyed.alias("b")
        # size filter: Jaccard >= t needs min(|A|,|B|) >= t * max(|A|,|B|)
        sizes_ok = ((F.col("a.len") >= F.lit(threshold) * F.col("b.len") - eps)
                    & (F.col("b.len") >= F.lit(threshold) * F.col("a.len") - eps))
        total = F.col("a.len") + F.col("b.len")
        return (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.name") < F.col("b.name")) & sizes_ok
                       & ((total <= together) if short else (total > together)))
                .select(F.col("a.name").alias("name_a"), F.col("b.name").alias("name_b")))

    # names are as many as the products: never broadcast on the size of a packed file
    cand = met(single, True).unionByName(met(double, False)).distinct().hint("merge")
    na = names.select(F.col("name").alias("name_a"), F.col("toks").alias("ta"), F.col("n").alias("count_a"))
    nb = names.select(F.col("name").alias("name_b"), F.col("toks").alias("tb"), F.col("n").alias("count_b"))
    pairs = cand.join(na, "name_a").join(nb, "name_b")
    shared = F.size(F.array_intersect("ta", "tb"))
    union = F.size(F.array_union("ta", "tb"))
    out = pairs.select("name_a", "name_b", shared.cast("bigint").alias("n_shared"), union.cast("bigint").alias("n_union"),
                       "count_a", "count_b")
    out = out.withColumn("jaccard", F.col("n_shared").cast("double") / F.col("n_union").cast("double"))
    return out.filter(F.col("jaccard") >= F.lit(threshold))


# Places that the subsets of a name's tokens for one partner length may fill;
# names that would need more meet in pairs.
SUBSET_PLACES = 2048


def shared_needed(la: int, lb: int, threshold: float) -> int | None:
    """Fewest tokens sets of la and lb must share for a Jaccard >= threshold."""
    # the quotient is the one similar_names tests, so both agree on every pair
    return next((s for s in range(1, min(la, lb) + 1) if s / (la + lb - s) >= threshold), None)


def _token_subsets(lengths: list[int], threshold: float) -> tuple[list[tuple], list[int]]:
    """(len, lo, hi, pick) for every pair of lengths lo <= hi that can be
    similar: the places of each subset of a sorted token set of ``len`` whose
    size is the number to share; and the lengths of the pairs that have too many."""
    picks, beyond = [], set()
    for lo, hi in ((a, b) for a in lengths for b in lengths if a <= b):
        if lo / hi < threshold:  # even if the smaller set lies inside the larger
            continue
        need = shared_needed(lo, hi, threshold)
        if need is None:
            continue
        if comb(hi, need) * need > SUBSET_PLACES:
            beyond |= {lo, hi}
            continue
        picks += [(n, lo, hi, list(pick)) for n in {lo, hi} for pick in combinations(range(n), need)]
    return picks, sorted(beyond)


def similar_links(names: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the nodes of ``names`` (node bigint, name: one row a
    name) that connect exactly what chains of ``similar_names`` pairs connect.

    Two names of la and lb tokens are similar if and only if they share some
    ``shared_needed(la, lb)`` tokens.  So all names of either length that hold the
    same such subset are similar across, and a star to the least of them connects
    them: links grow with the names, not with the pairs of a group.  Where a
    length has too many subsets, its names meet in pairs (``similar_names``)."""
    toks = names.select("node", "name", F.array_sort(tokens("name")).alias("toks")).withColumn("len", F.size("toks")).where("len > 0")
    # one row a length
    lengths = sorted(r[0] for r in toks.select("len").distinct().collect())
    picks, beyond = _token_subsets(lengths, threshold)
    spark = names.sparkSession
    picks = spark.createDataFrame(picks, "len int, lo int, hi int, pick array<int>")
    held = toks.join(F.broadcast(picks), "len").select(
        "node", "len", "lo", "hi", F.concat_ws(" ", F.transform("pick", lambda i: F.get("toks", i))).alias("key"))
    meet = ["lo", "hi", "key"]
    first = (held.groupBy(*meet).agg(F.min("node").alias("a"), F.max("node").alias("_z"), F.min("len").alias("_s"), F.max("len").alias("_l"))
             .where("a < _z AND _s = lo AND _l = hi").select(*meet, "a"))
    links = held.join(first.hint("merge"), meet).where("node <> a").select("a", F.col("node").alias("b")).distinct()
    if not beyond:
        return links
    long = toks.where(F.col("len").isin(beyond))
    ids = lambda c: long.select(F.col("name").alias(f"name_{c}"), F.col("node").alias(c))
    pairs = similar_names(long, "name", threshold).join(ids("a").hint("merge"), "name_a").join(ids("b").hint("merge"), "name_b")
    return links.unionByName(pairs.select("a", "b"))


# ---- D-09 ------------------------------------------------------------------
def cheapest_source(offers: DataFrame, key: str, source: str, price: str,
                    tie: list[str] | None = None, one_offer_per_source: bool = False) -> DataFrame:
    """Per key: cheapest source (price, then source, then ``tie``), spread
    (max - min) and number of sources.  With ``one_offer_per_source`` (each
    source has at most one offer per key, e.g. after first-seen dedup) the
    source count is a plain count: no distinct-aggregation expand.  An offer
    without a price is counted but never the cheapest."""
    tie = tie or []
    best = F.min(F.when(F.col(price).isNotNull(),
                        F.struct(F.col(price).alias("p"), F.col(source).alias("s"), *[F.col(c) for c in tie])))
    n_sources = F.count(source) if one_offer_per_source else F.count_distinct(source)
    return (offers.groupBy(key)
            .agg(best.alias("_b"), F.max(price).alias("max_price"),
                 n_sources.alias("n_sources"), F.count(F.lit(1)).alias("n_offers"))
            .select(key, F.col("_b.s").alias("cheapest_source"), F.col("_b.p").alias("cheapest_price"),
                    "max_price", (F.col("max_price") - F.col("_b.p")).alias("spread"),
                    "n_sources", "n_offers"))


# ---- D-10 ------------------------------------------------------------------
def price_history(offers: DataFrame, key: str, period: Column, price: str) -> DataFrame:
    """One price per (product, period) -- the minimum -- with the previous
    period's price and the change.  The window sees one row per period."""
    per = (offers.groupBy(key, period.alias("period")).agg(F.min(price).alias("price")))
    w = Window.partitionBy(key).orderBy("period")
    prev = F.lag("price").over(w)
    return per.select(key, "period", "price", prev.alias("prev_price"),
                      (F.col("price") - prev).alias("delta"))


# ---- D-11 ------------------------------------------------------------------
def snapshot_diff(a: DataFrame, b: DataFrame, key: str, price: str) -> DataFrame:
    """new / delisted / repriced / same between two snapshots (one row per
    key each).  A product listed without a price is listed: a price that
    appears or goes is a repricing."""
    j = (a.select(key, F.col(price).alias("price_a"), F.lit(True).alias("in_a"))
         .join(b.select(key, F.col(price).alias("price_b"), F.lit(True).alias("in_b")), key, "full_outer"))
    return j.select(key, "price_a", "price_b", _diff_status(F.col("in_a").isNotNull(), F.col("in_b").isNotNull()).alias("status"),
                    (F.col("price_b") - F.col("price_a")).alias("delta"))


def _diff_status(in_a: Column, in_b: Column) -> Column:
    return (F.when(~in_a, F.lit("new"))
            .when(~in_b, F.lit("delisted"))
            .when(F.col("price_a").eqNullSafe(F.col("price_b")), F.lit("same"))
            .otherwise(F.lit("repriced")))


def snapshot_diff_one_pass(df: DataFrame, key: str, snap_col: str, a: str, b: str, price: str) -> DataFrame:
    """The same diff from one frame holding both snapshots: one scan, one
    partial-aggregated shuffle on the key, no join."""
    s = F.col(snap_col)
    per = (df.filter(s.isin(a, b)).groupBy(key)
           .agg(F.min(F.when(s == a, F.col(price))).alias("price_a"),
                F.min(F.when(s == b, F.col(price))).alias("price_b"),
                F.max(s == a).alias("in_a"), F.max(s == b).alias("in_b")))
    return per.select(key, "price_a", "price_b", _diff_status(F.col("in_a"), F.col("in_b")).alias("status"),
                      (F.col("price_b") - F.col("price_a")).alias("delta"))


# ---- D-12 ------------------------------------------------------------------
def brand_rollup(df: DataFrame, source: str, brand: str, list_p: str, current_p: str) -> DataFrame:
    """Counts, prices and the average discount per (source, brand) with
    source subtotals and a grand total; ``gid`` tells the levels apart.  The
    discount is list less current price, to six places, over the products that
    have both."""
    discount = F.col(list_p).cast("decimal(18,6)") - F.col(current_p).cast("decimal(18,6)")
    return (df.rollup(source, brand)
            .agg(F.count(F.lit(1)).alias("n_products"),
                 F.min(current_p).alias("min_price"), F.max(current_p).alias("max_price"),
                 F.sum(F.col(list_p).cast("decimal(18,2)")).alias("_sum_list"),
                 F.sum(discount).alias("_sum_discount"), F.count(discount).alias("_n_discount"),
                 F.grouping_id().cast("bigint").alias("gid"))
            .select(source, brand, "gid", "n_products", "min_price", "max_price",
                    F.col("_sum_list").cast("double").alias("sum_list"),
                    (F.col("_sum_list").cast("double") / F.col("n_products")).alias("avg_list"),
                    F.try_divide(F.col("_sum_discount").cast("double"), F.col("_n_discount")).alias("avg_discount")))


# ---- D-13 ------------------------------------------------------------------
def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Newest row per key (max over order, full tie-break), whole row kept."""
    others = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others])
    return (df.groupBy(*keys).agg(F.max(packed).alias("_w"))
            .select(*keys, *[F.col("_w")[c].alias(c) for c in order + others])
            .select(*df.columns))
