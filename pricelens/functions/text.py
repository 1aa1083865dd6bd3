"""Scalar text helpers, all native Column expressions (no Python per row).

Every helper is null-on-failure: a value the reference would fail to parse
comes back as null, and the caller turns that into a reject reason.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (must equal the reference's for equal results):
#   first number          [0-9.]+
#   currency-tagged price HKD[0-9.]+   (the 3-character tag is dropped)
#   first integer         [0-9]+
#   CJK run               U+4E00 to U+9FA5
#   Latin run             [a-zA-Z]+
#   pack specification    [0-9]+ *[a-zA-Z]+ *x *[0-9]+   (lower-case x only)
FIRST_NUMBER_RX = r"[0-9.]+"
CURRENCY_TAG = "HKD"
FIRST_INT_RX = r"[0-9]+"
CJK_RUN_RX = "[一-龥]+"
LATIN_RUN_RX = r"[a-zA-Z]+"
PACK_SPEC_RX = r"[0-9]+ *[a-zA-Z]+ *x *[0-9]+"

# Unicode-aware: Python's str.strip() also removes U+3000 and friends.
_STRIP_RX = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Leading/trailing whitespace removed, Unicode whitespace included."""
    return F.regexp_replace(_c(c), _STRIP_RX, "")


def nonblank(c) -> Column:
    """null when the value is null or the empty string."""
    return F.nullif(_c(c), F.lit(""))


def first_match(c, pattern: str, group: int = 0) -> Column:
    """First regex match (or group), null when there is none."""
    return nonblank(F.regexp_extract(_c(c), pattern, group))


def _try_cast(c, type_name: str) -> Column:
    return _c(c).try_cast(type_name)


def first_number(c) -> Column:
    """float(first run of [0-9.]); '.' or '1.2.3' give null."""
    return _try_cast(first_match(c, FIRST_NUMBER_RX), "double")


def first_int(c) -> Column:
    """int(first run of digits), anywhere in the text."""
    return _try_cast(first_match(c, FIRST_INT_RX), "bigint")


def tagged_price(c, tag: str = CURRENCY_TAG) -> Column:
    """float of the number right after the currency tag."""
    return _try_cast(first_match(c, tag + "([0-9.]+)", 1), "double")


def cjk_else_latin(c) -> Column:
    """First CJK run, else first Latin-letter run, else null."""
    return F.coalesce(first_match(c, CJK_RUN_RX), first_match(c, LATIN_RUN_RX))


def pack_spec(title) -> Column:
    """The pack specification inside a title, '' when there is none."""
    return F.regexp_extract(_c(title), PACK_SPEC_RX, 0)


def name_before_spec(title) -> Column:
    """The title cut before its pack specification.

    Reproduces the reference rule exactly: the character right before the
    match is removed as well; a match at the very start keeps all but the
    last character; no match keeps the whole title.
    """
    t = _c(title)
    # 1-based position of the first match in code points (regexp_instr would
    # count UTF-16 units, which differ after characters outside the BMP)
    prefix = F.regexp_extract(t, "(?s)^(.*?)" + PACK_SPEC_RX, 1)
    i = F.when(t.rlike(PACK_SPEC_RX), F.char_length(prefix) + 1).otherwise(F.lit(0))
    return (F.when(t.isNull(), F.lit(None))
            .when(i == 0, t)
            .when(i == 1, F.substring(t, F.lit(1), F.char_length(t) - 1))
            .otherwise(F.substring(t, F.lit(1), F.greatest(i - 2, F.lit(0)))))


def query_param(url, key: str) -> Column:
    """First non-blank value of a query parameter, URL-decoded.

    Blank values count as absent (as in parse_qs); '+' decodes to a space;
    an undecodable value is kept literally.
    """
    raw = first_match(url, r"^[^?#]*\?(?:[^#]*?&)??" + re.escape(key) + r"=([^&#]+)", 1)
    # a '%' that does not start a valid escape stays literal, the rest decodes
    escaped = F.regexp_replace(raw, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), raw)


def url_host(url) -> Column:
    """Host name of a URL: lower case, without user info or port."""
    return F.lower(first_match(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def namespaced(source: str, c) -> Column:
    return F.concat(F.lit(source + "/"), _c(c))


def kv_map(lines) -> Column:
    """'key: value' lines -> map; split at the first ':', key untrimmed,
    value stripped, lines without ':' ignored, repeated key -> last wins.

    The last-wins rule is expressed in the array itself, so the result does
    not depend on ``spark.sql.mapKeyDedupPolicy``.
    """
    entries = F.transform(
        F.filter(_c(lines), lambda x: F.instr(x, ":") > 0),
        lambda x, i: F.struct(
            F.substring_index(x, ":", 1).alias("key"),
            i.alias("pos"),
            strip(F.substring(x, F.instr(x, ":") + 1, F.char_length(x))).alias("value")))
    # sorted by (key, position): the last entry of each key run wins -- O(k log k)
    ordered = F.array_sort(entries)
    last = F.filter(ordered, lambda e, i: F.coalesce(
        F.get(ordered, i + 1)["key"] != e["key"], F.lit(True)))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def map_get_or(m, key: str, default: str = "") -> Column:
    return F.coalesce(F.try_element_at(_c(m), F.lit(key)), F.lit(default))


def stamp_text(ts) -> Column:
    """Timestamp as the published text yyyy-MM-dd HH:mm:ss.SSSSSS."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def date_parts(ts) -> list[Column]:
    """Zero-padded UTC year / month / day partition values (strings).

    The calendar date comes from epoch microseconds, so it is the UTC date
    whatever the session time zone."""
    d = F.date_from_unix_date(F.floor(F.unix_micros(_c(ts)) / F.lit(86400000000)).cast("int"))
    return [F.date_format(d, "yyyy").alias("year"),
            F.date_format(d, "MM").alias("month"),
            F.date_format(d, "dd").alias("day")]


def norm_key(c) -> Column:
    """Comparison key: lower case, whitespace and punctuation removed."""
    return F.regexp_replace(F.lower(_c(c)), r"(?U)[\s\p{IsPunctuation}!-/:-@\[-`{-~]+", "")


def canonical_url(url) -> Column:
    """URL key for "the same page": scheme and host lower-cased, query
    arguments sorted, fragment dropped (the form a fetcher's duplicate filter
    compares).  Arguments are sorted as raw ``k=v`` text; percent-encoding is
    not re-normalised."""
    u = _c(url)
    origin = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))
    path = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    args = F.array_sort(F.filter(F.split(F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1), "&"),
                                 lambda a: a != ""))
    query = F.when(F.size(args) > 0, F.concat(F.lit("?"), F.array_join(args, "&"))).otherwise(F.lit(""))
    return F.when(u.isNull(), F.lit(None)).otherwise(F.concat(origin, path, query))
