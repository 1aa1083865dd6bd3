"""DuckDB SQL equivalents of ``pricelens.plans.queries`` (the correctness gate).

Written independently of the Spark code from the operator definitions; the
only shared choices are the texts built from column values and the output
column names and types.
"""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S.%f'"

# Entity decoding for the few entities the driver pages use.
def _dec(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, '&quot;', '\"'), '&middot;', '·'), "
            f"'&copy;', '©'), '&amp;', '&')")


def _param(key: str) -> str:
    return f"NULLIF(regexp_extract(url, '^[^?#]*\\?(?:[^#]*?&)??{key}=([^&#]+)', 1), '')"


_TITLE = """CASE p_type
  WHEN 'SMALL' THEN p_name || ' ' || CAST(p_size AS VARCHAR) || 'ml x ' || CAST(length(p_name) AS VARCHAR)
  WHEN 'LARGE' THEN p_name || ' ' || CAST(p_size AS VARCHAR) || '.5L x ' || CAST(length(p_brand) AS VARCHAR)
  WHEN 'PROMO' THEN p_name || CAST(p_size AS VARCHAR) || 'g x' || CAST(length(p_name) AS VARCHAR)
  WHEN 'ECONOMY' THEN p_name || ' ' || CAST(p_size AS VARCHAR) || 'ml X 6'
  WHEN 'MEDIUM' THEN CAST(p_size AS VARCHAR) || 'ml x ' || CAST(length(p_name) AS VARCHAR) || ' ' || p_name
  ELSE p_name || ' ' || CAST(p_size AS VARCHAR) || 'cl  x  ' || CAST(p_size AS VARCHAR) END"""

_SPEC_RX = "'[0-9]+ *[a-zA-Z]+ *x *[0-9]+'"

_DEC2 = "CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"

_PART_RECORDS = """r AS (SELECT
    CASE WHEN p_size = 1 THEN NULL WHEN p_size = 2 THEN '' ELSE 'PART/' || p_name END AS product_id,
    CASE WHEN p_size = 3 THEN NULL WHEN p_size = 4 THEN '' WHEN p_size = 5 THEN ' '
         ELSE concat_ws(' ', p_brand, p_type) END AS product_name,
    'http://shop.example/p?id=' || CAST(p_partkey AS VARCHAR) AS request_url, p_partkey FROM part),
  c AS (SELECT *, coalesce(length(product_id) > 0, false) AND coalesce(length(product_name) > 0, false) AS ok FROM r),
  k AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY p_partkey) AS rn FROM c WHERE ok)"""

_FIRST_SEEN = f"""SELECT user_id, event_type, event_id, strftime(ts, {FMT}) AS ts, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1"""

_K = "l_orderkey, l_linenumber, l_partkey, l_suppkey"

_LADDER_RUNGS = f"""j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, l.l_linestatus,
                p.p_retailprice FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
  rungs AS (
    SELECT {_K}, CAST(0 AS BIGINT) AS pos, CAST(1 AS BIGINT) AS unit, 'normal' AS CU_status,
           l_extendedprice / l_quantity AS price FROM j
    UNION ALL
    SELECT {_K}, 1, 1, 'original', p_retailprice FROM j
    UNION ALL
    SELECT {_K}, 2, CAST(l_quantity AS BIGINT), 'normal',
           CAST({_DEC2.format(c='l_extendedprice')} AS DOUBLE) FROM j
    UNION ALL
    SELECT {_K}, 3, CAST(l_linenumber AS BIGINT), 'normal',
           CAST({_DEC2.format(c='p_retailprice')} AS DOUBLE) FROM j WHERE l_linestatus = 'O')"""

_PART_PRODUCT_TS = "make_timestamp(1704067200000000 + p_partkey * 1000000)"

_OFFER_MIN = "SELECT l_partkey, min(l_extendedprice / l_quantity) AS p FROM lineitem"


def _canon(u: str) -> str:
    """Canonical URL: lower-cased origin, path, sorted non-empty query args, no fragment."""
    args = (f"list_sort(list_filter(string_split(regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1), '&'), "
            f"lambda a: a <> ''))")
    return (f"(lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1)) || "
            f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)', 1) || "
            f"CASE WHEN len({args}) > 0 THEN '?' || array_to_string({args}, '&') ELSE '' END)")


def _norm(c: str) -> str:
    return f"regexp_replace(lower({c}), '[[:space:][:punct:]]+', '', 'g')"


_REJECTS = f"""
WITH {_PART_RECORDS}
SELECT 'missing id or name' AS reason, product_id AS item_id, product_name AS item_name, request_url AS item_url
FROM c WHERE NOT ok
UNION ALL
SELECT 'duplicate item found', product_id, product_name, request_url FROM k WHERE rn > 1"""

ORACLES: dict[str, str] = {
    "cheapest_source": """
WITH o AS (SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_shipdate, l_quantity,
                  l_extendedprice / l_quantity AS unit_price FROM lineitem),
  f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_partkey
          ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, unit_price) AS rn FROM o)
          WHERE rn = 1),
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
          ORDER BY unit_price, l_suppkey) AS rn2 FROM f) WHERE rn2 = 1),
  a AS (SELECT l_partkey, max(unit_price) AS max_price, count(DISTINCT l_suppkey) AS n_sources,
               count(*) AS n_offers FROM f GROUP BY l_partkey)
SELECT a.l_partkey, p.p_name, c.l_suppkey AS cheapest_suppkey, c.unit_price AS cheapest_price,
       a.max_price, a.max_price - c.unit_price AS spread, a.n_sources, a.n_offers
FROM a JOIN c ON a.l_partkey = c.l_partkey JOIN part p ON p.p_partkey = a.l_partkey""",

    "page_h1": f"""
SELECT page_id, NULLIF({_dec("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS h1 FROM pages""",

    "deep_page_select": f"""
SELECT page_id, CASE WHEN page_id % 100 = 0 THEN 2499 ELSE 39 + page_id % 10 END::BIGINT AS n_inner,
       NULLIF({_dec("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")}, '') AS h1,
       length(regexp_extract_all(html, '<li><a href="([^"]*)"', 1))::BIGINT AS n_links, 0::BIGINT AS n_inside_out FROM pages""",

    "archive_pages": "SELECT page_id, url, sha256(html) AS html_sha256, length(html)::BIGINT AS n_chars FROM pages",

    "page_links": f"""
SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos, {_dec('href')} AS href FROM (
  SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS l FROM pages))""",

    "page_links_tail": f"""
SELECT page_id, CAST(pos - 1 AS BIGINT) AS pos, {_dec('href')} AS href FROM (
  SELECT page_id, unnest(l) AS href, generate_subscripts(l, 1) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="([^"]*)"', 1)[2:] AS l
        FROM pages))""",

    "page_second_link": f"""
SELECT page_id, href FROM (
  SELECT page_id, {_dec("regexp_extract_all(html, '<li><a href=\"([^\"]*)\"', 1)[2]")} AS href FROM pages)
WHERE href IS NOT NULL""",

    "page_desc_join": f"""
SELECT page_id, array_to_string(list_transform(
    list_filter(regexp_extract_all(html, '<p>([^<]*)', 1), lambda x: x <> ''), lambda x: {_dec('x')}), ' ') AS description
FROM pages""",

    "page_query_params": f"""
SELECT page_id,
  lower(NULLIF(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) AS host,
  {_param('utm_source')} AS utm_source, {_param('page')} AS page, {_param('ref')} AS ref
FROM pages""",

    "page_number_expand": f"""
SELECT page_id, CAST(i AS BIGINT) AS page_no, url || '&page=' || CAST(i AS VARCHAR) AS list_url
FROM (SELECT page_id, url,
        unnest(range(1, greatest(coalesce(TRY_CAST({_param('page')} AS BIGINT), 1), 1) + 1)) AS i
      FROM pages)""",

    "page_frontier": f"""
WITH links AS (
    SELECT CASE WHEN starts_with(h, '/') THEN o || h ELSE h END AS url FROM (
      SELECT unnest(list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: {_dec('x')})) AS h,
             regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS o
      FROM pages)),
  wanted AS (SELECT {_canon('url')} AS k, min(url) AS url FROM links GROUP BY ALL)
SELECT url FROM wanted WHERE k NOT IN (SELECT {_canon('url')} FROM pages)""",

    "frontier_next_run": f"""
WITH pg AS (
    SELECT list_transform(regexp_extract_all(html, '<a href="([^"]*)"', 1), lambda x: {_dec('x')}) AS hs,
           regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS o FROM pages),
  links AS (SELECT o, unnest(hs) AS h, generate_subscripts(hs, 1) = len(hs) AS is_last FROM pg),
  urls AS (SELECT CASE WHEN starts_with(h, '/') THEN o || h ELSE h END AS url, is_last FROM links),
  wanted AS (SELECT {_canon('url')} AS k, min(url) AS url, bool_and(is_last) AS new FROM urls GROUP BY 1)
SELECT url FROM wanted WHERE new""",

    "spec_split": f"""
WITH t AS (SELECT p_partkey, {_TITLE} AS title FROM part),
  s AS (SELECT p_partkey, title, regexp_extract(title, {_SPEC_RX}, 0) AS product_spec FROM t)
SELECT p_partkey, title, product_spec,
  CASE WHEN product_spec = '' THEN title
       WHEN strpos(title, product_spec) = 1 THEN substr(title, 1, length(title) - 1)
       ELSE substr(title, 1, greatest(strpos(title, product_spec) - 2, 0)) END AS product_name
FROM s""",

    "pack_unit_price": f"""
WITH s AS (SELECT p_partkey, p_retailprice, regexp_extract({_TITLE}, {_SPEC_RX}, 0) AS product_spec FROM part),
  p AS (SELECT p_partkey, p_retailprice, product_spec,
          TRY_CAST(NULLIF(regexp_extract(product_spec, '^([0-9]+)', 1), '') AS BIGINT) AS volume,
          lower(NULLIF(regexp_extract(product_spec, '^[0-9]+ *([a-zA-Z]+)', 1), '')) AS measure,
          TRY_CAST(NULLIF(regexp_extract(product_spec, '([0-9]+)$', 1), '') AS BIGINT) AS pack_count
        FROM s),
  f AS (SELECT *, CASE measure WHEN 'ml' THEN 'ml' WHEN 'cl' THEN 'ml' WHEN 'l' THEN 'ml'
                               WHEN 'g' THEN 'g' WHEN 'kg' THEN 'g' END AS base_measure,
                  CAST(CASE measure WHEN 'ml' THEN 1 WHEN 'cl' THEN 10 WHEN 'l' THEN 1000
                               WHEN 'g' THEN 1 WHEN 'kg' THEN 1000 END AS BIGINT) AS factor FROM p)
SELECT p_partkey, product_spec, volume, measure, pack_count, base_measure,
  p_retailprice / pack_count AS price_per_item,
  p_retailprice / (pack_count * volume * factor) * 100 AS price_per_100
FROM f""",

    "cjk_else_latin": """
SELECT p_partkey, COALESCE(NULLIF(regexp_extract(t, '[一-龥]+', 0), ''),
                           NULLIF(regexp_extract(t, '[a-zA-Z]+', 0), '')) AS category_name
FROM (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN p_name || ' 小號' WHEN 'LARGE' THEN '大號 ' || p_name
        WHEN 'PROMO' THEN CAST(p_size AS VARCHAR) WHEN 'MEDIUM' THEN 'NEW 新品 ' || p_name
        ELSE p_name END AS t FROM part)""",

    "first_number": """
WITH t AS (SELECT p_partkey, p_brand,
    'HK$' || CAST(p_size AS VARCHAR) || ',' || CAST(p_partkey AS VARCHAR) || '.00' AS comma,
    CASE p_type WHEN 'PROMO' THEN '.' WHEN 'SMALL' THEN CAST(p_size AS VARCHAR) || '.'
                WHEN 'LARGE' THEN '.' || CAST(p_size AS VARCHAR) WHEN 'MEDIUM' THEN '1.2.' || CAST(p_size AS VARCHAR)
                ELSE 'n/a' END AS odd FROM part)
SELECT p_partkey,
  TRY_CAST(NULLIF(regexp_extract(p_brand, '[0-9.]+', 0), '') AS DOUBLE) AS n_brand,
  TRY_CAST(NULLIF(regexp_extract(comma, '[0-9.]+', 0), '') AS DOUBLE) AS n_comma,
  TRY_CAST(NULLIF(regexp_extract(odd, '[0-9.]+', 0), '') AS DOUBLE) AS n_odd
FROM t""",

    "discount_parse": f"""
WITH t AS (SELECT {_K}, regexp_replace(CASE
      WHEN l_returnflag = 'A' THEN '  ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' or more HKD'
                                   || {_DEC2.format(c='l_extendedprice')} || ' '
      WHEN l_returnflag = 'R' THEN 'HKD' || {_DEC2.format(c='l_extendedprice')} || ' for '
                                   || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
      WHEN l_linestatus = 'O' THEN '   '
      ELSE ' ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' or more' END, '^\\s+|\\s+$', '', 'g') AS d
    FROM lineitem)
SELECT {_K},
  TRY_CAST(NULLIF(regexp_extract(d, '[0-9]+', 0), '') AS BIGINT) AS unit,
  TRY_CAST(NULLIF(regexp_extract(d, 'HKD([0-9.]+)', 1), '') AS DOUBLE) AS price
FROM t WHERE d <> ''""",

    "kv_map": f"""
SELECT p_partkey, CAST(p_size AS VARCHAR) || 'ml' AS spec,
  CAST(CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 1 ELSE 0 END AS BIGINT) AS has_rrp,
  CASE WHEN p_type IN ('PROMO', 'SMALL') THEN CAST({_DEC2.format(c='p_retailprice')} AS DOUBLE) END AS rrp,
  p_type AS colour, 'b:' || p_brand AS a_value,
  CAST(CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 5 ELSE 4 END AS BIGINT) AS n_keys
FROM part""",

    "price_ladder": f"""
WITH {_LADDER_RUNGS}
SELECT {_K}, pos, unit, CU_status, price FROM rungs""",

    "bulk_ladder_price": f"""
WITH j AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice,
                  l.l_linestatus, p.p_retailprice FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
  c AS (SELECT {_K}, list_filter([
          {{'u': CAST(1 AS BIGINT), 'np': -(l_extendedprice / l_quantity)}},
          {{'u': CAST(l_quantity AS BIGINT), 'np': -CAST({_DEC2.format(c='l_extendedprice')} AS DOUBLE)}},
          CASE WHEN l_linestatus = 'O' THEN
            {{'u': CAST(l_linenumber AS BIGINT), 'np': -CAST({_DEC2.format(c='p_retailprice')} AS DOUBLE)}} END],
          lambda x: x IS NOT NULL AND x.u <= 12) AS cands FROM j)
SELECT {_K}, -(list_max(cands).np) AS price_at_q FROM c""",

    "price_ladder_rrp": """
WITH now AS (SELECT l_partkey, min(l_extendedprice / l_quantity) AS now FROM lineitem GROUP BY l_partkey),
  j AS (SELECT p_partkey, p_type IN ('PROMO', 'SMALL', 'MEDIUM') AS has_rrp, p_retailprice, now
        FROM part JOIN now ON p_partkey = l_partkey),
  l AS (SELECT *, CASE WHEN has_rrp THEN p_retailprice ELSE now END AS list_price FROM j)
SELECT p_partkey, CAST(CASE WHEN has_rrp THEN 2 ELSE 1 END AS BIGINT) AS n_rungs, list_price,
  now AS current_price, list_price - now AS discount_amount,
  (list_price - now) / NULLIF(list_price, 0) AS discount_rate
FROM l""",

    "required_filter": f"""
WITH {_PART_RECORDS}
SELECT product_id, product_name, request_url, p_partkey FROM k WHERE rn = 1""",

    "rejects": _REJECTS,
    "stream_rejects": _REJECTS,

    "sketch_rollup": """
SELECT event_type, count(*) AS n_rows, count(value) AS n_values, min(value) AS value_min, max(value) AS value_max,
  count(DISTINCT user_id) AS exact_distinct, TRUE AS distinct_ok, TRUE AS quantile_ok FROM events GROUP BY event_type""",

    "first_seen": _FIRST_SEEN,
    "stream_first_seen": _FIRST_SEEN,

    "first_seen_text": """
SELECT doc_id, lang, source, n_chars
FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",

    "run_audit": f"""
SELECT event_type AS _source, count(*) AS n_items, strftime(min(ts), {FMT}) AS started_on,
  strftime(max(ts), {FMT}) AS stopped_on, epoch_us(max(ts)) - epoch_us(min(ts)) AS worked_micros
FROM events GROUP BY event_type""",

    "latest_snapshot": f"""
SELECT user_id, event_id, strftime(ts, {FMT}) AS ts, event_type, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",

    "profile": """
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE text IS NULL) AS text_nulls,
  count(*) FILTER (WHERE trim(text) = '') AS text_blanks,
  count(*) FILTER (WHERE lang IS NULL OR lang = '') AS lang_missing,
  count(*) FILTER (WHERE source IS NULL OR source = '') AS source_missing,
  count(DISTINCT doc_id) AS distinct_ids,
  count(*) - count(DISTINCT text) AS repeated_texts,
  min(n_chars) AS min_chars, max(n_chars) AS max_chars
FROM documents""",

    "bulk_price": """
WITH o AS (SELECT l_partkey, l_quantity, l_extendedprice / l_quantity AS unit_price FROM lineitem
           WHERE l_quantity <= 12),
  m AS (SELECT l_partkey, max(l_quantity) AS q FROM o GROUP BY l_partkey)
SELECT m.l_partkey, m.q AS at_quantity, min(o.unit_price) AS bulk_price
FROM m JOIN o ON o.l_partkey = m.l_partkey AND o.l_quantity = m.q
GROUP BY m.l_partkey, m.q""",

    "price_history": """
WITH per AS (SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS month,
                    min(l_extendedprice / l_quantity) AS price FROM lineitem GROUP BY ALL)
SELECT l_partkey, month, price, lag(price) OVER w AS prev_price, price - lag(price) OVER w AS delta
FROM per WINDOW w AS (PARTITION BY l_partkey ORDER BY month)""",

    "catalogue_diff": f"""
WITH a AS ({_OFFER_MIN} WHERE strftime(l_shipdate, '%Y') = '1999' GROUP BY l_partkey),
  b AS ({_OFFER_MIN} WHERE strftime(l_shipdate, '%Y') = '2000' GROUP BY l_partkey)
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, a.p AS price_a, b.p AS price_b,
  CASE WHEN a.p IS NULL THEN 'new' WHEN b.p IS NULL THEN 'delisted' WHEN a.p <> b.p THEN 'repriced'
       ELSE 'same' END AS status, b.p - a.p AS delta
FROM a FULL OUTER JOIN b ON a.l_partkey = b.l_partkey""",

    "brand_rollup": """
WITH best AS (SELECT l_partkey, min(l_extendedprice / l_quantity) AS current_price FROM lineitem GROUP BY l_partkey),
  u AS (SELECT p_partkey, 'RETAIL' AS _source, p_brand AS brand, p_retailprice AS list_price,
               p_retailprice AS current_price FROM part
        UNION ALL
        SELECT p_partkey, 'OFFER', p_brand, p_retailprice, current_price
        FROM best JOIN part ON l_partkey = p_partkey)
SELECT _source, brand, CAST(GROUPING(_source, brand) AS BIGINT) AS gid, count(*) AS n_products,
  min(current_price) AS min_price, max(current_price) AS max_price,
  CAST(sum(CAST(list_price AS DECIMAL(18,2))) AS DOUBLE) AS sum_list,
  CAST(sum(CAST(list_price AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_list,
  CAST(sum(CAST(list_price AS DECIMAL(18,6)) - CAST(current_price AS DECIMAL(18,6))) AS DOUBLE)
    / count(CAST(list_price AS DECIMAL(18,6)) - CAST(current_price AS DECIMAL(18,6))) AS avg_discount
FROM u GROUP BY ROLLUP (_source, brand)""",

    "exact_match": f"""
WITH k AS (SELECT p_partkey, p_type, {_norm('p_brand')} || '|' || {_norm('p_name')} AS match_key FROM part),
  s AS (SELECT match_key, count(*) AS n_products, count(DISTINCT p_type) AS n_sources FROM k GROUP BY match_key)
SELECT k.match_key, k.p_partkey, k.p_type, s.n_products, s.n_sources FROM k JOIN s ON k.match_key = s.match_key""",

    "similar_match": """
WITH n AS (SELECT p_name AS name, count(*) AS n,
                  list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS toks
           FROM part GROUP BY p_name),
  pr AS (SELECT a.name AS name_a, b.name AS name_b, a.n AS count_a, b.n AS count_b,
                len(list_intersect(a.toks, b.toks)) AS n_shared,
                len(list_distinct(list_concat(a.toks, b.toks))) AS n_union
         FROM n a JOIN n b ON a.name < b.name)
SELECT name_a, name_b, CAST(n_shared AS BIGINT) AS n_shared, CAST(n_union AS BIGINT) AS n_union,
  count_a, count_b, n_shared / n_union AS jaccard
FROM pr WHERE n_shared > 0 AND n_shared / n_union >= 0.3""",

    "publish_roundtrip": f"""
SELECT 'PART/' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_brand AS brand_name,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS product_desc, p_type AS category_name,
  p_retailprice AS price0, CAST(p_size AS VARCHAR) || 'ml x 1' AS product_spec,
  strftime({_PART_PRODUCT_TS}, {FMT}) AS created, 'PART' AS _source,
  strftime({_PART_PRODUCT_TS}, '%Y') AS year, strftime({_PART_PRODUCT_TS}, '%m') AS month,
  strftime({_PART_PRODUCT_TS}, '%d') AS day, strftime({_PART_PRODUCT_TS}, {FMT}) AS jsonl_created
FROM part""",

    "append_idempotent": f"""
SELECT 'PART/' || CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
  strftime({_PART_PRODUCT_TS}, {FMT}) AS created FROM part""",
}


# ---- full catalogue job on pages rendered from part -------------------------
_SITE_A_TITLE = f"""CASE WHEN p_type = 'ECONOMY' AND p_size BETWEEN 4 AND 8 THEN 'X' || CAST(p_size AS VARCHAR) || 'ml x 2'
  ELSE {_TITLE} END"""

_STAMP_SQL = f"strftime(make_timestamp(1704067200000000 + p_partkey * 1000000), {FMT})"

_SITE_A = f"""b AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
    CASE WHEN p_type = 'PROMO' THEN 'P' || CAST(p_size AS VARCHAR)
         WHEN p_type = 'STANDARD' AND p_size = 50 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS pid,
    {_SITE_A_TITLE} AS title,
    CASE WHEN p_type = 'SMALL' THEN '小號 Small' WHEN p_type = 'LARGE' THEN 'Large 大號'
         WHEN p_type = 'MEDIUM' AND p_size > 40 THEN '123 456' ELSE p_type END AS cate
  FROM part),
  s AS (SELECT *, regexp_extract(title, {_SPEC_RX}, 0) AS spec FROM b),
  r AS (SELECT *,
    'http://shop-a.example/index.php?route=product/product&path=' || CAST(p_size AS VARCHAR) || '&product_id=' || pid AS url,
    CASE WHEN spec = '' THEN title WHEN strpos(title, spec) = 1 THEN substr(title, 1, length(title) - 1)
         ELSE substr(title, 1, greatest(strpos(title, spec) - 2, 0)) END AS name,
    COALESCE(NULLIF(regexp_extract(cate, '[一-龥]+', 0), ''), NULLIF(regexp_extract(cate, '[a-zA-Z]+', 0), '')) AS cate_name,
    p_type = 'ECONOMY' AND p_size <= 3 AS err_page
  FROM s),
  e AS (SELECT *, CASE
      WHEN err_page THEN 'extract_error:error_page'
      WHEN pid = '' THEN 'extract_error:product_id'
      WHEN cate_name IS NULL THEN 'extract_error:product_category'
      WHEN (p_type = 'STANDARD' AND p_size BETWEEN 45 AND 49) OR (p_type = 'SMALL' AND p_size > 47)
        THEN 'extract_error:price'
      WHEN name = '' THEN 'missing id or name' END AS err,
    CASE WHEN pid = '' THEN NULL ELSE 'SITEA/' || pid END AS product_id,
    CASE WHEN err_page THEN NULL ELSE name END AS product_name
  FROM r),
  k AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY p_partkey) AS rn FROM e WHERE err IS NULL)"""

_SITE_B = """b AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
    CASE WHEN p_type = 'LARGE' THEN 'L' || CAST(p_size AS VARCHAR) ELSE CAST(p_partkey AS VARCHAR) END AS pid,
    p_type IN ('PROMO', 'SMALL') OR (p_type = 'MEDIUM' AND p_size > 45) AS has_rrp
  FROM part),
  e AS (SELECT *, 'https://web.shop-b.example/product/detail?itemno=' || pid AS url,
    'SITEB/' || pid AS product_id, p_name AS product_name,
    CASE WHEN p_type = 'ECONOMY' AND p_size < 4 THEN 'extract_error:product_category'
         WHEN p_type = 'MEDIUM' AND p_size > 45 THEN 'extract_error:price' END AS err
  FROM b),
  k AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY p_partkey) AS rn FROM e WHERE err IS NULL)"""

_MONEY = "TRY_CAST(CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR) AS DOUBLE)"

ORACLES.update({
    "site_a_catalogue": f"""
WITH {_SITE_A}
SELECT product_id, product_name, CASE WHEN p_type = 'LARGE' THEN '' ELSE p_brand || ' ' END AS brand_name,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'http://img.example/d/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS product_desc,
  'http://img.example/p/' || CAST(p_partkey AS VARCHAR) || ' 1.jpg' AS product_image, url AS request_url,
  cate_name AS category_name, '' AS category_code, spec AS product_spec,
  CAST(CASE WHEN p_size > 10 THEN 3 ELSE 2 END AS BIGINT) AS n_rungs,
  'normal' AS status0, {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size')} AS price0,
  'original' AS status1, {_MONEY.format(x='p_retailprice')} AS price1,
  CASE WHEN p_size > 10 THEN CAST(length(p_name) AS BIGINT) END AS unit2,
  CASE WHEN p_size > 10 THEN {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size * 2')} END AS price2,
  {_STAMP_SQL} AS created, 'SITEA' AS _source
FROM k WHERE rn = 1""",

    "site_a_rejects": f"""
WITH {_SITE_A}
SELECT err AS reason, product_id AS item_id, product_name AS item_name, url AS item_url FROM e WHERE err IS NOT NULL
UNION ALL
SELECT 'duplicate item found', product_id, product_name, url FROM k WHERE rn > 1""",

    "site_b_catalogue": f"""
WITH {_SITE_B}
SELECT product_id, product_name, CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE p_brand END AS brand_name,
  p_name || ' ' || p_type AS product_desc,
  CASE WHEN p_type = 'PROMO' THEN NULL ELSE '/img/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS product_image,
  url AS request_url,
  CASE WHEN p_type = 'SMALL' AND p_size > 45 THEN 'All' ELSE p_type END AS category_name,
  CAST(p_size AS VARCHAR) AS category_code, CAST(p_size AS VARCHAR) || 'ml' AS product_spec,
  CAST(CASE WHEN has_rrp THEN 2 ELSE 1 END AS BIGINT) AS n_rungs,
  CASE WHEN has_rrp THEN 'original' ELSE 'normal' END AS status0,
  CASE WHEN has_rrp THEN {_MONEY.format(x='p_retailprice')}
       ELSE {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size')} END AS price0,
  CASE WHEN has_rrp THEN 'discount' END AS status1,
  CASE WHEN has_rrp THEN {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size')} END AS price1,
  CAST(NULL AS BIGINT) AS unit2, CAST(NULL AS DOUBLE) AS price2,
  {_STAMP_SQL} AS created, 'SITEB' AS _source
FROM k WHERE rn = 1""",

    "site_b_rejects": f"""
WITH {_SITE_B}
SELECT err AS reason, product_id AS item_id, product_name AS item_name, url AS item_url FROM e WHERE err IS NOT NULL
UNION ALL
SELECT 'duplicate item found', product_id, product_name, url FROM k WHERE rn > 1""",
})


def _prefixed(cte: str, prefix: str, names: list[str]) -> str:
    """The site CTE text with its CTE names prefixed (to use two sites in one query)."""
    import re
    for n in names:
        cte = re.sub(rf"(?m)(^|\s|,)({n}) AS \(", rf"\1{prefix}{n} AS (", cte)
        cte = re.sub(rf"\bFROM {n}\b", f"FROM {prefix}{n}", cte)
    return cte


ORACLES["cross_site_comparison"] = f"""
WITH {_prefixed(_SITE_A, "a_", ["b", "s", "r", "e", "k"])},
  {_prefixed(_SITE_B, "b_", ["b", "e", "k"])},
  o AS (
    SELECT 'SITEA' AS src, {_norm("CASE WHEN p_type = 'LARGE' THEN '' ELSE p_brand || ' ' END")} || '|' || {_norm("product_name")} AS match_key,
           {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size')} AS cur
    FROM a_k WHERE rn = 1
    UNION ALL
    SELECT 'SITEB', {_norm("COALESCE(CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE p_brand END, '')")} || '|' || {_norm("product_name")},
           {_MONEY.format(x='CAST(p_retailprice AS DECIMAL(18,2)) - p_size')}
    FROM b_k WHERE rn = 1),
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_key ORDER BY cur, src) AS rn FROM o) WHERE rn = 1),
  g AS (SELECT match_key, max(cur) AS max_price, count(DISTINCT src) AS n_sources, count(*) AS n_products
        FROM o GROUP BY match_key)
SELECT g.match_key, c.src AS cheapest_source, c.cur AS cheapest_price, g.max_price, g.max_price - c.cur AS spread,
       g.n_sources, g.n_products
FROM g JOIN c ON g.match_key = c.match_key"""


_RUNS = f"""runs AS (
    SELECT 'PART/' || CAST(p_partkey AS VARCHAR) AS product_id,
           strftime({_PART_PRODUCT_TS}, '%Y-%m-%d') AS day, p_retailprice AS price FROM part
    UNION ALL
    SELECT 'PART/' || CAST(p_partkey AS VARCHAR),
           strftime({_PART_PRODUCT_TS} + INTERVAL 1 DAY, '%Y-%m-%d'),
           CASE WHEN p_type = 'PROMO' THEN p_retailprice
                ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) - p_size AS DOUBLE) END
    FROM part WHERE p_type <> 'ECONOMY')"""

ORACLES["published_price_history"] = f"""
WITH {_RUNS}
SELECT product_id, day, price, lag(price) OVER w AS prev_price, price - lag(price) OVER w AS delta
FROM runs WINDOW w AS (PARTITION BY product_id ORDER BY day)"""

ORACLES["published_run_diff"] = f"""
WITH {_RUNS},
  a AS (SELECT product_id, min(price) AS p FROM runs WHERE day = '2024-01-01' GROUP BY product_id),
  b AS (SELECT product_id, min(price) AS p FROM runs WHERE day = '2024-01-02' GROUP BY product_id)
SELECT coalesce(a.product_id, b.product_id) AS product_id, a.p AS price_a, b.p AS price_b,
  CASE WHEN a.p IS NULL THEN 'new' WHEN b.p IS NULL THEN 'delisted' WHEN a.p <> b.p THEN 'repriced'
       ELSE 'same' END AS status, b.p - a.p AS delta
FROM a FULL OUTER JOIN b ON a.product_id = b.product_id"""


# the same runs, read from the bucketed table
ORACLES["bucketed_run_diff"] = ORACLES["published_run_diff"]
ORACLES["bucketed_price_history"] = ORACLES["published_price_history"]

ORACLES["table_as_of_version"] = """
SELECT 'PART/' || CAST(p_partkey AS VARCHAR) AS product_id, p_retailprice AS price_then,
       CASE WHEN p_type IN ('PROMO', 'ECONOMY') THEN p_retailprice ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) - p_size AS DOUBLE) END AS price_now,
       CASE WHEN p_size <= 25 THEN 0 ELSE 1 END::BIGINT AS first_version, 3::BIGINT AS n_versions FROM part"""


ORACLES["site_a_ladder_histogram"] = f"""
WITH {_SITE_A}
SELECT CAST(CASE WHEN p_size > 10 THEN 3 ELSE 2 END AS BIGINT) AS ladder_len, count(*) AS n
FROM k WHERE rn = 1 GROUP BY ALL"""


ORACLES["table_latest_snapshot"] = f"""
WITH h AS (
    SELECT 'PART/' || CAST(p_partkey AS VARCHAR) AS product_id, {_PART_PRODUCT_TS} AS ts, p_retailprice AS price
    FROM part
    UNION ALL
    SELECT 'PART/' || CAST(p_partkey AS VARCHAR), {_PART_PRODUCT_TS} + INTERVAL 1 DAY,
           CASE WHEN p_type = 'PROMO' THEN p_retailprice
                ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) - p_size AS DOUBLE) END
    FROM part WHERE p_type <> 'ECONOMY')
SELECT product_id, strftime(ts, {FMT}) AS created, price
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY ts DESC) AS rn FROM h) WHERE rn = 1"""


def _rates(col: str, null_expr: str, blank_expr: str) -> str:
    return (f"avg(CASE WHEN {null_expr} THEN 1.0 ELSE 0.0 END) AS {col}__null_rate, "
            f"avg(CASE WHEN {blank_expr} THEN 1.0 ELSE 0.0 END) AS {col}__blank_rate")


ORACLES["site_b_profile"] = f"""
WITH {_SITE_B},
  c AS (SELECT product_id, product_name,
               CASE WHEN p_type = 'MEDIUM' THEN NULL ELSE p_brand END AS brand_name,
               p_name || ' ' || p_type AS product_desc,
               CASE WHEN p_type = 'PROMO' THEN NULL ELSE '/img/' || CAST(p_partkey AS VARCHAR) || '.jpg' END AS product_image,
               CAST(p_size AS VARCHAR) || 'ml' AS product_spec
        FROM k WHERE rn = 1)
SELECT count(*) AS n_rows, count(*) - count(DISTINCT product_id) AS duplicate_ids,
  {_rates("product_id", "product_id IS NULL", "trim(product_id) = ''")},
  {_rates("product_name", "product_name IS NULL", "trim(product_name) = ''")},
  {_rates("brand_name", "brand_name IS NULL", "trim(brand_name) = ''")},
  {_rates("product_desc", "product_desc IS NULL", "trim(product_desc) = ''")},
  {_rates("product_image", "product_image IS NULL", "trim(product_image) = ''")},
  {_rates("product_spec", "product_spec IS NULL", "trim(product_spec) = ''")}
FROM c"""


ORACLES["walk_layout_a"] = """
WITH r AS (SELECT 'http://shop-a.example/index.php?route=product/category&path=' || p_size AS cat,
                  'http://shop-a.example/index.php?route=product/product&product_id=' || p_partkey AS product,
                  p_partkey // 200 + 1 AS no FROM part)
SELECT 'http://shop-a.example/' AS url, 'home' AS page_type, NULL::VARCHAR AS cate_url, NULL::VARCHAR AS subcate_url
UNION ALL SELECT DISTINCT cat, 'pagination', cat, NULL FROM r
UNION ALL SELECT DISTINCT cat || '&page=' || no, 'listing', cat, NULL FROM r
UNION ALL SELECT DISTINCT product, 'product', cat, NULL FROM r"""

ORACLES["walk_layout_b"] = """
WITH r AS (SELECT 'http://web.shop-b.example/cate/list?c=' || lower(p_type) AS cat,
                  'https://web.shop-b.example/cate/list?s=' || lower(p_type) || '-' || p_size AS sub,
                  'https://web.shop-b.example/product/detail?itemno=' || p_partkey AS product,
                  p_partkey // 200 + 1 AS no FROM part)
SELECT 'http://web.shop-b.example/' AS url, 'home' AS page_type, NULL::VARCHAR AS cate_url, NULL::VARCHAR AS subcate_url
UNION ALL SELECT DISTINCT cat, 'subcategory', cat, NULL FROM r
UNION ALL SELECT DISTINCT sub, 'pagination', cat, sub FROM r
UNION ALL SELECT DISTINCT sub || '&page=' || no, 'listing', cat, sub FROM r
UNION ALL SELECT DISTINCT product, 'product', cat, sub FROM r"""


ORACLES["walk_categories"] = """
WITH r AS (SELECT 'http://shop-a.example/index.php?route=product/category&path=' || p_size AS cat,
                  'http://shop-a.example/index.php?route=product/product&product_id=' || p_partkey AS product,
                  p_partkey // 200 + 1 AS no FROM part WHERE p_size IN (SELECT unnest(range(2, 50, 3))))
SELECT 'http://shop-a.example/' AS url, 'home' AS page_type, NULL::VARCHAR AS cate_url, NULL::VARCHAR AS subcate_url
UNION ALL SELECT DISTINCT cat, 'pagination', cat, NULL FROM r
UNION ALL SELECT DISTINCT cat || '&page=' || no, 'listing', cat, NULL FROM r
UNION ALL SELECT DISTINCT product, 'product', cat, NULL FROM r"""

ORACLES["record_chain"] = f"""
WITH {_SITE_A}, c AS (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY p_partkey) AS first FROM e
                      WHERE (err IS NULL OR err = 'missing id or name') AND p_type <> 'LARGE')
SELECT product_id, trim(p_brand) || ': ' || product_name AS product_name, trim(p_brand) AS brand_name FROM c WHERE first = 1"""

ORACLES["stream_catalogue"] = ORACLES["site_a_catalogue"]

ORACLES["exact_match_spec"] = f"""
WITH t AS (SELECT p_partkey, p_type, p_brand, p_name, regexp_extract({_TITLE}, {_SPEC_RX}, 0) AS spec FROM part),
  k AS (SELECT p_partkey, p_type, {_norm('p_brand')} || '|' || {_norm('p_name')} || '|' || {_norm('spec')} AS match_key FROM t),
  g AS (SELECT match_key, count(*) AS n_products, count(DISTINCT p_type) AS n_sources FROM k GROUP BY match_key)
SELECT p_partkey, p_type, match_key, n_products, n_sources, n_sources > 1 AS cross_source FROM k JOIN g USING (match_key)"""

# ---- prices over time, groups of similar products --------------------------------
ORACLES["price_in_force"] = f"""
WITH p AS (SELECT l_partkey, l_shipdate AS since, min(CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END) AS in_force
           FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL)
SELECT q.l_orderkey, q.l_linenumber, q.l_partkey, q.l_suppkey, p.in_force, strftime(p.since, {FMT}) AS since
FROM (SELECT * FROM lineitem WHERE l_returnflag <> 'A') q ASOF LEFT JOIN p ON q.l_partkey = p.l_partkey AND q.l_shipdate >= p.since"""

ORACLES["price_intervals"] = """
WITH m AS (SELECT l_partkey, strftime(l_shipdate, '%Y-%m') AS month, min(floor(l_extendedprice / l_quantity / 1000)::BIGINT) AS price FROM lineitem GROUP BY ALL),
r AS (SELECT month, row_number() OVER (ORDER BY month) AS no, lead(month) OVER (ORDER BY month) AS next FROM (SELECT DISTINCT month FROM m)),
x AS (SELECT m.*, no, next, CASE WHEN lag(no) OVER w = no - 1 AND lag(price) OVER w IS NOT DISTINCT FROM price THEN 0 ELSE 1 END AS new
      FROM m JOIN r USING (month) WINDOW w AS (PARTITION BY l_partkey ORDER BY no)),
i AS (SELECT *, sum(new) OVER (PARTITION BY l_partkey ORDER BY no) AS island FROM x)
SELECT l_partkey, min(month) AS valid_from, arg_max_null(next, no) AS valid_to, min(price) AS price FROM i GROUP BY l_partkey, island"""

ORACLES["similar_group_cheapest"] = """
WITH RECURSIVE named AS (
  SELECT p_partkey, concat_ws(' ', p_name, p_type, 'lot' || (p_partkey // 40)::VARCHAR, 's' || p_size::VARCHAR) AS p_name FROM part),
n AS (
  SELECT p_name AS name, min(p_partkey) AS node, list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]+')) AS toks FROM named GROUP BY p_name),
e AS MATERIALIZED (
  SELECT a.node AS s, b.node AS d FROM n a JOIN n b ON a.node <> b.node
  WHERE len(list_intersect(a.toks, b.toks)) >= 0.6 * (len(a.toks) + len(b.toks) - len(list_intersect(a.toks, b.toks))) AND len(list_intersect(a.toks, b.toks)) > 0),
w AS (SELECT node AS s, node AS d FROM n UNION SELECT w.s, e.d FROM w JOIN e ON w.d = e.s),
g AS (SELECT s AS node, min(d) AS grp FROM w GROUP BY s),
pg AS (SELECT p_partkey, grp FROM named JOIN n ON p_name = name JOIN g ON g.node = n.node),
o AS (SELECT grp, l_suppkey, min(CASE WHEN l_quantity <> 0 THEN l_extendedprice / l_quantity END) AS price FROM lineitem JOIN pg ON l_partkey = p_partkey GROUP BY ALL),
b AS (SELECT grp, (min({'p': price, 's': l_suppkey}) FILTER (price IS NOT NULL)) AS best, max(price) AS max_price, count(l_suppkey) AS n_sources FROM o GROUP BY grp)
SELECT b.grp, best.s AS cheapest_source, best.p AS cheapest_price, max_price, max_price - best.p AS spread, n_sources,
       (SELECT count(*) FROM pg WHERE pg.grp = b.grp) AS n_products FROM b"""
