"""The same results in plain SQL over the same tables."""

from __future__ import annotations

_LISTINGS = """
parts AS (
  SELECT p_partkey, p_brand AS brand, concat_ws(' ', p_brand, p_name, p_type, p_size) AS product_name
  FROM part),
listings AS (
  SELECT product_name,
         CASE WHEN l_orderkey % 97 <> 0 THEN l_extendedprice END AS sale_price,
         TIMESTAMP '2025-01-28 00:00:00' + to_days(l_linenumber) AS ingest_timestamp_utc,
         CASE WHEN l_suppkey % 2 = 0 THEN 'watson' ELSE 'line_shopping' END AS ecommerce_name,
         brand, l_orderkey, l_linenumber, l_partkey, l_quantity
  FROM lineitem JOIN parts ON l_partkey = p_partkey)"""

_DISTURBED = (
    _LISTINGS
    + """,
disturbed AS (
  SELECT CASE WHEN ecommerce_name = 'watson' THEN product_name
              WHEN l_partkey % 3 = 0 THEN upper(product_name)
              WHEN l_partkey % 3 = 1 THEN concat_ws(' ', p_name, p_brand, p_size, p_type)
              ELSE product_name END AS product_name,
         sale_price, ingest_timestamp_utc, ecommerce_name, brand
  FROM listings JOIN part ON l_partkey = p_partkey)"""
)

_MAP = """
name_map AS (
  SELECT min(p_partkey) AS product_no, product_name FROM parts GROUP BY product_name)"""


def _awkward(name: str, turn: str) -> str:
    return f"""CASE {turn} % 8 WHEN 0 THEN '  ' || {name} WHEN 1 THEN {name} || ' '
      WHEN 2 THEN '5" pack, ' || {name} WHEN 3 THEN '"' || {name} || '"'
      WHEN 4 THEN {name} || chr(10) || 'refill \\' WHEN 5 THEN '' WHEN 6 THEN '(none)' ELSE {name} END"""


def _latest_l(source: str) -> str:
    return f"""SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY product_name
      ORDER BY ingest_timestamp_utc DESC NULLS FIRST, sale_price ASC NULLS FIRST) AS place
    FROM {source} WHERE ecommerce_name = 'line_shopping') WHERE place = 1"""


def _latest_w(source: str) -> str:
    return f"""SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY product_name
      ORDER BY ingest_timestamp_utc DESC NULLS FIRST, sale_price ASC NULLS LAST) AS place
    FROM {source} WHERE ecommerce_name = 'watson') WHERE place = 1"""


_REPORT = f"""
{_LISTINGS},{_MAP},
of_day AS (SELECT * FROM listings WHERE CAST(ingest_timestamp_utc AS DATE) = DATE '2025-02-04'),
l AS ({_latest_l("of_day")}),
w AS ({_latest_w("of_day")}),
lm AS (SELECT product_no, l.* FROM l JOIN name_map USING (product_name)),
wm AS (SELECT product_no, w.* FROM w JOIN name_map USING (product_name)),
report AS (
  SELECT wm.product_no, wm.product_name, lm.sale_price AS price_from_line,
         wm.sale_price AS price_from_watson, lm.sale_price - wm.sale_price AS diff,
         wm.ingest_timestamp_utc
  FROM wm JOIN lm USING (product_no))"""

_HISTORY = """product_name, sale_price, ingest_timestamp_utc, ecommerce_name,
  CAST(year(ingest_timestamp_utc) AS INTEGER) AS year,
  CAST(month(ingest_timestamp_utc) AS INTEGER) AS month"""

_FLAT_L = """
flat_l AS (
  SELECT product_name, sale_price FROM listings WHERE ecommerce_name = 'line_shopping'
  UNION ALL
  SELECT product_name || ' refill', 0.0 FROM listings WHERE ecommerce_name = 'line_shopping')"""

_FLAT_W = """
flat_w AS (
  SELECT product_name, sale_price FROM listings WHERE ecommerce_name = 'watson'
  UNION ALL
  SELECT product_name || ' refill', 1000.0 FROM listings WHERE ecommerce_name = 'watson'
  UNION ALL
  SELECT product_name || ' sample', NULL FROM listings WHERE ecommerce_name = 'watson')"""

_PAGES = """
declared AS (
  SELECT ecommerce_name, brand AS query, count(*) AS total_results,
         CAST(ceil(count(*) / 200.0) AS INTEGER) AS total_pages,
         CASE WHEN ecommerce_name = 'watson' THEN 0 ELSE 1 END AS first_page
  FROM listings GROUP BY ALL)"""

# Lower-case character trigrams; a gram is three code points in one number.
_GRAMS = """
chars AS (
  SELECT product_name, lower(product_name) AS t FROM names),
grams AS MATERIALIZED (
  SELECT product_name, gram, count(*) AS tf FROM (
    SELECT product_name, unnest(list_transform(range(1, length(t) - 1), lambda i:
      (CAST(unicode(substr(t, i, 1)) AS BIGINT) * 2097152
       + unicode(substr(t, i + 1, 1))) * 2097152 + unicode(substr(t, i + 2, 1)))) AS gram
    FROM chars)
  GROUP BY ALL),
norms AS MATERIALIZED (SELECT product_name, sqrt(sum(tf * tf)) AS norm FROM grams GROUP BY ALL)"""


_SIDES = f"""
{_DISTURBED},
q AS MATERIALIZED ({_latest_l("disturbed").replace("sale_price ASC NULLS FIRST", "sale_price ASC NULLS LAST")}),
b AS MATERIALIZED ({_latest_w("disturbed")}),
names AS (SELECT product_name FROM q UNION SELECT product_name FROM b)"""


def _packed(k: int, cut: float = 0.0) -> str:
    """The best of ``scored``, and one row per query with what is ranked."""
    return f"""
ranked AS MATERIALIZED (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_name ORDER BY score DESC, name) AS INTEGER)
      AS rank FROM scored WHERE score >= {cut})
  WHERE rank <= {k}),
packed AS MATERIALIZED (
  SELECT q.product_name AS query_name, q.sale_price AS query_price,
         coalesce(c.names, []) AS names, c.prices, c.scores
  FROM q LEFT JOIN (
    SELECT query_name, list(name ORDER BY rank) AS names, list(b.sale_price ORDER BY rank) AS prices,
           list(score ORDER BY rank) AS scores
    FROM ranked JOIN b ON b.product_name = name GROUP BY query_name) c
  ON c.query_name = q.product_name)"""


def _ranked(k: int, cut: float = 0.0, blocked: bool = True) -> str:
    """Ranked candidates of each shop-L name among shop W's, best first."""
    block = "AND q.brand = b.brand" if blocked else ""
    return f"""
{_SIDES},
{_GRAMS},
qg AS MATERIALIZED (SELECT q.product_name, q.brand, gram, tf FROM q JOIN grams USING (product_name)),
bg AS MATERIALIZED (SELECT b.product_name, b.brand, gram, tf FROM b JOIN grams USING (product_name)),
dots AS MATERIALIZED (
  SELECT q.product_name AS query_name, b.product_name AS name, sum(q.tf * b.tf) AS dot
  FROM qg q JOIN bg b ON q.gram = b.gram {block}
  GROUP BY ALL),
scored AS MATERIALIZED (
  SELECT query_name, name, round(dot / (nq.norm * nb.norm), 6) AS score
  FROM dots JOIN norms nq ON nq.product_name = query_name
  JOIN norms nb ON nb.product_name = name),
{_packed(k, cut)}"""


# Letters and digits of a name, counted; none for promotions and for texts known to fail.
_LETTER_RANKED = f"""
{_SIDES},
vectors AS MATERIALIZED (
  SELECT product_name, list_transform(regexp_extract_all('abcdefghijklmnopqrstuvwxyz0123456789', '.'),
    lambda c: (length(product_name) - length(replace(lower(product_name), c, '')))::DOUBLE) AS v
  FROM names WHERE NOT contains(product_name, 'PROMO')
    AND product_name NOT IN (SELECT product_name FROM parts WHERE p_partkey % 7 = 0)),
scored AS MATERIALIZED (
  SELECT q.product_name AS query_name, b.product_name AS name,
         round(list_cosine_similarity(qv.v, bv.v), 6) AS score
  FROM q JOIN b ON q.brand = b.brand
  JOIN vectors qv ON qv.product_name = q.product_name
  JOIN vectors bv ON bv.product_name = b.product_name),
{_packed(3)}"""


def _words(col: str) -> str:
    return f"list_distinct(list_filter(regexp_split_to_array(lower({col}), '\\s+'), lambda t: t <> ''))"


def _numbers(col: str) -> str:
    return f"list_sort(regexp_extract_all({col}, '\\d+(?:\\.\\d+)?'))"


_RULE = f"""
judged AS MATERIALIZED (
  SELECT p.query_name, min(r.rank) AS place
  FROM packed p JOIN ranked r USING (query_name)
  WHERE {_numbers("r.query_name")} = {_numbers("r.name")}
    AND len(list_intersect({_words("r.query_name")}, {_words("r.name")})) >= 0.8 *
        len(list_distinct(list_concat({_words("r.query_name")}, {_words("r.name")})))
  GROUP BY ALL),
decided AS (
  SELECT p.query_name,
         CASE WHEN len(names) = 0 THEN 'Matching Failed'
              ELSE names[coalesce(place, 1)] END AS base_name,
         query_price AS price_from_line,
         CASE WHEN len(names) = 0 THEN 0.0 ELSE prices[coalesce(place, 1)] END AS price_from_watson,
         CASE WHEN len(names) = 0 THEN 0.0 ELSE scores[coalesce(place, 1)] END AS similarity,
         place IS NOT NULL AS verified_match
  FROM packed p LEFT JOIN judged USING (query_name))"""

_RATIO = """CASE WHEN price_from_watson IS NULL OR price_from_line IS NULL THEN NULL
  WHEN price_from_watson <> 0 THEN price_from_line / price_from_watson
  WHEN price_from_line = 0 OR isnan(price_from_line) THEN 'NaN'::DOUBLE
  WHEN price_from_line > 0 THEN 'Infinity'::DOUBLE
  WHEN price_from_line < 0 THEN '-Infinity'::DOUBLE END"""

_TOP1 = """
top1 AS (
  SELECT query_name, coalesce(names[1], 'N/A (Query Embedding Error)') AS base_name,
         query_price AS price_from_line,
         CASE WHEN len(names) = 0 THEN 'NaN'::DOUBLE ELSE prices[1] END AS price_from_watson,
         coalesce(scores[1], 0.0) AS similarity
  FROM packed)"""

_SPOILED = """
spoiled AS (
  SELECT vec_id,
         CASE WHEN vec_id % 11 = 0 THEN 'empty' WHEN vec_id % 13 = 0 THEN 'zero norm'
              WHEN vec_id % 17 = 0 OR vec_id % 19 = 0 THEN 'not a number' ELSE 'ok' END AS state,
         CAST(embedding AS DOUBLE[]) AS v
  FROM embeddings)"""


def _cosine(
    k: int,
    source: str = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
    block: str = "true",
):
    return f"""
  SELECT * FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS catalog_id,
           round(list_cosine_similarity(q.v, c.v), 6) AS score,
           CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY
             round(list_cosine_similarity(q.v, c.v), 6) DESC, c.vec_id) AS INTEGER) AS rank
    FROM {source} q JOIN {source} c ON q.vec_id % 2 = 0 AND c.vec_id % 2 = 1 AND {block})
  WHERE rank <= {k}"""


def _shelf(side: str) -> str:
    return f"CASE WHEN {side}.vec_id % 3 = 0 THEN 'hot' ELSE 'shelf ' || (({side}.vec_id // 2) % 40) END"


_CACHE = """
texts AS (
  SELECT CASE WHEN l_quantity = 1 THEN '  ' ELSE product_name END AS text FROM listings),
cache AS (
  SELECT product_name AS text, e.embedding
  FROM (SELECT product_name, min(p_partkey) AS vec_id FROM parts WHERE p_partkey % 3 = 0
        GROUP BY product_name) LEFT JOIN embeddings e USING (vec_id))"""

_LANDING = """
docs AS (
  SELECT ecommerce_name, l_orderkey % 10 AS kind,
         'pre_landing/' || strftime(ingest_timestamp_utc, '%Y-%m-%d') || '/' || ecommerce_name || '_'
         || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '.json' AS file
  FROM listings)"""

_PRICE_TEXTS = """CASE
  WHEN event_id % 12 IN (2, 3, 8, 9) THEN NULL
  WHEN event_id % 12 IN (4, 5) THEN 1000.0
  WHEN event_id % 12 = 10 THEN '-Infinity'::DOUBLE
  ELSE value END"""

_PAIR_BUCKET = "substr(md5(query_name || chr(1) || base_name), 1, 3)"

ORACLES: dict[str, str] = {
    "price_report": f"WITH {_REPORT} SELECT * FROM report",
    "history_scan": f"WITH {_LISTINGS} SELECT {_HISTORY} FROM listings",
    "history_store": f"WITH {_LISTINGS} SELECT {_HISTORY} FROM listings",
    "report_day_filter": f"""WITH {_LISTINGS} SELECT {_HISTORY} FROM listings
      WHERE CAST(ingest_timestamp_utc AS DATE) = DATE '2025-02-04'""",
    "catalog_split": f"""WITH {_LISTINGS}
      SELECT CASE WHEN ecommerce_name = 'watson' THEN 'base' ELSE 'query' END AS side,
             product_name, sale_price FROM listings""",
    "latest_cheapest": f"""WITH {_LISTINGS}, l AS ({_latest_l("listings")})
      SELECT product_name, sale_price, ingest_timestamp_utc FROM l""",
    "latest_per_product": f"""WITH {_LISTINGS}, w AS ({_latest_w("listings")})
      SELECT product_name, sale_price, ingest_timestamp_utc FROM w""",
    "map_join": f"""WITH {_LISTINGS},{_MAP},
      l AS ({_latest_l("listings")}), w AS ({_latest_w("listings")}),
      both_shops AS (SELECT * FROM l UNION ALL SELECT * FROM w)
      SELECT ecommerce_name, product_name, sale_price, ingest_timestamp_utc, product_no
      FROM both_shops JOIN name_map USING (product_name)""",
    "step_counts": f"""WITH {_REPORT}
      SELECT 'loaded' AS step, ecommerce_name, count(*) AS n FROM of_day GROUP BY ALL
      UNION ALL SELECT 'latest', ecommerce_name, count(*) FROM l GROUP BY ALL
      UNION ALL SELECT 'latest', ecommerce_name, count(*) FROM w GROUP BY ALL
      UNION ALL SELECT 'mapped', ecommerce_name, count(*) FROM lm GROUP BY ALL
      UNION ALL SELECT 'mapped', ecommerce_name, count(*) FROM wm GROUP BY ALL
      UNION ALL SELECT 'compared', 'both', count(*) FROM report""",
    "distinct_names": f"WITH {_DISTURBED} SELECT DISTINCT product_name FROM disturbed",
    "landing_scan": f"""WITH {_LISTINGS}
      SELECT strftime(ingest_timestamp_utc, '%Y-%m-%d') AS ingest_date, ecommerce_name,
             count(*) AS documents FROM listings GROUP BY ALL""",
    "flatten_shop_l": f"WITH {_LISTINGS},{_FLAT_L} SELECT * FROM flat_l",
    "flatten_shop_w": f"WITH {_LISTINGS},{_FLAT_W} SELECT * FROM flat_w",
    "json_quarantine": f"""WITH {_LISTINGS},{_LANDING}
      SELECT file, CASE WHEN kind < 2 THEN -1 ELSE 3 END AS pos,
             CASE kind WHEN 0 THEN 'not json' WHEN 1 THEN 'not a list'
                       ELSE 'product is no object' END AS reason
      FROM docs WHERE kind < 2 OR ecommerce_name = 'line_shopping'""",
    "product_rows": f"""WITH {_LISTINGS},{_FLAT_L},{_FLAT_W}
      SELECT *, 'line' AS ecommerce FROM flat_l UNION ALL SELECT *, 'watson' FROM flat_w""",
    "history_build": f"""WITH {_LISTINGS},{_FLAT_L},{_FLAT_W},
      flat AS (SELECT *, 'line_shopping' AS ecommerce_name FROM flat_l
               UNION ALL SELECT *, 'watson' FROM flat_w)
      SELECT product_name, sale_price, TIMESTAMP '2025-01-31 01:00:05.123456'
             AS ingest_timestamp_utc, ecommerce_name, 2025 AS year, 1 AS month FROM flat""",
    "price_clean": f"SELECT event_id, {_PRICE_TEXTS} AS price FROM events",
    "falsy_coalesce": """SELECT event_id, CASE event_id % 11 WHEN 7 THEN 0.0 WHEN 8 THEN 3.5
      WHEN 9 THEN 4.5 ELSE value END AS price FROM events""",
    "products_csv": f"""WITH {_LISTINGS}
      SELECT {_awkward("product_name", "l_orderkey")} AS product_name, sale_price,
             CASE WHEN ecommerce_name = 'watson' THEN 'watson' ELSE 'line' END AS ecommerce
      FROM listings""",
    "name_map_csv": f"""WITH {_LISTINGS},{_MAP}
      SELECT product_no, {_awkward("product_name", "product_no")} AS query_name,
             product_name AS base_name
      FROM name_map""",
    "envelope_stamp": """WITH s AS (
        SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
          CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END
          || '+00:00' AS stamp FROM events)
      SELECT event_id, 'pre_landing/' || strftime(ts, '%Y-%m-%d') || '/line_shopping_' ||
             regexp_replace(event_type || ' ครีม#' || user_id, '[^\\p{L}\\p{N}]', '_', 'g') || '_'
             || strftime(ts, '%Y%m%d_%H%M%S') || '_' || event_id || '.json' AS object_name,
             strftime(ts, '%Y-%m-%d') AS ingest_date, 'line_shopping' AS ecommerce_name,
             stamp AS ingest_timestamp_utc,
             CASE event_id % 21 WHEN 0 THEN '-' WHEN 7 THEN '[' || props || ']'
               WHEN 14 THEN '<html>' || props || '</html>'
               ELSE substr(props, 1, length(props) - 1) || ',"ingest_timestamp_utc":"' || stamp ||
                    '","ecommerce_name":"line_shopping"}' END AS value,
             CASE WHEN event_id % 7 = 0 THEN 'body is no object' ELSE '-' END AS reason
      FROM s""",
    "page_plan": f"""WITH {_LISTINGS},{_PAGES}
      SELECT ecommerce_name, query, unnest(CASE WHEN total_pages > 1
        THEN range(first_page + 1, first_page + total_pages) ELSE [] END)::INTEGER AS page
      FROM declared""",
    "page_coverage": f"""WITH {_LISTINGS},{_PAGES},
      wanted AS (
        SELECT ecommerce_name AS shop, query, first_page,
               CASE WHEN query LIKE '%5' THEN 0 ELSE total_pages END AS total_pages,
               CASE WHEN query LIKE '%5' THEN 0 ELSE total_results END AS total_results
        FROM declared),
      landed AS (
        SELECT ecommerce_name, query, page < total_pages AS known, page, count(*) AS n
        FROM (SELECT ecommerce_name, query, total_pages,
                     CASE l_orderkey % (total_pages + 1) WHEN 1 THEN 0
                          ELSE l_orderkey % (total_pages + 1) END AS page
              FROM listings JOIN wanted ON wanted.query = brand
                AND wanted.shop = ecommerce_name) GROUP BY ALL),
      sums AS (SELECT ecommerce_name, query, count(*) FILTER (known) AS p,
                      (sum(n) FILTER (known))::BIGINT AS r, count(*) FILTER (NOT known) AS u
               FROM landed GROUP BY ALL)
      SELECT ecommerce_name, query, total_pages, total_results, coalesce(p, 0) AS landed_pages,
             coalesce(r, 0) AS landed_rows, total_pages - coalesce(p, 0) AS missing_pages,
             coalesce(u, 0) AS undeclared_pages
      FROM (SELECT * RENAME (shop AS ecommerce_name) FROM wanted)
      LEFT JOIN sums USING (ecommerce_name, query)""",
    "vector_norm": """SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]),
      lambda x: x * x))), 6) AS norm FROM embeddings""",
    "vector_validity": f"WITH {_SPOILED} SELECT vec_id, state FROM spoiled",
    "cosine_topk": _cosine(3),
    "cosine_topk_pivots": _cosine(3),
    "cosine_topk_blocked": _cosine(3, block=f"{_shelf('q')} = {_shelf('c')}"),
    "cosine_top1": f"SELECT query_id, catalog_id, score FROM ({_cosine(1)})",
    "ngram_vectors": f"""WITH {_DISTURBED},
      names AS (SELECT DISTINCT product_name FROM disturbed),{_GRAMS}
      SELECT product_name, gram, tf::INTEGER AS tf FROM grams""",
    "ngram_topk": f"""WITH {_ranked(3, 0.8, blocked=False)}
      SELECT query_name AS query_id, rank, name AS catalog_id, score FROM ranked""",
    "embedding_cache_misses": f"""WITH {_LISTINGS},{_CACHE}
      SELECT DISTINCT text, 'char3' AS model FROM texts
      WHERE trim(text) <> '' AND text NOT IN (SELECT text FROM cache)""",
    "embedding_lookup": f"""WITH {_LISTINGS},{_CACHE}
      SELECT t.text, CASE WHEN c.text IS NULL THEN 'missing' WHEN c.embedding IS NULL THEN 'failed'
             ELSE 'ok' END AS status,
             CASE WHEN c.text IS NULL THEN -1 ELSE coalesce(len(c.embedding), 0) END::INTEGER
             AS dimension
      FROM (SELECT DISTINCT text FROM texts) t LEFT JOIN cache c ON c.text = t.text""",
    "verify_payload": f"""WITH {_ranked(3)}
      SELECT query_name, 'Base product: ' || query_name || chr(10) || 'Candidates:' || chr(10) ||
             coalesce(array_to_string(list_transform(names, lambda p: '- ' || p), chr(10)), '') ||
             chr(10) || 'Reply with the exact candidate name, or None.' AS payload
      FROM packed""",
    "verify_rule": f"""WITH {_ranked(3)},{_RULE}
      SELECT query_name, CASE WHEN verified_match THEN base_name ELSE 'None' END AS reply
      FROM decided""",
    "verify_resolve": f"""WITH {_ranked(3)}
      SELECT query_name,
             CASE WHEN length(query_name) % 4 = 0 AND len(names) > 1 THEN names[2] ELSE '-' END
               AS verified_name,
             CASE WHEN length(query_name) % 4 = 0 AND len(names) > 1 THEN 2 ELSE 0 END AS verified_at
      FROM packed""",
    "match_decide": f"WITH {_ranked(3)},{_RULE} SELECT * FROM decided",
    "match_all_rows": f"""WITH {_ranked(1)}
      SELECT d.product_name AS query_name, d.sale_price AS price_from_line,
             coalesce(names[1], 'N/A (Query Embedding Error)') AS base_name,
             coalesce(scores[1], 0.0) AS similarity
      FROM disturbed d JOIN packed ON query_name = d.product_name
      WHERE d.ecommerce_name = 'line_shopping'""",
    "match_verified": f"""WITH {_ranked(3)},{_RULE}
      SELECT *, {_RATIO} AS diff FROM decided WHERE similarity >= 0.8 AND verified_match""",
    "match_ratio_min": f"""WITH {_ranked(1)},{_TOP1},
      rated AS (SELECT *, {_RATIO} AS diff FROM top1 WHERE similarity >= 0.82)
      SELECT * FROM rated WHERE diff >= 1.5""",
    "match_ratio_band": f"""WITH {_ranked(1)},{_TOP1},
      rated AS (SELECT *, {_RATIO} AS diff FROM top1 WHERE similarity >= 0.8)
      SELECT * FROM rated WHERE diff < 1.5 AND diff > 0.5""",
    "match_missing_vector": f"""WITH {_SPOILED}, good AS (SELECT * FROM spoiled WHERE state = 'ok'),
      best AS ({_cosine(1, "good")})
      SELECT 'item ' || s.vec_id AS query_name,
             CASE WHEN query_id IS NULL THEN 'N/A (Query Embedding Error)'
                  ELSE 'item ' || catalog_id END AS base_name,
             s.vec_id::DOUBLE AS price_from_line,
             CASE WHEN query_id IS NULL THEN 'NaN'::DOUBLE ELSE catalog_id::DOUBLE END
               AS price_from_watson,
             coalesce(score, 0.0) AS similarity
      FROM spoiled s LEFT JOIN best ON query_id = s.vec_id WHERE s.vec_id % 2 = 0""",
    "embedding_refresh": f"""WITH {_LISTINGS},{_CACHE},
      known AS (SELECT text, CASE WHEN embedding IS NULL THEN 'failed' ELSE 'ok' END AS status, 'cached' AS origin,
                       coalesce(len(embedding), 0) AS dimension, round(embedding[1]::DOUBLE, 6) AS first FROM cache),
      fresh AS (SELECT DISTINCT product_name AS text, CASE WHEN product_name LIKE '%PROMO%' THEN 'failed' ELSE 'ok' END AS status,
                       'new' AS origin, CASE WHEN product_name LIKE '%PROMO%' THEN 0 ELSE 3 END AS dimension,
                       CASE WHEN product_name NOT LIKE '%PROMO%' THEN length(product_name)::DOUBLE END AS first
                FROM parts WHERE product_name NOT IN (SELECT text FROM cache))
      SELECT text, 'char3' AS model, status, origin, dimension::INTEGER AS dimension, coalesce(first, -9.0) AS first
      FROM (SELECT * FROM known UNION ALL SELECT * FROM fresh)""",
    "judge_match": f"""WITH {_ranked(3)},
      told AS (SELECT *, contains(upper(query_name), 'PROMO') AS failed,
                      NOT contains(upper(query_name), 'PROMO') AND length(query_name) % 2 = 0 AND len(names) > 0 AS good
               FROM packed),
      picked AS (SELECT *, CASE WHEN good THEN len(names) ELSE 1 END AS place FROM told)
      SELECT query_name, CASE WHEN len(names) = 0 THEN 'Matching Failed' ELSE names[place] END AS base_name,
             query_price AS price_from_line, CASE WHEN len(names) = 0 THEN 0.0 ELSE prices[place] END AS price_from_watson,
             CASE WHEN len(names) = 0 THEN 0.0 ELSE scores[place] END AS similarity, good AS verified_match,
             CASE WHEN failed THEN 3 ELSE 1 END AS attempts, failed
      FROM picked""",
    "match_embedded": f"""WITH {_LETTER_RANKED},
      told AS (SELECT *, NOT contains(upper(query_name), 'PROMO') AND length(query_name) % 2 = 0 AND len(names) > 0 AS good
               FROM packed),
      picked AS (SELECT *, CASE WHEN good THEN len(names) ELSE 1 END AS place FROM told)
      SELECT query_name, CASE WHEN len(names) = 0 THEN 'Matching Failed' ELSE names[place] END AS base_name,
             query_price AS price_from_line, CASE WHEN len(names) = 0 THEN 0.0 ELSE prices[place] END AS price_from_watson,
             CASE WHEN len(names) = 0 THEN 0.0 ELSE scores[place] END AS similarity, good AS verified_match
      FROM picked""",
    "landing_select": f"""WITH {_LISTINGS},{_LANDING}
      SELECT file, ecommerce_name FROM docs WHERE file LIKE 'pre_landing/2025-02-04/%'""",
    "ingest_stream_report": f"""WITH {_LISTINGS},{_MAP},
      dated AS (SELECT *, CAST(ingest_timestamp_utc AS DATE) AS day FROM listings),
      l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day, product_name ORDER BY sale_price ASC NULLS FIRST) AS place
                           FROM dated WHERE ecommerce_name = 'line_shopping') WHERE place = 1),
      w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day, product_name ORDER BY sale_price ASC NULLS LAST) AS place
                           FROM dated WHERE ecommerce_name = 'watson') WHERE place = 1)
      SELECT day, product_no, product_name, l.sale_price AS price_from_line, w.sale_price AS price_from_watson,
             l.sale_price - w.sale_price AS diff, day + INTERVAL 1 DAY - INTERVAL 1 MICROSECOND AS ingest_timestamp_utc,
             count(*) OVER (PARTITION BY day) AS row_count
      FROM l JOIN w USING (day, product_name) JOIN name_map USING (product_name)""",
    "name_map_update": f"""WITH {_ranked(3)},{_RULE},
      pairs AS (SELECT DISTINCT query_name, base_name, price_from_line AS price FROM decided
                WHERE similarity >= 0.8 AND verified_match),
      earlier AS (SELECT row_number() OVER (ORDER BY {_PAIR_BUCKET}, query_name, base_name) AS product_no, query_name, base_name
                  FROM pairs WHERE price > 30000),
      fresh AS (SELECT (SELECT coalesce(max(product_no), 0) FROM earlier)
                       + row_number() OVER (ORDER BY {_PAIR_BUCKET}, query_name, base_name) AS product_no, query_name, base_name
                FROM pairs ANTI JOIN earlier USING (query_name, base_name) WHERE price < 50000)
      SELECT product_no, query_name AS query_product_name_from_line, base_name AS base_product_name_from_watson
      FROM (SELECT * FROM fresh UNION ALL
            SELECT * FROM earlier SEMI JOIN (SELECT * FROM pairs WHERE price < 50000) USING (query_name, base_name))""",
    "snapshot_merge": f"""WITH {_LISTINGS},
      placed AS (SELECT *, CAST(ingest_timestamp_utc AS DATE) AS day, row_number() OVER (
          PARTITION BY CAST(ingest_timestamp_utc AS DATE), ecommerce_name, product_name
          ORDER BY ingest_timestamp_utc DESC, sale_price IS NULL AND ecommerce_name = 'watson', sale_price ASC NULLS FIRST) AS place
        FROM listings)
      SELECT day, ecommerce_name, product_name, coalesce(sale_price, -1.0) AS sale_price, ingest_timestamp_utc
      FROM placed WHERE place = 1""",
    "name_map_build": f"""WITH {_ranked(3)},{_RULE},
      pairs AS (SELECT DISTINCT query_name, base_name FROM decided
                WHERE similarity >= 0.8 AND verified_match)
      SELECT row_number() OVER (ORDER BY {_PAIR_BUCKET}, query_name, base_name) AS product_no,
             query_name AS query_product_name_from_line,
             base_name AS base_product_name_from_watson
      FROM pairs""",
}
