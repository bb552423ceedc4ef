"""The same queries as SQL on the given tables, written without the operators' own means."""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT CAST(ts AS DATE) AS d, value AS close,
         event_type || '_' || CAST(user_id AS VARCHAR) AS symbol,
         event_type || '_' || CAST(user_id AS VARCHAR) AS indicator_name,
         event_type AS category, 'R' || CAST(user_id % 5 AS VARCHAR) AS region,
         CASE WHEN user_id % 10 = 0 THEN 'monthly' ELSE 'daily' END AS refresh,
         event_id AS seq, user_id
  FROM events)"""

UNIQUE_EVENTS = EVENTS + """,
uniq AS (
  SELECT * FROM ev
  QUALIFY row_number() OVER (PARTITION BY symbol, d ORDER BY seq DESC) = 1)"""

SNAPSHOT_OF = """
ranked AS (
  SELECT *, lag(close) OVER (PARTITION BY symbol ORDER BY d) AS prev_close,
         row_number() OVER (PARTITION BY symbol ORDER BY d DESC) AS age
  FROM {rows}),
snap AS (
  SELECT strftime(d, '%Y-%m-%d') AS date, symbol, indicator_name, category, region, refresh,
         close, prev_close, close - prev_close AS change,
         ((close - prev_close) / nullif(prev_close, 0)) * 100 AS change_pct
  FROM ranked WHERE age = 1)"""

SNAPSHOT = "WITH " + UNIQUE_EVENTS + "," + SNAPSHOT_OF.format(rows="uniq")

ORDERS = """
ob AS (
  SELECT CAST(o_orderdate AS DATE) AS d, o_totalprice AS close,
         'N' || CAST(n_nationkey AS VARCHAR) AS symbol, n_name AS indicator_name,
         c_mktsegment AS category, r_name AS region,
         CASE WHEN n_nationkey % 5 = 0 THEN 'monthly' ELSE 'daily' END AS refresh
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

LOADS = EVENTS + """,
loads AS (
  SELECT 0 AS batch, d, symbol, indicator_name, category, region, refresh, close, seq, user_id
  FROM ev WHERE d <= DATE '2024-01-20'
  UNION ALL
  SELECT 1, d, symbol, indicator_name, category, region, refresh, close + 1000, seq, user_id
  FROM ev WHERE d >= DATE '2024-01-11'),
merged AS (
  SELECT * FROM loads
  QUALIFY row_number() OVER (PARTITION BY symbol, d ORDER BY batch DESC, seq DESC) = 1)"""

RUN = LOADS + """,
kept AS (
  SELECT * FROM merged
  WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'click')
    AND user_id % 7 <> 3),""" + (
    SNAPSHOT_OF.format(rows="kept"))

FIRST_TARGET = "企業物価指数 2020年基準/輸入物価指数/円ベース"
SECOND_TARGET = "企業物価指数 2020年基準/消費税を除く国内企業物価指数"

# The long cells of the wide table, taken straight from the line items.
CELLS = f"""
cells AS (
  SELECT 'K' || CAST(l_suppkey AS VARCHAR) || l_returnflag AS code, l_suppkey,
         CASE l_returnflag WHEN 'A' THEN '{FIRST_TARGET}' WHEN 'R' THEN '{SECOND_TARGET}'
              ELSE 'other series' END AS series_name,
         CASE WHEN s_nationkey = 0 THEN 'nation/総平均 ' || s_name
              WHEN s_nationkey % 2 = 0
              THEN '　N' || CAST(s_nationkey AS VARCHAR) || '/__all /x '
              ELSE 'N' || CAST(s_nationkey AS VARCHAR) END AS label_raw,
         CASE WHEN s_nationkey = 0 THEN '総平均' ELSE 'N' || CAST(s_nationkey AS VARCHAR) END
           AS classification1,
         CASE WHEN s_nationkey > 0 AND s_nationkey % 2 = 0 THEN 'all /x' ELSE '' END
           AS classification2,
         strftime(l_shipdate, '%Y%m') AS yyyymm, max(l_quantity) AS close
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  GROUP BY ALL)"""

SHORT = """CASE series_name WHEN '{0}' THEN '輸入物価指数/円ベース'
              ELSE '消費税を除く国内企業物価指数' END""".format(FIRST_TARGET)

SERIES = """
series AS (
  SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, max(l_extendedprice) AS price,
         max(l_discount) AS discount
  FROM lineitem GROUP BY ALL)"""

PERIODS = """
periods AS (
  SELECT l_suppkey, date_trunc('month', l_shipdate) AS d, max(l_quantity) AS quantity
  FROM lineitem GROUP BY ALL HAVING max(l_quantity) <> 50)"""

PART_MONTH = "make_date(2024, p_size % 12 + 1, 1)"

# Two decimals with commas; SQL formatting of doubles rounds halves to even on the exact value.
TWO = "printf('%.2f', {0})"
TWO_COMMAS = "format('{{:,.2f}}', {0})"


def _number_text(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN '-' WHEN abs({x}) >= 1000 THEN {TWO_COMMAS.format(x)} "
            f"ELSE {TWO.format(x)} END")


def _delta_text(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE printf('%+.2f', {x}) || '%' END"


def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


TIDY = "WITH " + CELLS + f"""
SELECT substr(yyyymm, 1, 4) || '-' || substr(yyyymm, 5, 2) || '-01' AS date,
       {SHORT} AS indicator_name, classification1, classification2, close,
       'Inflation' AS category, 'Japan' AS region, 'monthly' AS refresh,
       'Bank of Japan' AS source, 'Index 2020=100' AS unit, code, series_name, label_raw
FROM cells WHERE series_name <> 'other series'
QUALIFY row_number() OVER (
  PARTITION BY yyyymm, series_name, classification1, classification2, close
  ORDER BY l_suppkey) = 1"""

ORACLES = {
    "latest_snapshot": SNAPSHOT + " SELECT * FROM snap",
    "latest_snapshot_by_name": "WITH " + UNIQUE_EVENTS + f""",
named AS (SELECT * REPLACE (symbol || '/' || CAST(seq % 3 AS VARCHAR) AS indicator_name) FROM uniq),
ranked AS (
  SELECT *, lag(close) OVER by_name AS prev_close, lead(close) OVER by_name IS NULL AS newest
  FROM named WINDOW by_name AS (PARTITION BY symbol ORDER BY indicator_name, d))
SELECT {_iso('d')} AS date, symbol, indicator_name, category, region, refresh, close, prev_close,
       close - prev_close AS change,
       ((close - prev_close) / nullif(prev_close, 0)) * 100 AS change_pct
FROM ranked WHERE newest""",
    "headline_topk": SNAPSHOT + f"""
SELECT symbol, indicator_name, close, change_pct,
       {_number_text('close')} AS close_text, {_delta_text('change_pct')} AS delta_text
FROM snap ORDER BY change_pct DESC NULLS LAST, symbol LIMIT 4""",
    "dedupe_keep_last": "WITH " + UNIQUE_EVENTS + f"""
SELECT {_iso('d')} AS date, symbol, indicator_name, category, region, refresh, close, seq
FROM uniq""",
    "dedupe_keep_first": f"""
SELECT l_partkey, {_iso('l_shipdate')} AS date, l_orderkey, l_linenumber, l_suppkey,
       l_extendedprice
FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
  ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice) = 1""",
    "upsert_history": "WITH " + LOADS + f"""
SELECT {_iso('d')} AS date, symbol, indicator_name, category, region, refresh, close
FROM merged""",
    "history_lite": "WITH " + ORDERS + f"""
SELECT {_iso('d')} AS date, indicator_name, category, region, refresh, close
FROM ob WHERE d >= DATE '1998-01-01'""",
    "segment_counts": "WITH " + ORDERS + f"""
SELECT refresh, CAST(year(d) AS INTEGER) AS year, count(*) AS rows,
       {_iso('min(d)')} AS first_date, {_iso('max(d)')} AS last_date
FROM ob WHERE d >= DATE '1998-01-01' GROUP BY refresh, year(d)""",
    "active_symbols": f"""
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, {_iso('o_orderdate')} AS date,
       o_totalprice AS close, o_orderkey AS seq
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    "catalog_by_refresh": """
SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS symbol,
       c_name AS name, 'daily' AS refresh, c_custkey AS pos
FROM customer WHERE c_nationkey % 5 <> 0""",
    "enrich_catalog": f"""
SELECT {_iso('o_orderdate')} AS date, 'C' || CAST(o_custkey AS VARCHAR) AS symbol,
       c_name AS indicator_name, c_mktsegment AS category,
       'N' || CAST(c_nationkey AS VARCHAR) AS region,
       CASE WHEN c_nationkey % 5 = 0 THEN '' ELSE 'daily' END AS refresh,
       o_totalprice AS close, o_totalprice AS open, o_totalprice AS adj_close,
       CAST(NULL AS DOUBLE) AS volume, 'orders' AS source,
       CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE 'USD' END AS unit, o_orderkey AS seq
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0""",
    "derived_product": "WITH " + UNIQUE_EVENTS + f""",
product AS (
  SELECT 'D' || CAST(a.user_id AS VARCHAR) AS symbol, {_iso('a.d')} AS date,
         a.close * b.close AS close
  FROM uniq a JOIN uniq b ON a.user_id = b.user_id AND a.d = b.d
  WHERE a.category = 'click' AND b.category = 'view')
SELECT symbol, date, close AS open, close AS high, close AS low, close, close AS adj_close,
       CAST(NULL AS DOUBLE) AS volume
FROM product""",
    "wide_to_long": "WITH " + CELLS + """
SELECT code, series_name, label_raw, yyyymm, close FROM cells""",
    "target_series": "WITH " + CELLS + f"""
SELECT DISTINCT code, label_raw, {SHORT} AS indicator_name
FROM cells WHERE series_name <> 'other series'""",
    "wide_index_tidy": TIDY,
    "archive_ingest": TIDY,
    "yearly_files": f"""
SELECT date, indicator_name, classification1, classification2, close, code, label_raw,
       CAST(substr(date, 1, 4) AS INTEGER) AS year
FROM ({TIDY})""",
    "csv_round_trip": "WITH " + UNIQUE_EVENTS + f"""
SELECT {_iso('d')} AS date, symbol, indicator_name, category, region, refresh, close FROM uniq""",
    "segment_files": "WITH " + ORDERS + f"""
SELECT refresh AS cadence, CAST(year(d) AS INTEGER) AS year, {_iso('d')} AS date,
       indicator_name, category, region, refresh, close
FROM ob WHERE d >= DATE '1998-01-01'""",
    "split_labels": r"""
WITH urls AS (
  SELECT 'u' || CAST(page_id AS VARCHAR) AS id,
         regexp_replace(url, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS label FROM pages)
SELECT 'p' || CAST(p_partkey AS VARCHAR) AS id,
       CASE p_type WHEN 'PROMO' THEN '総平均' WHEN 'LARGE' THEN trim(p_name) ELSE p_type END
         AS classification1,
       CASE WHEN p_type IN ('PROMO', 'LARGE') THEN '' ELSE p_brand || ' /' || p_name END
         AS classification2
FROM part
UNION ALL
SELECT id, CASE WHEN strpos(label, '/') > 0 THEN left(label, strpos(label, '/') - 1)
                ELSE label END,
       CASE WHEN strpos(label, '/') > 0 THEN substr(label, strpos(label, '/') + 1) ELSE '' END
FROM urls""",
    "page_text": r"""
SELECT page_id,
       regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
                      '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g') AS text
FROM pages""",
    "labelled_value": f"""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, {_iso(PART_MONTH)} AS date,
       p_retailprice AS open, p_retailprice AS close, CAST(NULL AS DOUBLE) AS volume
FROM part""",
    # The page's own text may hold an earlier "in <word> <year>"; if that word is no month, the
    # page is rejected.
    "labelled_value_web": r"""
WITH shown AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
                                 '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')
                  || ' in May 2024 ' AS text
  FROM pages),
found AS (
  SELECT page_id, regexp_extract(text, 'in\s+([A-Za-z]+)\s+(\d{4})', 1) AS word,
         regexp_extract(text, 'in\s+([A-Za-z]+)\s+(\d{4})', 2) AS year
  FROM shown),
dated AS (
  SELECT page_id, year, list_position(
    ['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'],
    lower(left(word, 3))) AS month
  FROM found)
SELECT 'W' || CAST(page_id AS VARCHAR) AS symbol,
       strftime(make_date(CAST(year AS INTEGER), month, 1), '%Y-%m-%d') AS date,
       page_id * 1000 + 0.5::DOUBLE AS open, page_id * 1000 + 0.5::DOUBLE AS close,
       CAST(NULL AS DOUBLE) AS volume
FROM dated WHERE month > 0""",
    "page_rejects": """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, 'pages' AS stage,
       'month reference is not a month' AS reason
FROM part WHERE p_type = 'PROMO'
  AND NOT list_contains(
    ['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'],
    lower(left(p_name, 3)))""",
    "month_reference": f"""
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, {_iso(PART_MONTH)} AS month,
       false AS rejected
FROM part""",
    "period_table": "WITH " + PERIODS + f"""
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, {_iso('d')} AS date, quantity AS open,
       quantity AS close, CAST(NULL AS DOUBLE) AS volume
FROM periods""",
    "price_table": f"""
SELECT 'O' || CAST(o_orderkey AS VARCHAR) AS symbol, {_iso('o_orderdate')} AS date,
       o_totalprice AS open, o_totalprice AS close, CAST(NULL AS DOUBLE) AS volume
FROM orders""",
    "series_normalise": "WITH " + SERIES + f""",
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY d) - 1 AS row FROM series)
SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS series_id, {_iso('d')} AS date, price AS close, row
FROM lines WHERE discount < 0.1""",
    "ohlcv_normalise": f"""
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, {_iso('o_orderdate')} AS date,
       o_totalprice AS open, o_totalprice AS high, o_totalprice AS low, o_totalprice AS close,
       CAST(NULL AS DOUBLE) AS adj_close, CAST(o_orderkey AS DOUBLE) AS volume
FROM orders WHERE o_orderdate >= DATE '2000-08-01'""",
    "coerce_numbers": """
SELECT event_id, CAST(v AS INTEGER) AS variant,
       CASE WHEN v IN (0, 1) THEN value WHEN v = 9 THEN CAST(user_id * 100 AS DOUBLE) END
         AS number
FROM events, range(0, 11) t(v)""",
    "coerce_dates": f"""
SELECT o_orderkey, CAST(v AS INTEGER) AS variant,
       CASE WHEN v IN (0, 1, 2) THEN {_iso('o_orderdate')} END AS day,
       CASE WHEN v IN (0, 1, 2) THEN CAST(year(o_orderdate) AS INTEGER) END AS year
FROM orders, range(0, 8) t(v)""",
    "display_text": f"""
SELECT l_orderkey, l_linenumber, {_number_text('l_extendedprice')} AS price_text,
       {_number_text('l_quantity')} AS quantity_text,
       {_delta_text('((l_discount - l_tax) * l_quantity)')} AS delta_text
FROM lineitem""",
    "facet_values": "WITH " + ORDERS + """
SELECT DISTINCT 'category' AS facet, category AS value FROM ob
UNION ALL SELECT DISTINCT 'region', region FROM ob
UNION ALL SELECT DISTINCT 'refresh', refresh FROM ob""",
    "date_extent": "WITH " + ORDERS + f"""
SELECT {_iso('min(d)')} AS min_date, {_iso('max(d)')} AS max_date,
       {_iso('greatest(min(d), max(d) - 180)')} AS default_start
FROM ob""",
    "trend_slice": "WITH " + ORDERS + f"""
SELECT indicator_name, symbol, {_iso('d')} AS date, close FROM ob
WHERE refresh IN ('daily') AND category IN ('BUILDING', 'MACHINERY')
  AND region IN ('ASIA', 'EUROPE', 'AFRICA')
  AND d BETWEEN DATE '1997-03-01' AND DATE '1999-09-30'""",
    "latest_slice": SNAPSHOT + """
SELECT indicator_name, category, region, refresh, date, close, change, change_pct, '' AS unit,
       'events' AS source
FROM snap WHERE category IN ('click', 'purchase') AND region IN ('R1', 'R2', 'R3')""",
    "fetch_observations": "WITH " + SERIES + "," + PERIODS + f""",
valued AS (SELECT * FROM series WHERE discount < 0.1),
raw AS (
  SELECT 'F' AS mark, l_suppkey AS key, d, price AS close, price AS open,
         CAST(NULL AS DOUBLE) AS volume, 'fred' AS kind
  FROM valued
  UNION ALL
  SELECT 'S', l_suppkey, CAST(d AS DATE), quantity, quantity, NULL, 'boj_main_series'
  FROM periods
  UNION ALL
  SELECT 'P', p_partkey, {PART_MONTH}, p_retailprice, p_retailprice, NULL,
         'tradingeconomics_latest'
  FROM part
  UNION ALL
  SELECT 'O', o_orderkey, CAST(o_orderdate AS DATE), o_totalprice, o_totalprice, NULL,
         'investing_historical_latest'
  FROM orders
  UNION ALL
  SELECT * FROM (
    SELECT 'C', o_custkey, CAST(o_orderdate AS DATE) AS day, o_totalprice, o_totalprice,
           CAST(o_orderkey AS DOUBLE), 'yahoo'
    FROM orders WHERE o_orderdate >= DATE '2000-08-01'
    QUALIFY row_number() OVER (PARTITION BY o_custkey, day ORDER BY o_orderkey DESC) = 1)
  UNION ALL
  SELECT 'X', a.l_suppkey, a.d, a.price * b.price, a.price * b.price, NULL, 'fred_derived'
  FROM valued a JOIN valued b ON b.l_suppkey = a.l_suppkey + 1 AND b.d = a.d)
SELECT mark || CAST(key AS VARCHAR) AS symbol, {_iso('d')} AS date, open, close, volume,
       kind || ' ' || CAST(key AS VARCHAR) AS indicator_name, 'cat' AS category,
       'reg' AS region, 'daily' AS refresh, kind AS source, '' AS unit,
       CASE WHEN mark = 'X' THEN '2001-08-01 00:00:00' ELSE '2024-06-30 00:00:00' END AS fetched_at
FROM raw WHERE d >= DATE '1998-01-01'""",
    "refresh_run": "WITH " + RUN + " SELECT * FROM snap WHERE refresh = 'daily'",
    "run_metrics": "WITH " + RUN + """
SELECT 'fetched' AS metric, count(DISTINCT (symbol, d)) AS rows FROM ev
WHERE d >= DATE '2024-01-11' AND symbol IN (SELECT symbol FROM kept)
UNION ALL SELECT 'rejected', count(DISTINCT symbol) FROM ev
WHERE user_id % 7 = 3 AND user_id IN (SELECT user_id FROM events WHERE event_type = 'click')
UNION ALL SELECT 'history', count(*) FROM kept
UNION ALL SELECT 'lite', count(*) FROM kept
UNION ALL SELECT 'snapshot', count(*) FROM snap WHERE refresh = 'daily'""",
}
ORACLES["run_rejects"] = "WITH " + EVENTS + """
SELECT DISTINCT symbol, 'catalog' AS stage, 'missing name' AS reason FROM ev
WHERE user_id % 7 = 3 AND user_id IN (SELECT user_id FROM events WHERE event_type = 'click')"""
ORACLES["imported_history"] = "WITH " + LOADS + f"""
SELECT {_iso('d')} AS date, symbol, indicator_name, category, region, refresh, close
FROM (
  SELECT * FROM loads WHERE batch = 0 OR user_id % 7 <> 3
  QUALIFY row_number() OVER (PARTITION BY symbol, d ORDER BY batch DESC, seq DESC) = 1)"""
ORACLES["run_exports"] = "WITH " + RUN + f"""
SELECT unnest(['segment_' || refresh || '_' || year(d), 'history', 'history_lite']) AS file,
       {_iso('d')} AS date, indicator_name, category, region, refresh, close
FROM kept"""
ORACLES["index_exports"] = f"""
SELECT unnest(['index_csv', 'index_tsv', 'yearly', 'yearly_lite']) AS file, date, indicator_name,
       classification1, classification2, close FROM ({TIDY})"""
ORACLES["archive_rejects"] = """
SELECT DISTINCT printf('archive-%012d.zip', l_suppkey // 2) AS path,
       CASE l_suppkey // 2 % 4 WHEN 1 THEN 'not a zip archive' ELSE 'no month columns' END AS reason
FROM lineitem WHERE l_suppkey // 2 % 4 IN (1, 2)"""
ORACLES["catalog_file"] = """
SELECT CASE WHEN c_acctbal < 0 THEN '' ELSE 'C' || c_custkey END AS symbol, c_name AS name,
       c_mktsegment AS category, 'N' || c_nationkey AS region,
       CASE WHEN c_nationkey % 5 <> 0 THEN 'daily' END AS refresh,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN 'USD' END AS unit,
       c_custkey % 25 AS file,
       row_number() OVER (PARTITION BY c_custkey % 25 ORDER BY c_custkey) AS place
FROM customer"""
ORACLES["ordered_dataset"] = "WITH " + ORDERS + f"""
SELECT row_number() OVER (ORDER BY indicator_name NULLS LAST, d NULLS LAST, close NULLS LAST,
         category NULLS LAST, region NULLS LAST) AS position,
       {_iso('d')} AS date, indicator_name, category, region, refresh, close
FROM ob"""
ORACLES["ordered_snapshot"] = SNAPSHOT + """
SELECT row_number() OVER (ORDER BY refresh, category, region, indicator_name, symbol) AS position,
       refresh, category, region, symbol, close FROM snap"""
ORACLES["ordered_index"] = f"""
SELECT row_number() OVER (ORDER BY indicator_name, date, classification1 NULLS LAST,
         classification2 NULLS LAST, close) AS position,
       date, indicator_name, classification1, classification2, close, code
FROM ({TIDY})"""
ORACLES["store_runs"] = ORACLES["fetch_observations"]
