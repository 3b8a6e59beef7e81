"""DuckDB oracles for the registered queries.

Each oracle states the *clean* answer from the driver's clean tables: where
the Spark side cleans a derived dirty column, the SQL simply reads the
original column, so no cleaning logic is shared between the two.
"""

from __future__ import annotations

# initcap() for blank-separated words, which DuckDB lacks
def _initcap(expr: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")


_LINES = """lines AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_orderdate, o.o_custkey
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_MONTHLY = """monthly AS (
  SELECT CAST(o_orderdate AS DATE) AS date, l_partkey AS product_id, o_custkey AS customer_code,
         l_quantity AS sold_quantity, l_linenumber
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

_ROLLUP_ALL = f"""WITH {_MONTHLY}
SELECT CAST(date_trunc('month', date) AS DATE) AS date, product_id, customer_code,
       CAST(sum(sold_quantity) AS BIGINT) AS sold_quantity
FROM monthly GROUP BY ALL"""

# every product of ``part``: raw ids are distinct, so none is a repeated row; ids with
# letters share the sentinel, which no order line or price carries
_PRODUCTS = f"""prod_raw AS (
  SELECT CASE WHEN p_partkey % 17 = 0 THEN '9999999' ELSE CAST(p_partkey AS VARCHAR) END AS product_id,
         (CASE WHEN p_partkey % 3 IN (0, 1) THEN 'Protein ' ELSE '' END) || p_name || ' ('
           || CAST(p_size AS VARCHAR) || 'g)' AS product_name,
         {_initcap('p_type')} AS category
  FROM part),
prod AS (SELECT *, sha256(product_name) AS product_code FROM prod_raw)"""

# daily lines: the largest quantity of a line key, with the product's code; {where} restricts the lines
_DAILY = f"""{_LINES}, {_PRODUCTS},
clean AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_custkey % 23 = 0 THEN '999999' ELSE CAST(o_custkey AS VARCHAR) END AS customer_code,
         CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         l_quantity AS qty, l_orderkey
  FROM lines WHERE (l_orderkey + l_linenumber) % 19 <> 0),
daily AS (
  SELECT order_id, date, customer_code, c.product_id, any_value(product_code) AS product_code, max(qty) AS qty
  FROM clean c JOIN prod p ON c.product_id = p.product_id {{where}}
  GROUP BY ALL)"""


def _monthly_fact(where: str = "") -> str:
    return f"""WITH {_DAILY.format(where=where)}
SELECT CAST(date_trunc('month', date) AS DATE) AS date, product_code, customer_code,
       CAST(sum(qty) AS BIGINT) AS sold_quantity
FROM daily GROUP BY ALL"""


_FACT = _monthly_fact()

# the parent's own row of every month
_OWN_ROWS = """
UNION ALL
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE), 'own', '0', 1 FROM orders"""

# the quantity of the latest load that has the order: the third, else the second, else the first
_SEQUENCED = f"""WITH {_DAILY.format(where="")}
SELECT order_id, date, product_code, customer_code, product_id,
       qty + CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN 0 WHEN CAST(order_id AS BIGINT) % 2 = 0 THEN 7 ELSE 2 END
         AS sold_quantity
FROM daily"""

_DIVISION = """CASE category WHEN 'Economy' THEN 'Value' WHEN 'Standard' THEN 'Core'
  WHEN 'Promo' THEN 'Core' WHEN 'Small' THEN 'Compact' WHEN 'Medium' THEN 'Compact' END"""

ORACLES: dict[str, str] = {
    "csv_roundtrip_scan": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, true AS from_file FROM orders""",
    "file_once_ingest": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders""",
    "dim_date": """
WITH b AS (SELECT CAST(date_trunc('month', min(o_orderdate)) AS DATE) AS s,
                  CAST(date_trunc('month', max(o_orderdate)) AS DATE) AS e FROM orders),
g AS (SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 MONTH)) AS DATE) AS month_start FROM b)
SELECT month_start, CAST(strftime(month_start, '%Y%m') AS INTEGER) AS date_key,
       CAST(year(month_start) AS INTEGER) AS year, strftime(month_start, '%B') AS month_name,
       strftime(month_start, '%b') AS month_short, 'Q' || CAST(quarter(month_start) AS VARCHAR) AS quarter,
       CAST(year(month_start) AS VARCHAR) || '-Q' || CAST(quarter(month_start) AS VARCHAR) AS year_quarter
FROM g""",
    "filter_not_null": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 10 <> 0",
    "filter_in_list": """
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""",
    "filter_sql_string": "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#4'",
    "map_then_allow_list": """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 3 THEN NULL ELSE c_mktsegment END AS segment FROM customer""",
    "sanitize_numeric_id": """
SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 11 = 0 THEN '999999'
                       ELSE CAST(c_custkey AS VARCHAR) END AS customer_id FROM customer""",
    "clean_numeric_abs": """
SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 OR c_custkey % 13 = 0 THEN 0.0
                       ELSE abs(c_acctbal) END AS acctbal FROM customer""",
    "normalize_names": f"SELECT p_partkey, {_initcap('p_name')} AS name FROM part",
    "fix_typo_regex": """
SELECT p_partkey, CASE WHEN p_partkey % 3 IN (0, 1) THEN 'Protein ' || p_name ELSE p_name END AS name
FROM part""",
    "extract_variant": """
SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN CAST(p_size AS VARCHAR) || 'g' ELSE '' END AS variant
FROM part""",
    "hash_business_key": "SELECT p_partkey, sha256(p_name || '|' || p_brand) AS product_code FROM part",
    "derive_category": f"""
WITH c AS (SELECT p_partkey, {_initcap('p_type')} AS category FROM part)
SELECT p_partkey, category, {_DIVISION} AS division FROM c""",
    "parse_multi_format_date": "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders",
    "fact_project_rename": """
SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS date, o_custkey AS customer_code,
       l_partkey AS product_id, l_linenumber, l_quantity AS sold_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "resolve_surrogate_key": """
SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) AS product_id,
       sha256(p_name || '|' || p_brand) AS product_code
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 13 <> 0""",
    "fill_missing_from_lookup": """
SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 AND c_custkey % 20 <> 0 THEN NULL ELSE c_mktsegment END
       AS c_mktsegment FROM customer""",
    "dedupe_single_key": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "dedupe_composite_key": """
SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_shipdate) = 1""",
    "monthly_rollup": _ROLLUP_ALL,
    "date_range": """
SELECT CAST(min(o_orderdate) AS DATE) AS start_date, CAST(max(o_orderdate) AS DATE) AS end_date
FROM orders""",
    "count_distinct": "SELECT count(DISTINCT o_custkey) AS n_customers FROM orders",
    "distinct_values": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "row_counts_by_stage": f"""
WITH {_LINES}, {_PRODUCTS},
raw AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber % 7 = 0),
q AS (SELECT * FROM raw WHERE (l_orderkey + l_linenumber) % 19 <> 0),
d AS (SELECT DISTINCT l_orderkey, CAST(o_orderdate AS DATE) AS dt,
             CASE WHEN o_custkey % 23 = 0 THEN '999999' ELSE CAST(o_custkey AS VARCHAR) END AS cust,
             CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id
      FROM q)
SELECT '1_raw' AS stage, count(*) AS rows FROM raw
UNION ALL SELECT '2_with_quantity', count(*) FROM q
UNION ALL SELECT '3_deduplicated', count(*) FROM d
UNION ALL SELECT '4_resolved', count(*) FROM d JOIN prod USING (product_id)""",
    "dq_duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "dq_untrimmed": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id, '  ' || upper(c_name) || ' ' AS customer_name
FROM customer WHERE c_custkey % 3 = 0""",
    "dq_missing_values": """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_custkey % 10 = 0""",
    "dq_profile": """
WITH r AS (SELECT * FROM customer UNION ALL SELECT * FROM customer WHERE c_custkey % 8 = 0)
SELECT count(*) AS rows, count(DISTINCT c_custkey) AS distinct_keys,
       CAST(0 AS BIGINT) AS nulls_customer_id, CAST(0 AS BIGINT) AS nulls_customer_name,
       CAST(0 AS BIGINT) AS nulls_city,
       count(*) FILTER (WHERE c_custkey % 3 = 0) AS untrimmed_customer_name,
       CAST(0 AS BIGINT) AS untrimmed_city
FROM r""",
    "latest_nonzero_per_group": """
WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
                  CAST(year(o_orderdate) AS INTEGER) AS year,
                  CASE WHEN o_orderkey % 6 = 0 THEN 0.0 ELSE o_totalprice END AS price FROM orders)
SELECT * FROM o QUALIFY rank() OVER (
  PARTITION BY o_custkey, year
  ORDER BY CASE WHEN price = 0 THEN 1 ELSE 0 END, o_orderdate DESC NULLS LAST) = 1""",
    "preview_top_n": """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 20""",
    "append_batches": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "schema_evolving_union": """
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "upsert_all_columns": """
SELECT c_custkey,
       CASE WHEN c_custkey % 5 = 0 THEN upper(c_name) ELSE c_name END AS c_name, c_nationkey,
       CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 5 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 = 0""",
    "upsert_set_columns": """
SELECT c_custkey, c_name, c_nationkey,
       CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 3 <> 0
UNION ALL
SELECT c_custkey, upper(c_name), CAST(NULL AS INTEGER), c_acctbal + 100, CAST(NULL AS VARCHAR)
FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 = 0""",
    "upsert_monthly_fact": _ROLLUP_ALL,
    "snapshot_diff": """
SELECT c_custkey, c_name, c_acctbal, 'insert' AS change_type FROM customer
  WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0 AND c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, 'insert' FROM customer
  WHERE c_custkey % 11 <> 0 AND c_custkey % 7 = 0 AND c_custkey % 5 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal, 'delete' FROM customer
  WHERE c_custkey % 7 <> 0 AND c_custkey % 11 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal, 'update_preimage' FROM customer
  WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 5 = 0
UNION ALL SELECT c_custkey, c_name, c_acctbal + 1, 'update_postimage' FROM customer
  WHERE c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 5 = 0""",
    "affected_month_recompute": _ROLLUP_ALL,
    "dim_customers_conform": f"""
WITH c AS (
  SELECT DISTINCT c_custkey, c_name,
         CASE WHEN c_custkey % 5 = 2 THEN (CASE WHEN c_custkey % 10 = 2 THEN n_name END)
              ELSE n_name END AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(c_custkey AS VARCHAR) AS customer_code,
       {_initcap('c_name')} || '-' || coalesce(city, 'unknown') AS customer,
       'India' AS market, 'Sports Bar' AS platform, 'Acquisition' AS channel
FROM c""",
    "dim_products_conform": f"""
WITH {_PRODUCTS}
SELECT product_code, regexp_extract(product_name, '\\(([^)]+)\\)', 1) AS variant,
       {_DIVISION} AS division, category, product_name AS product
FROM prod QUALIFY row_number() OVER (
  PARTITION BY product_code ORDER BY product_id, division NULLS LAST, category) = 1""",
    "dim_price_conform": f"""
WITH {_PRODUCTS},
pr AS (
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN '88888888' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         CAST(l_shipdate AS DATE) AS month,
         CASE WHEN l_orderkey % 9 = 0 THEN 0.0 ELSE abs(l_extendedprice) END AS gross_price
  FROM lineitem),
g AS (SELECT p.product_code, pr.month, pr.gross_price, CAST(year(pr.month) AS INTEGER) AS year
      FROM pr JOIN prod p ON pr.product_id = p.product_id)
SELECT product_code, CAST(year AS VARCHAR) AS year, gross_price AS price_inr FROM g
QUALIFY row_number() OVER (
  PARTITION BY product_code, year
  ORDER BY CASE WHEN gross_price = 0 THEN 1 ELSE 0 END, month DESC NULLS LAST, gross_price) = 1""",
    "dim_customers_load": f"""
WITH c AS (
  SELECT DISTINCT c_custkey, c_name,
         CASE WHEN c_custkey % 5 = 2 THEN (CASE WHEN c_custkey % 10 = 2 THEN n_name END)
              ELSE n_name END AS city
  FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(c_custkey AS VARCHAR) AS customer_code,
       {_initcap('c_name')} || '-' || coalesce(city, 'unknown') AS customer,
       'India' AS market, 'Sports Bar' AS platform, 'Acquisition' AS channel
FROM c
UNION ALL
SELECT 'P' || CAST(n_nationkey AS VARCHAR), 'Parent-' || n_name, 'India', 'Retail', 'Direct' FROM nation""",
    "dim_products_load": f"""
WITH {_PRODUCTS},
conf AS (
  SELECT product_code, regexp_extract(product_name, '\\(([^)]+)\\)', 1) AS variant,
         {_DIVISION} AS division, category, product_name AS product
  FROM prod QUALIFY row_number() OVER (
    PARTITION BY product_code ORDER BY product_id, division NULLS LAST, category) = 1)
SELECT product_code, variant, division, category, product,
       CASE WHEN substr(product_code, 1, 1) < '8' THEN 'parent' END AS source_system
FROM conf""",
    "dim_price_load": f"""
WITH {_PRODUCTS},
pr AS (
  SELECT CASE WHEN l_orderkey % 11 = 0 THEN '88888888' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         CAST(l_shipdate AS DATE) AS month,
         CASE WHEN l_orderkey % 9 = 0 THEN 0.0 ELSE abs(l_extendedprice) END AS gross_price
  FROM lineitem),
g AS (SELECT p.product_code, pr.month, pr.gross_price, CAST(year(pr.month) AS INTEGER) AS year
      FROM pr JOIN prod p ON pr.product_id = p.product_id),
child AS (
  SELECT product_code, CAST(year AS VARCHAR) AS year, gross_price AS price_inr FROM g
  QUALIFY row_number() OVER (
    PARTITION BY product_code, year
    ORDER BY CASE WHEN gross_price = 0 THEN 1 ELSE 0 END, month DESC NULLS LAST, gross_price) = 1),
stale AS (SELECT DISTINCT product_code, '2000' AS year, 1.0 AS price_inr FROM prod
          WHERE substr(product_code, 1, 1) < '8')
SELECT * FROM child
UNION ALL
SELECT * FROM stale s WHERE NOT EXISTS (
  SELECT 1 FROM child c WHERE c.product_code = s.product_code AND c.year = s.year)
UNION ALL
SELECT 'PB-' || p_brand, '2024', min(p_retailprice) FROM part GROUP BY p_brand""",
    "fact_full_load": _FACT,
    "fact_incremental_load": _FACT,
    "fact_stream_load": _FACT,
    "fact_replay": _monthly_fact("WHERE l_orderkey % 29 <> 0"),
    "fact_daily_gold": f"""WITH {_DAILY.format(where="")}
SELECT order_id, date, product_code, customer_code, product_id, qty AS sold_quantity FROM daily""",
    "fact_schema_drift": f"""WITH {_DAILY.format(where="")}
SELECT order_id, date AS order_placement_date, customer_code AS customer_id, product_id, qty AS order_qty,
       product_code, CASE WHEN CAST(order_id AS BIGINT) % 2 = 1 THEN 'web' END AS channel FROM daily""",
    "fact_rejects": f"""
WITH {_LINES}, {_PRODUCTS},
q AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber % 7 = 0),
c AS (SELECT CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
             CASE WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'no_quantity'
                  WHEN l_orderkey % 29 = 0 THEN 'bad_date' END AS reason
      FROM q)
SELECT coalesce(reason, 'unknown_product') AS reject_reason, product_id, count(*) AS rows FROM c
WHERE reason IS NOT NULL OR product_id NOT IN (SELECT product_id FROM prod)
GROUP BY ALL""",
    "fact_sequenced_in_order": _SEQUENCED,
    "fact_sequenced_late": _SEQUENCED,
    "fact_month_keep": _FACT + _OWN_ROWS,
    "fact_month_replace": _monthly_fact(
        "WHERE date < DATE '2000-06-01' OR CAST(c.product_id AS BIGINT) % 7 <> 0") + _OWN_ROWS,
    "fact_late_products": f"""{_FACT}
UNION ALL
SELECT CAST(NULL AS DATE), reason, 'rejects', count(*) FROM (
  SELECT CASE WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'no_quantity' ELSE 'unknown_product' END AS reason
  FROM (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber % 7 = 0)
  WHERE (l_orderkey + l_linenumber) % 19 = 0
     OR (CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END) NOT IN (SELECT product_id FROM prod))
GROUP BY reason""",
    "fact_change_feed": f"""WITH {_LINES}, {_PRODUCTS},
clean AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_placement_date,
         CASE WHEN o_custkey % 23 = 0 THEN '999999' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         l_quantity AS qty, o_orderdate >= TIMESTAMP '2000-06-15' OR l_partkey % 5 = 0 AS late, l_orderkey % 7 = 0 AS wrong
  FROM lines WHERE (l_orderkey + l_linenumber) % 19 <> 0),
b1 AS (
  SELECT order_id, order_placement_date, customer_id, product_id, max(CASE WHEN wrong THEN qty + 1 ELSE qty END) AS qty
  FROM clean WHERE NOT late GROUP BY ALL),
b2 AS (
  SELECT order_id, order_placement_date, customer_id, product_id, max(qty) AS qty
  FROM clean WHERE late OR wrong GROUP BY ALL),
both_ AS (
  SELECT b2.*, b1.qty AS was, b1.order_id IS NOT NULL AS had
  FROM b2 LEFT JOIN b1 USING (order_id, order_placement_date, customer_id, product_id)),
feed AS (
  SELECT * EXCLUDE (was, had), 'insert' AS change_type FROM both_ WHERE NOT had
  UNION ALL SELECT * EXCLUDE (was, had), 'update_postimage' FROM both_ WHERE had AND was <> qty
  UNION ALL SELECT * EXCLUDE (was, had) REPLACE (was AS qty), 'update_preimage' FROM both_ WHERE had AND was <> qty)
SELECT order_id, order_placement_date, customer_id, feed.product_id, qty AS order_qty, product_code, change_type
FROM feed JOIN prod ON feed.product_id = prod.product_id""",
    "fact_stream_mixed_headers": f"""WITH {_LINES}, {_PRODUCTS},
q AS (
  SELECT *, CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id
  FROM (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber % 7 = 0)),
judged AS (
  SELECT *, CASE WHEN l_orderkey % 4 = 3 THEN 'broken_row'
                 WHEN (l_orderkey + l_linenumber) % 19 = 0 THEN 'no_quantity'
                 WHEN product_id NOT IN (SELECT product_id FROM prod) THEN 'unknown_product' END AS reason FROM q)
SELECT reason AS what, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT CASE WHEN l_orderkey % 4 = 1 THEN 'web' ELSE 'shop' END AS what, count(DISTINCT (l_orderkey, l_partkey)) AS rows
FROM judged WHERE reason IS NULL GROUP BY 1""",
    "schema_widening": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS customer, CAST(floor(o_totalprice) AS DOUBLE) AS amount,
       CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_orderpriority END AS o_orderpriority FROM orders""",
    "dedupe_five_columns": f"""
WITH {_LINES}
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_placement_date,
       CASE WHEN o_custkey % 23 = 0 THEN '999999' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN l_orderkey % 13 = 0 THEN '99999999' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
       l_quantity AS order_qty
FROM lines WHERE (l_orderkey + l_linenumber) % 19 <> 0""",
    "fill_from_literal_table": """
SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
       CASE WHEN c_custkey % 10 <> 0 THEN c_mktsegment WHEN c_custkey = 10 THEN 'BUILDING'
            WHEN c_custkey = 20 THEN 'MACHINERY' WHEN c_custkey = 30 THEN 'HOUSEHOLD' END AS segment
FROM customer""",
    "hash_key_with_nulls": r"""
SELECT c_custkey, sha256(
  coalesce(CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END, '\N') || '|' ||
  coalesce(CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 4 = 0 THEN ''
                ELSE 'a\|b' || CAST(c_custkey AS VARCHAR) END, '\N') || '|' ||
  coalesce(CASE WHEN c_custkey % 2 <> 0 THEN 'x' END, '\N')) AS key
FROM customer""",
}
