"""The three messy all-STRING source tables, derived from the driver's
TPC-H-like tables (FIXTURES.md §2).

The same text runs in Spark SQL (``spark.sql(text, lineitem=df, ...)``) and in
the DuckDB oracle (placeholders replaced by view names), so both sides see
identical inputs. Every row of the driver tables is used: the views are
deterministic rewrites, not samples.
"""

RAW_ORDERS_SQL = """
SELECT order_id, user_id, product_id, order_date, quantity, status, revenue_czk, discount_pct FROM (
SELECT
 CASE WHEN k = 40 THEN '' WHEN k = 41 THEN CAST(NULL AS STRING) ELSE CAST(lo AS STRING) || '-' || CAST(ln AS STRING) END AS order_id,
 CASE WHEN k = 0 THEN CAST(NULL AS STRING) WHEN k = 1 THEN 'ghost' ELSE CAST(cust AS STRING) END AS user_id,
 CASE WHEN k = 2 THEN '' WHEN k = 3 THEN 'missing' ELSE CAST(lp AS STRING) END AS product_id,
 CASE WHEN k = 4 THEN CAST(NULL AS STRING) WHEN k = 5 THEN 'n/a' ELSE CAST(CAST(od AS DATE) AS STRING) END AS order_date,
 CASE WHEN k = 6 THEN '0' WHEN k = 7 THEN 'abc' WHEN k = 8 THEN '0.4' WHEN k = 9 THEN '-2' ELSE CAST(CAST(q AS INT) AS STRING) END AS quantity,
 CASE WHEN k = 16 THEN 'shipped' WHEN k = 17 THEN '' WHEN k = 18 THEN CAST(NULL AS STRING)
      WHEN st = 'F' AND k IN (10, 11) THEN 'COMPLETED' WHEN st = 'F' AND k = 12 THEN ' Completed '
      WHEN st = 'F' AND k = 13 THEN 'kompletní' WHEN st = 'F' AND k = 14 THEN 'KOMPLETNÍ'
      WHEN st = 'F' THEN 'completed' WHEN st = 'O' THEN 'cancelled' ELSE 'returned' END AS status,
 CASE WHEN k = 20 THEN '0' WHEN k = 21 THEN '' WHEN k = 22 THEN '0.40' WHEN k = 23 THEN 'free' ELSE CAST(CAST(FLOOR(px / 40) AS INT) AS STRING) || '.50' END AS revenue_czk,
 CASE WHEN k = 30 THEN '1.5' WHEN k = 31 THEN '-0.1' ELSE CAST(CAST(dc AS DECIMAL(6,4)) AS STRING) END AS discount_pct
FROM (SELECT l_orderkey lo, l_linenumber ln, l_partkey lp, o_custkey cust, o_orderdate od, o_orderstatus st, l_quantity q,
             l_extendedprice px, l_discount dc, (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 100 AS k
      FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey) s) t
"""

RAW_PRODUCTS_SQL = """
SELECT CASE WHEN p_partkey % 97 = 5 THEN '' ELSE CAST(p_partkey AS STRING) END AS product_id,
 CASE WHEN p_partkey % 50 = 1 THEN '' ELSE p_name END AS product_name,
 CASE WHEN p_partkey % 50 = 2 THEN '' WHEN p_partkey % 50 = 3 THEN CAST(NULL AS STRING) WHEN p_partkey % 3 = 0 THEN ' ' || p_type ELSE LOWER(p_type) END AS category,
 CASE WHEN p_partkey % 50 = 4 THEN '0' WHEN p_partkey % 50 = 5 THEN '0.40' WHEN p_partkey % 50 = 6 THEN 'x' ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS price_czk,
 CASE WHEN p_partkey % 50 = 7 THEN '1.2' WHEN p_partkey % 50 = 8 THEN '' ELSE CAST(CAST(p_size / 100.0 AS DECIMAL(6,4)) AS STRING) END AS margin_pct,
 CASE WHEN p_partkey % 4 = 0 THEN 'ANO' WHEN p_partkey % 4 = 1 THEN '0' WHEN p_partkey % 4 = 2 THEN ' true ' ELSE 'maybe' END AS is_active
FROM {part}
UNION ALL
SELECT CAST(p_partkey AS STRING), p_name, p_type, CAST(CAST(p_retailprice + 1 AS DECIMAL(18,2)) AS STRING), '0.1000', '1' FROM {part} WHERE p_partkey % 25 = 10
"""

RAW_USERS_SQL = """
SELECT CASE WHEN c_custkey % 97 = 5 THEN CAST(NULL AS STRING) ELSE CAST(c_custkey AS STRING) END AS user_id,
 CASE WHEN c_custkey % 30 = 1 THEN '' WHEN c_custkey % 30 = 2 THEN 'DE' WHEN c_custkey % 100 = 0 THEN 'RO' WHEN c_nationkey % 4 = 0 THEN 'cz' WHEN c_nationkey % 4 = 1 THEN ' SK' WHEN c_nationkey % 4 = 2 THEN 'PL' ELSE 'HU' END AS country,
 CASE WHEN c_custkey % 30 = 3 THEN CAST(NULL AS STRING) WHEN c_mktsegment = 'BUILDING' THEN 'Email' WHEN c_mktsegment = 'MACHINERY' THEN 'organic' WHEN c_mktsegment = 'FURNITURE' THEN 'paid_search' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'direct' ELSE 'affiliate' END AS acquisition_channel,
 CASE WHEN c_custkey % 30 = 4 THEN '' WHEN c_custkey % 30 = 5 THEN 'unknown' ELSE CAST(DATE '1995-01-01' + CAST((c_custkey * 37) % 2400 AS INT) AS STRING) END AS registered_at,
 CASE WHEN c_custkey % 30 = 6 THEN '' WHEN c_custkey % 30 = 7 THEN '55 plus' WHEN c_custkey % 5 = 0 THEN '18-24' WHEN c_custkey % 5 = 1 THEN '25-34' WHEN c_custkey % 5 = 2 THEN '35-44' WHEN c_custkey % 5 = 3 THEN '45-54' ELSE '55+' END AS age_group
FROM {customer}
UNION ALL
SELECT CAST(c_custkey AS STRING), 'CZ', 'social', '2001-07-01', '25-34' FROM {customer} WHERE c_custkey % 40 = 8
"""

# Which driver tables each view reads.
VIEW_INPUTS = {
    "raw_orders": (RAW_ORDERS_SQL, ("lineitem", "orders")),
    "raw_products": (RAW_PRODUCTS_SQL, ("part",)),
    "raw_users": (RAW_USERS_SQL, ("customer",)),
}
