"""Bind the shared test tables to the raw (all-text) source schemas.

The same SQL text runs in Spark (DataFrames passed as ``{name}`` parameters)
and in DuckDB (where the placeholders become the registered view names), so
the oracle reads exactly the raw rows Spark reads. Every source row is used;
the modulo rules only plant dirt (padded text, bad numbers and dates, missing
keys, missing children) so that each cleaning rule is exercised at every
scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("orders", "lineitem", "customer", "part", "supplier", "nation")

RAW_SQL: dict[str, str] = {
    "raw_orders": """
SELECT CAST(o_orderkey AS STRING) AS order_id,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS customer_id,
       CASE WHEN o_orderkey % 11 = 0 THEN '  ' || o_orderstatus || ' '
            WHEN o_orderkey % 13 = 0 THEN ' ' WHEN o_orderkey % 29 = 0 THEN 'n/a' ELSE o_orderstatus END AS order_status,
       CAST(o_orderdate AS STRING) AS order_purchase_timestamp,
       CASE WHEN o_orderkey % 17 = 0 THEN 'not a date' WHEN o_orderkey % 19 = 0 THEN 'None'
            WHEN o_orderkey % 23 = 0 THEN SUBSTR(CAST(o_orderdate + INTERVAL '1' DAY AS STRING), 1, 10)
            WHEN o_orderkey % 29 = 0 THEN REPLACE(CAST(o_orderdate + INTERVAL '1' DAY AS STRING), ' ', 'T')
            WHEN o_orderkey % 31 = 0 THEN CAST(o_orderdate + INTERVAL '1' DAY AS STRING) || '.123456789'
            WHEN o_orderkey % 37 = 0 THEN '2017'
            ELSE CAST(o_orderdate + INTERVAL '1' DAY AS STRING) END AS order_approved_at,
       CAST(o_orderdate + INTERVAL '2' DAY AS STRING) AS order_delivered_carrier_date,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL
            ELSE CAST(o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 500) AS STRING) END AS order_delivered_customer_date,
       CAST(o_orderdate + INTERVAL '20' DAY AS STRING) AS order_estimated_delivery_date
FROM {orders}""",
    "raw_order_items": """
SELECT CAST(l_orderkey AS STRING) AS order_id,
       CAST(l_linenumber AS STRING) || '.0' AS order_item_id,
       CAST(l_partkey AS STRING) AS product_id,
       CAST(l_suppkey AS STRING) AS seller_id,
       CAST(l_shipdate AS STRING) AS shipping_limit_date,
       CASE WHEN l_orderkey % 41 = 0 THEN 'n/k' WHEN l_orderkey % 43 = 0 THEN 'NA'
            WHEN l_orderkey % 47 = 0 THEN ' 12.50 ' WHEN l_orderkey % 53 = 0 THEN '1e3' ELSE CAST(l_extendedprice AS STRING) END AS price,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS STRING) AS freight_value
FROM {lineitem}""",
    "raw_payments": """
SELECT CAST(o_orderkey AS STRING) AS order_id, '1' AS payment_sequential,
       CASE WHEN o_orderkey % 31 = 0 THEN '#N/A' ELSE o_orderpriority END AS payment_type,
       CAST(1 + o_orderkey % 12 AS STRING) AS payment_installments, CAST(o_totalprice AS STRING) AS payment_value
FROM {orders} WHERE o_orderkey % 13 <> 0
UNION ALL
SELECT CAST(o_orderkey AS STRING), '2', ' Voucher ', '1', '10.5'
FROM {orders} WHERE o_orderkey % 5 = 0""",
    "raw_reviews": """
SELECT 'r' || CAST(o_orderkey AS STRING) AS review_id, CAST(o_orderkey AS STRING) AS order_id,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS STRING) END AS review_score,
       CASE WHEN o_orderkey % 37 = 0 THEN '<NA>' ELSE ' ' END AS review_comment_title,
       CASE WHEN o_orderkey % 31 = 0 THEN 'null' WHEN o_orderkey % 41 = 0 THEN 'NULL' ELSE o_orderpriority END AS review_comment_message,
       CAST(o_orderdate + INTERVAL '30' DAY AS STRING) AS review_creation_date,
       CAST(o_orderdate + INTERVAL '31' DAY AS STRING) AS review_answer_timestamp
FROM {orders} WHERE o_orderkey % 10 <> 0
UNION ALL
SELECT 'q' || CAST(o_orderkey AS STRING), CAST(o_orderkey AS STRING), '5',
       CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING), CAST(NULL AS STRING)
FROM {orders} WHERE o_orderkey % 20 = 1""",
    "raw_customers": """
SELECT CAST(c_custkey AS STRING) AS customer_id, CASE WHEN c_custkey % 31 = 0 THEN 'N/A' ELSE c_name END AS customer_unique_id,
       CAST(10000 + c_nationkey AS STRING) AS customer_zip_code_prefix,
       ' ' || n_name AS customer_city, LOWER(c_mktsegment) AS customer_state
FROM {customer} LEFT JOIN {nation} ON c_nationkey = n_nationkey""",
    "raw_products": """
SELECT CAST(p_partkey AS STRING) AS product_id,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_type END AS product_category_name,
       CAST(LENGTH(p_name) AS STRING) AS product_name_lenght,
       CAST(p_size * 10 AS STRING) || '.0' AS product_description_lenght,
       CAST(p_partkey % 5 AS STRING) AS product_photos_qty,
       CASE WHEN p_partkey % 23 = 0 THEN 'x' WHEN p_partkey % 29 = 0 THEN 'NaN' ELSE CAST(p_size * 100 AS STRING) END AS product_weight_g,
       CAST(p_size AS STRING) AS product_length_cm,
       CAST(p_size + 1 AS STRING) AS product_height_cm,
       CAST(p_size + 2 AS STRING) AS product_width_cm
FROM {part}""",
    "raw_translations": """
SELECT DISTINCT p_type AS product_category_name, CASE WHEN p_type LIKE 'E%' THEN 'nan' ELSE 'EN_' || p_type END AS product_category_name_english
FROM {part} WHERE p_type <> 'PROMO'""",
    "raw_sellers": """
SELECT CAST(s_suppkey AS STRING) AS seller_id, CAST(20000 + s_nationkey AS STRING) AS seller_zip_code_prefix,
       CASE WHEN s_suppkey % 7 = 0 THEN '#NA' ELSE n_name END AS seller_city, ' br ' AS seller_state
FROM {supplier} LEFT JOIN {nation} ON s_nationkey = n_nationkey""",
}

RAW_TABLES = tuple(RAW_SQL)


def load_base(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in BASE_TABLES}


def bind_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Raw text tables derived from the test tables under ``sf_dir`` (lazy plans)."""
    base = load_base(spark, sf_dir)
    return {name: spark.sql(sql, **{k: v for k, v in base.items() if "{" + k + "}" in sql})
            for name, sql in RAW_SQL.items()}


def raw_sql_for_duckdb(name: str) -> str:
    """The binding of one raw table as DuckDB text over the registered views."""
    return RAW_SQL[name].format(**{t: t for t in BASE_TABLES})


def raw_ctes() -> str:
    """``WITH`` prefix defining every raw table for oracle SQL."""
    return "WITH " + ",\n".join(f"{n} AS ({raw_sql_for_duckdb(n)})" for n in RAW_TABLES)
