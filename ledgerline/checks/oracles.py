"""Oracle SQL per registered query (DuckDB dialect, test-table views pre-registered).

Written independently of the Spark plans: batch-dependent results are
computed the brute-force way -- every batch's closure materialised per batch,
then "last batch wins" -- while the Spark side uses per-key last-batch
aggregates.
"""

from __future__ import annotations

from .. import schemas
from ..sources.binding import RAW_TABLES
from . import sqlgen as g

BATCH_SIZE = 5000
PIPELINE = "orders_warehouse_incremental"
ELIGIBLE = ("order_purchase_timestamp IS NOT NULL "
            "AND CAST(order_purchase_timestamp AS TIMESTAMP) > TIMESTAMP '1900-01-01 00:00:00'")
BATCH_ALL = f"batch AS (SELECT * FROM raw_orders WHERE {ELIGIBLE})"
TS = "CAST(order_purchase_timestamp AS TIMESTAMP)"


def q(body: str, *ctes: str) -> str:
    return g.with_raw(body, ",\n".join(c for c in ctes if c))


def _lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


# ------------------------------------------------------------------ full build (one batch holds all)
def closure_ctes(batch: str = "batch") -> str:
    return ",\n".join([
        f"c_items AS (SELECT * FROM raw_order_items WHERE order_id IN (SELECT order_id FROM {batch}))",
        f"c_payments AS (SELECT * FROM raw_payments WHERE order_id IN (SELECT order_id FROM {batch}))",
        f"c_reviews AS (SELECT * FROM raw_reviews WHERE order_id IN (SELECT order_id FROM {batch}))",
        f"c_customers AS (SELECT * FROM raw_customers WHERE customer_id IN (SELECT customer_id FROM {batch}))",
        "c_products AS (SELECT * FROM raw_products WHERE product_id IN (SELECT product_id FROM c_items))",
        "c_translations AS (SELECT * FROM raw_translations WHERE product_category_name IN "
        "(SELECT product_category_name FROM c_products))",
        "c_sellers AS (SELECT * FROM raw_sellers WHERE seller_id IN (SELECT seller_id FROM c_items))",
        "c_products_t AS (SELECT p.*, t.product_category_name_english FROM c_products p "
        "LEFT JOIN c_translations t ON p.product_category_name = t.product_category_name)",
    ])


def clean_ctes(batch: str = "batch") -> str:
    return ",\n".join([
        f"o AS ({g.cleaned_orders(batch)})",
        f"it AS ({g.cleaned_select('items', 'c_items')})",
        f"pay AS ({g.cleaned_select('payments', 'c_payments')})",
        f"rev AS ({g.cleaned_select('reviews', 'c_reviews')})",
        f"cus AS ({g.cleaned_select('customers', 'c_customers')})",
        f"prd AS ({g.cleaned_select('products', 'c_products_t')})",
        f"sel AS ({g.cleaned_select('sellers', 'c_sellers')})",
    ])


AGG_CTES = """ia AS (SELECT order_id, COUNT(order_item_id) AS order_item_count,
                      COUNT(DISTINCT product_id) AS distinct_product_count,
                      COALESCE(SUM(price), 0) AS total_item_value,
                      COALESCE(SUM(freight_value), 0) AS total_freight_value
               FROM it GROUP BY order_id),
pa AS (SELECT order_id, COALESCE(SUM(payment_value), 0) AS total_payment_value FROM pay GROUP BY order_id),
ra AS (SELECT order_id, AVG(review_score) AS avg_review_score, COUNT(review_score) AS review_count
       FROM rev GROUP BY order_id)"""

FACT_SELECT = f"""SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at, o.approved_at,
       o.delivered_carrier_at, o.delivered_customer_at, o.estimated_delivery_at,
       CAST({g.days_between('o.delivered_customer_at', 'o.purchased_at')} AS DECIMAL(10,2)) AS delivery_days,
       CAST(COALESCE(ia.order_item_count, 0) AS INTEGER) AS order_item_count,
       CAST(COALESCE(ia.distinct_product_count, 0) AS INTEGER) AS distinct_product_count,
       CAST(ia.total_item_value AS DECIMAL(12,2)) AS total_item_value,
       CAST(ia.total_freight_value AS DECIMAL(12,2)) AS total_freight_value,
       CAST(pa.total_payment_value AS DECIMAL(12,2)) AS total_payment_value,
       CAST(ra.avg_review_score AS DECIMAL(3,2)) AS avg_review_score,
       CAST(COALESCE(ra.review_count, 0) AS INTEGER) AS review_count"""

FACT_FROM = """FROM o LEFT JOIN ia ON o.order_id = ia.order_id LEFT JOIN pa ON o.order_id = pa.order_id
LEFT JOIN ra ON o.order_id = ra.order_id
WHERE o._rn_latest = 1"""


def full(body: str, *more: str) -> str:
    return q(body, BATCH_ALL, closure_ctes(), clean_ctes(), AGG_CTES, *more)


FACT_CTE = f"fact AS ({FACT_SELECT}\n{FACT_FROM})"


def typed_cols(schema, alias: str = "") -> str:
    pre = f"{alias}." if alias else ""
    out = []
    for f in schema.fields:
        t = f.dataType.simpleString()
        sql_t = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP"}.get(t, t.upper())
        out.append(f"CAST({pre}{f.name} AS {sql_t}) AS {f.name}")
    return ", ".join(out)


# ------------------------------------------------------------------ per-batch (incremental) brute force
def batch_ctes(src: str = "batch", max_batch: int | None = None) -> str:
    lim = f" WHERE _batch <= {max_batch}" if max_batch else ""
    return ",\n".join([
        f"assigned AS (SELECT * FROM (SELECT *, CAST(ceil(row_number() OVER (ORDER BY {TS}, order_id NULLS LAST) "
        f"/ {BATCH_SIZE}.0) AS BIGINT) AS _batch FROM {src}){lim})",
        "bo AS (SELECT DISTINCT order_id AS _v, _batch FROM assigned WHERE order_id IS NOT NULL)",
        "bcu AS (SELECT DISTINCT customer_id AS _v, _batch FROM assigned WHERE customer_id IS NOT NULL)",
        "b_items AS (SELECT i.*, bo._batch FROM raw_order_items i JOIN bo ON i.order_id = bo._v)",
        "b_payments AS (SELECT p.*, bo._batch FROM raw_payments p JOIN bo ON p.order_id = bo._v)",
        "b_reviews AS (SELECT r.*, bo._batch FROM raw_reviews r JOIN bo ON r.order_id = bo._v)",
        "b_customers AS (SELECT c.*, bcu._batch FROM raw_customers c JOIN bcu ON c.customer_id = bcu._v)",
        "bp AS (SELECT DISTINCT product_id AS _v, _batch FROM b_items WHERE product_id IS NOT NULL)",
        "bs AS (SELECT DISTINCT seller_id AS _v, _batch FROM b_items WHERE seller_id IS NOT NULL)",
        "b_products AS (SELECT p.*, t.product_category_name_english, bp._batch FROM raw_products p "
        "JOIN bp ON p.product_id = bp._v LEFT JOIN raw_translations t ON p.product_category_name = t.product_category_name)",
        "b_sellers AS (SELECT s.*, bs._batch FROM raw_sellers s JOIN bs ON s.seller_id = bs._v)",
        f"ob AS ({g.cleaned_orders('assigned', per_batch=True)})",
        f"itb AS ({g.cleaned_select('items', 'b_items', per_batch=True)})",
        f"payb AS ({g.cleaned_select('payments', 'b_payments', per_batch=True)})",
        f"revb AS ({g.cleaned_select('reviews', 'b_reviews', per_batch=True)})",
        f"cusb AS ({g.cleaned_select('customers', 'b_customers', per_batch=True)})",
        f"prdb AS ({g.cleaned_select('products', 'b_products', per_batch=True)})",
        f"selb AS ({g.cleaned_select('sellers', 'b_sellers', per_batch=True)})",
    ])


def last_batch(cte: str, keys: list[str], schema) -> str:
    cols = ", ".join(schema.fieldNames())
    return (f"SELECT {typed_cols(schema)}, source_batch_id FROM (SELECT {cols}, _batch AS source_batch_id, "
            f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY _batch DESC) AS _rn FROM {cte}) x "
            f"WHERE _rn = 1")


FACT_B = f"""factb AS (
SELECT o.order_id, o.customer_id, o.order_status, o.purchased_at, o.approved_at,
       o.delivered_carrier_at, o.delivered_customer_at, o.estimated_delivery_at,
       CAST({g.days_between('o.delivered_customer_at', 'o.purchased_at')} AS DECIMAL(10,2)) AS delivery_days,
       CAST(COALESCE(ia.order_item_count, 0) AS INTEGER) AS order_item_count,
       CAST(COALESCE(ia.distinct_product_count, 0) AS INTEGER) AS distinct_product_count,
       CAST(ia.total_item_value AS DECIMAL(12,2)) AS total_item_value,
       CAST(ia.total_freight_value AS DECIMAL(12,2)) AS total_freight_value,
       CAST(pa.total_payment_value AS DECIMAL(12,2)) AS total_payment_value,
       CAST(ra.avg_review_score AS DECIMAL(3,2)) AS avg_review_score,
       CAST(COALESCE(ra.review_count, 0) AS INTEGER) AS review_count,
       o._batch AS source_batch_id
FROM ob o
LEFT JOIN (SELECT _batch, order_id, COUNT(order_item_id) AS order_item_count,
                  COUNT(DISTINCT product_id) AS distinct_product_count,
                  COALESCE(SUM(price), 0) AS total_item_value, COALESCE(SUM(freight_value), 0) AS total_freight_value
           FROM itb GROUP BY _batch, order_id) ia ON o.order_id = ia.order_id AND o._batch = ia._batch
LEFT JOIN (SELECT _batch, order_id, COALESCE(SUM(payment_value), 0) AS total_payment_value
           FROM payb GROUP BY _batch, order_id) pa ON o.order_id = pa.order_id AND o._batch = pa._batch
LEFT JOIN (SELECT _batch, order_id, AVG(review_score) AS avg_review_score, COUNT(review_score) AS review_count
           FROM revb GROUP BY _batch, order_id) ra ON o.order_id = ra.order_id AND o._batch = ra._batch
WHERE o._rn_latest = 1)"""


def incremental(body: str, *more: str, max_batch: int | None = None, src_cte: str = BATCH_ALL) -> str:
    return q(body, src_cte, batch_ctes(max_batch=max_batch), *more)


LOG_BOUNDS = f"""log AS (
SELECT b._batch AS batch_id, CAST(b.n AS INTEGER) AS batch_size,
       lo.ts AS source_min_purchase_ts, hi.ts AS source_max_purchase_ts,
       lo.order_id AS source_min_order_id, hi.order_id AS source_max_order_id,
       CAST(COALESCE(no.n_orders, 0) AS INTEGER) AS staging_orders_loaded,
       CAST(COALESCE(ni.n_items, 0) AS INTEGER) AS staging_items_loaded
FROM (SELECT _batch, COUNT(*) AS n FROM assigned GROUP BY _batch) b
JOIN (SELECT _batch, {TS} AS ts, order_id, row_number() OVER (PARTITION BY _batch ORDER BY {TS}, order_id NULLS LAST) AS r
      FROM assigned) lo ON lo._batch = b._batch AND lo.r = 1
JOIN (SELECT _batch, {TS} AS ts, order_id, row_number() OVER (PARTITION BY _batch ORDER BY {TS} DESC, order_id DESC NULLS FIRST) AS r
      FROM assigned) hi ON hi._batch = b._batch AND hi.r = 1
LEFT JOIN (SELECT _batch, COUNT(*) AS n_orders FROM ob GROUP BY _batch) no ON no._batch = b._batch
LEFT JOIN (SELECT _batch, COUNT(*) AS n_items FROM itb GROUP BY _batch) ni ON ni._batch = b._batch)"""

LOG_LISTING_COLS = ("batch_id, 'completed' AS status, batch_size, staging_orders_loaded, "
                    "staging_orders_loaded AS fact_orders_upserted, source_min_purchase_ts, source_max_purchase_ts")


# The missing-value tokens, written out here on their own.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
           "NULL", "NaN", "None", "n/a", "nan", "null"]


def na_clean(table: str) -> str:
    tokens = ", ".join(_lit(t) for t in MISSING)
    cols = g.RAW_COLUMNS[table]
    return "SELECT " + ", ".join(f"CASE WHEN {c} IN ({tokens}) THEN NULL ELSE {c} END AS {c}" for c in cols) + \
        f" FROM {table}"


def counts_union(pairs: list[tuple[str, str]], name_col: str = "table_name") -> str:
    return "\nUNION ALL\n".join(f"SELECT '{n}' AS {name_col}, CAST(COUNT(*) AS BIGINT) AS row_count FROM {src}"
                                for n, src in pairs)


def serving_ctes() -> str:
    return ",\n".join([
        "sj AS (SELECT i.*, p.product_category_name FROM raw_order_items i LEFT JOIN "
        "(SELECT product_id, product_category_name FROM raw_products) p ON i.product_id IS NOT DISTINCT FROM p.product_id)",
        f"sia AS (SELECT order_id, COUNT(order_item_id) AS items_count, "
        f"COALESCE(SUM({g.to_number('price')}), 0) AS total_items_value, "
        f"COALESCE(SUM({g.to_number('freight_value')}), 0) AS total_freight_value, "
        f"string_agg(DISTINCT product_category_name, ', ' ORDER BY product_category_name) AS product_categories "
        f"FROM sj WHERE order_id IS NOT NULL GROUP BY order_id)",
        f"spa AS (SELECT order_id, COALESCE(SUM({g.to_number('payment_value')}), 0) AS total_payment_value "
        f"FROM raw_payments WHERE order_id IS NOT NULL GROUP BY order_id)",
        f"sra AS (SELECT order_id, AVG({g.to_number('review_score')}) AS avg_review_score "
        f"FROM raw_reviews WHERE order_id IS NOT NULL GROUP BY order_id)",
        """serving AS (SELECT o.order_id, o.customer_id, c.customer_state, o.order_status,
       CAST(o.order_purchase_timestamp AS TIMESTAMP) AS purchased_at,
       CAST(o.order_delivered_customer_date AS TIMESTAMP) AS delivered_at,
       CAST(sia.items_count AS INTEGER) AS items_count,
       CAST(sia.total_items_value AS DECIMAL(12,2)) AS total_items_value,
       CAST(sia.total_freight_value AS DECIMAL(12,2)) AS total_freight_value,
       CAST(spa.total_payment_value AS DECIMAL(12,2)) AS total_payment_value,
       CAST(sra.avg_review_score AS DECIMAL(3,2)) AS avg_review_score,
       sia.product_categories
FROM raw_orders o
LEFT JOIN (SELECT customer_id, customer_state FROM raw_customers) c ON o.customer_id IS NOT DISTINCT FROM c.customer_id
LEFT JOIN sia ON o.order_id = sia.order_id LEFT JOIN spa ON o.order_id = spa.order_id
LEFT JOIN sra ON o.order_id = sra.order_id)""",
    ])


SEMI = {
    "customers": "SELECT * FROM raw_customers WHERE customer_id IN (SELECT customer_id FROM batch)",
    "items": "SELECT * FROM c_items",
    "payments": "SELECT * FROM raw_payments WHERE order_id IN (SELECT order_id FROM batch)",
    "reviews": "SELECT * FROM raw_reviews WHERE order_id IN (SELECT order_id FROM batch)",
    "products": "SELECT * FROM c_products",
    "sellers": "SELECT * FROM c_sellers",
    "translations": "SELECT * FROM c_translations",
}

FIRST_BATCH = (f"fb AS (SELECT * FROM raw_orders WHERE {ELIGIBLE} ORDER BY {TS}, order_id NULLS LAST "
               f"LIMIT {BATCH_SIZE})")


def _oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    # sources
    o["csv_ingest"] = q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, concat_ws('|', " + ", ".join(f"COALESCE({c}, '~')" for c in g.RAW_COLUMNS[t])
        + f") AS cells FROM ({na_clean(t)}) x" for t in RAW_TABLES))
    o["na_tokens"] = q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(COUNT(*) AS BIGINT) AS row_count, CAST(COUNT({c}) AS BIGINT) AS present "
        f"FROM ({na_clean(t)}) x" for t in RAW_TABLES for c in g.RAW_COLUMNS[t]))
    o["table_profile"] = q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count, "
        f"CAST({len(g.RAW_COLUMNS[t])} AS INTEGER) AS column_count, {_lit(', '.join(g.RAW_COLUMNS[t]))} AS columns "
        f"FROM {t}" for t in RAW_TABLES))
    o["raw_all_text"] = q("\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, concat_ws('|', " + ", ".join(f"COALESCE(NULLIF({c}, ''), '~')" for c in g.RAW_COLUMNS[t])
        + f") AS cells FROM {t}" for t in RAW_TABLES))
    o["raw_load_counts"] = q(counts_union([(t, t) for t in RAW_TABLES]))
    o["scan_projected"] = "SELECT c_custkey, c_mktsegment FROM customer"
    o["param_query"] = q("SELECT order_id, customer_id, order_purchase_timestamp FROM raw_orders "
                         "WHERE CAST(order_purchase_timestamp AS TIMESTAMP) >= TIMESTAMP '1999-01-01 00:00:00' "
                         "AND customer_id IS NOT NULL")
    o["keyset_batch"] = q("SELECT * FROM fb", FIRST_BATCH)
    o["batch_closure"] = q(counts_union([(n, f"c_{n}") for n in
                                         ("customers", "items", "payments", "reviews", "products", "translations",
                                          "sellers")]), FIRST_BATCH, closure_ctes("fb"))
    for name, sql in SEMI.items():
        o[f"semi_{name}"] = q(sql, BATCH_ALL, closure_ctes())
    # projections / filters
    o["required_keys"] = q(f"SELECT * FROM (SELECT {g.clean_text('order_id')} AS order_id, "
                           f"{g.to_integer('order_item_id')} AS order_item_id, {g.clean_text('product_id')} AS product_id, "
                           f"{g.to_number('price')} AS price FROM raw_order_items) x "
                           f"WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL")
    o["distinct_keys"] = q("SELECT DISTINCT product_id FROM raw_order_items WHERE product_id IS NOT NULL")
    o["nan_to_null"] = ("SELECT l_orderkey, l_linenumber, l_partkey, "
                        "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS discount FROM lineitem")
    # joins
    o["join_translation"] = q("SELECT p.product_id, p.product_category_name, t.product_category_name_english "
                              "FROM raw_products p LEFT JOIN raw_translations t "
                              "ON p.product_category_name = t.product_category_name")
    o["join_items_products"] = q("SELECT i.order_id, i.order_item_id, i.product_id, p.product_category_name "
                                 "FROM raw_order_items i LEFT JOIN raw_products p "
                                 "ON i.product_id IS NOT DISTINCT FROM p.product_id")
    o["join_orders_customers"] = q("SELECT o.order_id, o.customer_id, c.customer_state FROM raw_orders o "
                                   "LEFT JOIN raw_customers c ON o.customer_id IS NOT DISTINCT FROM c.customer_id")
    # aggregates
    o["agg_items"] = full("SELECT order_id, CAST(order_item_count AS BIGINT) AS order_item_count, "
                          "CAST(distinct_product_count AS BIGINT) AS distinct_product_count, "
                          "CAST(total_item_value AS DECIMAL(28,6)) AS total_item_value, "
                          "CAST(total_freight_value AS DECIMAL(28,6)) AS total_freight_value FROM ia")
    o["agg_payments"] = full("SELECT order_id, CAST(total_payment_value AS DECIMAL(28,6)) AS total_payment_value FROM pa")
    o["agg_reviews"] = full("SELECT order_id, avg_review_score, CAST(review_count AS BIGINT) AS review_count FROM ra")
    o["agg_items_categories"] = q("SELECT order_id, CAST(items_count AS BIGINT) AS items_count, "
                                  "CAST(total_items_value AS DECIMAL(28,6)) AS total_items_value, "
                                  "CAST(total_freight_value AS DECIMAL(28,6)) AS total_freight_value, "
                                  "product_categories FROM sia", serving_ctes())
    o["agg_sorted_distinct_text"] = q("SELECT order_id, product_categories FROM sia", serving_ctes())
    o["agg_payments_raw"] = q("SELECT order_id, CAST(total_payment_value AS DECIMAL(28,6)) AS total_payment_value "
                              "FROM spa", serving_ctes())
    o["agg_reviews_raw"] = q("SELECT order_id, CAST(avg_review_score AS DOUBLE) AS avg_review_score FROM sra",
                             serving_ctes())
    o["dedupe_keep_last"] = q(f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id, "
                              f"order_item_id ORDER BY {g.tiebreak(g.RAW_COLUMNS['raw_order_items'], ['order_id', 'order_item_id'])}) "
                              f"AS _rn FROM raw_order_items WHERE order_id IS NOT NULL AND order_item_id IS NOT NULL) x "
                              f"WHERE _rn = 1")
    o["batch_bounds"] = incremental("SELECT batch_id, batch_size, source_min_purchase_ts, source_max_purchase_ts, "
                                    "source_min_order_id, source_max_order_id FROM log", LOG_BOUNDS)
    o["fact_orders_no_children"] = full("SELECT * FROM fact WHERE order_item_count = 0 OR "
                                        "total_payment_value IS NULL OR avg_review_score IS NULL", FACT_CTE)
    # scalar functions
    o["fn_clean_text"] = q(f"SELECT order_id, {g.clean_text('order_status')} AS status_clean, "
                           f"{g.clean_text('order_status', upper=True)} AS status_upper, "
                           f"{g.clean_text('order_status', lower=True)} AS status_lower FROM raw_orders")
    o["fn_to_datetime"] = q(f"SELECT order_id, {g.to_datetime('order_approved_at')} AS approved_at, "
                            f"{g.to_datetime('order_delivered_customer_date')} AS delivered_customer_at FROM raw_orders")
    o["fn_to_number"] = q(f"SELECT order_id, order_item_id, {g.to_number('price')} AS price, "
                          f"{g.to_number('freight_value')} AS freight_value FROM raw_order_items")
    o["fn_to_integer"] = q(f"SELECT product_id, {g.to_integer('product_description_lenght')} AS description_length, "
                           f"{g.to_integer('product_weight_g')} AS weight_g FROM raw_products")
    o["fn_delivery_days"] = full(f"SELECT order_id, {g.days_between('delivered_customer_at', 'purchased_at')} "
                                 f"AS delivery_days FROM o")
    words = "[' yes', chr(9) || 'NO' || chr(10), 'y', 'n', '1', '0', chr(12288) || 'True', 'false']"
    word = g.clean_text("word", lower=True)
    o["fn_parse_bool"] = (f"SELECT o_orderkey, word, CASE {word} WHEN '1' THEN TRUE WHEN 'true' THEN TRUE WHEN 'yes' THEN TRUE "
                          f"WHEN 'y' THEN TRUE WHEN '0' THEN FALSE WHEN 'false' THEN FALSE WHEN 'no' THEN FALSE WHEN 'n' THEN FALSE END AS flag "
                          f"FROM (SELECT o_orderkey, {words}[o_orderkey % 8 + 1] AS word FROM orders) x")
    # entities and facts
    o["clean_orders"] = full("SELECT * EXCLUDE (_rn_latest) FROM o")
    o["clean_customers"] = full(f"SELECT {typed_cols(schemas.CUSTOMERS)} FROM cus")
    o["clean_products"] = full(f"SELECT {typed_cols(schemas.PRODUCTS)} FROM prd")
    o["clean_sellers"] = full(f"SELECT {typed_cols(schemas.SELLERS)} FROM sel")
    o["clean_payments"] = full("SELECT * FROM pay")
    o["clean_reviews"] = full(f"SELECT {typed_cols(schemas.REVIEWS)} FROM rev")
    o["clean_items"] = full("SELECT * FROM it")
    o["fact_orders"] = full(f"{FACT_SELECT}\n{FACT_FROM}")
    o["fact_order_items"] = full(f"SELECT {typed_cols(schemas.ORDER_ITEMS)} FROM it")
    o["typed_store"] = full(f"SELECT {typed_cols(schemas.PAYMENTS)} FROM pay")
    o["orders_serving"] = q("SELECT * FROM serving", serving_ctes())
    o["constraint_report"] = q("""SELECT 'orders' AS table_name, constraint_name, violations FROM (
SELECT 'not_null:order_id' AS constraint_name, CAST(COUNT(*) FILTER (WHERE order_id IS NULL) AS BIGINT) AS violations FROM serving
UNION ALL SELECT 'not_null:customer_id', CAST(COUNT(*) FILTER (WHERE customer_id IS NULL) AS BIGINT) FROM serving
UNION ALL SELECT 'primary_key:order_id', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT)
          FROM (SELECT order_id, COUNT(*) AS n FROM serving GROUP BY order_id HAVING COUNT(*) > 1) d
) x WHERE violations > 0""", serving_ctes())
    preview_cols = ", ".join(schemas.FACT_ORDERS.fieldNames())
    o["preview"] = full(f"SELECT {preview_cols} FROM fact ORDER BY order_id LIMIT 5", FACT_CTE)
    o["clustered_write"] = full(f"{FACT_SELECT}\n{FACT_FROM}")
    # incremental state
    o["batch_assignment"] = incremental("SELECT order_id, order_purchase_timestamp, _batch AS batch_id FROM assigned")
    per_batch = [("raw_orders", "assigned"), ("raw_order_items", "b_items"), ("raw_payments", "b_payments"), ("raw_reviews", "b_reviews"),
                 ("raw_customers", "b_customers"), ("raw_sellers", "b_sellers"), ("raw_products", "(SELECT _batch FROM raw_products JOIN bp ON product_id = _v)"),
                 ("raw_translations", "(SELECT b._batch FROM raw_translations t JOIN (SELECT DISTINCT product_category_name AS c, _batch "
                                      "FROM raw_products JOIN bp ON product_id = _v) b ON t.product_category_name = b.c)")]
    o["batch_slices"] = incremental(" UNION ALL ".join(
        f"SELECT _batch AS batch_id, '{name}' AS table_name, COUNT(*) AS row_count FROM {cte} GROUP BY _batch" for name, cte in per_batch))
    o["dim_customer"] = incremental(last_batch("cusb", ["customer_id"], schemas.CUSTOMERS))
    o["dim_product"] = incremental(last_batch("prdb", ["product_id"], schemas.PRODUCTS))
    o["dim_seller"] = incremental(last_batch("selb", ["seller_id"], schemas.SELLERS))
    stg = {
        "stg_orders": "(SELECT * FROM ob WHERE _rn_latest = 1)",
        "stg_customers": f"({last_batch('cusb', ['customer_id'], schemas.CUSTOMERS)})",
        "stg_products": f"({last_batch('prdb', ['product_id'], schemas.PRODUCTS)})",
        "stg_sellers": f"({last_batch('selb', ['seller_id'], schemas.SELLERS)})",
        "stg_order_items": f"({last_batch('itb', ['order_id', 'order_item_id'], schemas.ORDER_ITEMS)})",
        "stg_payments": f"({last_batch('payb', ['order_id', 'payment_sequential'], schemas.PAYMENTS)})",
        "stg_reviews": f"({last_batch('revb', ['review_id', 'order_id'], schemas.REVIEWS)})",
    }
    o["staging_counts"] = incremental(counts_union([(k, v + " s") for k, v in stg.items()], "layer_table"))
    fact_cols = ", ".join(schemas.FACT_ORDERS.fieldNames())
    o["incremental_final_state"] = incremental(f"SELECT {fact_cols}, source_batch_id FROM factb", FACT_B)
    o["process_batch"] = incremental(last_batch("itb", ["order_id", "order_item_id"], schemas.ORDER_ITEMS),
                                     max_batch=1)
    o["watermark_lookup"] = incremental(
        f"SELECT * FROM (SELECT '{PIPELINE}' AS pipeline_name, {TS} AS last_order_purchase_timestamp, order_id AS last_order_id "
        f"FROM assigned ORDER BY {TS} DESC, order_id DESC NULLS FIRST LIMIT 1) UNION ALL "
        "SELECT 'never_ran', TIMESTAMP '1900-01-01 00:00:00', ''")
    o["watermark_advance"] = incremental(
        f"SELECT '{PIPELINE}' AS pipeline_name, {TS} AS last_order_purchase_timestamp, order_id AS last_order_id "
        f"FROM assigned ORDER BY {TS} DESC, order_id DESC NULLS FIRST LIMIT 1")
    o["batch_log_start"] = incremental(
        f"SELECT batch_id, '{PIPELINE}' AS pipeline_name, 'running' AS status, batch_size, source_min_purchase_ts, "
        "source_max_purchase_ts, source_min_order_id, source_max_order_id, 0 AS staging_orders_loaded, "
        "0 AS staging_items_loaded, 0 AS fact_orders_upserted, 0 AS fact_items_upserted, 'Batch started' AS message "
        "FROM log", LOG_BOUNDS, max_batch=1)
    o["batch_log_finish"] = incremental(
        f"SELECT batch_id, '{PIPELINE}' AS pipeline_name, 'completed' AS status, batch_size, source_min_purchase_ts, "
        "source_max_purchase_ts, source_min_order_id, source_max_order_id, staging_orders_loaded, "
        "staging_items_loaded, staging_orders_loaded AS fact_orders_upserted, staging_items_loaded AS fact_items_upserted, "
        "'Batch completed' AS message FROM log", LOG_BOUNDS)
    o["log_listing"] = incremental(f"SELECT {LOG_LISTING_COLS} FROM log ORDER BY batch_id", LOG_BOUNDS)
    o["log_latest"] = incremental(f"SELECT {LOG_LISTING_COLS} FROM log ORDER BY batch_id DESC LIMIT 10", LOG_BOUNDS)
    o["layer_counts"] = incremental(counts_union([
        ("raw_orders", "raw_orders"), ("raw_order_items", "raw_order_items"),
        ("stg_orders", stg["stg_orders"] + " s"), ("fact_orders", stg["stg_orders"] + " f"),
        ("fact_order_items", stg["stg_order_items"] + " i")], "layer_table"))
    o["full_refresh"] = incremental(counts_union(
        [(t, "(SELECT 1 WHERE FALSE) e") for t in [*schemas.WAREHOUSE_TABLES, "etl_watermarks"]]
        + [("etl_batch_log", "log")], "layer_table"), LOG_BOUNDS)
    cust_b = lambda b: (f"(SELECT {typed_cols(schemas.CUSTOMERS)}, CAST({b} AS BIGINT) AS source_batch_id "
                        f"FROM cusx{b})")
    two = ",\n".join([
        f"az AS (SELECT *, CAST(ceil(row_number() OVER (ORDER BY {TS}, order_id NULLS LAST) / "
        f"{BATCH_SIZE}.0) AS BIGINT) AS _batch FROM batch)",
        "a2 AS (SELECT * EXCLUDE (_batch), CASE WHEN _batch <= (SELECT ceil(max(_batch) / 2.0) FROM az) THEN 1 ELSE 2 END AS _batch FROM az)",
        *[f"cx{b} AS (SELECT * FROM raw_customers WHERE customer_id IN (SELECT customer_id FROM a2 WHERE _batch = {b}))"
          for b in (1, 2)],
        *[f"cusx{b} AS ({g.cleaned_select('customers', f'cx{b}')})" for b in (1, 2)],
        f"merged AS (SELECT n.*, customer_id IN (SELECT customer_id FROM cusx1) AS kept_audit FROM {cust_b(2)} n UNION ALL "
        f"SELECT t.*, TRUE FROM {cust_b(1)} t WHERE t.customer_id NOT IN (SELECT customer_id FROM cusx2))",
    ])
    o["upsert_update"] = q("SELECT *, FALSE AS bounded FROM merged UNION ALL "
                           "SELECT *, (SELECT COUNT(*) FROM cusx2) <= 50000 FROM merged", BATCH_ALL, two)
    o["upsert_ignore"] = q(f"SELECT * FROM {cust_b(1)} t UNION ALL SELECT * FROM {cust_b(2)} n "
                           f"WHERE n.customer_id NOT IN (SELECT customer_id FROM cusx1)", BATCH_ALL, two)
    early_src = (f"batch AS (SELECT * FROM raw_orders WHERE {ELIGIBLE} AND CAST(order_id AS BIGINT) % 7 <> 0)")
    o["late_rows_report"] = q(
        f"""SELECT a.order_id, a.customer_id, a.order_status, a.purchased_at, a.approved_at, a.delivered_carrier_at,
       a.delivered_customer_at, a.estimated_delivery_at
FROM allo a, wm
WHERE (a.purchased_at < wm.ts OR (a.purchased_at = wm.ts AND a.order_id <= wm.id))
  AND a.order_id NOT IN (SELECT order_id FROM ob)""",
        early_src, batch_ctes(),
        f"wm AS (SELECT {TS} AS ts, order_id AS id FROM assigned ORDER BY {TS} DESC, order_id DESC NULLS FIRST LIMIT 1)",
        f"allb AS (SELECT * FROM raw_orders WHERE {ELIGIBLE})",
        f"allo AS ({g.cleaned_orders('allb')})")
    o["replay_idempotent"] = incremental(
        """SELECT CAST(batch_id AS BIGINT) AS batch_id, status, CAST(batch_size AS INTEGER) AS batch_size,
       CAST(fact_rows AS BIGINT) AS fact_rows, CAST(fact_rows AS BIGINT) AS rows_as_in_a_clean_run FROM (
  SELECT CASE WHEN b._batch = 1 THEN 1 ELSE b._batch + 1 END AS batch_id, 'completed' AS status, b.n AS batch_size,
         COALESCE(f.n, 0) AS fact_rows
  FROM (SELECT _batch, COUNT(*) AS n FROM assigned GROUP BY _batch) b
  LEFT JOIN (SELECT _batch, COUNT(*) AS n FROM ob WHERE _rn_latest = 1 GROUP BY _batch) f ON f._batch = b._batch
  UNION ALL
  SELECT 2, 'failed', (SELECT COUNT(*) FROM assigned WHERE _batch = 2), 0
  WHERE EXISTS (SELECT 1 FROM assigned WHERE _batch = 2)) x""")
    return o


def oracle_sql() -> dict[str, str]:
    return _oracles()
