"""Backlog mode: the loop's final state in one distributed pass.

The loop re-scans and re-sorts the raw orders once per batch and rewrites
every target per batch. Here the whole backlog after the watermark gets its
batch numbers at once -- batch = ceil(rank / batch_size) under the
(purchase time, order id) order -- and each table's final rows are picked
with "last touching batch wins":

* order-keyed children (items, payments, reviews) reach a batch through the
  raw order id, so each raw id gets ``maxb`` = the last batch that scanned it;
* customers through the orders' raw customer id, products and sellers through
  the items, translations through the products -- each with its own ``maxb``;
* a cleaned key takes its rows from the greatest ``maxb`` among its raw rows,
  then keeps the last row as the loop would within that batch.

Everything is an aggregate or a 1:1 / semi join: no row is copied per batch.
The result equals the loop's final state whenever no run of equal
``(purchase time, order id)`` rows straddles a batch edge (the loop would
skip the rest of such a run and shift every later batch), and no batch ends
at a NULL order id (the loop fails there). :func:`run_backlog` therefore loads
up to the first such edge in one pass; after a straddled edge it re-ranks the
rest from the new watermark, and a batch that ends at a NULL id fails as in
the loop. Both are seen in one aggregate, a row per batch.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions import clean_text, strict_timestamp
from ..operators.keys import TIEBREAK, dedupe_keep_last
from ..operators.rank import global_row_number
from ..plans import entities as E
from ..plans.build import eligible_orders
from ..plans.facts import build_fact_orders, item_aggregates
from ..plans.store import typed
from ..session import checkpoint_root
from . import state
from .batches import (DEFAULT_BATCH_SIZE, MAX_BATCH_SIZE, PURCHASED, Staged, _layout, order_periods, plan_upserts, publish_planned,
                      purchase_order, with_purchase_time)
from .publish import LAYOUT_COL, month_of

BATCH = "_batch"
#: A pass over so many counted orders writes its frames and tables side by side, which is faster: together they need some 100 MB of disk.
SIDE_BY_SIDE = 200_000
#: What :func:`assign_batches` stages.
ASSIGNING = ("eligible", "ranked")


def assign_batches(raw_orders: DataFrame, batch_size: int, after_ts: str = "1900-01-01 00:00:00",
                   after_id: str = "", first_batch_id: int = 1, staged: Staged | None = None) -> DataFrame:
    """Eligible raw orders with ``_batch`` = the batch id the loop would give them.

    With ``staged`` the rows in between are written there (``ASSIGNING``) and may be dropped when the result is written.
    """
    eligible = with_purchase_time(eligible_orders(raw_orders, after_ts, after_id))
    # A scan-stable row id splits runs of identical copies across range
    # partitions (a run may hold a large share of all rows); it is computed
    # on the scan's input splits. The rows are written first: the range partitioning samples them, then moves them.
    order = [*purchase_order(raw_orders), F.col("_row_uid").asc()]
    eligible = (staged or Staged(raw_orders.sparkSession)).keep("eligible", eligible.withColumn("_row_uid", F.monotonically_increasing_id()))
    kept = {"keep": lambda df: staged.keep("ranked", df)} if staged else {}
    ranked = global_row_number(eligible, order, out="_rank", **kept).drop("_row_uid", PURCHASED)
    return ranked.withColumn(
        BATCH, (F.ceil(F.col("_rank") / F.lit(batch_size)) + F.lit(first_batch_id - 1)).cast("long"))


def _order_key():
    """(purchase time, order id) in batch order, NULL ids last."""
    return F.struct(strict_timestamp("order_purchase_timestamp").alias("ts"),
                    F.col("order_id").isNull().alias("id_null"), F.col("order_id").alias("id"))


def batch_edges(assigned: DataFrame) -> DataFrame:
    """Per batch: ``n`` rows, first key ``lo`` and last key ``hi``."""
    return assigned.groupBy(BATCH).agg(F.count(F.lit(1)).alias("n"), F.min(_order_key()).alias("lo"), F.max(_order_key()).alias("hi"))


def first_bad_edges(edges: DataFrame) -> tuple[int | None, int | None]:
    """The first batch after which the loop would skip rows, and the first that ends at a NULL id.

    The loop goes on strictly after a batch's last key: it skips further rows with that key, and rows of
    that time without an id. Keys are compared as parsed, so two spellings of one time are one run. A row
    per batch is read.
    """
    after = edges.select((F.col(BATCH) - 1).alias(BATCH), F.col("lo").alias("next"))
    row = edges.join(after, BATCH, "left").agg(
        F.min(F.when((F.col("hi.ts") == F.col("next.ts")) & (F.col("next.id_null") | (F.col("hi.id") == F.col("next.id"))),
                     F.col(BATCH))).alias("straddled"),
        F.min(F.when(F.col("hi.id_null"), F.col(BATCH))).alias("null_id")).first()
    return row.straddled, row.null_id


def _last_batch_by(rows: DataFrame, key_col: str, batch_col: str = BATCH) -> DataFrame:
    """``key -> _maxb``: the last batch in which a raw key value was seen."""
    return rows.where(F.col(key_col).isNotNull()).groupBy(key_col).agg(F.max(batch_col).alias("_maxb"))


def _tagged(rows: DataFrame, maxb: DataFrame, row_col: str) -> DataFrame:
    """Raw rows with the last batch that fetched them; rows never fetched drop out (1:1 join)."""
    m = maxb.select(F.col(maxb.columns[0]).alias("_key"), *maxb.columns[1:])
    return rows.join(m, rows[row_col] == m["_key"], "inner").drop("_key")


def _last_touch(cleaner, tagged_rows: DataFrame) -> DataFrame:
    """Clean rows tagged with ``_maxb``; per cleaned key keep the last batch's last row."""
    b = F.col("_maxb")
    return cleaner(tagged_rows, b, lead=[b])


RAW_ID = "_raw_id"


def _last_by_spelling(cleaner, keys: list[str], tagged_rows: DataFrame) -> DataFrame:
    """Clean children of orders, the last row of each key and raw order id.

    What decides between rows of one raw id is the same for staging and fact: all were fetched by the same batches. Only orders in
    several spellings need a further pick (:func:`_last_of_spellings`), for which their rows keep the tie-break.
    """
    rows = cleaner(tagged_rows.withColumn(RAW_ID, F.col("order_id")), F.col("_maxb"), carry=[RAW_ID, "_month", "_in_final", "_several"],
                   keep_tiebreak=True)
    last = dedupe_keep_last(rows, [*keys, RAW_ID], drop=False)
    return last.withColumn(TIEBREAK, F.when(F.col("_several"), F.col(TIEBREAK)))


def _last_of_spellings(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """One row per key of :func:`_last_by_spelling`'s rows: of orders that come in several spellings the greatest by ``order``."""
    several = rows.where("_several").withColumn(TIEBREAK, order)
    return rows.where(~F.col("_several")).drop(TIEBREAK).unionByName(dedupe_keep_last(several, keys))


CHILD_KEYS = {"items": ["order_id", "order_item_id"], "payments": ["order_id", "payment_sequential"], "reviews": ["review_id", "order_id"]}


#: Per staged frame that :func:`backlog_state` leaves, the tables made of it.
STAGED_FOR = {"fact_orders": ["fact_orders"], "orders": ["stg_orders"], "payments": ["stg_payments"], "reviews": ["stg_reviews"],
              "pairs": [schemas.LOCATOR], "items": ["fact_order_items", "stg_order_items"]}


@dataclass
class BacklogState:
    tables: dict[str, DataFrame]   # final new rows per warehouse table (typed, with source_batch_id)
    log_rows: DataFrame            # one completed log row per batch
    pairs: DataFrame               # (order_id, period) of all order-grain rows


def backlog_state(raw: dict[str, DataFrame], assigned: DataFrame, edges: DataFrame, staged: Staged,
                  pipeline: str = state.PIPELINE_NAME, started: dt.datetime | None = None) -> BacklogState:
    """Final rows of all tables after the assigned batches, and their log rows.

    Every frame that is used again is written to ``staged``: rows are cleaned once for staging and fact, and what range
    partitioning samples is a file. It is dropped behind its last reader; ``STAGED_FOR`` are left for the tables.
    """
    batch_col = F.col(BATCH)
    cust_maxb = _last_batch_by(assigned, "customer_id")

    # Orders: every cleaned row carries its batch; the latest batch, then the latest row, wins.
    orders_all = E.clean_orders(assigned, batch_col, keep_tiebreak=True)
    orders_last = dedupe_keep_last(
        orders_all.withColumn(TIEBREAK, F.struct(F.col("source_batch_id"), F.col(TIEBREAK))), ["order_id"])
    # Each raw order id once per batch that scanned it; ``_several``: its cleaned id comes in several raw spellings.
    spellings = Window.partitionBy("_k")
    scanned_once = (assigned.where(F.col("order_id").isNotNull()).groupBy("order_id", batch_col.alias("_b"))
                    .agg(F.max(strict_timestamp("order_purchase_timestamp")).alias("_ts"))
                    .withColumn("_k", clean_text("order_id"))
                    .withColumn("_several", F.min("order_id").over(spellings) != F.max("order_id").over(spellings)))
    first = staged.keep_all({"orders": orders_last, "scanned": scanned_once,
                             "customers": _last_touch(E.clean_customers, _tagged(raw["raw_customers"], cust_maxb, "customer_id"))})
    orders_final, scanned, cust_final = first["orders"], first["scanned"], first["customers"]

    # At order grain: per raw order id the last batch that scanned it, the layout month of its children, and
    # whether the final batch of its cleaned order is among the batches that scanned it.
    final_batch = orders_final.select(F.col("order_id").alias("_k"), F.col("source_batch_id").alias("_fb"))
    order_maxb = staged.keep("order_maxb", scanned.join(final_batch, "_k", "left").groupBy("order_id")
                             .agg(F.max("_b").alias("_maxb"), month_of(F.max("_ts")).alias("_month"), F.max("_several").alias("_several"),
                                  F.coalesce(F.max(F.col("_b") == F.col("_fb")), F.lit(False)).alias("_in_final")))

    # Children: reached through raw order ids, last touching batch wins. Items also say which products and sellers are reached.
    # Items come first, and their measures in the fact (each cleaned order's children are those that its final batch fetched):
    # what they shuffle is the most, and little else is staged then.
    items_t = _tagged(raw["raw_order_items"], order_maxb, "order_id")
    children = {"items": staged.keep("items", _last_by_spelling(E.clean_items, CHILD_KEYS["items"], items_t))}

    def fetched(child: str) -> DataFrame:
        return _last_of_spellings(children[child].where("_in_final"), CHILD_KEYS[child], F.col(TIEBREAK))

    measures = staged.keep("item_measures", item_aggregates(fetched("items")))
    children |= staged.keep_all({
        "payments": _last_by_spelling(E.clean_payments, CHILD_KEYS["payments"], _tagged(raw["raw_payments"], order_maxb, "order_id")),
        "reviews": _last_by_spelling(E.clean_reviews, CHILD_KEYS["reviews"], _tagged(raw["raw_reviews"], order_maxb, "order_id")),
        "named": items_t.select("product_id", "seller_id", "_maxb"),
        "pairs": order_periods(orders_final, order_maxb),
    })
    latest = F.struct(F.col("source_batch_id"), F.col(TIEBREAK))
    log_rows = staged.keep("log", batch_log_rows(edges, scanned, orders_all, children["items"], pipeline, started))
    staged.drop("assigned", "scanned", "order_maxb")
    items_final, pay_final, rev_final = (_last_of_spellings(children[c], keys, latest) for c, keys in CHILD_KEYS.items())
    # Products and sellers: the last batch among fetched items that name them.
    prod_maxb, sell_maxb = _last_batch_by(children["named"], "product_id", "_maxb"), _last_batch_by(children["named"], "seller_id", "_maxb")
    late = staged.keep_all({
        "fact_orders": build_fact_orders(orders_final, measures, fetched("payments"), fetched("reviews"), measured=True),
        "products": _last_touch(lambda df, b, lead: E.clean_products(df, raw["raw_translations"], b, lead=lead),
                                _tagged(raw["raw_products"], prod_maxb, "product_id")),
        "sellers": _last_touch(E.clean_sellers, _tagged(raw["raw_sellers"], sell_maxb, "seller_id")),
    })
    prod_final, sell_final = late["products"], late["sellers"]
    staged.drop("named", "item_measures")

    items_typed = _layout(items_final, schemas.ORDER_ITEMS, F.col("_month"))
    tables = {
        "stg_orders": _layout(orders_final, schemas.STG_ORDERS, month_of(F.col("purchased_at"))),
        "stg_customers": typed(cust_final, schemas.CUSTOMERS),
        "stg_products": typed(prod_final, schemas.PRODUCTS),
        "stg_sellers": typed(sell_final, schemas.SELLERS),
        "stg_order_items": items_typed,
        "stg_payments": _layout(pay_final, schemas.PAYMENTS, F.col("_month")),
        "stg_reviews": _layout(rev_final, schemas.REVIEWS, F.col("_month")),
        "dim_customer": typed(cust_final, schemas.CUSTOMERS),
        "dim_product": typed(prod_final, schemas.PRODUCTS),
        "dim_seller": typed(sell_final, schemas.SELLERS),
        "fact_order_items": items_typed,
        "fact_orders": late["fact_orders"].withColumn(LAYOUT_COL, month_of(F.col("purchased_at"))),
    }
    return BacklogState(tables, log_rows, children["pairs"])


def items_per_batch(scanned: DataFrame, items: DataFrame) -> DataFrame:
    """(batch, n_items): distinct cleaned item keys among the items that each batch fetched.

    ``items`` has every cleaned key once per raw order id. Items are counted once per raw id; batches meet the counts at order
    grain. Only orders that come in several raw spellings, whose items one batch may fetch twice, are expanded to item keys.
    """
    ids = scanned.select(F.col("order_id").alias(RAW_ID), F.col("_b").alias(BATCH), "_several")
    once = (ids.where(~F.col("_several")).join(items.where(~F.col("_several")).groupBy(RAW_ID).agg(F.count(F.lit(1)).alias("n")), RAW_ID)
            .select(BATCH, "n"))
    many = (ids.where("_several").select(RAW_ID, BATCH).join(items.where("_several").select(RAW_ID, *CHILD_KEYS["items"]), RAW_ID)
            .select(BATCH, *CHILD_KEYS["items"]).distinct().groupBy(BATCH).agg(F.count(F.lit(1)).alias("n")))
    return once.unionByName(many).groupBy(BATCH).agg(F.sum("n").alias("n_items"))


def batch_log_rows(edges: DataFrame, scanned: DataFrame, orders_all: DataFrame, items: DataFrame,
                   pipeline: str = state.PIPELINE_NAME, started: dt.datetime | None = None) -> DataFrame:
    """One ``completed`` log row per batch with its bounds and the four counters.

    ``items`` are the items whose order id was scanned by some batch, each key once per raw id; ``started`` is when the pass began.
    """
    n_orders = orders_all.groupBy(F.col("source_batch_id").alias(BATCH)).agg(F.count(F.lit(1)).alias("n_orders"))
    now = state.now_ntz()
    rows = edges.join(n_orders, BATCH, "left").join(items_per_batch(scanned, items), BATCH, "left")
    return rows.select(
        F.col(BATCH).alias("batch_id"), F.lit(pipeline).alias("pipeline_name"),
        F.lit("completed").alias("status"),
        (F.lit(started).cast("timestamp_ntz") if started else now).alias("started_at"), now.alias("finished_at"),
        F.col("n").cast("int").alias("batch_size"),
        F.col("lo.ts").alias("source_min_purchase_ts"), F.col("hi.ts").alias("source_max_purchase_ts"),
        F.col("lo.id").alias("source_min_order_id"), F.col("hi.id").alias("source_max_order_id"),
        F.coalesce("n_orders", F.lit(0)).cast("int").alias("staging_orders_loaded"),
        F.coalesce("n_items", F.lit(0)).cast("int").alias("staging_items_loaded"),
        F.coalesce("n_orders", F.lit(0)).cast("int").alias("fact_orders_upserted"),
        F.coalesce("n_items", F.lit(0)).cast("int").alias("fact_items_upserted"),
        F.lit("Batch completed").alias("message"),
    )


def run_backlog(spark: SparkSession, raw: dict[str, DataFrame], store, batch_size: int = DEFAULT_BATCH_SIZE,
                refresh: bool = False, max_batches: int = 0, pipeline: str = state.PIPELINE_NAME,
                max_batch_size: int = MAX_BATCH_SIZE) -> int:
    """Load everything after the watermark, one publish per pass. Returns the number of batches.

    ``max_batches`` limits the load to that many batches (0 = all; negative = one).
    When a run of equal (ts, id) rows straddles a batch edge, the pass stops at
    that batch; the next pass re-ranks from the new watermark, which skips the
    rest of the run exactly as the loop does. A batch that ends at a NULL id is
    logged as failed after everything before it was loaded, and raises.
    """
    from .pipeline import full_refresh, validate_batch_size

    validate_batch_size(batch_size, max_batch_size)
    checkpoint_root(spark)
    if refresh:
        full_refresh(store, pipeline)
    limit = 1 if max_batches < 0 else max_batches
    done = 0
    while True:
        wm_ts, wm_id = state.get_watermark(store.read("etl_watermarks"), pipeline)
        first_id = state.next_batch_id(store.read("etl_batch_log"))
        ts_text = wm_ts.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(wm_ts, dt.datetime) else str(wm_ts)
        with Staged(spark, spare=True) as staged:  # nothing of a pass is read behind it
            assigned = assign_batches(raw["raw_orders"], batch_size, ts_text, wm_id, first_id, staged)
            if limit:
                assigned = assigned.where(F.col(BATCH) < F.lit(first_id + limit - done))
            assigned = staged.keep("assigned", assigned)
            staged.drop(*ASSIGNING)
            staged.spare = staged.rows["assigned"] > SIDE_BY_SIDE
            edges = batch_edges(assigned).checkpoint()  # a row per batch
            straddled, null_id = first_bad_edges(edges)
            last = edges.agg(F.max(BATCH)).first()[0]
            if last is None:
                return done
            if straddled is not None:
                last = min(last, straddled)
            failing = null_id is not None and null_id <= last
            if failing:
                last = null_id - 1
            if last >= first_id:
                upto = F.col(BATCH) <= F.lit(last)
                _load_pass(spark, raw, store, assigned.where(upto), edges.where(upto), staged, first_id, pipeline)
                done += last - first_id + 1
            if failing:
                _open(spark, store, edges, null_id, pipeline)
                _fail(store, null_id, NULL_ID)
                raise ValueError(NULL_ID)
            if straddled is None or (limit and done >= limit):
                return done


NULL_ID = "null value in column last_order_id violates not-null constraint"


def _open(spark: SparkSession, store, edges: DataFrame, batch_id: int, pipeline: str) -> None:
    """Publish the ``running`` row of a batch, as the loop does before it works on one."""
    bounds = edges.where(F.col(BATCH) == batch_id).select(
        F.col("n").cast("int").alias("batch_size"), F.col("lo.ts").alias("source_min_purchase_ts"), F.col("hi.ts").alias("source_max_purchase_ts"),
        F.col("lo.id").alias("source_min_order_id"), F.col("hi.id").alias("source_max_order_id"))
    log = store.read("etl_batch_log")
    store.publish({"etl_batch_log": state.log_started(spark, log, batch_id, bounds, pipeline)})


def _fail(store, batch_id: int, error: str) -> None:
    store.publish({"etl_batch_log": state.log_finished(store.read("etl_batch_log"), batch_id, error=error)})


def _releases(staged: Staged) -> dict[str, Callable[[], None]]:
    """Per table, what to do when it is written: staged frames go with the last table made of them."""
    def release(frame: str, tables: list[str], table: str) -> None:
        tables.remove(table)
        if not tables:
            staged.drop(frame)

    return {table: partial(release, frame, left, table) for frame, left in ((f, list(tables)) for f, tables in STAGED_FOR.items()) for table in left}


def _load_pass(spark: SparkSession, raw: dict[str, DataFrame], store, assigned: DataFrame, edges: DataFrame,
               staged: Staged, first_id: int, pipeline: str) -> None:
    """Publish the final state of the assigned batches (one manifest swap).

    Unless orders are few, the tables of order grain are written one after another, the largest last, when the frames of the others are gone.
    The first batch's log row is ``running`` meanwhile, and ``failed`` if the pass fails: nothing of it was published.
    """
    from .pipeline import CLUSTER_KEYS

    _open(spark, store, edges, first_id, pipeline)
    log = store.read("etl_batch_log")
    started = log.where(F.col("batch_id") == first_id).first().started_at
    try:
        result = backlog_state(raw, assigned, edges, staged, pipeline, started)
        planned, release = plan_upserts(store, result.tables, result.pairs), _releases(staged) if staged.spare else {}
        planned = {t: replace(planned[t], release=release.get(t)) for t in [*release, *(t for t in planned if t not in release)]}
        hi = edges.agg(F.max("hi").alias("hi")).first().hi
        extra = {
            "etl_watermarks": state.advance_watermark(spark, store.read("etl_watermarks"), hi.ts, hi.id, pipeline),
            "etl_batch_log": log.where(F.col("batch_id") != first_id).unionByName(result.log_rows),
        }
        publish_planned(store, planned, extra, sort_by=CLUSTER_KEYS)
    except Exception as exc:
        _fail(store, first_id, str(exc))
        raise
