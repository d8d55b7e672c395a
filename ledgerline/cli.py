"""Command line for the three jobs (submit with ``spark-submit -m``-style ``python -m ledgerline.cli``).

    ingest  --csv-dir DIR --bronze DIR [--splittable] CSV files -> all-text bronze tables
    load    --bronze DIR --warehouse DIR [--batch-size N] [--max-batch-size N] [--max-batches N]
            [--full-refresh WORD] [--backlog]
    serve   --bronze DIR --warehouse DIR             rebuild and publish the ``orders`` table

Bronze tables are Parquet tables named ``raw_<table>`` (``ingest`` writes them
from ``<table>.csv`` files as one load: all tables or none become current). The session comes from the submit
environment; ``spark.checkpoint.dir`` should name a shared folder.
"""

from __future__ import annotations

import argparse
import logging
import sys

from .functions import boolean_option
from .plans.operational import layer_counts
from .plans.publishing import publish_orders_serving
from .session import build_session
from .sources import ingest
from .streaming.backlog import run_backlog
from .streaming.batches import DEFAULT_BATCH_SIZE, MAX_BATCH_SIZE
from .streaming.pipeline import run_pipeline
from .streaming.publish import Warehouse

log = logging.getLogger(__name__)

RAW_NAMES = ("raw_orders", "raw_customers", "raw_products", "raw_translations", "raw_sellers",
             "raw_order_items", "raw_payments", "raw_reviews")


def read_bronze(spark, bronze: str) -> dict:
    """The eight raw tables of the newest committed bronze load."""
    tables = ingest.read_bronze(spark, bronze)
    missing = [n for n in RAW_NAMES if n not in tables]
    if missing:
        raise FileNotFoundError(f"bronze load lacks {missing}")
    return {n: tables[n] for n in RAW_NAMES}


def _jobs() -> argparse.ArgumentParser:
    places = {flag: argparse.ArgumentParser(add_help=False) for flag in ("csv-dir", "bronze", "warehouse")}
    for flag, holder in places.items():
        holder.add_argument(f"--{flag}", required=True, metavar="DIR")
    top = argparse.ArgumentParser(prog="ledgerline", description=__doc__.splitlines()[0])
    jobs = top.add_subparsers(dest="job", required=True, metavar="JOB")

    ingest = jobs.add_parser("ingest", parents=[places["csv-dir"], places["bronze"]])
    ingest.add_argument("--splittable", action="store_true", help="no quoted line breaks: read each file by many tasks")

    jobs.add_parser("serve", parents=[places["bronze"], places["warehouse"]])

    load = jobs.add_parser("load", parents=[places["bronze"], places["warehouse"]])
    load.add_argument("--batch-size", type=int, default=DEFAULT_BATCH_SIZE, metavar="N")
    load.add_argument("--max-batch-size", type=int, default=MAX_BATCH_SIZE, metavar="N", help="largest batch size allowed")
    load.add_argument("--max-batches", type=int, default=0, metavar="N", help="0: until the source is drained")
    load.add_argument("--full-refresh", type=boolean_option, nargs="?", const=True, default=False, metavar="WORD",
                      help="empty the warehouse first")
    load.add_argument("--backlog", action="store_true", help="everything after the watermark in one pass")
    return top


def _ingest(spark, options) -> None:
    tables = ingest.load_csv_directory(spark, options.csv_dir, multi_line=not options.splittable)
    token = ingest.land_bronze(spark, {f"raw_{name}": df for name, df in tables.items()}, options.bronze)
    landed = layer_counts(ingest.read_bronze(spark, options.bronze))
    for row in landed.orderBy("layer_table").collect():
        log.info("%s: %d rows in load %s", row.layer_table, row.row_count, token)


def _serve(spark, options) -> None:
    store = Warehouse(spark, options.warehouse)
    publish_orders_serving(store, read_bronze(spark, options.bronze))
    log.info("orders: version %d, %d rows", store.version, store.read("orders").count())


def _load(spark, options) -> None:
    run = run_backlog if options.backlog else run_pipeline
    batches = run(spark, read_bronze(spark, options.bronze), Warehouse(spark, options.warehouse), batch_size=options.batch_size,
                  max_batches=options.max_batches, refresh=options.full_refresh, max_batch_size=options.max_batch_size)
    log.info("loaded %d batches", batches)


def main(argv: list[str] | None = None) -> int:
    options = _jobs().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="[%(levelname)s] %(name)s: %(message)s")
    spark = build_session(app_name=f"ledgerline-{options.job}")
    {"ingest": _ingest, "serve": _serve, "load": _load}[options.job](spark, options)
    return 0


if __name__ == "__main__":
    sys.exit(main())
