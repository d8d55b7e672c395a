"""Versioned tables with an atomic multi-table publish.

Layout under ``root`` (a folder on the shared file system):

    <root>/<table>/v=<n>-<attempt>/part-*.parquet                    whole-table version
    <root>/<table>/layout_period=<p>/v=<n>-<attempt>/part-*.parquet  one period of a partitioned table
    <root>/_manifest/version=<k>/attempt=<a>/part-*                  (table_name, part, path) rows

Order-grain tables (orders, their items, payments and reviews) are split by
purchase period (month by default, see ``LAYOUT_FORMAT_CONF``). A batch
advances in purchase time, so it touches only the newest periods (plus any
period still holding an older row of a key it rewrites); only those fragments
are rewritten, every other period keeps its pointer. Which periods hold rows of an
order is kept in one narrow table, ``order_locator``, split the same way. Dimensions and other
small tables are rewritten whole.

Row counts and the periods that hold rows are observed by the writing jobs themselves.

A publish writes every changed table or fragment into fresh directories, then
appends manifest version ``k+1`` listing the fragments of *every* table.
Readers use the newest manifest version only, so a crash before the manifest
write leaves the previous state fully visible: data, watermark and batch log
change together or not at all. Every publish attempt writes under its own
attempt token, so files left by a failed attempt are never picked up by a
retry (they stay unreferenced). One writer at a time is assumed (as in the
source system's one concurrent run).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import chain

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..plans.store import not_null, refuse_found, repeated_keys
from ..session import drop_unused_shuffles
from ..sources.ingest import committed

LAYOUT_COL = "layout_period"
#: Compression of stored tables and staged frames: a third smaller than Spark's default.
STORED_AS = "zstd"
WHOLE = ""  # ``part`` value of an unpartitioned table's single fragment
ORDER_GRAIN = {"stg_orders", "fact_orders", "stg_order_items", "fact_order_items", "stg_payments", "stg_reviews"}
PARTITIONED = ORDER_GRAIN | {schemas.LOCATOR}

MANIFEST_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("part", T.StringType(), False),
    T.StructField("path", T.StringType(), False),
])


# Session setting for the rewrite grain of order-grain tables. ``yyyy-MM``
# (default) suits small and medium volumes; at tens of TB use ``yyyy-MM-dd`` so
# a bounded batch rewrites a day, not a month. Changing it needs a full refresh.
LAYOUT_FORMAT_CONF = "spark.ledgerline.layoutFormat"
DEFAULT_LAYOUT_FORMAT = "yyyy-MM"


#: The manifest row that says which layout format the fragments were written with.
LAYOUT_ROW = "_layout_format"


def layout_format(spark: SparkSession | None = None) -> str:
    """The session's rewrite grain; ``spark`` defaults to the active session and there must be one."""
    return (spark or SparkSession.active()).conf.get(LAYOUT_FORMAT_CONF, DEFAULT_LAYOUT_FORMAT)


def month_of(ts_col) -> F.Column:
    """Layout period of a purchase timestamp (``yyyy-MM`` unless configured)."""
    return F.date_format(ts_col, layout_format())


class Warehouse:
    """Tables of the warehouse, resolved through the newest manifest."""

    def __init__(self, spark: SparkSession, root: str, write_parallelism: int = 8):
        self.spark = spark
        self.root = root.rstrip("/")
        self.write_parallelism = write_parallelism
        self._frags: dict[str, dict[str, str]] | None = None
        self._version: int | None = None
        self._layout: str | None = None
        #: Rows per table that the latest publish wrote, as its jobs counted them (of a partitioned table: of its touched periods).
        self.written_rows: dict[str, int] = {}

    # -- manifest ------------------------------------------------------------
    def _load_manifest(self) -> None:
        m = committed(self.spark, f"{self.root}/_manifest")
        if m is None:
            self._frags, self._version = {}, 0
            return
        latest = m.agg(F.max("version")).first()[0]
        top = m.where(F.col("version") == latest)
        # One committed attempt per version (single writer); pick deterministically anyway.
        attempt = top.agg(F.min(F.col("attempt").cast("string"))).first()[0]
        rows = (top.where(F.col("attempt").cast("string") == F.lit(attempt))
                .select("table_name", "part", "path").collect())  # pointers only
        frags: dict[str, dict[str, str]] = {}
        for r in rows:
            if r.table_name == LAYOUT_ROW:
                self._layout = r.path
                continue
            frags.setdefault(r.table_name, {})
            if r.path:
                frags[r.table_name][r.part] = r.path
        self._frags, self._version = frags, int(latest)

    def fragments(self, table: str) -> dict[str, str]:
        if self._frags is None:
            self._load_manifest()
        return dict(self._frags.get(table, {}))

    @property
    def version(self) -> int:
        if self._version is None:
            self._load_manifest()
        return int(self._version)

    def schema_of(self, table: str) -> T.StructType:
        return schemas.ALL_TABLES[table][0]

    # -- reading -------------------------------------------------------------
    def read(self, table: str, parts: Iterable[str] | None = None, layout: bool = False) -> DataFrame:
        """The table's current rows; ``parts`` restricts a partitioned table to those months.

        ``layout=True`` keeps the ``layout_period`` column (partitioned tables only).
        """
        frags = self.fragments(table)
        if parts is not None:
            wanted = set(parts)
            frags = {p: path for p, path in frags.items() if p in wanted}
        return self._read_fragments(table, frags, layout)

    def _read_fragments(self, table: str, frags: dict[str, str], layout: bool = False) -> DataFrame:
        schema = self.schema_of(table)
        keep_layout = layout and table in PARTITIONED
        if not frags:
            extra = [T.StructField(LAYOUT_COL, T.StringType())] if keep_layout else []
            return self.spark.createDataFrame([], T.StructType(list(schema.fields) + extra))
        if table not in PARTITIONED:
            return self.spark.read.schema(schema).parquet(frags[WHOLE])
        full = T.StructType(list(schema.fields) + [T.StructField(LAYOUT_COL, T.StringType()),
                                                   T.StructField("v", T.StringType())])
        # Fragments may live under more than one table directory (a store cloned from
        # another keeps pointing at its files): one read per base directory.
        by_base: dict[str, list[str]] = {}
        for path in frags.values():
            by_base.setdefault(path.split(f"/{LAYOUT_COL}=")[0], []).append(path)
        cols = schema.fieldNames() + ([LAYOUT_COL] if keep_layout else [])
        parts_read = [self.spark.read.option("basePath", base).schema(full).parquet(*sorted(paths)).select(*cols)
                      for base, paths in sorted(by_base.items())]
        df = parts_read[0]
        for other in parts_read[1:]:
            df = df.unionByName(other)
        return df

    # -- writing -------------------------------------------------------------
    def publish(self, changes: dict[str, DataFrame | None], touched: dict[str, set[str]] | None = None,
                sort_by: dict[str, list[str]] | None = None, release: dict[str, Callable[[], None]] | None = None) -> int:
        """Write changed tables, then swap the manifest once. Returns the new version.

        ``changes[t]`` is the new content of table ``t`` (``None`` = empty). A
        partitioned table's frame carries ``layout_period``; with ``touched[t]`` it replaces only
        those periods (other periods keep their fragments), otherwise the whole
        table. The periods that then hold rows are observed while they are written.
        Tables are written side by side, those with a ``release`` one after another in the order of ``changes``: they are so large
        that the shuffle files of several are too much. ``release[t]`` is called when ``t`` is written and checked.
        """
        touched, release = touched or {}, release or {}
        version = self.version + 1
        layout = layout_format(self.spark)
        if self._layout not in (None, layout) and any(self.fragments(t) for t in PARTITIONED if changes.get(t, ()) is not None):
            raise ValueError(f"the tables are laid out by {self._layout}, the session asks for {layout}: refresh fully to change it")
        attempt = uuid.uuid4().hex[:12]
        frags = {t: self.fragments(t) for t in schemas.ALL_TABLES}

        def write(item: tuple[str, DataFrame | None]) -> tuple[str, dict[str, str], set[str] | None, int, list[Row]]:
            """Written fragments, the periods they replace, rows, and what they violate."""
            table, df = item
            schema = self.schema_of(table)
            part = table in PARTITIONED
            if df is None:
                return table, {}, None, 0, []
            cols = [not_null(f, table) for f in schema.fields]
            out = df.select(*cols, *([F.col(LAYOUT_COL).cast("string")] if part else []))
            keys = (sort_by or {}).get(table)
            if keys:
                # Clustered layout: range partitions + sorted files give tight
                # per-file min/max statistics on the ordering columns.
                out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
            tag, seen = f"{version:08d}-{attempt}", Observation(f"{table}-{attempt}")
            counted = out.observe(seen, F.count(F.lit(1)).alias("rows"), *([F.collect_set(LAYOUT_COL).alias("periods")] if part else []))
            if not part:
                path = f"{self.root}/{table}/v={tag}"
                counted.write.mode("errorifexists").option("compression", STORED_AS).parquet(path)
                return table, {WHOLE: path}, None, seen.get["rows"], self._repeated_keys(table, {WHOLE: path})
            counted.withColumn("v", F.lit(tag)).write.partitionBy(LAYOUT_COL, "v").mode("append") \
                .option("compression", STORED_AS).parquet(f"{self.root}/{table}")
            if table in release:
                drop_unused_shuffles(self.spark)
            written = {m: f"{self.root}/{table}/{LAYOUT_COL}={m}/v={tag}" for m in seen.get["periods"]}
            return table, written, touched.get(table), seen.get["rows"], self._repeated_keys(table, written)

        def write_and_release(item: tuple[str, DataFrame | None]) -> tuple[str, dict[str, str], set[str] | None, int, list[Row]]:
            result = write(item)
            release[item[0]]()
            drop_unused_shuffles(self.spark)
            return result

        # Independent tables are written, and their keys checked, by concurrent Spark jobs; the manifest
        # swap below happens only after every write has succeeded.
        found: list[Row] = []
        counts: dict[str, int] = {}
        with ThreadPoolExecutor(max_workers=max(1, self.write_parallelism)) as pool:
            beside = pool.map(write, [x for x in changes.items() if x[0] not in release])
            in_turn = (write_and_release(x) for x in changes.items() if x[0] in release)
            for table, written, replaced, counts[table], violations in chain(in_turn, beside):
                found += violations
                if replaced is None:
                    frags[table] = written
                else:
                    kept = {m: p for m, p in frags[table].items() if m not in replaced}
                    frags[table] = {**kept, **written}
        refuse_found(sorted(found, key=lambda r: r.table_name), "this version")
        rows = [(t, part, path) for t in sorted(frags) for part, path in sorted(frags[t].items())]
        rows += [(t, WHOLE, "") for t in sorted(frags) if not frags[t]]  # keep empty tables listed
        rows.append((LAYOUT_ROW, WHOLE, layout))
        self._write_manifest(rows, version, attempt)
        self._frags, self._version, self._layout, self.written_rows = frags, version, layout, counts
        return version

    def _repeated_keys(self, table: str, written: dict[str, str]) -> list[Row]:
        """Before the swap: no key may repeat in what was just written. Reads key columns only."""
        keys = schemas.ALL_TABLES[table][1]
        return repeated_keys(self._read_fragments(table, written).select(*keys), table, keys).collect() if written else []

    def _write_manifest(self, rows: list[tuple[str, str, str]], version: int, attempt: str) -> None:
        """The pointer swap: one small file, visible only once its job commits."""
        manifest = self.spark.createDataFrame(rows, MANIFEST_SCHEMA)
        manifest.coalesce(1).write.mode("errorifexists").parquet(
            f"{self.root}/_manifest/version={version}/attempt={attempt}")
