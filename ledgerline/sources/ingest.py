"""CSV directory -> all-text bronze tables.

Each ``*.csv`` directly under the directory is one table named after its stem
(a ``name.csv/`` directory of part files counts as one table too). Every cell
is read as text -- no type inference -- and missing-value tokens become NULL.
``_ordinal`` records a row's place in its table: file path, block, row.

With ``multi_line`` (the default) quoted cells may hold line breaks. Where none does, files of more than one input split are
read line by line, as Spark splits them; else in parallel by quote parity (:func:`split_records`), smaller ones by one task. Without it
lines are rows. A row with fewer cells than the header ends in NULLs, one with more fails the load.
"""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import to_datetime
from ..functions.misc import null_na_tokens
from ..operators.keys import ORDINAL
from ..session import scratch_path

CSV_PARSE = {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_READ = {"header": "true", "encoding": "UTF-8", "inferSchema": "false", **CSV_PARSE}
CSV_WRITE = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def _listed(spark: SparkSession, pattern: str) -> DataFrame | None:
    """The files at a path or glob; None if there is no such path."""
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(pattern).select("path")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def list_csv_tables(spark: SparkSession, directory: str) -> dict[str, str]:
    """``stem -> path`` for every CSV table directly under ``directory``, sorted by name.

    Listing uses the ``binaryFile`` source with only ``path`` selected, so no
    file content is read; part files are reduced to their table before anything
    reaches the driver. The directory may be named in any way (``.``, ``dir/.``); only what lies
    directly in it counts, whatever folders below it are called.
    """
    root = re.sub(r"([\[\]{}*?\\])", r"\\\1", directory.rstrip("/") or "/")
    if _listed(spark, root) is None:
        raise FileNotFoundError(f"{directory}: no such directory")
    found, parts = _listed(spark, f"{root}/*.csv"), _listed(spark, f"{root}/*.csv/*.csv")
    folders = None if parts is None else parts.select(F.regexp_replace("path", "/[^/]*$", "").alias("path")).distinct()
    if found is not None and parts is not None:  # a folder's part files match the shorter pattern as well
        found = found.join(folders.select(F.col("path").alias("folder")), F.regexp_replace("path", "/[^/]*$", "") == F.col("folder"), "left_anti")
    tables = [t for t in (found, folders) if t is not None]
    paths = sorted(r.path for t in tables for r in t.where(F.col("path").endswith(".csv")).collect())  # one per table
    stems = [p.rsplit("/", 1)[1][:-len(".csv")] for p in paths]
    if not stems:
        raise FileNotFoundError(f"no CSV table in {directory}")
    repeated = sorted({x for x in stems if stems.count(x) > 1})
    if repeated:
        raise ValueError(f"several CSV tables in {directory} are named {', '.join(repeated)}")
    return dict(sorted(zip(stems, paths)))


_CORRUPT, _MARK = "_corrupt_row", "\x01"


def split_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, row, number, record): the CSV records of all files at ``path``, read by as many tasks as there are input splits.

    Lines are read in parallel. A line break is inside a quoted cell if an odd number of quotes comes before it: quotes are counted
    per split, and the counts' running sum over a file's splits (one row each) tells how each split begins. Lines
    from one outside break to the next are a record, numbered from 1 per file; (block, row) is the place of its first line.
    Only lines of records that hold line breaks meet again.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"))
    lines = lines.withColumn("quotes", F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit(""))))
    in_split = Window.partitionBy("file", "block").orderBy("row")
    lines = lines.withColumn("before", F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2)
    # A split starts as many records as lines begin at either parity; which one holds is known once the splits before are.
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"), F.sum((F.col("before") == 0).cast("long")).alias("even"),
                                                 F.sum((F.col("before") == 1).cast("long")).alias("odd"),
                                                 F.min_by(F.col("line").endswith("\r"), "row").alias("cr"))
              .withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
              .withColumn("first", F.coalesce(F.sum(F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))).over(earlier), F.lit(0)))
              .withColumn("crlf", F.first("cr").over(Window.partitionBy("file").orderBy("block")))
              .select("file", "block", "inside", "first", "crlf"))
    starts = ((F.col("before") + F.col("inside")) % 2 == 0).cast("long")
    upto = in_split.rowsBetween(Window.unboundedPreceding, 0)
    placed = (lines.join(F.broadcast(splits), ["file", "block"]).withColumn("starts", starts)  # a row per split
              .withColumn("number", F.col("first") + F.sum("starts").over(upto)))
    whole = (F.col("starts") == 1) & (F.col("quotes") % 2 == 0)
    single = placed.where(whole).select("file", "block", "row", "number", "crlf", F.col("line").alias("record"))
    joined = (placed.where(~whole).groupBy("file", "number", "crlf")
              .agg(F.array_sort(F.collect_list(F.struct("block", "row", "line"))).alias("parts"))
              .select("file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["row"].alias("row"), "number", "crlf",
                      F.array_join(F.col("parts.line"), "\n").alias("record")))
    bare = F.regexp_replace("record", "\r$", "")
    # As in the one-task read, a file whose first line ends in \r\n has only \n inside its cells.
    records = single.unionByName(joined).withColumn("record", F.when(F.col("crlf"), F.replace(bare, F.lit("\r\n"), F.lit("\n"))).otherwise(bare))
    return records.where(F.length("record") > 0).drop("crlf")


def _regular(record: Column) -> Column:
    """Quotes only around whole cells (doubled inside them), and no other line break than the record's."""
    parts = F.split(F.replace(record, F.lit('""'), F.lit("")), '"', -1)
    # Every second part lies outside quotes: it must end in a comma before a quote and begin with one behind.
    wrong = F.transform(parts, lambda s, i: (i % 2 == 0) & (((i > 0) & (s != "") & ~s.startswith(","))
                                                          | ((i < F.size(parts) - 1) & ~(s.endswith(",") | ((i == 0) & (s == ""))))
                                                          | s.contains("\r") | s.contains("\n")))
    return (F.size(parts) % 2 == 1) & ~F.exists(wrong, lambda x: x)


def _parallel_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """Rows of ``schema`` with their ordinal, parsed record by record; None if some record is not regular, so that parity may mislead."""
    folder = scratch_path(spark, "csv-records")
    split_records(spark, path).write.parquet(folder)
    records = spark.read.parquet(folder)
    if not records.where(~_regular(F.col("record"))).isEmpty():
        return None
    names = [_CORRUPT if c == _CORRUPT else f"c{i}" for i, c in enumerate(schema.names)]
    cells = F.from_csv("record", ", ".join(f"{c} string" for c in names),
                       {**CSV_PARSE, "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    return (records.where(F.col("number") > 1).select(cells.alias("cells"), F.struct("file", "block", "row").alias("place"))
            .select("cells.*", "place").toDF(*schema.names, ORDINAL))


def _lines_are_records(spark: SparkSession, path: str) -> bool:
    """Whether no cell at ``path`` holds a line break and quotes stand only around whole cells, so that every line is a record.

    One look at every line, which moves nothing: Spark's own reader then splits the files.
    """
    line = F.regexp_replace("value", "\r$", "")
    plain = F.when(line.contains('"'), _regular(line)).otherwise(F.lit(True)) & ~line.contains("\r")
    return spark.read.option("lineSep", "\n").text(path).agg(F.coalesce(F.bool_and(plain), F.lit(True))).first()[0]


def _in_one_split(spark: SparkSession, path: str) -> bool:
    """Whether every file at ``path`` is read as one split anyway."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("length")
    return (sizes.agg(F.max("length")).first()[0] or 0) <= _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _bytes(setting: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def read_csv_table(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One CSV table as text columns, NA tokens nulled, with the source ordinal.

    Rows whose number of cells differs from the header's arrive flagged with
    their text. Only those are parsed once more, a mark put behind their last
    cell: if the mark is not among the first header + 1 cells, the row is too long.
    """
    options = {**CSV_READ, "multiLine": str(multi_line).lower()}
    columns = spark.read.options(**options).csv(path).columns
    if _CORRUPT in columns:
        raise ValueError(f"{path}: column name {_CORRUPT} is reserved")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _CORRUPT]])
    rows = None
    if multi_line and not _in_one_split(spark, path):
        if _lines_are_records(spark, path):
            options["multiLine"] = "false"
        else:
            rows = _parallel_rows(spark, path, schema)
    if rows is None:
        rows = spark.read.options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT, columnPruning="false",
                                  enforceSchema="false").schema(schema).csv(path)
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("row"))
        rows = rows.select("*", place.alias(ORDINAL))
    cells = [f"c{i}" for i in range(len(columns) + 1)]
    again = F.from_csv(F.concat(F.col(_CORRUPT), F.lit(f",{_MARK}")), ", ".join(f"{c} string" for c in cells),
                       {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    fits = reduce(Column.__or__, [again[c].eqNullSafe(F.lit(_MARK)) for c in cells])
    too_long = F.col(_CORRUPT).isNotNull() & ~fits
    # Naming a data cell also keeps the reader from scanning for the flag alone, which Spark refuses.
    message = F.concat(F.lit(f"{path}: row with more than {len(columns)} cells, the first "), F.coalesce(columns[0], F.lit("NULL")),
                       F.lit(": "), F.substring(_CORRUPT, 1, 200))
    checked = rows.where(F.when(too_long, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return null_na_tokens(checked.drop(_CORRUPT), columns)


def load_csv_directory(spark: SparkSession, directory: str, multi_line: bool = True) -> dict[str, DataFrame]:
    return {name: read_csv_table(spark, path, multi_line) for name, path in list_csv_tables(spark, directory).items()}


def as_raw_text(df: DataFrame) -> DataFrame:
    """Every column as text; empty text is NULL (a blank cell is a missing value)."""
    return df.select(*[
        (F.when(F.col(c).cast("string") != F.lit(""), F.col(c).cast("string")).alias(c) if c != ORDINAL else F.col(c))
        for c in df.columns
    ])


def clustered(df: DataFrame, key: Column) -> DataFrame:
    """Range-partitioned and sorted by ``key``; a hash of the row splits a key (or NULL) that holds many rows."""
    spread = F.xxhash64(*[F.col(c) for c in df.columns if c != ORDINAL])
    return df.repartitionByRange(key.asc_nulls_last(), spread).sortWithinPartitions(key)


PURCHASE_TS = "_purchase_ts"  # typed ordering column added to bronze orders


def with_ordering_column(orders: DataFrame) -> DataFrame:
    """Bronze orders with a typed purchase time (NULL when unparsable), clustered by it.

    The batch scan filters on a strict cast of the text column, which Parquet
    cannot evaluate; this column lets a redundant ``>= watermark`` predicate
    reach the reader, and sorted files give tight min/max statistics, so row
    groups wholly before the watermark are skipped.
    """
    typed = orders.withColumn(PURCHASE_TS, to_datetime("order_purchase_timestamp"))
    return clustered(typed, F.col(PURCHASE_TS))


# Lookup key of each child table: bronze files are clustered by it, so a batch's
# key range (a literal predicate) skips the row groups outside it.
CLUSTER_BY_KEY = {
    "raw_order_items": "order_id", "raw_payments": "order_id", "raw_reviews": "order_id",
    "raw_customers": "customer_id", "raw_products": "product_id", "raw_sellers": "seller_id",
}


def write_bronze(tables: dict[str, DataFrame], root: str, suffix: str = "") -> dict[str, str]:
    """Land each table under ``root/<name>`` as all-text Parquet (replacing it).

    ``raw_orders`` also gets the typed ordering column (see
    :func:`with_ordering_column`); child tables are clustered by their lookup key.
    """
    paths = {}
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/{name}" + (f"/{suffix}" if suffix else "")
        out = as_raw_text(df)
        if name == "raw_orders" and "order_purchase_timestamp" in df.columns:
            out = with_ordering_column(out)
        elif CLUSTER_BY_KEY.get(name) in df.columns:
            key = CLUSTER_BY_KEY[name]
            out = clustered(out, F.col(key))
        out.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


def write_csv_tables(tables: dict[str, DataFrame], directory: str) -> None:
    """Write tables as ``<directory>/<name>.csv/part-*.csv`` with a header."""
    for name, df in tables.items():
        df.write.mode("overwrite").options(**CSV_WRITE).csv(f"{directory.rstrip('/')}/{name}.csv")


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count, column_count, columns)`` for every table, in one job."""
    parts = []
    for name, df in tables.items():
        cols = [c for c in df.columns if c != ORDINAL]
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.col("row_count").cast("long").alias("row_count"),
            F.lit(len(cols)).cast("int").alias("column_count"), F.lit(", ".join(cols)).alias("columns")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def land_bronze(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> str:
    """Load every table as one unit: write each under a new load token, then commit one manifest.

    ``<root>/<name>/load=<token>/`` holds the data, ``<root>/_loads/load=<token>/``
    the (table_name, path) list. A crash before the manifest write leaves the
    previous load current; readers use :func:`read_bronze`. Returns the token.
    """
    root = root.rstrip("/")
    previous = _latest_load(spark, root)
    seq = int(previous.split("-")[0]) + 1 if previous else 1
    token = f"{seq:08d}-{uuid.uuid4().hex[:12]}"
    paths = write_bronze({name: df for name, df in tables.items()}, root, suffix=f"load={token}")
    rows = sorted(paths.items())
    manifest = spark.createDataFrame(rows, "table_name string, path string")
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{root}/_loads/load={token}")
    return token


def _latest_load(spark: SparkSession, root: str) -> str | None:
    loads = committed(spark, f"{root}/_loads")
    return None if loads is None else loads.agg(F.max(F.col("load").cast("string"))).first()[0]


def committed(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None if nothing was ever committed there. Any other failure raises."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def read_bronze(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest committed bronze load."""
    root = root.rstrip("/")
    token = _latest_load(spark, root)
    if token is None:
        raise FileNotFoundError(f"No committed bronze load under {root}")
    rows = (spark.read.parquet(f"{root}/_loads").where(F.col("load").cast("string") == F.lit(token))
            .select("table_name", "path").collect())  # one row per table
    return {r.table_name: spark.read.parquet(r.path) for r in rows}
