"""Lines that repeat across documents, by levelled sorted runs of line hashes. DataFrame functions only.

Documents come in batches of falling id. A run is a Parquet table of line keys, sorted, with how many documents of
its batches hold the key and the largest of their ids. A batch's keys are merge-anti-joined with the keys that some
run already holds often enough: of these the answer is settled, for no later batch has a larger id. What is left is
the batch's own run at level 0. ``FAN_IN`` runs of a level are compacted to one of the next; at the end all runs
are merged, and every document's lines are held against the keys that enough documents hold.

Keys are two 64-bit hashes with different seeds. Documents move once, to meet the places of their dropped lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# What is stripped from a line's ends, and the letters that are lower-cased.
BLANKS = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Batches of a corpus, about equal in documents, and runs of one level that are compacted to one.
BATCHES = 8
FAN_IN = 4
#: At most so many keys are broadcast: each has at least this share of all occurrences that the runs counted.
HOT_KEYS = 80_000
#: A key in fewer documents is no hot one.
HOT_DOCUMENTS = 1_000
KEY = ["k1", "k2"]
_OCCURRENCES = "id long, t1 long, t2 long, k1 long, k2 long, pos int, first boolean, batch int"
_RUN = "k1 long, k2 long, n long, last long"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _occurrences(docs: DataFrame, cuts: list[int], min_chars: int) -> DataFrame:
    """(id, text) -> a row per line whose key is long enough: its key, its place from 1, whether the document has it first here."""
    keys = F.transform(_lines(F.col("text")), lambda line: F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER))
    placed = F.transform(keys, lambda key, i: F.when(F.char_length(key) >= min_chars, F.struct(
        F.xxhash64(key).alias("k1"), F.xxhash64(F.lit(1), key).alias("k2"), (i + 1).alias("pos"))))
    ordered = docs.select("id", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"),
                          F.array_sort(F.filter(placed, lambda x: x.isNotNull())).alias("lines"))
    before = F.concat(F.array(F.lit(None).cast("struct<k1:long,k2:long,pos:int>")), F.col("lines"))
    marked = F.zip_with("lines", F.slice(before, F.lit(1), F.size("lines")), lambda x, y: F.struct(
        x["k1"].alias("k1"), x["k2"].alias("k2"), x["pos"].alias("pos"),
        (y.isNull() | (y["k1"] != x["k1"]) | (y["k2"] != x["k2"])).alias("first")))
    batch = reduce(Column.__add__, [(F.col("id") <= c).cast("int") for c in cuts], F.lit(0))
    return (ordered.filter(F.size("lines") > 0).select("id", "t1", "t2", F.inline(marked))
            .withColumn("batch", F.coalesce(batch, F.lit(len(cuts)))))


def _merged(runs: DataFrame) -> DataFrame:
    return runs.groupBy(*KEY).agg(F.sum("n").alias("n"), F.max("last").alias("last"))


class SortedRuns:
    """Levels of runs under one shared folder. A run is written whole before it counts, so a lost task writes it again."""

    def __init__(self, spark, folder: str, min_docs: int, fan_in: int = FAN_IN):
        self.spark, self.folder, self.min_docs, self.fan_in = spark, folder, min_docs, fan_in
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, run: DataFrame) -> str:
        path = f"{self.folder}/run-{self.written}"
        run.sortWithinPartitions(*KEY).select("k1", "k2", "n", "last").write.parquet(path)
        self.written += 1
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(_RUN).parquet(*paths)

    def add(self, batch: DataFrame) -> None:
        """One batch's (id, k1, k2, first); every id is at most those of the batches before."""
        own = batch.groupBy(*KEY).agg(F.sum(F.col("first").cast("long")).alias("n"), F.max("id").alias("last"))
        paths = [p for level in self.levels for p in level]
        if paths:
            settled = self._read(paths).filter(F.col("n") >= self.min_docs).select(*KEY).distinct()
            own = own.join(settled.hint("merge"), KEY, "left_anti")
        self._place(self._write(own), 0)

    def _place(self, path: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fan_in:
            runs, self.levels[level] = self.levels[level], []
            self._place(self._write(_merged(self._read(runs))), level + 1)

    def common(self) -> tuple[DataFrame, int]:
        """Keys of enough documents (k1, k2, n, last), all runs merged to one, and the occurrences that the runs counted."""
        paths = [p for level in self.levels for p in level]
        every = _merged(self._read(paths))
        total = self._read(paths).agg(F.sum("n")).first()[0] or 0
        return self._read([self._write(every.filter(F.col("n") >= self.min_docs))]), total


def drop_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20,
                      batches: int = BATCHES, fan_in: int = FAN_IN) -> DataFrame:
    r"""``df`` with ``n_lines``, ``n_dropped`` (long) and ``kept_text``.

    Lines are what ``\n`` separates; a line's key is the line without ASCII white space at its ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points in at least ``min_docs`` documents lose all lines but those of the
    largest id that holds them. Null and empty texts are one empty line. Every row is a document: repeated
    rows count each, and where several rows have the largest id, all of them keep their lines. A null id is
    smaller than any other; where only such rows hold a key, all keep it. A line that one document repeats counts
    once, and stays or goes with all its copies. Columns of ``df`` named like the new ones are replaced. An empty frame
    gives an empty frame. Ids are integers.
    """
    spark = df.sparkSession
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    doc_id, text = (F.col(f"c{df.columns.index(c)}") for c in (id_col, text_col))
    docs = plain.select(doc_id.cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))

    shares = [i / batches for i in range(1, batches)]
    cuts = docs.agg(F.percentile_approx("id", shares, 10_000)).first()[0] if shares else []
    folder = scratch_path(spark, "line-dedup")
    _occurrences(docs, cuts or [], min_chars).write.partitionBy("batch").parquet(f"{folder}/occurrences")
    found = spark.read.schema(_OCCURRENCES).parquet(f"{folder}/occurrences")

    runs = SortedRuns(spark, folder, min_docs, fan_in)
    for batch in range(len(cuts or []) + 1):
        runs.add(found.filter(F.col("batch") == batch))
    common, total = runs.common()

    # Keys of a fixed share of all occurrences are so few that they go to every task; the rest by sort-merge join.
    often = max(HOT_DOCUMENTS, -(-total // HOT_KEYS))
    hot = F.broadcast(common.filter(F.col("n") >= often).select(*KEY, "last"))
    rest = common.filter(F.col("n") < often).select(*KEY, "last")
    met = found.join(hot, KEY).unionByName(found.join(hot, KEY, "left_anti").join(rest, KEY))
    places = (met.filter(~F.col("id").eqNullSafe(F.col("last"))).groupBy("id", "t1", "t2")
              .agg(F.array_sort(F.collect_set("pos")).alias("gone")))  # of one document, so no longer than its text

    content = F.coalesce(text, F.lit(""))
    both = plain.join(places, doc_id.cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(content) == F.col("t1"))
                      & (F.xxhash64(F.lit(1), content) == F.col("t2")), "left")
    # What lies between neighbouring dropped lines stays. The one-element array binds the split text once.
    n_lines, gone = F.size(_lines(text)), F.col("gone")
    kept = F.transform(F.array(_lines(text)), lambda lines: F.concat_ws("\n", F.flatten(F.zip_with(
        F.concat(F.array(F.lit(0)), gone), F.concat(gone, F.array(F.size(lines) + 1)),
        lambda a, b: F.slice(lines, a + 1, b - a - 1)))))[0]
    new = {"n_lines": n_lines.cast("long"), "n_dropped": F.coalesce(F.size(gone), F.lit(0)).cast("long"),
           "kept_text": F.when(gone.isNull(), content).otherwise(kept)}
    stay = [i for i, c in enumerate(df.columns) if c not in new]
    # Named last: a select that mixes names and columns would take a new name for a column of that name.
    return both.select(*(f"c{i}" for i in stay), *new.values()).toDF(*(df.columns[i] for i in stay), *new)
