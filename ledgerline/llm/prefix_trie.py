"""Trie of the turn prefixes that conversations share, screened by a count-min sketch of prefix digests.

A turn is a 128-bit digest of role and text; a prefix is the exclusive or of its turns' digests, each hashed with its
place, so the prefix digests of a conversation are a running sum and texts never move. All prefixes are
counted in a two-row count-min sketch. Its estimates never fall short: an estimate of one proves that no other
conversation has the prefix, and its node is emitted where it stands. Only the other prefixes are shuffled and
grouped exactly, so a false alarm costs time alone.

Sums over a node's subtree need no walk of the trie. Every node is booked on its smallest member, at its depth; the
sum of a member's bookings from a depth on is its share of the node at that depth, and the shares of all members are
added up. Places in a conversation and these sums are found in pieces (a range of the sorted rows, a block of depths), so
one conversation may be any share of all turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut, tidy

#: Counters of a sketch row: four per prefix within these bounds. Beyond, estimates are too large more often, never too small.
FEWEST_COUNTERS, MOST_COUNTERS = 1 << 16, 1 << 24
SLICE = 1 << 16
#: Codes of counts: exact below EXACT, EXACT + k for at most EXACT << k + 1.
EXACT = 128
#: Members that a hot node's rows are split by when its children look for it.
MEMBERS_PER_SALT = 1_024
MOST_SALTS = 4_096
#: Depths of one conversation that are summed in one piece.
BLOCK = 4_096
#: Ids of one node that are joined at once, before its digest's task reads them.
CHUNK = 10_000
NODE = ["depth", "g1", "g2"]


def _prefix_of(conv: Column, modulus: int) -> Column:
    """How many turns a conversation takes from its group's first one."""
    return F.crc32(conv.cast("string")) % F.lit(modulus)


def placed(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``df`` with ``place`` (from 1, by ``order`` within ``key``), ``total`` rows of the key, and the piece and row that a row is in.

    Rows are range-partitioned and sorted; a key's rows in one partition are a piece, however many pieces a key has.
    """
    by = [F.col(c).asc_nulls_first() for c in [key, *order]]
    split = df.withColumn("uid", F.monotonically_increasing_id())  # equal rows may fall into different partitions
    sorted_rows = cut(split.repartitionByRange(*by, "uid").sortWithinPartitions(*by, "uid").drop("uid")
                      .withColumn("piece", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id()))
    of_key = Window.partitionBy(key)
    before = of_key.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (sorted_rows.groupBy("piece", key).agg(F.count("*").alias("n"), F.min("row").alias("start"))
              .select("piece", key, "start", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), F.sum("n").over(of_key).alias("total")))
    return (sorted_rows.join(pieces, ["piece", key]).withColumn("place", F.col("before") + F.col("row") - F.col("start") + 1)
            .drop("start", "before"))


def rebuilt(turns: DataFrame, group: int, modulus: int) -> tuple[DataFrame, DataFrame]:
    """(conversations ``c``, their rebuilt turns ``c, source, rank, digest, bytes``) of turns (c, turn, digest, bytes)."""
    ranked = placed(turns, "c", ["turn", "digest"]).select("c", F.col("place").alias("rank"), "digest", "bytes")
    ids = cut(ranked.filter("rank = 1").select("c"))
    first, taken = F.col("c") - F.col("c") % group, _prefix_of(F.col("c"), modulus)
    own = ranked.filter((F.col("c") == first) | (F.col("rank") > taken)).withColumn("source", F.lit(1))
    near = F.explode(F.sequence(F.lit(1 - group), F.lit(group - 1)))
    heads = (ranked.filter((F.col("c") == first) & (F.col("rank") < modulus)).withColumnRenamed("c", "base").withColumn("near", near)
             .withColumn("c", F.try_add("base", "near")).filter((F.col("c") != F.col("base")) & (first == F.col("base")) & (F.col("rank") <= taken))
             .join(ids, "c", "left_semi").withColumn("source", F.lit(0)))
    return ids, own.unionByName(heads.select(own.columns))


def prefixes(turns: DataFrame) -> DataFrame:
    """Rebuilt turns -> (c, depth, g1, g2, p1, p2, bytes, ends): digest of every prefix and of the one before it."""
    rows = placed(turns, "c", ["source", "rank"])
    rows = (rows.withColumn("h1", F.xxhash64("place", "digest")).withColumn("h2", F.xxhash64(F.lit(1), "place", "digest"))
            .select("piece", "c", "row", F.col("place").alias("depth"), "h1", "h2", "bytes", (F.col("place") == F.col("total")).alias("ends")))
    before = Window.partitionBy("c").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (rows.groupBy("piece", "c").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"))
              .select("piece", "c", *(F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"b{i}") for i in (1, 2))))
    upto = Window.partitionBy("piece", "c").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    g1, g2 = (F.col(f"b{i}").bitwiseXOR(F.bit_xor(f"h{i}").over(upto)) for i in (1, 2))
    return (rows.join(pieces, ["piece", "c"]).withColumn("g1", g1).withColumn("g2", g2)
            .select("c", "depth", "g1", "g2", F.col("g1").bitwiseXOR(F.col("h1")).alias("p1"), F.col("g2").bitwiseXOR(F.col("h2")).alias("p2"), "bytes", "ends"))


# ---- the sketch

def counters_for(n: int) -> int:
    return min(MOST_COUNTERS, max(FEWEST_COUNTERS, 1 << (4 * n - 1).bit_length() if n else 1))


def _at(g1: np.ndarray, g2: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray]:
    """A prefix's counter in either row; the second row's lie behind the first's."""
    return g1 & (counters - 1), (g2 & (counters - 1)) + counters


def _counted(counters: int):
    """mapInArrow: digests -> this task's counts, by slices of the sketch: places in the slice and counts as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        touched, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            at = np.concatenate([touched, *_at(b.column("g1").to_numpy(), b.column("g2").to_numpy(), counters)])
            n = np.concatenate([counts, np.ones(len(at) - len(counts), np.int64)])
            touched, back = np.unique(at, return_inverse=True)
            counts = np.bincount(back, weights=n, minlength=len(touched)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(touched // SLICE)) + 1
        for at, n in zip(np.split(touched, cuts), np.split(counts, cuts)):
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array([at[0] // SLICE], pa.int64()), pa.array([(at % SLICE).astype(np.uint16).tobytes()], pa.binary()),
                                                  pa.array([np.minimum(n, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], names=["slice", "at", "n"])

    return run


def codes_of(counts: np.ndarray, exact: int) -> np.ndarray:
    """One byte per count, never falling: the count itself, or ``exact`` and its magnitude."""
    high = np.maximum(counts, exact).astype(np.float64) / exact
    return np.where(counts < exact, counts, exact + np.minimum(np.floor(np.log2(high)), 100)).astype(np.uint8)


def salts_of(codes: np.ndarray, exact: int, members: int) -> np.ndarray:
    """Pieces that a node of this code is split into; all its members know the code, so they agree."""
    most = exact * 2.0 ** (codes.astype(np.float64) - exact + 1)
    return np.where(codes < exact, 1, np.clip(most / members, 1, MOST_SALTS)).astype(np.int32)


def _added(exact: int):
    """mapInArrow over rows sorted by slice: the codes of each slice's summed counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slice_id, total = None, None

        def done():
            return pa.RecordBatch.from_arrays([pa.array([slice_id], pa.int64()), pa.array([codes_of(total, exact).tobytes()], pa.binary())],
                                              names=["slice", "codes"])

        for b in batches:
            for s, at, n in zip(*(b.column(c).to_pylist() for c in ("slice", "at", "n"))):
                if s != slice_id:
                    if slice_id is not None:
                        yield done()
                    slice_id, total = s, np.zeros(SLICE, np.int64)
                total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.uint32)
        if slice_id is not None:
            yield done()

    return run


def sketch(rows: DataFrame, counters: int) -> np.ndarray:
    """Codes of both rows' counters; at most 2 * MOST_COUNTERS bytes come to the driver."""
    parts = rows.select("g1", "g2").mapInArrow(tidy(_counted(counters)), "slice long, at binary, n binary")
    out = np.zeros(2 * counters, np.uint8)
    for r in parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(tidy(_added(EXACT)), "slice long, codes binary").toLocalIterator():
        at = r.slice * SLICE
        out[at:at + SLICE] = np.frombuffer(r.codes, np.uint8)[:len(out) - at]
    return out


def _screened(shared, exact: int, members: int):
    """mapInArrow: prefixes with the sketch's estimate of their and their parents' members, as codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value
        for b in batches:
            g1, g2, p1, p2 = (b.column(c).to_numpy() for c in ("g1", "g2", "p1", "p2"))
            own, above = (np.minimum(*(codes[at] for at in _at(x, y, len(codes) // 2))) for x, y in ((g1, g2), (p1, p2)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own != 1), pa.array(above != 1), pa.array(salts_of(own, exact, members)),
                                              pa.array(salts_of(above, exact, members))],
                                             names=[*b.schema.names, "maybe", "above_maybe", "salts", "above_salts"])

    return run


# ---- the ids that end at a node

def _packed(size: int):
    """mapInArrow over sorted (node, c): a node's neighbouring ids joined by commas, at most ``size`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node = np.stack([b.column(c).to_numpy() for c in NODE], axis=1)
            ids = b.column("c").to_numpy()
            cuts = np.flatnonzero((node[1:] != node[:-1]).any(axis=1)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.append(cuts, len(ids))
            spans = [(i, min(i + size, e)) for s, e in zip(starts, ends) for i in range(s, e, size)]
            first = pa.array([s for s, _ in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(first) for c in NODE), b.column("c").take(first),
                                              pa.array([",".join(map(str, ids[s:e].tolist())) for s, e in spans], pa.string())],
                                             names=[*NODE, "c", "ids"])

    return run


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over chunks sorted by node and first id: SHA-256 of a node's ids, a chunk at a time."""
    node, digest = None, None

    def done():
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in node), pa.array([digest.hexdigest()])], names=[*NODE, "ends_sha256"])

    for b in batches:
        for *key, ids in zip(*(b.column(c).to_pylist() for c in (*NODE, "ids"))):
            if key != node:
                if node is not None:
                    yield done()
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
    if node is not None:
        yield done()


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, c) -> (node, ends_sha256): ids ascending, joined by commas.

    Sorting and joining are spread over ranges, so the one task that a node's digest needs only reads joined text.
    """
    spread = ends.select(*NODE, "c").repartitionByRange(*NODE, "c").sortWithinPartitions(*NODE, "c")
    chunks = spread.mapInArrow(tidy(_packed(CHUNK)), "depth long, g1 long, g2 long, c long, ids string")
    return (chunks.repartition(*NODE).sortWithinPartitions(*NODE, "c")
            .mapInArrow(tidy(_digested), "depth long, g1 long, g2 long, ends_sha256 string"))


# ---- exact nodes

def _shares(maybe: DataFrame, booked: DataFrame) -> DataFrame:
    """(node, n_leaves, saved): bookings (c, depth, leaves, saved) from a depth on, added up over the members of each node."""
    none = F.lit(0).cast("long")
    events = (maybe.select("c", *NODE, none.alias("leaves"), none.alias("saved"))
              .unionByName(booked.select("c", "depth", F.lit(None).cast("long").alias("g1"), F.lit(None).cast("long").alias("g2"), "leaves", "saved"))
              .withColumn("block", F.floor(F.col("depth") / BLOCK)))
    # Of the few conversations longer than a block: what is booked in later blocks.
    later = Window.partitionBy("c").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    behind = (booked.groupBy("c", F.floor(F.col("depth") / BLOCK).alias("block")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
              .unionByName(maybe.filter(F.col("depth") >= BLOCK).select("c", F.explode(F.array(F.floor(F.col("depth") / BLOCK), F.floor(F.col("depth") / BLOCK) - 1)).alias("block"))
                           .distinct().select("c", "block", none.alias("leaves"), none.alias("saved")))
              .groupBy("c", "block").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
              .select("c", "block", F.sum("leaves").over(later).alias("leaves_behind"), F.sum("saved").over(later).alias("saved_behind"))
              .filter("leaves_behind > 0 or saved_behind > 0"))
    from_here = Window.partitionBy("c", "block").orderBy(F.desc("depth")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    summed = (events.withColumn("leaves", F.sum("leaves").over(from_here)).withColumn("saved", F.sum("saved").over(from_here))
              .filter("g1 is not null").join(behind, ["c", "block"], "left"))
    return summed.groupBy(*NODE).agg(F.sum(F.col("leaves") + F.coalesce("leaves_behind", F.lit(0))).alias("n_leaves"),
                                     F.sum(F.col("saved") + F.coalesce("saved_behind", F.lit(0))).alias("saved"))


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                group: int = 5, modulus: int = 9) -> DataFrame:
    """Per node of the trie of rebuilt conversations: ``conv_col`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A conversation c is rebuilt from the first crc32(c) % ``modulus`` turns of conversation c - c % ``group`` and its own
    turns after so many. Turns are ordered by ``turn_col``, null first, and, where that is equal, by the MD5 digest of length of
    role, colon, role and text. A null role or text is empty. Rows without a conversation id belong to none and are
    left out; repeated rows are turns of their own; remainders have the sign of the id. Other columns are not read. An empty frame gives no node, not
    even a root. Prefixes are equal if 128 bits of their digests and their lengths are.
    """
    spark = df.sparkSession
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    turns = df.select(F.col(f"`{conv_col}`").cast("long").alias("c"), F.col(f"`{turn_col}`").alias("turn"),
                      F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
                      F.octet_length(text).cast("long").alias("bytes")).filter("c is not null")
    ids, again = rebuilt(turns, group, modulus)
    rows = cut(prefixes(again))
    n_convs, smallest = ids.agg(F.count("*"), F.min("c")).first()
    codes = sketch(rows, counters_for(rows.count()))
    shared = spark.sparkContext.broadcast(codes)
    rows = cut(rows.mapInArrow(tidy(_screened(shared, EXACT, MEMBERS_PER_SALT)), "c long, depth long, g1 long, g2 long, p1 long, p2 long, bytes long, ends boolean, "
                               "maybe boolean, above_maybe boolean, salts int, above_salts int"))
    maybe, alone = rows.filter("maybe"), rows.filter("not maybe")

    nodes = cut(maybe.groupBy(*NODE).agg(
        F.min("c").alias("c"), F.count("*").alias("n_convs"), F.sum(F.col("ends").cast("long")).alias("n_ends"), F.max("bytes").alias("bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.max("above_maybe").alias("above_maybe"), F.max("salts").alias("salts"), F.max("above_salts").alias("above_salts")))
    # Every node is booked on its smallest member: a leaf where all members end, and what its copies would cost.
    zero = F.lit(0).cast("long")
    booked = (nodes.select("c", "depth", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
              .unionByName(alone.filter("ends").select("c", "depth", F.lit(1).cast("long").alias("leaves"), zero.alias("saved"))))
    below = [nodes.filter("above_maybe"), alone.filter("above_maybe")]  # nodes whose parent is among ``nodes``
    children = (below[0].select(*NODE, "p1", "p2").unionByName(below[1].select(*NODE, "p1", "p2"))
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(F.count("*").alias("n_children")))
    about = (nodes.join(_shares(maybe, booked), NODE).join(children, NODE, "left")
             .join(ends_digests(maybe.filter("ends")), NODE, "left")
             .select(*NODE, "c", "n_convs", F.coalesce("n_children", zero).alias("n_children"), "n_leaves", "saved",
                     F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "p1", "p2", "above_maybe", "above_salts"))
    single = alone.select(*NODE, "c", F.lit(1).cast("long").alias("n_convs"), (~F.col("ends")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
                          zero.alias("saved"), F.sha2(F.when(F.col("ends"), F.col("c").cast("string")).otherwise(F.lit("")), 256).alias("ends_sha256"),
                          "p1", "p2", "above_maybe", "above_salts")
    out = about.unionByName(single)

    # The parent's smallest member: known at depth one (the root's) and where the parent is this conversation's own node.
    look_up = (F.col("depth") > 1) & F.col("above_maybe")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("g1").alias("p1"), F.col("g2").alias("p2"), F.col("c").alias("parent"),
                           F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    found = out.filter(look_up).withColumn("salt", F.pmod(F.xxhash64("g1", "g2"), F.col("above_salts")).cast("int")).join(parents, ["depth", "p1", "p2", "salt"], "left")
    local = out.filter(~look_up).withColumn("parent", F.when(F.col("depth") == 1, F.lit(smallest).cast("long")).otherwise(F.col("c")))
    columns = ["c", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
    return found.select(columns).unionByName(local.select(columns)).unionByName(_root(rows, nodes, booked, ids, n_convs, smallest).select(columns)).toDF(
        conv_col, "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _root(rows: DataFrame, nodes: DataFrame, booked: DataFrame, ids: DataFrame, n_convs: int, smallest: int | None) -> DataFrame:
    """The root's row; none if there is no conversation."""
    zero = F.lit(0).cast("long")
    sums = booked.agg(F.coalesce(F.sum("leaves"), zero).alias("leaves"), F.coalesce(F.sum("saved"), zero).alias("saved"))
    children = (nodes.filter("depth = 1").select("c").unionByName(rows.filter("depth = 1 and not maybe").select("c"))
                .agg(F.count("*").alias("n_children")))
    turnless = ids.join(rows.filter("depth = 1").select("c"), "c", "left_anti").select(zero.alias("depth"), zero.alias("g1"), zero.alias("g2"), "c")
    ends = ends_digests(turnless).agg(F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    one = sums.join(F.broadcast(children)).join(F.broadcast(ends))  # three single rows
    return one.select(F.lit(smallest).cast("long").alias("c"), zero.alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(n_convs).cast("long").alias("n_convs"),
                      "n_children", F.greatest("leaves", F.lit(1)).alias("n_leaves"), "saved", "ends_sha256").filter(F.lit(n_convs > 0))
