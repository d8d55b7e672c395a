"""N-gram Jaccard self-join with adaptive multi-match prefixes, and its connected components.

All shingles have one global order, rare ones first (by a fixed-width count table over all documents,
then by hash). Of a set of n shingles the first ``n - rest(n)`` are its prefix. Two sets of similarity t
share at least ``need(n) - rest(n)`` prefix shingles, so a longer prefix asks for more matches. Every set
takes one of two lengths (``LEVELS``): the longer if the count table estimates that its shorter prefix
would meet many candidates. A pair goes by the shorter level of the two.

What the extra matches buy: with the prefix shingles' exact posting lengths, each set may leave out its
``spare(n) - 1`` most frequent ones, for the rarest shingle that a pair shares has at least so many shared
ones above it. Sets whose prefix repeats by chance only thus post nothing. The postings left are
joined, and a pair must still share as many of them as its sizes imply before it is verified.

Copies are collapsed first: documents with equal sets are one node. A node is named by 64 bits of its set's digest; where
sets share these but not 64 further bits, they are named by the latter. Components need no list of all pairs:
round one verifies every set against the one with the fewest shingles of its own in a posting list, of these
the one it shares most lists with; round two verifies all remaining candidate pairs whose components still differ. Long postings are split into
blocks of rows that meet pairwise in different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerline.llm.common import cut, drop_unused_shuffles, release_memory, tidy

#: (percent, count): a prefix of this level is percent + 100 - t of a set, and count shingles, long.
LEVELS = ((5, 3), (10, 6))
COUNTERS = 1 << 18
COUNTER_ROWS = 16
POSTING_BLOCK = 1_000
#: A set that posts no more shingles takes the list of them along; another one takes its ``FIRST`` least shingles.
LISTED = 48
FIRST = 4
#: Bits of a set's first name. Fewer only in tests.
NAME_BITS = 64
#: Rows that one task of round two compares at a time, after long postings were copied to their blocks.
ROWS_PER_BUCKET = 30_000
#: What verifying a candidate costs, in postings.
VERIFY_COST = 10
#: Ids of the sets to verify are broadcast if they were counted and are no more (8 MB).
BROADCAST_IDS = 500_000
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _M[2]
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; with fewer words, the whole sequence is one.

    Words are what ASCII white space separates, A-Z lower-cased.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    k = min(width, len(words))
    n = len(h) - k + 1
    out = np.full(n, np.uint64(len(words) if len(words) < width else 0), dtype=np.uint64)
    for j in range(k):
        out = _mix(out * _M[0] + h[j:n + j] + _M[1])
    return np.unique(out)


def set_names(shingles: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two independent 64-bit digests of a set (of the first, ``bits`` bits count): together its identity."""
    raw = shingles.tobytes()
    return tuple(int(np.uint64(h).view(np.int64)) for h in (xxhash.xxh3_64_intdigest(raw) & (1 << bits) - 1, xxhash.xxh3_64_intdigest(raw, 1)))


def set_key(shingles: np.ndarray, shared: frozenset[int], bits: int = 64) -> int:
    """The node of a set: its first name, or its second if several sets share the first."""
    first, second = set_names(shingles, bits)
    return second if first in shared else first


def need(t100: int, n):
    """Overlap that a set of n needs at least with any similar set: ceil(t n)."""
    return -(-t100 * n // 100)


def rest(t100: int, n, level: int):
    """Shingles behind the prefix. Never falls as n grows, nor does ``spare``; the proof above needs both."""
    percent, count = LEVELS[level]
    return np.maximum(0, (t100 - percent) * n // 100 - count)


def spare(t100: int, n, level: int):
    """At most need(n) - rest(n): prefix shingles that any similar pair of at least this size shares."""
    percent, count = LEVELS[level]
    return np.minimum(percent * n // 100 + count - 1, need(t100, n))


def _sql(t100: int, level: int) -> tuple[str, str]:
    """``rest`` and ``spare`` of the column n."""
    percent, count = LEVELS[level]
    return (f"greatest(0, ({t100 - percent} * n) div 100 - {count})",
            f"least(({percent} * n) div 100 + {count - 1}, ({t100} * n + 99) div 100)")


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(7)) & np.uint64(COUNTERS - 1)


def _describe(width: int, bits: int):
    """mapInArrow: (id, text, digest) -> one row per document (n, key, other), and per task the counts of its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counters, id_type = np.zeros(COUNTERS, np.int64), [np.zeros(0, np.int64)], pa.int64()
        names = ["id", "digest", "n", "key", "other", "slice", "counts"]
        for b in batches:
            id_type = b.column("id").type
            ns, keys = [], []
            for t in b.column("text").to_pylist():
                s = shingle_set(t, width)
                ns.append(len(s))
                keys.append(set_names(s, bits))
                counters.append(_counter(s).astype(np.int64))
                if len(counters) == 1_000:
                    total += np.bincount(np.concatenate(counters), minlength=COUNTERS)
                    counters = []
            m = len(ns)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("digest"), pa.array(ns, pa.int64()), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)),
                 pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        parts = np.split(total + np.bincount(np.concatenate(counters), minlength=COUNTERS), COUNTER_ROWS)
        m = len(parts)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(m, id_type), *(pa.nulls(m, pa.int64()) for _ in range(4)), pa.array(range(m), pa.int32()),
             pa.array([p.tobytes() for p in parts], pa.binary())], names=names)

    return run


def _add_up(table: pa.Table) -> pa.Table:
    total = np.zeros(COUNTERS // COUNTER_ROWS, np.int64)
    for raw in table.column("counts").to_pylist():
        total += np.frombuffer(raw, np.int64)
    return pa.table({"slice": table.column("slice").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})


def _prefixes(width: int, t100: int, shared, twice: frozenset[int], bits: int):
    """mapInArrow: text -> postings (token, key, n, level, place, short) of the prefix, once per set and task.

    ``place``: how many shingles of the set come before. ``short``: the shingle lies in the prefix of level 0 as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = shared.value, set()
        usual = 2 * float(rarity.mean())
        for b in batches:
            out = []
            for t in b.column("text").to_pylist():
                s = shingle_set(t, width)
                n = len(s)
                if not n or (key := set_key(s, twice, bits)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(key)
                short, long = (n - int(rest(t100, n, level)) for level in (0, 1))
                count = rarity[_counter(s).astype(np.int64)]
                order = np.lexsort((s, count)) if long == n else _first(count, s, long)
                # Estimated candidates of the shorter prefix, after what it may leave out, against the longer one's postings.
                posted = count[order[:max(0, short - int(spare(t100, n, 0)) + 1)]]
                level = int(VERIFY_COST * np.maximum(posted - usual, 0).sum() > long - short)
                m = long if level else short
                out.append((s[order[:m]].view(np.int64), np.full(m, key, np.int64), np.full(m, n, np.int32),
                            np.full(m, level, np.int8), np.arange(m, dtype=np.int32), np.arange(m) < short))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["token", "key", "n", "level", "place", "short"])

    return run


def _first(count: np.ndarray, shingles: np.ndarray, m: int) -> np.ndarray:
    """Indices of the first m in order of (count, shingle)."""
    edge = np.partition(count, m - 1)[m - 1]
    some = np.flatnonzero(count <= edge)
    return some[np.lexsort((shingles[some], count[some]))][:m]


def _padded(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Lists as rows of a matrix and their lengths (0 for null)."""
    lists = lists.combine_chunks()
    size = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False), nan=0).astype(np.int64)
    out = np.zeros((len(lists), int(size.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(lists)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out, size


def _shared(tokens: np.ndarray, size: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows: how many tokens they have in common, and the least of these."""
    count, least = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    at = np.arange(tokens.shape[1])
    step = max(1, 4_000_000 // max(1, tokens.shape[1] ** 2))
    for i in range(0, len(x), step):
        p, q = x[i:i + step], y[i:i + step]
        same = (tokens[p][:, :, None] == tokens[q][:, None, :]) & (at < size[q][:, None])[:, None, :]
        both = same.any(axis=2) & (at < size[p][:, None])
        count[i:i + step] = both.sum(axis=1)
        least[i:i + step] = np.where(both, tokens[p], np.iinfo(np.int64).max).min(axis=1)
    return count, least


def _cross_pairs(t100: int):
    """applyInArrow on a bucket of postings: pairs of keys in different components that may be similar.

    A pair goes out at the least posting it shares. Sets come with the list of all they posted, if that is short: then the shared ones are
    counted, and the pair goes out only if they are enough. Of a longer list the least come along: a pair that has one in common is left
    out at every later posting; pairs without may go out several times.
    A posting's places in both sets bound their overlap: a similar pair passes that test at every posting it shares.
    """

    def run(table: pa.Table) -> pa.Table:
        names = ("token", "a", "b", "block", "n", "level", "place", "in_short", "in_long", "comp", "key", "short_whole", "long_whole")
        col = {c: table.column(c).to_numpy() for c in names}
        order = np.lexsort((col["key"], col["b"], col["a"], col["token"]))
        col = {c: v[order] for c, v in col.items()}
        t, n = col["token"], col["n"].astype(np.int64)
        before, behind = col["place"].astype(np.int64), n - col["place"]  # shingles in the global order; behind counts the posting too
        new = np.concatenate([[True], (t[1:] != t[:-1]) | (col["a"][1:] != col["a"][:-1]) | (col["b"][1:] != col["b"][:-1])]) if len(t) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        length = np.diff(np.append(first, len(t)))
        if len(first):  # runs within one component have nothing to compare
            mixed = np.minimum.reduceat(col["comp"], first) < np.maximum.reduceat(col["comp"], first)
            first, length = first[mixed], length[mixed]
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        row, left = np.repeat(first, length) + at, np.repeat(length, length) - at
        lists = [_padded(table.column(c)) for c in ("short_list", "long_list")]
        lists = [(tokens[order], size[order]) for tokens, size in lists]
        whole = [col[c] for c in ("short_whole", "long_whole")]
        out, d = [(np.zeros(0, np.int64),) * 2], 1
        while len(row):  # every row with the d-th after it in its run
            row, left = row[left > d], left[left > d]
            x, y = row, row + d
            level = np.minimum(col["level"][x], col["level"][y]).astype(np.int64)
            both = np.where(level > 0, col["in_long"][x] & col["in_long"][y], col["in_short"][x] & col["in_short"][y])
            most = np.minimum(before[x], before[y]) + np.minimum(behind[x], behind[y])  # overlap of two sets that share this posting
            ok = (both & (col["comp"][x] != col["comp"][y]) & ((col["a"][x] == col["b"][x]) | (col["block"][x] != col["block"][y]))
                  & ((100 + t100) * most >= t100 * (n[x] + n[y])))
            x, y, level = x[ok], y[ok], level[ok]
            for at_level, (tokens, size) in enumerate(lists):
                mine = level == at_level
                p, q = x[mine], y[mine]
                count, least = _shared(tokens, size, p, q)
                larger = np.maximum(n[p], n[q])
                wanted = -(-t100 * (n[p] + n[q]) // (100 + t100)) - rest(t100, larger, at_level) - spare(t100, larger, at_level) + 1
                go = (least >= t[p]) & ((count >= wanted) | ~(whole[at_level][p] & whole[at_level][q]))
                out.append((p[go], q[go]))
            d += 1
        x, y = map(np.concatenate, zip(*out))
        swap = col["key"][x] > col["key"][y]
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        pairs = np.unique(np.stack([col["key"][x], col["key"][y]], axis=1), axis=0)
        del table, col, lists, whole, out, row, left, x, y
        release_memory()
        return pa.table({"x": pairs[:, 0], "y": pairs[:, 1]})

    return run


def _packed_sets(width: int, twice: frozenset[int], bits: int):
    """mapInArrow: (key, text) -> (key, shingles as bytes) of the rows whose text has that set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 1_000):
                part = b.slice(i, 1_000)
                sets = [shingle_set(t, width) for t in part.column("text").to_pylist()]
                keep = pa.array([set_key(s, twice, bits) == k for s, k in zip(sets, part.column("key").to_pylist())], pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 names=["key", "shingles"]).filter(keep)

    return run


def _similar(t100: int):
    """mapInArrow: (x, y, shingles of both) -> the pairs whose Jaccard similarity suffices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for a, c in zip(b.column("sx").to_pylist(), b.column("sy").to_pylist()):
                a, c = np.frombuffer(a, np.uint64), np.frombuffer(c, np.uint64)
                both = np.sort(np.concatenate([a, c]))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= t100 * (len(both) - same))
            yield pa.RecordBatch.from_arrays([b.column("x"), b.column("y")], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of the edges (x, y): comp is the smallest node reachable.

    Alternating large-star and small-star steps until nothing changes; each step is a keyed aggregate and
    a join, and its edges are cut in the shared checkpoint folder. A node's neighbours are never listed.
    """
    edges = cut(edges.select("x", "y").filter("x != y").distinct())
    before = None
    while True:
        # Large star: larger neighbours of every node go to the smallest node around it.
        both = edges.union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        large = both.filter("y > x").join(least, "x").select(F.col("m").alias("x"), "y")
        # Small star: a node and its smaller neighbours go to the smallest of them.
        down = large.filter("x < y").distinct().select(F.col("y").alias("x"), F.col("x").alias("y"))
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(low, "x").select(F.col("m").alias("x"), "y").filter("x < y").union(low.select(F.col("m").alias("x"), F.col("x").alias("y")))
        edges = cut(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("y").alias("node"), F.col("x").alias("comp")).union(
        edges.select(F.col("x").alias("node"), F.col("x").alias("comp")).distinct())


def similarity_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """Per row of ``df``: ``id_col``, ``n_shingles`` and ``component_id``.

    Rows link when 100 * intersection >= percent * union of their sets of ``width``-word shingles; the
    component's id is the smallest id reachable by links. Null, empty and blank texts have no
    shingles, link with nothing and keep their own id. Rows with equal sets link whatever their ids, so
    repeated rows are kept and share a component; a null id counts only where a component has no
    other. Other columns are not read. Texts count whole. An empty frame gives an empty frame.
    """
    spark, t100 = df.sparkSession, percent
    id_type = "long" if isinstance(df.schema[id_col].dataType, IntegralType) else df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(f"`{id_col}`").cast(id_type).alias("id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(f"`{text_col}`").alias("digest"))
    described = cut(docs.mapInArrow(tidy(_describe(width, NAME_BITS)), f"id {id_type}, digest long, n long, key long, other long, slice int, counts binary"))
    rows = described.filter("slice IS NULL")
    # First names that several sets share: of n sets, n * n / 2 ** 65 at most are to be expected.
    twice = rows.groupBy("key").agg((F.min("other") != F.max("other")).alias("twice")).filter("twice").select("key")
    twice = frozenset(r.key for r in twice.toLocalIterator())
    if twice:
        named = F.broadcast(spark.createDataFrame([(k,) for k in twice], "twice long"))
        rows = cut(rows.join(named, F.col("key") == F.col("twice"), "left").withColumn("key", F.when(F.col("twice").isNull(), F.col("key")).otherwise(F.col("other"))))
    rows = rows.select("id", "digest", "n", "key")
    counts = (described.filter("slice IS NOT NULL").select("slice", "counts").groupBy("slice")
              .applyInArrow(_add_up, "slice int, counts binary").collect())  # COUNTERS numbers, whatever the table
    counts = {r["slice"]: np.frombuffer(r["counts"], np.int64) for r in counts}
    rarity = np.concatenate([counts.get(i, np.zeros(COUNTERS // COUNTER_ROWS, np.int64)) for i in range(COUNTER_ROWS)])
    rarity = np.minimum(rarity, np.iinfo(np.int32).max).astype(np.int32)

    postings = docs.select("text").mapInArrow(tidy(_prefixes(width, t100, spark.sparkContext.broadcast(rarity), twice, NAME_BITS)),
                                              "token long, key long, n int, level byte, place int, short boolean")
    lengths = postings.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    # Of each set's repeated prefix shingles, the most frequent may be left out at either level.
    repeated = postings.join(lengths, "token").groupBy("token", "key").agg(
        F.min("n").alias("n"), F.min("level").alias("level"), F.min("place").alias("place"), F.min("short").alias("short"), F.min("df").alias("df"))
    above = [F.desc("df"), F.desc("token")]
    (short_rest, short_spare), (long_rest, long_spare) = (_sql(t100, level) for level in (0, 1))
    of_set = Window.partitionBy("key")
    # ``own`` only says how typical a set is: what no other prefix holds may still lie behind another's.
    placed = (repeated.withColumn("own", (F.expr(f"n - if(level = 0, {short_rest}, {long_rest})") - F.count("*").over(of_set)).cast("int"))
              .withColumn("long_place", F.row_number().over(Window.partitionBy("key").orderBy(*above)))
              .withColumn("short_place", F.row_number().over(Window.partitionBy("key").orderBy(F.desc("short"), *above))))
    common = cut(placed.withColumn("in_short", F.expr(f"short and short_place >= {short_spare}"))
                 .withColumn("in_long", F.expr(f"level = 1 and long_place >= {long_spare}"))
                 .filter("in_short or in_long").select("token", "key", "n", "own", "level", "place", "in_short", "in_long"))
    del postings, lengths, repeated, placed
    drop_unused_shuffles(spark)
    # One text of every set; it is fetched by id and digest, so rows without an id don't all meet.
    sample = rows.filter("n > 0").groupBy("key").agg(F.min(F.struct("id", "digest")).alias("one")).select("key", "one.id", "one.digest")

    def similar(pairs: DataFrame) -> DataFrame:
        """Those of the written pairs (x, y) of keys whose sets are similar. Each set is fetched once; x's meets each y's."""
        asked = cut(pairs.select(F.col("x").alias("key")).union(pairs.select(F.col("y").alias("key"))).distinct().join(sample, "key"))
        wanted = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked
        sets = (docs.join(wanted, docs["id"].eqNullSafe(wanted["id"]) & docs["digest"].eqNullSafe(wanted["digest"])).select("key", "text")
                .mapInArrow(tidy(_packed_sets(width, twice, NAME_BITS)), "key long, shingles binary").dropDuplicates(["key"]))
        return cut(pairs.join(sets.select(F.col("key").alias("y"), F.col("shingles").alias("sy")), "y")
                   .join(sets.select(F.col("key").alias("x"), F.col("shingles").alias("sx")), "x")
                   .select("x", "y", "sx", "sy").mapInArrow(tidy(_similar(t100)), "x long, y long"))

    # Round one: every set with the most typical set of a posting list, of these the one it shares most lists with.
    leaders = common.groupBy("token").agg(F.min(F.struct("own", "key"))["key"].alias("x"))
    stars = cut(common.select("token", F.col("key").alias("y")).join(leaders, "token").filter("x != y").groupBy("x", "y").count()
                .groupBy("y").agg(F.max_by("x", F.struct("count", "x")).alias("x")).select("x", "y"))
    stars = connected_components(similar(stars))
    del leaders
    drop_unused_shuffles(spark)

    # Round two: all candidates whose components differ.
    labelled = (common.join(stars.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key")))
    # The largest component of a list only needs to meet the others: its blocks meet theirs, not each other.
    by_comp = labelled.groupBy("token", "comp").count()
    lists = cut(by_comp.groupBy("token").agg(F.sum("count").alias("total"), F.max(F.struct("count", "comp")).alias("top"))
                .filter("total > top.count")
                .select("token", F.col("top.comp").alias("top"), F.col("top.count").alias("inside"), (F.col("total") - F.col("top.count")).alias("outside"))
                .withColumn("p", F.expr(f"cast(ceil(inside / {POSTING_BLOCK}) as int)"))
                .withColumn("q", F.expr(f"cast(ceil(outside / {POSTING_BLOCK}) as int)")))
    met = (labelled.join(lists, "token")
           .withColumn("block", F.expr("if(comp = top, pmod(xxhash64(key), p), p + pmod(xxhash64(key), q))").cast("int"))
           .withColumn("other", F.explode(F.expr("if(comp = top, sequence(p, p + q - 1), sequence(0, p + q - 1))")))
           .select("token", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "n", "level", "place",
                   "in_short", "in_long", "comp", "key"))
    # Sets that posted little carry all they posted, so that their pairs are counted where they meet; others the least.
    posted = common.groupBy("key").agg(*[F.array_sort(F.collect_list(F.when(F.col(f"in_{k}"), F.col("token")))).alias(f"{k}_list") for k in ("short", "long")])
    carried = posted.select("key", *[column for k in ("short", "long") for column in (
        F.expr(f"size({k}_list) <= {LISTED}").alias(f"{k}_whole"), F.expr(f"slice({k}_list, 1, if(size({k}_list) <= {LISTED}, {LISTED}, {FIRST}))").alias(f"{k}_list"))])
    met = met.join(carried, "key")
    n_met = lists.agg(F.sum(F.expr("inside * q + outside * (p + q)"))).first()[0] or 0
    n_buckets = max(1, -(-n_met // ROWS_PER_BUCKET))
    pairs = cut(met.withColumn("bucket", F.pmod(F.xxhash64("token", "a", "b"), F.lit(n_buckets))).groupBy("bucket")
                .applyInArrow(_cross_pairs(t100), "x long, y long").distinct())
    del labelled, by_comp, lists, met, posted, carried
    drop_unused_shuffles(spark)
    more = similar(pairs)
    comps = connected_components(more.union(stars.select(F.col("comp").alias("x"), F.col("node").alias("y")))).withColumnRenamed("node", "key")
    del pairs, more, stars, common
    drop_unused_shuffles(spark)

    nodes = rows.join(comps, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    smallest = nodes.filter("n > 0").groupBy("comp").agg(F.min("id").alias("first"))
    return (nodes.join(smallest, "comp", "left")
            .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("id")).alias("component_id")))
