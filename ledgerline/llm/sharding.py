"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix.

1. Rows are spread over P partitions by a hash; their counts are known exactly.
2. The matrix of how many rows partition p sends to shard s is drawn: row after row a multivariate
   hypergeometric sample from the capacity that the shards have left. Its row sums are the partition
   sizes, its column sums the shard sizes, and it is distributed as under a uniform shuffle.
3. Each partition permutes its rows and cuts the permutation by its row of the matrix (exchange).
4. Each shard permutes what it received, in sub-buckets so that no task holds a whole shard.

Everything on the rows is DataFrame functions; the driver only sees one count per partition.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import cut

#: Rows that a partition or a shard's sub-bucket holds on average, at most.
ROWS_PER_BUCKET = 65_536
MIN_BUCKETS = 256
COPY_BLOCK = 4_096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Marked balls among ``draws`` from ``good`` marked and ``bad`` unmarked ones, for any size.

    Inverse distribution function over 40 standard deviations around the mode; what lies outside is below 1e-300.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    p = good / total
    spread = int(40 * (draws * p * (1 - p)) ** 0.5) + 60
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (draws - k)) - np.log((k + 1) * (bad - draws + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(weights, rng.random() * weights[-1], side="right").clip(0, last - first))


def communication_matrix(rng: np.random.Generator, sizes: list[int], capacities: list[int]) -> np.ndarray:
    """Counts [partition, shard] with these row and column sums, as a uniform random assignment has them."""
    left, out = [int(c) for c in capacities], np.zeros((len(sizes), len(capacities)), dtype=np.int64)
    for p, size in enumerate(sizes):
        draws, others = int(size), sum(left)
        for s, room in enumerate(left):
            others -= room
            out[p, s] = got = hypergeometric(rng, room, others, draws)
            left[s] -= got
            draws -= got
    return out


def _position(partition: list[str], order: list[str]):
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1


def shard_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_shards: int = 16, seed: int = 2) -> DataFrame:
    """Deal all rows to ``n_shards`` shards whose row counts differ by one at most.

    Returns, per row, ``id_col``, ``size`` (UTF-8 bytes of the text, none for null, plus 1),
    ``text_crc32`` (unsigned; of no bytes for null), ``shard`` and ``slot`` (0, 1, 2, ... in each shard).
    Rows are told apart by id, size and text digests; repeated rows are counted first and numbered, so
    even one row repeated in a third of the table spreads evenly. Null ids are ordinary values. Other
    columns of ``df`` are not read. An empty frame gives an empty frame. The same rows and seed give the
    same result, whatever the partitioning of the input.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    distinct = (df.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                          F.crc32(text).alias("crc"), F.xxhash64(text).alias("digest"))
                .groupBy("id", "size", "crc", "digest").count())
    rows = (distinct
            .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(count - 1) div {COPY_BLOCK}"))))
            .withColumn("copy", F.explode(F.expr(
                f"sequence(block * {COPY_BLOCK}, least((block + 1) * {COPY_BLOCK}, count) - 1)"))))
    keys = [F.col(c) for c in ("id", "size", "crc", "digest", "copy")]
    draw = [F.xxhash64(F.lit(f"{seed}/{i}"), *keys) for i in range(4)]

    total = df.count()
    n_parts = max(MIN_BUCKETS, -(-total // ROWS_PER_BUCKET))
    n_bins = max(MIN_BUCKETS // n_shards, -(-total // n_shards // ROWS_PER_BUCKET), 1)
    dealt = cut(rows.select("id", "size", "crc", "copy", F.pmod(draw[0], F.lit(n_parts)).cast("int").alias("part"),
                            draw[1].alias("turn"), F.pmod(draw[2], F.lit(n_bins)).cast("int").alias("bin"), draw[3].alias("place")))

    sizes = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}
    capacities = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    matrix = communication_matrix(np.random.default_rng(seed), [sizes.get(p, 0) for p in range(n_parts)], capacities)
    upto = spark.createDataFrame([(p, row.tolist()) for p, row in enumerate(matrix.cumsum(axis=1))], "part int, upto array<long>")
    sent = cut(dealt.withColumn("at", _position(["part"], ["turn", "id", "copy"])).join(upto, "part")
               .withColumn("shard", F.size(F.filter("upto", lambda u: u <= F.col("at"))))
               .select("id", "size", "crc", "copy", "shard", "bin", "place"))

    counts = {(r["shard"], r["bin"]): r["count"] for r in sent.groupBy("shard", "bin").count().collect()}
    starts, at = [], 0
    for s in range(n_shards):
        at = 0
        for b in range(n_bins):
            starts.append((s, b, at))
            at += counts.get((s, b), 0)
    starts = spark.createDataFrame(starts, "shard int, bin int, start long")
    return (sent.withColumn("within", _position(["shard", "bin"], ["place", "id", "copy"])).join(starts, ["shard", "bin"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard",
                    (F.col("start") + F.col("within")).alias("slot")))
