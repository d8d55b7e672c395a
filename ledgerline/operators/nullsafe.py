"""Left join on a null-safe key (NULL matches NULL) whose NULL keys are no hot key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most pieces that the rows without a key are dealt to.
MOST_PIECES = 1_024


def left_join_null_safe(left: DataFrame, right: DataFrame, key: str, right_key: str) -> DataFrame:
    """``left`` with the other columns of ``right``, where the keys are equal or both NULL; duplicates on the right fan out.

    All NULL keys together would be one key of the shuffle. Left rows without a key are dealt to as many pieces as the shuffle has
    partitions, and the right's rows without one (for an entity table: none, or the one left unnamed) go to every piece. One join
    serves both kinds of rows, so neither side is read twice.
    """
    pieces = min(MOST_PIECES, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    others = [c for c in right.columns if c != right_key]
    dealt = left.withColumn("_piece", F.when(F.col(key).isNull(), F.monotonically_increasing_id() % pieces).otherwise(F.lit(0)).cast("int"))
    everywhere = F.when(F.col(right_key).isNull(), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
    named = right.select(F.col(right_key).alias("_key"), *others, F.explode(everywhere).alias("_at"))
    return dealt.join(named, dealt[key].eqNullSafe(named["_key"]) & (dealt["_piece"] == named["_at"]), "left").drop("_piece", "_key", "_at")
