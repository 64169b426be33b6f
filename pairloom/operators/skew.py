"""Joining one row per key to rows of which one key may hold a third.

The adaptive skew join cannot split a partition whose other side comes straight out
of an aggregate on the join key, which is the usual case here. So hot keys get a
salt: their rows are dealt over several tasks and their one partner row is repeated
for each. Every row still meets its partner.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which a NULL key meets a NULL key; the keys come out once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})

    def meets(k: str) -> Column:
        a, b = F.col(k), F.col(f"_right_{k}")
        return a.eqNullSafe(b) if left.schema[k].nullable and right.schema[k].nullable else a == b

    return left.join(renamed, reduce(lambda a, b: a & b, map(meets, keys)), how).drop(*[f"_right_{k}" for k in keys])


def salted_join(
    rows: DataFrame,
    partners: DataFrame,
    keys: list[str],
    deal_by: str,
    rows_per_task: int = ROWS_PER_TASK,
    size: str | None = None,
) -> DataFrame:
    """Inner join of ``rows`` with ``partners``, which has one row per key; NULL is a key.

    ``deal_by`` differs between the rows of a key. Hot keys are those with more than
    ``rows_per_task`` rows, so there is at most one for each ``rows_per_task`` rows
    of the whole table: their list, a hash and a number each, stays small enough to
    broadcast (16 MB for a million million rows). ``size`` names a column of
    ``partners`` with the number of rows of its key; without it the rows are counted.
    """
    key_hash = F.xxhash64(*keys)
    if size:
        counted = partners.select(key_hash.alias("_h"), F.col(size).alias("_rows"))
    else:
        counted = rows.select(key_hash.alias("_h")).groupBy("_h").agg(F.count("*").alias("_rows"))
    hot = F.broadcast(
        counted.filter(F.col("_rows") > rows_per_task)
        .groupBy("_h")
        .agg(F.max(F.ceil(F.col("_rows") / rows_per_task)).cast("int").alias("_ways"))
    )
    ways = F.coalesce("_ways", F.lit(1))
    dealt = rows.withColumn("_h", key_hash).join(hot, "_h", "left").select(
        *rows.columns, F.pmod(F.xxhash64(deal_by), ways).cast("int").alias("_salt")
    )
    repeated = partners.withColumn("_h", key_hash).join(hot, "_h", "left").select(
        *partners.columns, F.explode(F.sequence(F.lit(0), ways - 1)).alias("_salt")
    )
    return join_null_safe(dealt, repeated, [*keys, "_salt"]).drop("_salt")
