"""Seeded order, disjoint range splits, limits."""

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import hex_int, order_key

# ---- fixed values: default sizes, in shuffle order ----
DEFAULT_SEED = 42
DEFAULT_SIZES = {"eval": 300, "sft": 3000, "dpo": 1500, "rl": 400}
# ---- end of fixed values ----

# The leading 16 bits of the shuffle key: 65,536 buckets whatever the row count.
BUCKET_DIGITS = 4


def _keyed(rows: DataFrame, seed: int, row_id: str) -> DataFrame:
    key = order_key(seed, F.col(row_id))
    return rows.withColumn("_key", key).withColumn("_bucket", hex_int(F.col("_key"), 1, BUCKET_DIGITS))


def _ranked(rows: DataFrame, seed: int, row_id: str, below: int | None) -> DataFrame:
    """``rows`` with their 0-based ``position`` in the seeded order.

    A first pass over ``row_id`` alone counts the key buckets. With ``below`` only
    the buckets that reach that far are kept, before anything is shuffled.
    """
    counts = _keyed(rows.select(row_id), seed, row_id).groupBy("_bucket").agg(F.count("*").alias("_n"))
    # At most 65,536 rows of two numbers: one task adds them up, and broadcasting
    # them is always safe.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"))
    if below is not None:
        starts = starts.filter(F.col("_n_before") < below)
    in_bucket = Window.partitionBy("_bucket").orderBy("_key", row_id)
    ranked = _keyed(rows, seed, row_id).join(F.broadcast(starts), "_bucket").withColumn(
        "position", F.col("_n_before") + F.row_number().over(in_bucket) - 1
    )
    if below is not None:
        ranked = ranked.filter(F.col("position") < below)
    return ranked.select(*rows.columns, "position")


def seeded_order(rows: DataFrame, seed: int = DEFAULT_SEED, row_id: str = "row_id") -> DataFrame:
    """Every row with its 0-based ``position`` in a reproducible shuffle.

    The order is that of the md5 of seed and row id, so it does not depend on
    partitioning, and each of the 65,536 key buckets is ranked by its own task.
    """
    return _ranked(rows, seed, row_id, None)


def range_splits(
    rows: DataFrame,
    sizes: dict[str, int] | None = None,
    seed: int = DEFAULT_SEED,
    row_id: str = "row_id",
) -> DataFrame:
    """Disjoint consecutive ranges of the seeded order.

    ``sizes`` maps split name to size; offsets follow from the sizes before it.
    Adds ``split`` and ``split_ix``, the 0-based place in the split that seeds the
    verdicts.
    """
    sizes = DEFAULT_SIZES if sizes is None else sizes
    ends = list(accumulate(sizes.values()))
    starts = [0, *ends[:-1]]
    ranked = _ranked(rows, seed, row_id, ends[-1])
    split, start = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    for name, lo, hi in reversed(list(zip(sizes, starts, ends))):
        split = F.when(F.col("position") < hi, F.lit(name)).otherwise(split)
        start = F.when(F.col("position") < hi, F.lit(lo)).otherwise(start)
    return ranked.select(
        *rows.columns, split.alias("split"), (F.col("position") - start).alias("split_ix")
    )


def split_overlap(splits: DataFrame, key: str) -> DataFrame:
    """Keys that occur in two splits, counted for each pair of splits.

    ``key`` is the row id for a range check or the rendered prompt for content
    leaks. One row per key with the splits it is in, so copies are never paired.
    """
    hashed = splits.select(
        F.xxhash64(key).alias("_h"), F.col(key).alias("_key"), "split"
    ).distinct()
    per_key = hashed.groupBy("_h", "_key").agg(F.array_sort(F.collect_set("split")).alias("s"))
    found = per_key.filter(F.size("s") > 1)
    two = F.filter(
        F.flatten(
            F.transform(
                "s", lambda a: F.transform("s", lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))
            )
        ),
        lambda p: p["split_a"] < p["split_b"],
    )
    return (
        found.select(F.inline(two)).groupBy("split_a", "split_b").agg(F.count("*").alias("shared"))
    )


def limit_examples(df: DataFrame, n: int, order: str = "line_no") -> DataFrame:
    """The first ``n`` rows in file order."""
    return df.orderBy(order).limit(n)
