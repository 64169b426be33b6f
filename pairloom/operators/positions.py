"""Positions and running totals without one task holding a whole group.

Rows are range-partitioned by group and order, so a bucket is a partition: its size
is the planner's, whatever the values of the order column and however large a group is.
Windows run over the rows of a group in a bucket, and over one row per bucket of a group.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .skew import join_null_safe


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    values: dict[str, Column],
    buckets: int | None = None,
) -> DataFrame:
    """Position and running sums per group along a column.

    Adds ``position`` (1-based) and one running sum per entry of ``values``. The rows are
    shuffled and staged once, with the number of their bucket, so pass what is needed.
    ``buckets`` fixes their number; by default the adaptive planner sizes them. NULL is a group
    like any other and comes first in the order; rows with an equal place keep apart, in the
    order of a hash over all their columns.
    """
    group = list(group)
    tie = "_tie"
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    df_columns, df = df.columns, df.withColumn(tie, F.xxhash64(*hashed))
    keyed = df.withColumns(
        {"_n": F.lit(1).cast("bigint")} | {f"_v_{name}": col.cast("bigint") for name, col in values.items()}
    )
    sums = ["_n", *[f"_v_{name}" for name in values]]
    ranged = keyed.repartitionByRange(*([buckets] if buckets else []), *group, order, tie)
    rows = staged(ranged.withColumn("_bucket", F.spark_partition_id()), "ranged")
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*group, "_bucket")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(*group, "_bucket", *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_before") for s in sums])
    )
    here = (
        Window.partitionBy(*group, "_bucket")
        .orderBy(order, tie)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = rows.withColumns({f"{s}_here": F.sum(s).over(here) for s in sums})
    out = join_null_safe(summed, offsets, [*group, "_bucket"])
    return out.select(
        *df_columns,
        (F.col("_n_here") + F.col("_n_before")).alias("position"),
        *[(F.col(f"_v_{n}_here") + F.col(f"_v_{n}_before")).alias(n) for n in values],
    )
