"""Connected components of a graph given as an edge table.

Alternating large-star and small-star steps: each step gives every node's neighbours
to the least of them, so paths shorten by a constant factor and every component ends
as a star around its least node. All state is in tables in the shared folder; the
driver sees only a count and a hash of each.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.staging import drop_stage, new_stage


def _write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = new_stage(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _least_neighbour(pairs: DataFrame) -> tuple[DataFrame, str]:
    # A table of its own: the join then has two plain sides, of which the adaptive
    # planner splits a hot node's.
    least = pairs.groupBy("u").agg(F.min("v").alias("v_min"))
    return _write(least.select("u", F.least("u", "v_min").alias("m")), "least")


def _size(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has an edge; root is its component's least node.

    ``edges`` has two columns of longs; direction, loops and repeats do not matter, and
    edges with a null end are none. An empty table gives an empty table. The root itself
    is also a row.
    """
    a, b = edges.columns
    first = edges.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    )
    state, path = _write(first.distinct(), "edges")
    spark = state.sparkSession
    size = _size(state)
    while size[0]:
        # Large-star: the greater neighbours of u go to the least of u and its neighbours.
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least, least_path = _least_neighbour(both)
        large, large_path = _write(
            both.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct(),
            "large",
        )
        # Small-star: u and its lesser neighbours go to the least of those.
        least_small, small_path = _least_neighbour(large)
        stars = (
            large.join(least_small, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v"))
        )
        after, after_path = _write(stars.distinct(), "edges")
        new_size = _size(after)
        for old in (path, least_path, large_path, small_path):
            drop_stage(spark, old)
        state, path = after, after_path
        if new_size == size:
            break
        size = new_size
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
