"""The places of lines in files that do not state them.

A reader that needs the n-th record of a file finds no order in a DataFrame. But a task
reads a split from its start to its end, so a record's place is the records of the splits
before, and its own number within the split. Records are parsed and written once, with
their split and a number that rises along it; counts per split are summed up along the file
and joined back. The written table fixes the numbers: a task that runs again, or a cluster that plans
other splits for the next scan, cannot change them.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sqltext import strip
from ..staging import staged

#: The list of splits is broadcast up to this length (some 20 MB), and else joined by a shuffle.
SPLITS_AT_ONCE = 100_000


def required(col: Column, what: str) -> Column:
    """``col``, and an error where it is NULL: a lost place must not look like a miss."""
    return F.coalesce(col, F.raise_error(F.lit(f"a record without {what}")).cast("bigint"))


def numbered_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, within: Column | None = None
) -> DataFrame:
    """JSON lines as ``record``, with ``file``, ``file_line`` and ``line_no``, both from 0.

    ``line_no`` goes on from file to file in the order of their paths; ``within``, an expression
    over ``file`` and ``record``, starts it anew for each of its values. Blank lines hold no record and
    are not counted. A line that is no such record is an error. Folders named like
    ``model=a`` become columns.
    """
    text = spark.read.text(path)
    folders = [c for c in text.columns if c != "value"]
    parsed = (
        text.filter(F.length(strip(F.col("value"))) > 0)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("place"),
            F.from_json("value", schema, {"mode": "FAILFAST"}).alias("record"),
            *(F.col(c).cast("string") for c in folders),
        )
        .withColumn("within", F.lit(0) if within is None else within)
    )
    rows = staged(parsed, "lines")
    # One row for each split of the scan, a list that the driver plans with anyway.
    splits = rows.groupBy("within", "file", "split_start").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    ends = Window.partitionBy("within").orderBy("file", "split_start").rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy("file").orderBy("split_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(
        splits.select(
            "file",
            "split_start",
            (F.coalesce(F.sum("n").over(ends), F.lit(0)) - F.col("first")).alias("to_line"),
            (F.coalesce(F.sum("n").over(own), F.lit(0)) - F.col("first")).alias("to_file_line"),
            F.col("within").alias("part"),
        ),
        "splits",
    )
    if offsets.count() <= SPLITS_AT_ONCE:
        offsets = F.broadcast(offsets)
    same = (rows["file"] == offsets["file"]) & (rows["split_start"] == offsets["split_start"]) & rows["within"].eqNullSafe(offsets["part"])
    return rows.join(offsets, same).select(
        rows["file"],
        (F.col("place") + F.col("to_file_line")).alias("file_line"),
        (F.col("place") + F.col("to_line")).alias("line_no"),
        "record",
        *folders,
    )


def read_placed(
    spark: SparkSession, path: str | list[str], schema: T.StructType, within: Column | None = None
) -> DataFrame:
    """Records with their ``line_no``: the one they carry, or the place of their line.

    The first record tells which of the two a path holds; a mixture is an error when it is read.
    """
    stated = spark.read.schema(schema).json(path)
    first = stated.select("line_no").head()
    if first is None or first["line_no"] is not None:
        return stated.withColumn("line_no", required(F.col("line_no"), "line_no among others that have one"))
    found = numbered_records(spark, path, schema, within)
    mixed = F.raise_error(F.lit("a record with line_no among others without")).cast("bigint")
    fields = [n for n in schema.fieldNames() if n != "line_no"]
    return found.select(
        F.when(F.col("record.line_no").isNotNull(), mixed).otherwise(F.col("line_no")).alias("line_no"),
        *(F.coalesce(F.col(n), F.col(f"record.{n}")).alias(n) if n in found.columns else F.col(f"record.{n}") for n in fields),
        "file",
    )
