"""Canonical text of result rows."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROUND_TO = 6
NULL_TEXT = "None"


def cell_text(col: Column, dtype: T.DataType) -> Column:
    """One cell as tagged text.

    Fractional numbers are tagged ``f:`` and rounded to 6 places, the rest ``s:``,
    so 5 and 5.0 differ. NULL reads as ``None`` and equals that string. A boolean
    counts as 0 or 1. Numbers past decimal(38,6) keep their own text.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        wide = col.cast("double")
        fixed = F.coalesce(wide.try_cast(f"decimal(38,{ROUND_TO})").cast("string"), wide.cast("string"))
        return F.when(col.isNull(), F.lit(f"s:{NULL_TEXT}")).otherwise(F.concat(F.lit("f:"), fixed))
    if isinstance(dtype, T.BooleanType):
        col = col.cast("int")
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        col = F.to_json(col)
    return F.concat(F.lit("s:"), F.coalesce(col.cast("string"), F.lit(NULL_TEXT)))


def row_key(df: DataFrame, cols: list[str]) -> Column:
    """The row as a JSON array of cell texts; column names do not matter."""
    return F.to_json(F.array(*[cell_text(F.col(f"`{c}`"), df.schema[c].dataType) for c in cols]))


def all_null(df: DataFrame, cols: list[str]) -> Column:
    """True when every cell reads as NULL."""
    tests = [
        cell_text(F.col(f"`{c}`"), df.schema[c].dataType) == f"s:{NULL_TEXT}" for c in cols
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))
