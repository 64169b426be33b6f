"""Naming an intermediate value inside an expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda Spark shares no common subexpressions, so an expression used
    several times would be computed several times.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
