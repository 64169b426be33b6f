"""Reproducible draws: the hash of a key stands in for a random stream.

A draw depends on its key alone, so any partitioning, retry or re-run of a task
gives the same value.
"""

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let
from .sqltext import is_numeric_type

# ---- fixed values: shape of the drawn cells ----
LITERAL_SHARE = 0.4
SMALL_INTS = 6
FILLER_WORDS = ("alpha", "bravo", "carol", "delta", "echo")
NUMBER_SUFFIXES = ("_id", "_number")
# ---- end of fixed values ----

HEX_DIGITS = 7
HEX_RANGE = float(16**HEX_DIGITS)


def order_key(seed: int, row_id: Column) -> Column:
    """Shuffle key: sorting by it is a seeded permutation."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def hex_int(digest: Column, start: int, digits: int) -> Column:
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("bigint")


def unit(digest: Column, slot: int) -> Column:
    """The ``slot``-th uniform number in [0, 1) of one digest (up to 4)."""
    return hex_int(digest, 1 + slot * HEX_DIGITS, HEX_DIGITS) / F.lit(HEX_RANGE)


def pick(u: Column, n: Column) -> Column:
    """0-based index below ``n`` for a uniform ``u``."""
    return F.floor(u * n).cast("int")


def is_number_column(col: Column, sql_type: Column) -> Column:
    """Columns that get numbers: by type, or by the end of their name."""
    number = is_numeric_type(sql_type)
    for suffix in NUMBER_SUFFIXES:
        number = number | col.endswith(suffix)
    return number


def second_digits(digest: Column) -> Column:
    """The digits of the digest's second uniform number, as bytes: cutting and comparing these looks at no characters."""
    return F.substring(digest.cast("binary"), 1 + HEX_DIGITS, HEX_DIGITS)


def _below(share: float) -> str:
    """The least digits of a uniform number that is not below ``share``; digits order like numbers."""
    return f"{ceil(share * HEX_RANGE):0{HEX_DIGITS}x}"


def _one_of(digits: Column, values: Sequence[str]) -> Column:
    """``values[pick(u, n)]`` by comparing digits, a fraction of the cost of reading them as a number."""

    def between(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return F.lit(values[lo])
        middle = (lo + hi) // 2
        return F.when(digits < bytearray(_below(middle / len(values)).encode()), between(lo, middle)).otherwise(between(middle, hi))

    return between(0, len(values))


def drawn_cell(digest: Column, second: Column, number: Column, pool: Column, pooled: Column | None = None) -> Column:
    """``fixture_cell`` from the digest of its key and its ``second_digits``; without a pool where ``pooled`` is false."""
    numbers = [str(k + 1) for k in range(SMALL_INTS)]
    drawn = F.conv(second.cast("string"), 16, 10).cast("bigint") / F.lit(HEX_RANGE)
    member = F.get(pool, pick(drawn, F.size(pool)))
    # The digest orders like its first digits: one that begins with the bound itself is longer, so not below it.
    literal = (digest < _below(LITERAL_SHARE)) & (F.size(pool) > 0)
    return (
        F.when(literal if pooled is None else literal & pooled, member)
        .when(number, _one_of(second, numbers))
        .otherwise(_one_of(second, FILLER_WORDS))
    )


def fixture_cell(key: Column, number: Column, pool: Column) -> Column:
    """One synthetic cell as text.

    With a non-empty pool, 40% of cells are a pool member. Else a number column
    gets 1..6 and any other column one of five words: ranges that small make join
    keys and categories meet across rows.
    """
    return let(F.md5(key), lambda digest: let(second_digits(digest), lambda second: drawn_cell(digest, second, number, pool)))
