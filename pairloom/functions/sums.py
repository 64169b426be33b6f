"""Running sums along an array."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let


def _plain(block: Column) -> Column:
    done = F.aggregate(
        block,
        F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("up_to")),
        lambda d, x: let(d["at"] + x, lambda at: F.struct(at.alias("at"), F.concat(d["up_to"], F.array(at)).alias("up_to"))),
    )
    return done["up_to"]


def running_sums(values: Column) -> Column:
    """The sums of an array's elements up to each one.

    In blocks, since an array that grows is copied at each step: n elements take n to the
    power 1.5 and not its square.
    """

    def joined(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), width)
        blocks = F.transform(starts, lambda k: _plain(F.slice(v, k, width)))

        def moved(b: Column) -> Column:
            last = F.transform(b, lambda x: F.coalesce(F.try_element_at(x, F.lit(-1)), F.lit(0).cast("bigint")))
            add = lambda x, off: F.transform(x, lambda y: y + off)
            return let(
                _plain(last),
                lambda before: F.flatten(F.transform(b, lambda x, k: let(F.coalesce(F.get(before, k - 1), F.lit(0)), lambda off: add(x, off)))),
            )

        return let(blocks, moved)

    return let(values, joined)


def places(text: Column, marker: str) -> Column:
    """0-based places of a text's occurrences of ``marker``, from the left and without overlap."""
    gaps = F.transform(F.split(text, re.escape(marker), -1), F.char_length)
    ends = let(gaps, lambda g: F.transform(F.slice(g, F.lit(1), F.size(g) - 1), lambda x: (x + len(marker)).cast("bigint")))
    return F.transform(running_sums(ends), lambda end: end - len(marker))
