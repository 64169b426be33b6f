"""SimHash near-duplicates by ball hashing that meets in the middle.

A fingerprint has 64 bits. Two fingerprints within 2r bits share a variant: some word
within r bits of both. So each distinct fingerprint emits its ball of radius r, the
variants are shuffled, and fingerprints that meet are linked. For even distances no
meeting is false, and a bucket holds no more members than a ball has words (65 for
r = 1), however hot a fingerprint is: copies were merged before. Within a bucket each
member is linked to the least one, which joins them all without naming all pairs.

Null and word-less texts have fingerprint zero and link like any other. Rows that repeat
a doc_id are documents of their own with the same id; rows with a null doc_id take part
and never name a component unless all of its rows lack an id (then it is null).
"""

from collections.abc import Iterable
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import raw_text, ship, slices, small
from .components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Shingles hashed at once: bounds the memory of one very long text.
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(raw: bytes, width: int = SHINGLE_WORDS) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text: a bit is 1 if set in over half the hashes.

    Words are cut at ASCII white space after A-Z is lower-cased; a text of fewer than
    ``width`` words is one shingle, a text of none has fingerprint zero.
    """
    words = raw.lower().split()
    if not words:
        return 0
    shingles = max(1, len(words) - width + 1)

    def parts():
        for start in range(0, shingles, SHINGLES_AT_ONCE):
            part = words[start : start + SHINGLES_AT_ONCE + width - 1]
            count = min(SHINGLES_AT_ONCE, shingles - start)
            joined = map(b" ".join, zip(*(part[k : k + count] for k in range(width)))) if len(words) >= width else [
                b" ".join(words)
            ]
            yield np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in joined), "<u8", count)

    return majority(parts(), shingles)


def majority(parts: Iterable[np.ndarray], count: int) -> int:
    """The signed 64-bit number whose bits are set in over half of ``count`` hashes, given in parts."""
    ones = np.zeros(64, np.int64)
    for hashes in parts:
        for start in range(0, len(hashes), SHINGLES_AT_ONCE):
            some = np.ascontiguousarray(hashes[start : start + SHINGLES_AT_ONCE], "<u8")
            ones += np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<i8")[0])


def _fingerprints(batches):
    for batch in slices(batches):
        prints = [fingerprint(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.drop_columns(["text"]).columns, pa.array(prints, pa.int64())],
            names=[*(n for n in batch.schema.names if n != "text"), "fp"],
        )


def fingerprints(docs: DataFrame, text_col: str, **keep) -> DataFrame:
    """A row for each document: the ``keep`` columns by name, and ``fp``."""
    ship(docs.sparkSession)
    rows = docs.select(*(c.alias(n) for n, c in keep.items()), raw_text(text_col).alias("text"))
    schema = ", ".join(f"{n} {t}" for n, t in rows.dtypes if n != "text") + ", fp bigint"
    return rows.mapInArrow(_fingerprints, schema)


def _ball(radius: int) -> list[int]:
    words = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [w - (1 << 64) if w >> 63 else w for w in words]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) with a < b: links that join all fingerprints within ``max_bits`` of each other.

    ``distinct`` has one row per fingerprint in its column ``fp``. ``max_bits`` is even.
    """
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits is 0, 2 or 4: a ball has half that radius")
    variants = distinct.select(
        "fp",
        F.explode(F.array(*(F.col("fp").bitwiseXOR(F.lit(m).cast("bigint")) for m in _ball(max_bits // 2)))).alias(
            "variant"
        ),
    )
    # A bucket holds at most a ball's worth of rows, so no window is large.
    least = F.min("fp").over(Window.partitionBy("variant"))
    return (
        variants.select("fp", least.alias("a"))
        .filter(F.col("a") < F.col("fp"))
        .select("a", F.col("fp").alias("b"))
        .distinct()
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id of the component).

    One row for each row of ``docs``; no other column of it is used.
    """
    prints = staged(fingerprints(docs, text_col, doc_id=F.col(id_col)), "prints")
    first = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "firsts")
    members = staged(components(links(first, max_bits)).withColumnRenamed("node", "fp"), "members")
    joined = staged(members.join(first, "fp"), "joined")
    least = staged(joined.groupBy("root").agg(F.min("first_id").alias("least_id")), "least")
    linked = joined.join(least, "root").select("fp", "least_id")
    # A table, so that the last join has two plain sides and a hot fingerprint can be split.
    named = staged(
        first.join(linked, "fp", "left").select("fp", F.coalesce("least_id", "first_id").alias("component_id")),
        "named",
    )
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group left, columns unchanged.

    The one with the least doc_id stays (a null id counts as the greatest, equal ids go
    by a hash of the text); of rows with equal ids and texts one stays.
    """
    digest = F.xxhash64(F.col(text_col))
    prints = fingerprints(docs, text_col, doc_id=F.col(id_col), digest=digest)
    rows = staged(prints.groupBy("fp", "doc_id", "digest").agg(F.count("*").alias("copies")), "rows")
    members = staged(components(links(rows.select("fp").distinct(), max_bits)), "members")
    return first_of_each(docs, rows, members, id_col, digest)


def first_of_each(docs: DataFrame, rows: DataFrame, members: DataFrame, id_col: str, digest: Column) -> DataFrame:
    """The rows of ``docs`` without all but the first of each group.

    ``rows`` has fp, doc_id, digest and copies of all documents, ``members`` the node and root of
    each fp that is linked; both are staged tables.
    """
    grouped = staged(
        rows.join(members, F.col("fp") == F.col("node"), "left").select(
            F.coalesce("root", "fp").alias("root"), "doc_id", "digest", "copies"
        ),
        "grouped",
    )
    order = F.struct(F.isnull("doc_id"), "doc_id", "digest")
    first = staged(
        grouped.groupBy("root")
        .agg(F.min(order).alias("first"), F.sum("copies").alias("group_rows"))
        .filter("group_rows > 1"),
        "first",
    )
    # What is not in this table stays as it is.
    judged = grouped.join(first, "root").select(
        "doc_id", "digest", "copies", (order == F.col("first")).alias("stays")
    )
    judged = staged(judged.filter(~F.col("stays") | (F.col("copies") > 1)), "judged")
    found = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("i"), digest.alias("d")).join(
        small(judged, 32), F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("d") == F.col("digest")), "left"
    )
    repeated = found.filter("stays").groupBy("i", "d").agg(F.first("row").alias("row"))
    return found.filter(F.isnull("stays")).select("row.*").unionByName(repeated.select("row.*"))
