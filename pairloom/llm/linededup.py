"""Line deduplication by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Two lines match if the Jaccard similarity of their sets
is at least 0.8; a line is removed if an earlier line matches it, whether that line stays
or not. Earlier is by doc_id, then (for rows with equal ids) a hash of the text, then
line number.

1. Lines with equal sets are merged, their first place kept (partial aggregates).
2. The words of a set are ordered by rarity: by the occurrences of their hash bucket in
   the whole corpus (a table of fixed size), then by hash. Matching sets share a word within
   their prefixes of ``n - ceil(0.8 n) + 1`` words.
3. Star round: where many sets of a size share one of their last prefix words, each is
   paired with a few first ones. This settles the members of a group of near copies
   with a few pairs each.
4. Full round: sets that are not settled meet every set that shares a prefix word, under
   the length filter, the positional filter and a bitmap filter (words in one set only
   flip bits, so 128 parities bound their number from below).
5. Pairs that pass are verified on the words of the lines themselves.

Words are runs of other than white space, in lower case. Lines without words match
nothing and stay; null texts stay null. Rows with equal ids and texts are treated alike
(their lines share places). Columns other than the text are returned as they are.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import small

#: The least similarity, as a fraction.
PART, WHOLE = 4, 5
#: Hash buckets whose word counts order the words.
BUCKETS = 1 << 16
SPACE = r" \t\x0B\f\r"
#: White space other than blanks, within a line.
OTHER_SPACE = r"[\t\x0B\f\r]"
PLACE = ["doc_id", "digest", "line_no"]
#: The star round's words of a set, and its first sets of a group.
STAR_WORDS, HEADS = 4, 4
#: Parities of the words by six bits of their keys, in two words by a seventh: what each value of the
#: seven bits flips. (A lambda is interpreted for every word, and looking up costs half of shifting.)
BITMAPS = {"low": [*(1 << b for b in range(64)), *[0] * 64], "high": [*[0] * 64, *(1 << b for b in range(64))]}


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, digest, line_no, line: a row for each line."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text_col).alias("digest"),
        F.posexplode(F.split(text_col, "\n")).alias("line_no", "line"),
    )


def _worded(lines: DataFrame) -> DataFrame:
    """The lines that have words, with ``words`` (repeats included) in place of ``line``."""
    rest = [c for c in lines.columns if c != "line"]
    # Only a split at one plain character goes without a pattern compiled for every line.
    clean = F.btrim(F.regexp_replace(F.lower("line"), OTHER_SPACE, " "))
    return (
        lines.select(*rest, clean.alias("clean"))
        .filter("clean != ''")
        .select(*rest, F.array_remove(F.split("clean", " "), "").alias("words"))
    )


def _rarity(docs: DataFrame, text_col: str) -> DataFrame:
    """One row with an array: the class of each bucket by its words, from rare to frequent, as a key's high byte."""
    words = F.split(F.regexp_replace(F.lower(text_col), rf"[\n{SPACE}]", " "), " ")
    counts = (
        docs.select(F.explode(words).alias("word"))
        .filter("word != ''")
        .groupBy(F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).alias("bucket"))
        .count()
    )
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).cast("bigint").alias("count"))
    high = F.shiftleft(F.least(F.floor(4 * F.log2(F.sum("count") + 1)), F.lit(127)).cast("bigint"), 56)
    classes = (
        counts.unionByName(every)
        .groupBy("bucket")
        .agg(high.alias("class"))
        .agg(F.array_sort(F.collect_list(F.struct("bucket", "class"))).alias("all"))
    )
    return staged(classes.select(F.col("all.class").alias("class")), "rarity")


def _flips(masks: list[int]) -> str:
    """SQL: an array of 64-bit numbers."""
    signed = (m - (1 << 64) if m >> 63 else m for m in masks)
    return f"array({', '.join(f'cast({m} as bigint)' for m in signed)})"


def _sets(lines: DataFrame, rarity: DataFrame) -> DataFrame:
    """A row for each distinct set: lid, its first place, n, bitmap, prefix (keys in order of rarity)."""
    keyed = (
        lines.withColumn("class", rarity.scalar())
        .withColumn("hashes", F.expr("array_distinct(transform(words, w -> xxhash64(w)))"))
        .withColumn(
            "keys",
            F.expr(
                f"sort_array(transform(hashes, h -> class[int(h & {BUCKETS - 1})] | shiftrightunsigned(h, 8)))"
            ),
        )
        .select(
            F.xxhash64("keys").alias("k1"),
            F.xxhash64(F.lit(7), "keys").alias("k2"),
            F.struct(*PLACE).alias("place"),
            F.size("keys").alias("n"),
            *(
                F.expr(f"aggregate(keys, 0L, (b, k) -> b ^ {_flips(masks)}[int(k & 127)])").alias(name)
                for name, masks in BITMAPS.items()
            ),
            F.expr(f"slice(keys, 1, size(keys) - ({PART} * size(keys) + {WHOLE - 1}) div {WHOLE} + 1)").alias("prefix"),
        )
    )
    # All but the place follow from the set.
    sets = keyed.groupBy("k1", "k2").agg(
        F.min("place").alias("place"),
        F.min("n").alias("n"),
        *(F.min(b).alias(b) for b in BITMAPS),
        F.first("prefix").alias("prefix"),
    )
    return staged(
        sets.select(F.monotonically_increasing_id().alias("lid"), "place.*", "n", *BITMAPS, "prefix"), "sets"
    )


def _need(n1: str, n2: str) -> str:
    """SQL: the least overlap of two matching sets."""
    return f"(({PART} * ({n1} + {n2}) + {PART + WHOLE - 1}) div {PART + WHOLE})"


def _may_match(a: str, b: str) -> str:
    """SQL: the length and bitmap filters."""
    return (
        f"{WHOLE} * {a}.n >= {PART} * {b}.n AND {WHOLE} * {b}.n >= {PART} * {a}.n"
        f" AND {' + '.join(f'bit_count({a}.{m} ^ {b}.{m})' for m in BITMAPS)}"
        f" <= {a}.n + {b}.n - 2 * {_need(f'{a}.n', f'{b}.n')}"
    )


def _star_pairs(sets: DataFrame) -> DataFrame:
    """(a, b): in large groups of sets of one size that share a word, b and some first sets a.

    The words are the last of the prefixes, which near copies of a line have in common.
    Each group has ``HEADS`` first sets, one for each remainder of the set numbers.
    """
    rows = sets.filter(f"n >= {WHOLE - 1}").select(  # smaller sets match equal ones only
        "lid", "n", F.explode(F.expr(f"slice(prefix, -least({STAR_WORDS}, size(prefix)), {STAR_WORDS})")).alias("word")
    )
    large = staged(rows.groupBy("word", "n").count().filter(f"count >= {2 * HEADS}").select("word", "n"), "large")
    members = rows.join(small(large, 32), ["word", "n"])
    facts = sets.select("lid", F.struct(*PLACE).alias("place"), *BITMAPS)
    members = staged(members.join(facts, "lid"), "members")
    first = F.min(F.struct("place", "lid", "n", *BITMAPS)).alias("h")
    heads = staged(members.groupBy("word", "n", F.pmod("lid", F.lit(HEADS)).alias("slot")).agg(first), "heads")
    met = members.alias("r").join(
        heads.alias("g"), F.expr("r.word = g.word AND r.n = g.n AND r.lid != g.h.lid AND " + _may_match("r", "g.h"))
    )
    return met.select(F.col("h.lid").alias("a"), F.col("r.lid").alias("b")).distinct()


def _full_pairs(sets: DataFrame, settled: DataFrame) -> DataFrame:
    """(a, b): sets that share a prefix word and pass the filters, one of them not settled."""
    rows = (
        sets.filter(f"n >= {WHOLE - 1}")
        .join(small(settled, 16), "lid", "left")
        .select("lid", F.coalesce("settled", F.lit(False)).alias("settled"), "n", *BITMAPS, F.posexplode("prefix").alias("i", "word"))
        # One number for three, as these rows are the largest shuffle.
        .select("word", "lid", F.expr("(bigint(n) << 32) | (i << 1) | int(settled)").alias("packed"), *BITMAPS)
    )
    x, y = ({"n": f"({r}.packed >> 32)", "i": f"(({r}.packed >> 1) & 2147483647)", "settled": f"({r}.packed & 1)"} for r in "xy")
    overlap = f"least({x['n']} - {x['i']}, {y['n']} - {y['i']}) >= {_need(x['n'], y['n'])}"
    condition = (
        f"x.word = y.word AND x.lid < y.lid AND {x['settled']} + {y['settled']} < 2"
        f" AND {overlap} AND {_may_match('x', 'y').replace('x.n', x['n']).replace('y.n', y['n'])}"
    )
    return (
        rows.alias("x")
        .join(rows.alias("y"), F.expr(condition))
        .select(F.col("x.lid").alias("a"), F.col("y.lid").alias("b"))
        .distinct()
    )


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pairs whose lines have a similarity of 0.8 or more, by their words."""
    pairs = staged(pairs, "pairs")
    asked = staged(pairs.select(F.explode(F.array("a", "b")).alias("lid")).distinct(), "asked")
    places = staged(sets.join(small(asked, 16), "lid").select("lid", *PLACE), "places")
    same = " AND ".join(f"l.{c} <=> p.{c}" for c in PLACE)
    asked_lines = (
        _lines(docs, id_col, text_col).alias("l").join(small(places, 48).alias("p"), F.expr(same)).select("lid", "line")
    )
    # Rows with equal ids and texts give a line twice.
    words = _worded(asked_lines).select("lid", F.array_distinct("words").alias("words")).dropDuplicates(["lid"])
    words = staged(words, "words")
    both = pairs.join(words.select(F.col("lid").alias("a"), F.col("words").alias("u")), "a").join(
        words.select(F.col("lid").alias("b"), F.col("words").alias("v")), "b"
    )
    shared = F.size(F.array_intersect("u", "v"))
    return both.filter((PART + WHOLE) * shared >= PART * (F.size("u") + F.size("v"))).select("a", "b")


def _removed(links: DataFrame, sets: DataFrame) -> DataFrame:
    """lid of every set with an earlier match."""
    place = sets.select("lid", F.struct(*PLACE).alias("place"))
    ends = links.join(place.select(F.col("lid").alias("a"), F.col("place").alias("at_a")), "a").join(
        place.select(F.col("lid").alias("b"), F.col("place").alias("at_b")), "b"
    )
    return ends.select(F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("lid")).distinct()


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest, line_no of the lines with words that no earlier line matches."""
    lines = _worded(_lines(docs, id_col, text_col))
    sets = _sets(lines, _rarity(docs, text_col))
    star = staged(_verified(_star_pairs(sets), sets, docs, id_col, text_col), "star")
    settled = staged(_removed(star, sets).withColumn("settled", F.lit(True)), "settled")
    full = _verified(_full_pairs(sets, settled), sets, docs, id_col, text_col)
    removed = staged(_removed(full, sets).unionByName(settled.select("lid")).distinct(), "removed")
    return sets.join(small(removed, 16), "lid", "left_anti").select(*PLACE)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """``docs`` with the later of matching lines removed from the text, other columns as they are.

    ``count_col`` names a further column: how many lines of the row were removed.
    """
    kept = staged(
        kept_lines(docs, id_col, text_col).groupBy("doc_id", "digest").agg(F.collect_list("line_no").alias("kept")), "kept"
    )
    rows = docs.select(
        F.struct("*").alias("row"), F.col(id_col).alias("i"), F.xxhash64(text_col).alias("d"), F.col(text_col).alias("t")
    )
    found = rows.join(
        small(kept, 96), F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("d") == F.col("digest")), "left"
    )
    # SQL text has no \f: it would be the letter.
    blank = r"filter(sequence(0, size(lines) - 1), j -> btrim(lines[j], ' \t\u000B\u000C\r') = '')"
    found = found.withColumn("lines", F.split("t", "\n")).withColumn(
        "stay", F.expr(f"array_sort(concat(coalesce(kept, cast(array() as array<int>)), {blank}))")
    )
    text = F.expr("array_join(transform(stay, j -> lines[j]), '\\n')")  # null for a null text
    removed = F.coalesce(F.size("lines") - F.size("stay"), F.lit(0)).cast("bigint")
    return found.select(
        *(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns),
        *([removed.alias(count_col)] if count_col else []),
    )
