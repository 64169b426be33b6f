"""Cleaning SQL text and reading facts out of it, as column expressions.

White space, word characters and letter case follow Unicode: patterns carry
``(?U)`` and the white-space class adds four separators that Java leaves out.
(Spelled out as ranges the class is five times slower.) Trimming uses ``btrim`` with
a character set: a ``\\s+$`` pattern would rescan every inner run of white space in
a long text.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .bind import let

# Every character Unicode (and Python) counts as white space, for btrim.
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# ---- fixed values: patterns ----
WS = r"[\s\x1c-\x1f]"
NOT_WS = r"[^\s\x1c-\x1f]"
# The same in ASCII, one character after the other: such a class is a table, where a range or \s is a call for each character.
ASCII_SPACES = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f"
FENCE = rf"(?isU)```(?:sql)?{WS}*(.+?)```"
SCHEMA = r"(?s)Given this database schema:\n\n(.*?)\n\nWrite a SQL query"
TABLE = rf"(?isU)CREATE TABLE{WS}+({NOT_WS}+){WS}*\(([^)]*+)\)"
# The first two words between commas.
COLUMN = r"(?U)(?:^|,)[\s\x1c-\x1f]*+([^\s\x1c-\x1f,]++)[\s\x1c-\x1f]++([^\s\x1c-\x1f,]++)[^,]*+"
# A match starts at a word's start or where the last match ended: trying the inner
# letters of a word as well would find nothing else and cost half the time.
COMPARISON = (
    rf"(?iU)(?:(?<!\w)|\G)(\w+){WS}*(>=|<=|!=|=|>|<|LIKE){WS}*"
    r"""("[^"]*"|'[^']*'|-?[\d.]+)"""
)
NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
NUMERIC_TYPE = "INT|REAL|NUMERIC|DECIMAL|FLOAT"
# ---- end of fixed values ----


def by_alphabet(text: Column, build: Callable[[Callable[[str], str]], Column]) -> Column:
    """``build`` with its patterns as they are, or without the flag ``U`` where a text is all ASCII.

    Both match the same in such a text, but Unicode's classes cost many times as much for each character.
    """
    spaces = {r"[\s\x1c-\x1f]": f"[{ASCII_SPACES}]", r"[^\s\x1c-\x1f": f"[^{ASCII_SPACES}"}
    flags = {"(?U)": "", "(?iU)": "(?i)", "(?isU)": "(?is)"}
    plain = build(lambda p: reduce(lambda q, change: q.replace(*change), (flags | spaces).items(), p))
    return F.when(F.octet_length(text) == F.char_length(text), plain).otherwise(build(lambda p: p))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def extract_sql(text: Column) -> Column:
    """Content of the first fenced block, else the whole text; stripped.

    The captured group is never empty, so an empty extract means "no fence".
    """
    fenced = F.regexp_extract(text, FENCE, 1)
    return strip(F.when(fenced != "", fenced).otherwise(text))


def normalize_sql(sql: Column) -> Column:
    """Strip, drop trailing semicolons, single spaces, one quote style, lower case.

    Nothing is stripped after the semicolons go, so ``a ;`` keeps one space.
    """
    bare = F.rtrim(strip(sql), F.lit(";"))
    spaced = F.regexp_replace(bare, rf"(?U){WS}+", " ")
    return F.lower(F.replace(spaced, F.lit("'"), F.lit('"')))


def exact_match(prediction: Column, gold: Column) -> Column:
    return normalize_sql(prediction) == normalize_sql(gold)


def extract_schema(prompt: Column) -> Column:
    """The schema part of a rendered prompt; empty when absent."""
    return F.regexp_extract(prompt, SCHEMA, 1)


def is_numeric_type(sql_type: Column) -> Column:
    """By substring, so POINT and INTERVAL count and DOUBLE does not."""
    return sql_type.rlike(NUMERIC_TYPE)


def _columns(body: Column) -> Column:
    # One pass for each of the two words: splitting at commas and white space compiles its pattern for every piece.
    word = lambda k: by_alphabet(body, lambda flags: F.regexp_extract_all(body, F.lit(flags(COLUMN)), F.lit(k)))
    return F.zip_with(word(1), word(2), lambda c, t: F.struct(c.alias("col"), F.upper(t).alias("type")))


def parse_tables(schema: Column) -> Column:
    """ARRAY<STRUCT<name, columns ARRAY<STRUCT<col, type>>>>, in text order.

    A body ends at the first closing bracket and a column needs two words. Of
    tables with one name the last stays.
    """
    names, bodies = [
        by_alphabet(schema, lambda flags, k=k: F.regexp_extract_all(schema, F.lit(flags(TABLE)), F.lit(k))) for k in (1, 2)
    ]

    def later(all_names: Column, i: Column) -> Column:
        return F.slice(all_names, i + 2, F.greatest(F.size(all_names) - i - 1, F.lit(0)))

    return let(
        names,
        lambda ns: F.filter(
            F.zip_with(ns, bodies, lambda n, b: F.struct(n.alias("name"), _columns(b).alias("columns"))),
            lambda t, i: ~F.array_contains(later(ns, i), t["name"]),
        ),
    )


def literal_pairs(sql: Column) -> Column:
    """ARRAY<STRUCT<col, val>>: each ``column OP literal``, by appearance."""
    cols, vals = [
        by_alphabet(sql, lambda flags, k=k: F.regexp_extract_all(sql, F.lit(flags(COMPARISON)), F.lit(k))) for k in (1, 3)
    ]
    return F.zip_with(
        cols,
        vals,
        lambda c, v: F.struct(F.lower(c).alias("col"), F.btrim(v, F.lit("\"'")).alias("val")),
    )


def _number_text(n: Column) -> Column:
    """A fraction without exponent from 1e-4 up to 1e16."""
    short = (F.abs(n) >= 1e-3) & (F.abs(n) < 1e7)
    plain = (F.abs(n) >= 1e-4) & (F.abs(n) < 1e16) & ~short
    digits = F.rtrim(n.cast("decimal(38,17)").cast("string"), F.lit("0"))
    return F.when(plain, digits).otherwise(n.cast("string"))


def boundary_values(val: Column) -> Column:
    """The literal and, for a number K, also K-1, K and K+1 as text.

    Whole numbers are written without a fraction, to the last digit of the double that the
    literal reads as. Infinite values stay without neighbours.
    """
    # Most literals are short whole numbers or hold no digit: neither needs a double.
    around = lambda n: F.array_distinct(F.array(val, *[(n + d).cast("string") for d in (-1, 0, 1)]))
    return (
        F.when(val.rlike(r"^-?[0-9]{1,15}\z"), let(val.try_cast("bigint"), around))
        .when(~val.rlike("[0-9]"), F.array(val))
        .when(val.rlike(r"^-?[0-9]{1,15}\.[0-9]{1,15}\z"), let(val.try_cast("double"), lambda n: _with_neighbours(val, n)))
        .otherwise(_boundary_values(val))
    )


def _with_neighbours(val: Column, number: Column) -> Column:
    return F.array_distinct(F.concat(F.array(val), F.coalesce(_neighbours(number), F.array().cast("array<string>"))))


def _boundary_values(val: Column) -> Column:
    text = strip(val)
    number = F.when(text.rlike(NUMBER), F.regexp_replace(text, "_", "")).try_cast("double")
    finite = F.when(F.abs(number) < float("inf"), number)
    return let(finite, lambda n: _with_neighbours(val, n))


def _neighbours(n: Column) -> Column:
    """Texts of n-1, n and n+1; NULL for no number."""
    texts = lambda base, text: F.array(*[text(base + d) for d in (-1, 0, 1)])
    whole = n == F.rint(n)
    # A bigint is exact where it fits.
    return (
        F.when(whole & (F.abs(n) < 9.0e18), texts(n.try_cast("bigint"), lambda x: x.cast("string")))
        .when(whole, _wide_neighbours(n))
        .when(~whole, texts(n, _number_text))
    )


_LIMB_DIGITS = 9
_LIMB = 10**_LIMB_DIGITS
_BITS_AT_ONCE = 29  # a limb times so many powers of two stays in a bigint


def _div(x: Column) -> Column:
    return F.call_function("div", x, F.lit(_LIMB))


def _times_power(limbs: Column, bits: Column) -> Column:
    """A whole number in limbs, the lowest first, times a power of two."""
    factor = F.call_function("shiftleft", F.lit(1).cast("bigint"), bits)

    def step(done: Column, limb: Column) -> Column:
        return let(
            limb * factor + done["carry"],
            lambda x: F.struct(_div(x).alias("carry"), F.array_append(done["out"], x % _LIMB).alias("out")),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(
        limbs, start, step, lambda d: F.when(d["carry"] > 0, F.array_append(d["out"], d["carry"])).otherwise(d["out"])
    )


def _digits(n: Column) -> Column:
    """All digits of a whole double from 2^53 on."""

    def shown(exponent: Column) -> Column:
        # A double is a whole number below 2^54 times a power of two; both steps are exact.
        significand = (n / F.pow(F.lit(2.0), exponent)).cast("bigint")
        limbs = let(significand, lambda m: F.array(m % _LIMB, _div(m)))
        steps = F.sequence(F.lit(0), exponent - 1, F.lit(_BITS_AT_ONCE))
        grown = F.aggregate(steps, limbs, lambda x, k: _times_power(x, F.least(F.lit(_BITS_AT_ONCE), exponent - k)))
        return F.array_join(
            F.transform(F.reverse(grown), lambda x, i: F.when(i == 0, x.cast("string")).otherwise(F.lpad(x.cast("string"), _LIMB_DIGITS, "0"))), ""
        )

    return let((F.floor(F.log2(n)) - 53).cast("int"), shown)


def _wide_neighbours(n: Column) -> Column:
    """The same past a bigint, by the digits: such a double is even, so only one less can borrow."""

    def texts(digits: Column) -> Column:
        more = F.concat(F.regexp_replace(digits, r"\d$", ""), (F.right(digits, F.lit(1)).cast("int") + 1).cast("string"))
        part = lambda k: F.regexp_extract(digits, r"^(\d*)([1-9])(0*)$", k)
        less = F.concat(part(1), (part(2).cast("int") - 1).cast("string"), F.replace(part(3), F.lit("0"), F.lit("9")))
        less = F.ltrim(less, F.lit("0"))
        minus = lambda x: F.concat(F.lit("-"), x)
        return F.when(n > 0, F.array(less, digits, more)).otherwise(F.array(minus(more), minus(digits), minus(less)))

    return let(_digits(F.abs(n)), texts)


def literal_pools(pairs: Column) -> Column:
    """MAP<col, STRUCT<first, pool>> from ``literal_pairs``.

    ``first`` is the first literal by appearance; ``pool`` is the sorted set of
    the literals and their boundary values. Built inside the row: no shuffle.
    """

    def entry(all_pairs: Column, col: Column) -> Column:
        own = F.transform(F.filter(all_pairs, lambda p: p["col"] == col), lambda p: p["val"])
        pool = let(own, lambda o: F.sort_array(F.array_distinct(F.flatten(F.transform(o, boundary_values)))))
        return F.struct(
            col.alias("key"),
            F.struct(F.get(own, F.lit(0)).alias("first"), pool.alias("pool")).alias("value"),
        )

    # A literal that comes again changes neither the first nor the pool.
    return let(
        F.array_distinct(pairs),
        lambda ps: F.map_from_entries(
            F.transform(
                F.array_distinct(F.transform(ps, lambda p: p["col"])), lambda c: entry(ps, c)
            )
        ),
    )


def column_literals(sql: Column) -> Column:
    return literal_pools(literal_pairs(sql))


def merge_literals(gold: Column, candidate: Column) -> Column:
    """Union of two pool maps; the gold query's literal comes first."""
    none = F.array().cast("array<string>")
    return F.map_zip_with(
        gold,
        candidate,
        lambda _, g, c: F.struct(
            F.coalesce(g["first"], c["first"]).alias("first"),
            F.sort_array(
                F.array_union(F.coalesce(g["pool"], none), F.coalesce(c["pool"], none))
            ).alias("pool"),
        ),
    )
