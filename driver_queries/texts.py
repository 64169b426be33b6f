"""SQL text: cleaning, schemas, literals."""

from pyspark.sql import functions as F

from pairloom.functions import sqltext
from pairloom.operators import chats

from . import tables as t
from .registry import query


@query("extract_sql", f"WITH {t.RESPONSES} SELECT line_no, {t.extract_sql_sql('raw_response')} AS prediction FROM responses")
def extract_sql(spark, sf):
    return t.responses(spark, sf).select(
        "line_no", sqltext.extract_sql(F.col("raw_response")).alias("prediction")
    )


@query("normalize_sql", f"WITH {t.RESPONSES} SELECT line_no, {t.normalize_sql_sql('gold')} AS normal FROM responses")
def normalize_sql(spark, sf):
    return t.responses(spark, sf).select("line_no", sqltext.normalize_sql(F.col("gold")).alias("normal"))


@query("exact_match", f"WITH {t.PREDICTIONS} SELECT model, line_no, match FROM predictions")
def exact_match(spark, sf):
    return chats.score_responses(t.responses(spark, sf)).select("model", "line_no", "match")


@query("extract_schema", f"WITH {t.PROMPTS} SELECT row_id, context AS schema_text FROM prompts")
def extract_schema(spark, sf):
    return t.prompts(spark, sf).select(
        "row_id", sqltext.extract_schema(F.col("prompt")).alias("schema_text")
    )


# ---- fixed values: the patterns of the schema and literal readers, for RE2 in SQL strings ----
TABLE_RE = r"(?is)CREATE TABLE\s+(\S+)\s*\((.*?)\)"
COMPARISON_RE = r"""(?i)(\w+)\s*(>=|<=|!=|=|>|<|LIKE)\s*("[^"]*"|''[^'']*''|-?[\d.]+)"""
NUMERIC_RE = "INT|REAL|NUMERIC|DECIMAL|FLOAT"
# ---- end of fixed values ----

TABLES_SQL = rf"""found AS (
  SELECT row_id, unnest(regexp_extract_all(context, '{TABLE_RE}', 1)) AS table_name,
    unnest(regexp_extract_all(context, '{TABLE_RE}', 2)) AS body,
    generate_subscripts(regexp_extract_all(context, '{TABLE_RE}', 1), 1) AS ix
  FROM instructions
), kept AS (
  SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY row_id, table_name ORDER BY ix DESC) = 1
), defs AS (
  SELECT row_id, table_name, unnest(string_split(body, ',')) AS def,
    generate_subscripts(string_split(body, ','), 1) AS def_ix
  FROM kept
), columns_ AS (
  SELECT row_id, table_name, row_number() OVER (PARTITION BY row_id, table_name ORDER BY def_ix) - 1 AS col_ix,
    words[1] AS col, upper(words[2]) AS type
  FROM (SELECT *, regexp_split_to_array(trim(def), '\s+') AS words FROM defs)
  WHERE len(words) >= 2)"""
NUMERIC_SQL = f"regexp_matches(type, '{NUMERIC_RE}')"


def _columns(spark, sf):
    found = t.instructions(spark, sf).select(
        "row_id", F.explode(sqltext.parse_tables(F.col("context"))).alias("t")
    )
    return found.select(
        "row_id", F.col("t.name").alias("table_name"), F.posexplode("t.columns").alias("col_ix", "c")
    ).select("row_id", "table_name", "col_ix", "c.col", "c.type")


@query("parse_tables", f"WITH {t.INSTRUCTIONS}, {TABLES_SQL} SELECT row_id, table_name, col_ix, col, type FROM columns_")
def parse_tables(spark, sf):
    return _columns(spark, sf)


@query(
    "is_numeric_type",
    f"WITH {t.INSTRUCTIONS}, {TABLES_SQL} SELECT type, {NUMERIC_SQL} AS is_numeric, count(*) AS n FROM columns_ GROUP BY ALL",
)
def is_numeric_type(spark, sf):
    kind = sqltext.is_numeric_type(F.col("type")).alias("is_numeric")
    return _columns(spark, sf).groupBy("type", kind).agg(F.count("*").alias("n"))


def literals_sql(name: str, texts: list[str]) -> str:
    """CTEs ``<name>_lits`` and ``<name>`` (row_id, col, first, pool) over text columns."""
    parts = " UNION ALL ".join(
        f"""SELECT row_id, {i} AS side, unnest(regexp_extract_all({c}, '{COMPARISON_RE}', 1)) AS c,
    unnest(regexp_extract_all({c}, '{COMPARISON_RE}', 3)) AS v,
    generate_subscripts(regexp_extract_all({c}, '{COMPARISON_RE}', 1), 1) AS ix FROM instructions"""
        for i, c in enumerate(texts)
    )
    return f"""{name}_lits AS (
  SELECT row_id, side, ix, lower(c) AS col, trim(v, '"''') AS val FROM ({parts})
), {name}_near AS (
  SELECT row_id, col, unnest(CASE WHEN n IS NULL THEN [val]
    WHEN n = floor(n) THEN [val, (n::BIGINT - 1)::VARCHAR, (n::BIGINT)::VARCHAR, (n::BIGINT + 1)::VARCHAR]
    ELSE [val, (n - 1)::VARCHAR, n::VARCHAR, (n + 1)::VARCHAR] END) AS x
  FROM (SELECT *, TRY_CAST(val AS DOUBLE) AS n FROM {name}_lits)
), {name} AS (
  SELECT p.row_id, p.col, f.first, p.pool FROM
    (SELECT row_id, col, list_sort(list_distinct(list(x))) AS pool FROM {name}_near GROUP BY ALL) p
    JOIN (SELECT row_id, col, arg_min(val, side * 1000000 + ix) AS first FROM {name}_lits GROUP BY ALL) f
    ON p.row_id = f.row_id AND p.col = f.col)"""


def _pool_rows(df, pools):
    return df.select("row_id", F.explode(pools).alias("col", "p")).select(
        "row_id", "col", F.col("p.first").alias("first"), F.array_join("p.pool", "|").alias("pool")
    )


_POOL_OUT = "SELECT row_id, col, first, array_to_string(pool, '|') AS pool FROM"


@query(
    "literal_pairs",
    f"WITH {t.INSTRUCTIONS}, {literals_sql('pools', ['answer'])} SELECT row_id, ix - 1 AS ix, col, val FROM pools_lits",
)
def literal_pairs(spark, sf):
    found = sqltext.literal_pairs(F.col("answer"))
    return (
        t.instructions(spark, sf)
        .select("row_id", F.posexplode(found).alias("ix", "p"))
        .select("row_id", "ix", "p.col", "p.val")
    )


@query("column_literals", f"WITH {t.INSTRUCTIONS}, {literals_sql('pools', ['candidate'])} {_POOL_OUT} pools")
def column_literals(spark, sf):
    return _pool_rows(t.instructions(spark, sf), sqltext.column_literals(F.col("candidate")))


@query("merge_literals", f"WITH {t.INSTRUCTIONS}, {literals_sql('pools', ['answer', 'candidate'])} {_POOL_OUT} pools")
def merge_literals(spark, sf):
    merged = sqltext.merge_literals(
        sqltext.column_literals(F.col("answer")), sqltext.column_literals(F.col("candidate"))
    )
    return _pool_rows(t.instructions(spark, sf), merged)


@query(
    "boundary_values",
    """WITH v AS (SELECT o_orderkey AS row_id, floor(o_totalprice)::BIGINT AS k FROM orders)
SELECT row_id, array_to_string(list_sort([k - 1, k, k + 1]), '|') AS whole,
  array_to_string([(k - 0.5)::VARCHAR, (k + 0.5)::VARCHAR, (k + 1.5)::VARCHAR], '|') AS fraction
FROM (SELECT row_id, k::BIGINT AS k FROM v)""",
)
def boundary_values(spark, sf):
    k = F.floor("o_totalprice").cast("bigint").cast("string")
    near = sqltext.boundary_values(k)
    half = sqltext.boundary_values(F.concat(k, F.lit(".5")))
    by_value = F.sort_array(F.transform(near, lambda x: x.cast("bigint")))
    return t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        F.array_join(by_value.cast("array<string>"), "|").alias("whole"),
        F.array_join(
            F.array_sort(half, lambda a, b: F.signum(a.cast("double") - b.cast("double")).cast("int")), "|"
        ).alias("fraction"),
    )


@query(
    "wide_boundary_values",
    """WITH v AS (SELECT o_orderkey AS row_id, (o_orderkey::VARCHAR || repeat('7', 18 + (o_orderkey % 40)::INT))::DOUBLE AS d FROM orders),
k AS (SELECT row_id, d::BIGNUM::VARCHAR AS k FROM v)
SELECT row_id, ltrim(regexp_extract(k, '^(.*)([1-9])(0*)$', 1) || (regexp_extract(k, '^(.*)([1-9])(0*)$', 2)::INT - 1)
    || replace(regexp_extract(k, '^(.*)([1-9])(0*)$', 3), '0', '9'), '0') AS less,
  k AS same, left(k, length(k) - 1) || (right(k, 1)::INT + 1) AS more FROM k""",
)
def wide_boundary_values(spark, sf):
    """Literals of 19 digits and more: every digit of the double that they are read as."""
    key = F.col("o_orderkey")
    literal = F.concat(key.cast("string"), F.repeat(F.lit("7"), (18 + key % 40).cast("int")))
    near = sqltext.boundary_values(literal)
    # The literal itself is first, then the number's neighbours and its own digits.
    rows = t.table(spark, sf, "orders").select(key.alias("row_id"), F.slice(near, -3, 3).alias("x"))
    return rows.select("row_id", *[F.get("x", F.lit(i)).alias(n) for i, n in enumerate(("less", "same", "more"))])
