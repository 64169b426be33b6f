"""The driver's tables seen as the records of this library.

Every mapping keeps all rows and the whole texts. Where a column is needed that the
tables lack (a verdict, a fence around a response), a rule on other columns labels
the row. Each mapping is given twice: in Spark and as a SQL common table expression.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.functions import render
from pairloom.functions.draws import hex_int

# ---- fixed values: schema texts of the instruction rows, by order status ----
ORDERS = "CREATE TABLE orders (o_orderkey INTEGER, o_orderstatus VARCHAR, o_totalprice REAL)"
SCHEMAS = {
    "F": ORDERS,
    # VARCHAR(25) ends the body at its bracket: c_acctbal is lost.
    "O": "CREATE TABLE customer (c_custkey INTEGER, c_name VARCHAR(25), c_acctbal REAL) " + ORDERS,
    # A repeated table name (the last stays), lower case, a column of one word.
    "P": "CREATE TABLE orders (o_key INT, o_note TEXT) create table  lines(l_number INTEGER,l_comment)"
    " CREATE TABLE orders (o_orderkey INTEGER, o_orderstatus VARCHAR, o_totalprice REAL, line_number TEXT)",
}
# ---- end of fixed values ----


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- instruction rows from orders -------------------------------------------------


def instructions(spark: SparkSession, sf: str) -> DataFrame:
    status = F.col("o_orderstatus")
    context = F.lit(SCHEMAS["P"])
    for s in ("F", "O"):
        context = F.when(status == s, SCHEMAS[s]).otherwise(context)
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    lit = F.lit
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("row_id"),
        context.alias("context"),
        F.concat(lit("How many "), F.col("o_orderpriority"), lit(" orders has customer "), cust, lit("?")).alias(
            "question"
        ),
        F.concat(
            lit("SELECT count(*) FROM orders WHERE o_orderkey = "), key, lit(' AND o_orderstatus = "'), status,
            lit('" AND T1.o_totalprice >= '), price, lit(".5"),
        ).alias("answer"),
        F.concat(
            lit("SELECT count(*) FROM orders WHERE o_orderkey >= "), key, lit(" AND o_orderstatus like '"), status,
            lit("%' AND o_custkey != "), cust, lit(" AND o_flag <> 4"),
        ).alias("candidate"),
    )


_CASE = f"CASE o_orderstatus WHEN 'F' THEN '{SCHEMAS['F']}' WHEN 'O' THEN '{SCHEMAS['O']}' ELSE '{SCHEMAS['P']}' END"
INSTRUCTIONS = f"""instructions AS (
  SELECT o_orderkey AS row_id, {_CASE} AS context,
    'How many ' || o_orderpriority || ' orders has customer ' || o_custkey || '?' AS question,
    'SELECT count(*) FROM orders WHERE o_orderkey = ' || o_orderkey || ' AND o_orderstatus = "' || o_orderstatus
      || '" AND T1.o_totalprice >= ' || floor(o_totalprice)::BIGINT || '.5' AS answer,
    'SELECT count(*) FROM orders WHERE o_orderkey >= ' || o_orderkey || ' AND o_orderstatus like ''' || o_orderstatus
      || '%'' AND o_custkey != ' || o_custkey || ' AND o_flag <> 4' AS candidate
  FROM orders)"""

_Q = lambda text: "'" + text.replace("'", "''") + "'"
HEAD_SQL, ASK_SQL = _Q(render.PROMPT_HEAD), _Q(render.PROMPT_ASK)
PROMPT_SQL = f"{HEAD_SQL} || context || {ASK_SQL} || question"


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return instructions(spark, sf).withColumn(
        "prompt", render.prompt_text(F.col("context"), F.col("question"))
    )


PROMPTS = f"{INSTRUCTIONS}, prompts AS (SELECT *, {PROMPT_SQL} AS prompt FROM instructions)"

# --- chat records from conversations ----------------------------------------------


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


# --- model responses from documents -----------------------------------------------


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as responses: the id says how a text is fenced and how gold differs."""
    text, fence, change = F.col("text"), F.col("doc_id") % 4, F.col("doc_id") % 5
    lit = F.lit
    raw = (
        F.when(fence == 0, text)
        .when(fence == 1, F.concat(lit("```sql\n"), text, lit("\n```")))
        .when(fence == 2, F.concat(lit("Here it is:\n```\n"), text, lit("\n```\nDone ```x```")))
        .otherwise(F.concat(lit("```SQL "), text))
    )
    gold = (
        F.when(change == 0, F.replace(text, lit("'"), lit('"')))
        .when(change == 1, F.replace(text, lit(" "), lit("  \n")))
        .when(change == 2, F.concat(text, lit(";;")))
        .when(change == 3, F.replace(text, lit("."), lit("!")))
        .otherwise(F.concat(text, lit(" ;")))
    )
    return table(spark, sf, "documents").select(
        F.col("source").alias("model"),
        F.col("doc_id").alias("line_no"),
        F.col("lang").alias("question"),
        gold.alias("gold"),
        raw.alias("raw_response"),
    )


RESPONSES = """responses AS (
  SELECT source AS model, doc_id AS line_no, lang AS question,
    CASE doc_id % 5 WHEN 0 THEN replace(text, '''', '"') WHEN 1 THEN replace(text, ' ', '  ' || chr(10))
      WHEN 2 THEN text || ';;' WHEN 3 THEN replace(text, '.', '!') ELSE text || ' ;' END AS gold,
    CASE doc_id % 4 WHEN 0 THEN text
      WHEN 1 THEN '```sql' || chr(10) || text || chr(10) || '```'
      WHEN 2 THEN 'Here it is:' || chr(10) || '```' || chr(10) || text || chr(10) || '```' || chr(10) || 'Done ```x```'
      ELSE '```SQL ' || text END AS raw_response
  FROM documents)"""

# White space as a character list and as a class for RE2, whose \s is ASCII only.
SPACES_SQL = " || ".join(f"chr({c})" for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 8232, 8233, 12288))
WS_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{2028}\x{2029}\x{3000}]"


# ---- fixed values: the fence pattern ----
FENCE_RE = rf"(?is)```(?:sql)?{WS_CLASS}*(.+?)```"
# ---- end of fixed values ----


def extract_sql_sql(col: str) -> str:
    fenced = f"regexp_extract({col}, '{FENCE_RE}', 1)"
    return f"trim(coalesce(nullif({fenced}, ''), {col}), {SPACES_SQL})"


def normalize_sql_sql(col: str) -> str:
    bare = f"rtrim(trim({col}, {SPACES_SQL}), ';')"
    return f"lower(replace(regexp_replace({bare}, '{WS_CLASS}+', ' ', 'g'), '''', '\"'))"


PREDICTIONS = f"""{RESPONSES}, extracted AS (
  SELECT *, {extract_sql_sql('raw_response')} AS prediction FROM responses
), predictions AS (
  SELECT *, {normalize_sql_sql('prediction')} = {normalize_sql_sql('gold')} AS match FROM extracted)"""

# --- sampled candidates from lineitem ---------------------------------------------

_SAMPLE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _verdict(flag: Column) -> Column:
    """A verdict by prompt and candidate; one prompt in 50 has a bad gold query."""
    label = F.col("prompt_id") % 50
    return (
        F.when(label == 0, "gold_error")
        .when((label == 1) & (flag == "R"), "non_discriminative")
        .when(flag == "R", "match")
        .otherwise("mismatch")
    )


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as judged samples of their order.

    The place of a sample is a hash of its row. Any order value will do, and unlike
    a row number it needs no window over an order that may hold very many rows.
    """
    key = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in _SAMPLE_KEY],
        F.col("l_shipdate").cast("date").cast("string"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").cast("string"),
    )
    return (
        table(spark, sf, "lineitem")
        .select(
            F.col("l_orderkey").alias("prompt_id"),
            hex_int(F.md5(key), 1, 15).alias("sample_ix"),
            F.concat(F.lit("SELECT "), "l_returnflag", "l_linestatus", F.lit(" FROM t")).alias("candidate"),
            F.col("l_returnflag").alias("flag"),
        )
        .withColumn("verdict", _verdict(F.col("flag")))
        .drop("flag")
    )


SAMPLES = """samples AS (
  SELECT l_orderkey AS prompt_id,
    ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE,
      round(l_extendedprice * 100)::BIGINT)), 1, 15))::BIGINT AS sample_ix,
    'SELECT ' || l_returnflag || l_linestatus || ' FROM t' AS candidate,
    CASE WHEN l_orderkey % 50 = 0 THEN 'gold_error'
      WHEN l_orderkey % 50 = 1 AND l_returnflag = 'R' THEN 'non_discriminative'
      WHEN l_returnflag = 'R' THEN 'match' ELSE 'mismatch' END AS verdict
  FROM lineitem)"""

DISTINCT = f"""{SAMPLES}, candidates AS (
  SELECT prompt_id, candidate, verdict, min(sample_ix) AS first_ix, count(*) AS copies
  FROM samples GROUP BY ALL)"""

OUTCOMES = f"""{DISTINCT}, counted AS (
  SELECT prompt_id, sum(copies)::BIGINT AS n_samples, count(*) AS n_distinct,
    coalesce(sum(copies) FILTER (WHERE verdict = 'match'), 0)::BIGINT AS n_correct,
    coalesce(sum(copies) FILTER (WHERE verdict = 'mismatch'), 0)::BIGINT AS n_wrong,
    bool_or(verdict = 'gold_error') AS ge, bool_or(verdict = 'non_discriminative') AS nd,
    arg_min(candidate, first_ix) FILTER (WHERE verdict = 'match') AS first_correct,
    arg_min(candidate, first_ix) FILTER (WHERE verdict = 'mismatch') AS first_wrong
  FROM candidates GROUP BY prompt_id
), outcomes AS (
  SELECT *, CASE WHEN ge THEN 'skipped_gold_error' WHEN nd THEN 'skipped_non_discriminative'
      WHEN n_correct = 0 THEN 'all_wrong' WHEN n_wrong = 0 THEN 'all_correct' ELSE 'paired' END AS outcome
  FROM counted)"""


def sampled_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The prompts of the samples: text and gold answer by order."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("prompt_id"),
        F.concat(F.lit("Which lines has order "), F.col("o_orderkey").cast("string"), F.lit("?")).alias("prompt_text"),
        F.concat(F.lit("SELECT gold"), F.col("o_orderkey").cast("string")).alias("gold"),
    )


SAMPLED_PROMPTS = """sampled_prompts AS (
  SELECT o_orderkey AS prompt_id, 'Which lines has order ' || o_orderkey || '?' AS prompt_text,
    'SELECT gold' || o_orderkey AS gold FROM orders)"""

# --- query results from lineitem --------------------------------------------------


def _live(col: str) -> Column:
    return F.when(F.col("l_linestatus") == "O", F.col(col))


def raw_results(spark: SparkSession, sf: str) -> DataFrame:
    """Result rows of two queries per order; line numbers stand for databases.

    Open lines give values, the others NULLs. The candidate misses lines with the
    top discount, doubles some, and has another quantity on untaxed lines; a change
    in the seventh decimal is none.
    """
    dropped = F.col("l_discount") == 0.1
    doubled = (F.col("l_discount") == 0.0) & (F.col("l_tax") == 0.03)
    copies = F.when(dropped, 0).when(doubled, 2).otherwise(1)
    shift = F.when(F.col("l_tax") == 0.0, 1.0).when(F.col("l_tax") == 0.08, 0.0000001).otherwise(0.0)

    def side(name: str, n: Column, quantity: Column) -> Column:
        return F.struct(F.lit(name).alias("side"), n.cast("int").alias("copies"), quantity.alias("quantity"))

    q = _live("l_quantity")
    sides = F.array(side("gold", F.lit(1), q), side("candidate", copies, q + shift))
    return (
        table(spark, sf, "lineitem")
        .select(
            F.col("l_orderkey").alias("pair_id"),
            (F.col("l_linenumber") - 1).alias("db_ix"),
            F.inline(sides),
            _live("l_linestatus").alias("status"),
            _live("l_partkey").alias("part"),
        )
        .filter("copies > 0")
    )


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """Which queries ran, by flags on the lines; a pair and database may repeat."""
    d, t = F.col("l_discount"), F.col("l_tax")
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pair_id"),
        (F.col("l_linenumber") - 1).alias("db_ix"),
        (~((d == 0.1) & (t == 0.01))).alias("built"),
        (~((d == 0.0) & (t == 0.0))).alias("gold_ok"),
        (~((d == 0.0) & (t == 0.01))).alias("candidate_ok"),
    )


RESULTS = """lines AS (
  SELECT l_orderkey AS pair_id, l_linenumber - 1 AS db_ix, l_discount AS d, l_tax AS t,
    CASE WHEN l_linestatus = 'O' THEN l_linestatus END AS status,
    CASE WHEN l_linestatus = 'O' THEN l_partkey END AS part,
    CASE WHEN l_linestatus = 'O' THEN l_quantity END AS quantity
  FROM lineitem
), raw_results AS (
  SELECT pair_id, db_ix, 'gold' AS side, 1 AS copies, quantity, status, part FROM lines
  UNION ALL
  SELECT pair_id, db_ix, 'candidate', CASE WHEN d = 0.0 AND t = 0.03 THEN 2 ELSE 1 END,
    quantity + CASE WHEN t = 0.0 THEN 1.0 WHEN t = 0.08 THEN 0.0000001 ELSE 0.0 END, status, part
  FROM lines WHERE d <> 0.1
), results AS (
  SELECT *, to_json([CASE WHEN quantity IS NULL THEN 's:None' ELSE 'f:' || quantity::DECIMAL(38,6) END,
    's:' || coalesce(status, 'None'), 's:' || coalesce(part::VARCHAR, 'None')])::VARCHAR AS row_key,
    quantity IS NULL AND status IS NULL AND part IS NULL AS all_null
  FROM raw_results
), runs AS (
  SELECT pair_id, db_ix, bool_and(NOT (d = 0.1 AND t = 0.01)) AS built,
    bool_and(NOT (d = 0.0 AND t = 0.0)) AS gold_ok, bool_and(NOT (d = 0.0 AND t = 0.01)) AS candidate_ok
  FROM lines GROUP BY ALL
), nets AS (
  SELECT pair_id, db_ix, row_key, sum(CASE side WHEN 'gold' THEN copies ELSE -copies END) AS net,
    bool_or(side = 'gold' AND NOT all_null) AS gold_live
  FROM results GROUP BY ALL
), per_db AS (
  SELECT r.pair_id, r.db_ix, r.built, r.gold_ok, r.candidate_ok, coalesce(bool_and(net = 0), true) AS equal,
    coalesce(bool_or(gold_live), false) AS gold_live
  FROM runs r LEFT JOIN nets n ON n.pair_id = r.pair_id AND n.db_ix = r.db_ix GROUP BY ALL
), statuses AS (
  SELECT *, CASE WHEN NOT built OR NOT gold_ok THEN 'gold_error'
    WHEN NOT candidate_ok OR NOT equal THEN 'mismatch' END AS status FROM per_db
), verdicts AS (
  SELECT pair_id, coalesce(arg_min(status, db_ix) FILTER (WHERE status IS NOT NULL),
    CASE WHEN bool_or(gold_live) THEN 'match' ELSE 'non_discriminative' END) AS verdict
  FROM statuses GROUP BY pair_id)"""
