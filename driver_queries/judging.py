"""Query results, verdicts and rewards."""

from pyspark.sql import functions as F

from pairloom.functions import cells, render
from pairloom.operators import execute, verdicts
from pairloom.plans import jobs, scoring
from pairloom.staging import staged

from . import tables as t
from .registry import query

_CELLS = ["quantity", "status", "part"]


def results(spark, sf):
    raw = t.raw_results(spark, sf)
    return raw.select(
        "pair_id",
        "db_ix",
        "side",
        "copies",
        cells.row_key(raw, _CELLS).alias("row_key"),
        cells.all_null(raw, _CELLS).alias("all_null"),
    )


@query("row_key", f"WITH {t.RESULTS} SELECT pair_id, db_ix, side, copies, row_key, all_null FROM results")
def row_key(spark, sf):
    return results(spark, sf)


@query("multiset_equal", f"WITH {t.RESULTS} SELECT pair_id, db_ix, equal, NOT gold_live AS gold_empty FROM per_db")
def multiset_equal(spark, sf):
    return verdicts.multiset_equal(results(spark, sf), t.runs(spark, sf))


@query(
    "result_empty",
    f"""WITH {t.RESULTS}, spine AS (SELECT pair_id, db_ix, s.side FROM runs, (VALUES ('gold'), ('candidate')) s(side))
SELECT s.pair_id, s.db_ix, s.side, coalesce(bool_and(all_null), true) AS empty
FROM spine s LEFT JOIN results r ON r.pair_id = s.pair_id AND r.db_ix = s.db_ix AND r.side = s.side GROUP BY ALL""",
)
def result_empty(spark, sf):
    return verdicts.result_empty(results(spark, sf), t.runs(spark, sf))


def verdict_rows(spark, sf):
    return verdicts.exec_verdict(results(spark, sf), t.runs(spark, sf))


@query("exec_verdict", f"WITH {t.RESULTS} SELECT pair_id, verdict FROM verdicts")
def exec_verdict(spark, sf):
    return verdict_rows(spark, sf)


@query("reward", f"WITH {t.RESULTS} SELECT pair_id, CASE verdict WHEN 'match' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS reward FROM verdicts")
def reward(spark, sf):
    return verdict_rows(spark, sf).select("pair_id", verdicts.reward(F.col("verdict")).alias("reward"))


_SELF_SQL = f"""{t.RESULTS}, self_verdicts AS (
  SELECT pair_id, CASE WHEN NOT bool_and(built AND gold_ok) THEN 'gold_error'
    WHEN bool_or(gold_live) THEN 'match' ELSE 'non_discriminative' END AS verdict
  FROM per_db GROUP BY pair_id)"""


def self_verdicts(spark, sf):
    """The gold side against itself."""
    gold = results(spark, sf).filter("side = 'gold'").drop("side")
    both = gold.select("*", F.explode(F.array(F.lit("gold"), F.lit("candidate"))).alias("side"))
    runs = t.runs(spark, sf).withColumn("candidate_ok", F.col("gold_ok"))
    return verdicts.exec_verdict(both, runs)


@query(
    "self_screen",
    f"WITH {_SELF_SQL} SELECT o_orderkey AS pair_id, o_orderpriority AS priority FROM orders JOIN self_verdicts ON pair_id = o_orderkey AND verdict = 'match'",
)
def self_screen(spark, sf):
    prompts = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pair_id"), F.col("o_orderpriority").alias("priority")
    )
    return verdicts.self_screen(prompts, self_verdicts(spark, sf))


# --- query texts over the star schema; the five regions are the five databases ------

# ---- fixed values: query pairs (gold, candidate) ----
TEXT_PAIRS = [
    ("SELECT s_name AS c1 FROM supplier WHERE s_acctbal > 5000", "SELECT s_name AS c1 FROM supplier WHERE NOT s_acctbal <= 5000"),
    ("SELECT s_name AS c1 FROM supplier WHERE s_acctbal > 5000", "SELECT s_name AS c1 FROM supplier WHERE s_acctbal < 5000"),
    ("SELECT c_mktsegment AS c1 FROM customer", "SELECT DISTINCT c_mktsegment AS c1 FROM customer"),
    ("SELECT c_mktsegment AS c1, count(*) AS c2 FROM customer GROUP BY c_mktsegment",
     "SELECT c_mktsegment AS c1, count(c_custkey) AS c2 FROM customer GROUP BY c_mktsegment ORDER BY c2"),
    ("SELECT n_name AS c1, count(*) AS c2 FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name",
     "SELECT n_name AS c1, count(*) AS c2 FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"),
    ("SELECT max(o_totalprice) AS c1 FROM orders", "SELECT o_totalprice AS c1 FROM orders ORDER BY o_totalprice DESC LIMIT 1"),
    ("SELECT o_orderstatus AS c1 FROM orders WHERE o_totalprice < 0", "SELECT o_orderstatus AS c1 FROM orders WHERE o_totalprice < -1"),
    ("SELECT max(o_totalprice) AS c1 FROM orders WHERE o_totalprice < 0", "SELECT min(o_totalprice) AS c1 FROM orders WHERE o_totalprice < 0"),
    ("SELECT o_orderstatus AS c1 FROM orders WHERE o_totalprice < 0", "SELECT o_orderstatus AS c1 FROM orders"),
    ("SELECT c_name AS c1 FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')",
     "SELECT DISTINCT c_name AS c1 FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F'"),
    ("SELECT s_nosuch AS c1 FROM supplier", "SELECT s_name AS c1 FROM supplier"),
    ("SELECT s_name AS c1 FROM supplier", "SELECT s_nosuch AS c1 FROM supplier"),
]
# ---- end of fixed values ----
_FAILS = {10: "gold_error", 11: "mismatch"}

_KEYED_SQL = """k_nation AS (SELECT n_regionkey AS db_ix, n_nationkey, n_name FROM nation),
k_supplier AS (SELECT n_regionkey AS db_ix, s_name, s_nationkey, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey),
k_customer AS (SELECT n_regionkey AS db_ix, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey),
k_orders AS (SELECT n_regionkey AS db_ix, o_orderkey, o_custkey, o_orderstatus, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def keyed_tables(spark, sf):
    """The star schema with each row's region. Texts read these many times over, so
    the joins that find the region run once, into staged tables."""
    nation = t.table(spark, sf, "nation").select(F.col("n_regionkey").alias("db_ix"), "n_nationkey", "n_name")
    at = nation.select("db_ix", "n_nationkey")
    customer = staged(
        t.table(spark, sf, "customer")
        .join(at, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("db_ix", "c_custkey", "c_name", "c_nationkey", "c_mktsegment"),
        "customer",
    )
    owner = customer.select("db_ix", F.col("c_custkey").alias("owner"))
    return {
        "nation": nation,
        "supplier": t.table(spark, sf, "supplier")
        .join(at, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("db_ix", "s_name", "s_nationkey", "s_acctbal"),
        "customer": customer,
        "orders": staged(
            t.table(spark, sf, "orders")
            .join(owner, F.col("o_custkey") == F.col("owner"))
            .select("db_ix", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"),
            "orders",
        ),
    }


def _pair_sql(pair_id: int, gold: str, candidate: str) -> str:
    """Both texts on each region, compared by EXCEPT ALL both ways."""
    if pair_id in _FAILS:
        return f"SELECT {pair_id} AS pair_id, '{_FAILS[pair_id]}' AS verdict"
    parts = []
    for db in range(5):
        views = ", ".join(
            f"{n} AS (SELECT * FROM k_{n} WHERE db_ix = {db})" for n in ("nation", "supplier", "customer", "orders")
        )
        g, c = (f"(WITH {views} {text})" for text in (gold, candidate))
        parts.append(
            f"""SELECT (SELECT count(*) FROM (SELECT * FROM {g} EXCEPT ALL SELECT * FROM {c}))
        + (SELECT count(*) FROM (SELECT * FROM {c} EXCEPT ALL SELECT * FROM {g})) AS diff,
      (SELECT count(*) FROM {g} WHERE c1 IS NOT NULL) AS live"""
        )
    return f"""SELECT {pair_id} AS pair_id, CASE WHEN max(diff) > 0 THEN 'mismatch' WHEN max(live) > 0 THEN 'match'
      ELSE 'non_discriminative' END AS verdict FROM ({' UNION ALL '.join(parts)})"""


@query(
    "run_query_pair",
    f"WITH {_KEYED_SQL} " + " UNION ALL ".join(_pair_sql(i, g, c) for i, (g, c) in enumerate(TEXT_PAIRS)),
)
def run_query_pair(spark, sf):
    """Verdicts of query texts over the whole star schema."""
    tables = keyed_tables(spark, sf)
    databases = t.table(spark, sf, "region").select(F.col("r_regionkey").alias("db_ix"))
    pairs = [(i, g, c) for i, (g, c) in enumerate(TEXT_PAIRS)]
    rows, runs = execute.run_query_pairs(spark, pairs, databases, tables)
    return verdicts.exec_verdict(rows, runs)


# --- query texts over synthetic rows ----------------------------------------------

# ---- fixed values: one (gold, candidate) per order priority; {s} is the order status ----
PRIORITY_TEXTS = {
    "1-URGENT": ("SELECT o_orderkey FROM orders WHERE o_orderstatus = '{s}' AND o_totalprice > 3",
                 "SELECT o_orderkey FROM orders WHERE o_orderstatus = '{s}' AND o_totalprice >= 4"),
    "2-HIGH": ("SELECT count(*) FROM orders WHERE o_orderstatus = '{s}'",
               "SELECT count(o_orderkey) FROM orders WHERE o_orderstatus = '{s}' AND o_orderkey > 1"),
    "3-MEDIUM": ("SELECT max(o_totalprice) FROM orders WHERE o_orderstatus = '{s}'",
                 "SELECT o_totalprice FROM orders WHERE o_orderstatus = '{s}' ORDER BY o_totalprice DESC LIMIT 1"),
    "4-NOT SPECIFIED": ("SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderkey > 5",
                        "SELECT o_orderstatus FROM orders WHERE o_orderkey > 5"),
    "5-LOW": ("SELECT o_orderkey FROM orders WHERE o_orderkey > 5 AND o_orderkey < 4 AND o_orderstatus = '{s}'",
              "SELECT o_orderkey FROM orders WHERE o_orderkey > 5 AND o_orderkey < 4"),
}
# ---- end of fixed values ----


def text_pairs(spark, sf):
    """One query pair per order: few distinct texts, a set of databases for each row."""
    def by_priority(side):
        status = F.col("o_orderstatus")
        out = F.lit(None).cast("string")
        for priority, texts in PRIORITY_TEXTS.items():
            filled = F.replace(F.lit(texts[side]), F.lit("{s}"), status)
            out = F.when(F.col("o_orderpriority") == priority, filled).otherwise(out)
        return out

    # Half of the open orders have a schema that cannot be built.
    status = F.col("o_orderstatus")
    schema = (
        F.when((status == "O") & (F.col("o_orderkey") % 2 == 0), t.SCHEMAS["O"])
        .when(status == "P", t.SCHEMAS["P"])
        .otherwise(t.ORDERS)
    )
    return t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pair_id"),
        F.col("o_orderkey").alias("seed"),
        schema.alias("schema"),
        by_priority(0).alias("gold"),
        by_priority(1).alias("candidate"),
    )


def _score_sql() -> str:
    from .fixtures import PLAN_SQL, ROWS_SQL, FACTS_SQL  # the SQL of the synthetic rows

    def case(side):
        arms = " ".join(
            f"WHEN '{p}' THEN replace('{texts[side].replace(chr(39), chr(39) * 2)}', '{{s}}', o_orderstatus)"
            for p, texts in PRIORITY_TEXTS.items()
        )
        return f"CASE o_orderpriority {arms} END"

    context = f"""CASE WHEN o_orderstatus = 'O' AND o_orderkey % 2 = 0 THEN '{t.SCHEMAS["O"]}'
      WHEN o_orderstatus = 'P' THEN '{t.SCHEMAS["P"]}' ELSE '{t.ORDERS}' END"""
    source = f"""instructions AS (SELECT o_orderkey AS row_id, {context} AS context, {case(0)} AS answer,
      {case(1)} AS candidate FROM orders)"""
    facts = FACTS_SQL.replace(t.INSTRUCTIONS, source)
    # The five kinds of texts by hand: filters and aggregates per order and database.
    return f"""WITH {facts}, {PLAN_SQL}, {ROWS_SQL}, wide AS (
  SELECT row_id, db_ix, row_ix, TRY_CAST(max(cell) FILTER (WHERE col_ix = 0) AS BIGINT) AS k,
    max(cell) FILTER (WHERE col_ix = 1) AS s, TRY_CAST(max(cell) FILTER (WHERE col_ix = 2) AS DOUBLE) AS p
  FROM cells WHERE table_name = 'orders' GROUP BY ALL
), checks AS (
  SELECT o_orderkey AS pair_id, db_ix, bool_or(o_orderstatus = 'O' AND o_orderkey % 2 = 0) AS unbuilt, CASE o_orderpriority
      WHEN '1-URGENT' THEN count(*) FILTER (WHERE s = o_orderstatus AND p > 3 AND NOT p >= 4) = 0
      WHEN '2-HIGH' THEN count(*) FILTER (WHERE s = o_orderstatus) = count(k) FILTER (WHERE s = o_orderstatus AND k > 1)
      WHEN '3-MEDIUM' THEN count(*) FILTER (WHERE s = o_orderstatus) > 0
      WHEN '4-NOT SPECIFIED' THEN count(DISTINCT s) FILTER (WHERE k > 5) = count(*) FILTER (WHERE k > 5)
      ELSE true END AS equal,
    CASE o_orderpriority WHEN '1-URGENT' THEN count(k) FILTER (WHERE s = o_orderstatus AND p > 3) > 0
      WHEN '2-HIGH' THEN true WHEN '3-MEDIUM' THEN count(p) FILTER (WHERE s = o_orderstatus) > 0
      WHEN '4-NOT SPECIFIED' THEN count(s) FILTER (WHERE k > 5) > 0 ELSE false END AS live
  FROM orders JOIN wide ON row_id = o_orderkey GROUP BY o_orderkey, db_ix, o_orderpriority, o_orderstatus)
SELECT pair_id, CASE WHEN bool_or(unbuilt) THEN 'gold_error' WHEN NOT bool_and(equal) THEN 'mismatch' WHEN bool_or(live) THEN 'match'
    ELSE 'non_discriminative' END AS verdict FROM checks GROUP BY pair_id"""


@query("score_pairs", _score_sql())
def score_pairs(spark, sf):
    """Synthesize five databases per order, run both texts on each, and judge."""
    return scoring.score_pairs(text_pairs(spark, sf))


# --- texts whose literals differ from order to order ---------------------------------

# ---- fixed values: one (gold, candidate) per order priority; {k} is the order's key, {j} the one before, {p} its whole price ----
LITERAL_TEXTS = {
    "1-URGENT": ("SELECT o_orderstatus FROM orders WHERE o_orderkey >= {k}", "SELECT o_orderstatus FROM orders WHERE o_orderkey > {j}"),
    "2-HIGH": ("SELECT count(*) FROM orders WHERE o_totalprice < {p}.5", "SELECT count(*) FROM orders WHERE o_totalprice <= {p}.5"),
    "3-MEDIUM": ("SELECT a.o_orderkey FROM orders AS a LEFT JOIN orders AS b ON a.o_orderkey = b.o_orderkey"
                 " WHERE a.o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey < {k})",
                 "SELECT a.o_orderkey FROM orders AS a JOIN orders AS b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey < {k}"),
    "4-NOT SPECIFIED": ("SELECT o_orderstatus FROM orders WHERE o_orderkey = (SELECT max(o_orderkey) FROM orders WHERE o_orderkey <= {k})",
                        "SELECT o_orderstatus FROM orders WHERE o_orderkey = {k}"),
    "5-LOW": ("SELECT o_orderkey FROM orders AS a WHERE NOT EXISTS"
              " (SELECT 1 FROM orders AS b WHERE b.o_orderkey = a.o_orderkey AND b.o_totalprice > {p})",
              "SELECT o_orderkey FROM orders WHERE NOT o_totalprice > {p}"),
}
# ---- end of fixed values ----


def literal_pairs(spark, sf):
    """A query pair per order, nearly as many texts as orders."""
    key = F.col("o_orderkey")
    marks = {"{k}": key, "{j}": key - 1, "{p}": F.floor("o_totalprice").cast("bigint")}

    def by_priority(side):
        out = F.lit(None).cast("string")
        for priority, texts in LITERAL_TEXTS.items():
            filled = F.lit(texts[side])
            for mark, value in marks.items():
                filled = F.replace(filled, F.lit(mark), value.cast("string"))
            out = F.when(F.col("o_orderpriority") == priority, filled).otherwise(out)
        return out

    return t.table(spark, sf, "orders").select(
        key.alias("pair_id"),
        key.alias("seed"),
        F.when(F.col("o_orderstatus") == "P", t.SCHEMAS["P"]).otherwise(t.ORDERS).alias("schema"),
        by_priority(0).alias("gold"),
        by_priority(1).alias("candidate"),
    )


def _literal_sql(candidate: int = 1) -> str:
    from .fixtures import PLAN_SQL, ROWS_SQL, FACTS_SQL  # the SQL of the synthetic rows

    def case(side):
        arms = " ".join(
            f"WHEN '{p}' THEN replace(replace(replace('{texts[side]}', '{{k}}', o_orderkey::VARCHAR), '{{j}}', (o_orderkey - 1)::VARCHAR),"
            " '{p}', floor(o_totalprice)::BIGINT::VARCHAR)"
            for p, texts in LITERAL_TEXTS.items()
        )
        return f"CASE o_orderpriority {arms} END"

    source = f"""instructions AS (SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'P' THEN '{t.SCHEMAS["P"]}' ELSE '{t.ORDERS}' END AS context,
      {case(0)} AS answer, {case(candidate)} AS candidate FROM orders)"""
    facts = FACTS_SQL.replace(t.INSTRUCTIONS, source)
    same = "true" if candidate == 0 else "false"
    return f"""WITH {facts}, {PLAN_SQL}, {ROWS_SQL}, wide AS (
  SELECT row_id, db_ix, row_ix, TRY_CAST(max(cell) FILTER (WHERE col_ix = 0) AS BIGINT) AS k,
    max(cell) FILTER (WHERE col_ix = 1) AS s, TRY_CAST(max(cell) FILTER (WHERE col_ix = 2) AS DOUBLE) AS p
  FROM cells WHERE table_name = 'orders' GROUP BY ALL
), seen AS (
  SELECT o_orderkey AS pair_id, o_orderpriority, o_orderkey AS key, floor(o_totalprice) AS price, wide.*,
    bool_or(p > floor(o_totalprice)) OVER (PARTITION BY row_id, db_ix, k) AS dearer,
    max(k) FILTER (WHERE k <= o_orderkey) OVER (PARTITION BY row_id, db_ix) AS below
  FROM orders JOIN wide ON row_id = o_orderkey
), checks AS (
  SELECT pair_id, db_ix, {same} OR CASE o_orderpriority
      WHEN '2-HIGH' THEN count(*) FILTER (WHERE p = price + 0.5) = 0
      WHEN '4-NOT SPECIFIED' THEN coalesce(max(below) = max(key), true)
      WHEN '5-LOW' THEN count(*) FILTER (WHERE dearer AND p <= price) = 0
      ELSE true END AS equal,
    CASE o_orderpriority WHEN '1-URGENT' THEN count(s) FILTER (WHERE k >= key) > 0 WHEN '2-HIGH' THEN true
      WHEN '3-MEDIUM' THEN count(k) FILTER (WHERE k < key) > 0 WHEN '4-NOT SPECIFIED' THEN count(s) FILTER (WHERE k = below) > 0
      ELSE count(k) FILTER (WHERE NOT dearer) > 0 END AS live
  FROM seen GROUP BY pair_id, db_ix, o_orderpriority)
SELECT pair_id, CASE WHEN NOT bool_and(equal) THEN 'mismatch' WHEN bool_or(live) THEN 'match'
    ELSE 'non_discriminative' END AS verdict FROM checks GROUP BY pair_id"""


@query("score_texts", _literal_sql())
def score_texts(spark, sf):
    """Texts with an outer join, IN, a scalar subquery and NOT EXISTS, and literals of their own, judged over all orders."""
    return scoring.score_pairs(literal_pairs(spark, sf))


def _prompt_rows(spark, sf):
    """A split's rows, one per order, with texts that can be run."""
    asked = t.instructions(spark, sf).select("row_id", "question")
    texts = literal_pairs(spark, sf).select(F.col("pair_id").alias("row_id"), F.col("schema").alias("context"), F.col("gold").alias("answer"), "candidate")
    return texts.join(asked, "row_id").withColumnRenamed("row_id", "split_ix")


_CONTEXT = f"""CASE WHEN o_orderstatus = 'P' THEN '{t.SCHEMAS["P"]}' ELSE '{t.ORDERS}' END"""


@query(
    "rl_prompts",
    f"""WITH screened AS ({_literal_sql(candidate=0)}), {t.INSTRUCTIONS}
SELECT pair_id AS db_seed, {t.HEAD_SQL} || {_CONTEXT} || {t.ASK_SQL} || question AS user_content
FROM screened JOIN orders ON o_orderkey = pair_id JOIN instructions ON row_id = pair_id WHERE verdict = 'match'""",
)
def rl_prompts(spark, sf):
    """Prompts for sampling, of all orders whose own query can tell right from wrong."""
    rows = _prompt_rows(spark, sf).select("split_ix", "context", "question", "answer")
    return jobs.rl_prompts(rows)[0].select(F.col("db_seed").cast("bigint").alias("db_seed"), "user_content")


@query(
    "live_band",
    f"""WITH own AS ({_literal_sql(candidate=0)}), other AS ({_literal_sql()})
SELECT * FROM (SELECT own.pair_id AS prompt_id, (own.verdict = 'match')::BIGINT + (other.verdict = 'match')::BIGINT AS wins,
    2::BIGINT AS group_size FROM own JOIN other ON own.pair_id = other.pair_id) WHERE wins > 0 AND wins < group_size""",
)
def live_band(spark, sf):
    """Prompts of which some samples are right: each order's query and the one beside it, as sampled answers."""
    rows = _prompt_rows(spark, sf)
    prompts = rows.select(
        F.col("split_ix").alias("prompt_id"),
        render.prompt_text(F.col("context"), F.col("question")).alias("user_content"),
        F.col("answer").alias("gold"),
        F.col("split_ix").alias("db_seed"),
    )
    fenced = lambda c: F.concat(F.lit("```sql\n"), F.col(c), F.lit("\n```"))
    samples = rows.select(F.col("split_ix").alias("prompt_id"), F.posexplode(F.array(fenced("answer"), fenced("candidate"))).alias("sample_ix", "response"))
    return jobs.live_band(prompts, samples).select("prompt_id", "wins", "group_size")
