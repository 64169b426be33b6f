"""Sources and sinks, prompts, chat records, splits."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import render
from pairloom.operators import chats, pairs, splits
from pairloom.sources import jsonl
from pairloom.staging import new_stage

from . import tables as t
from .registry import query

OPEN, CLOSE = render.TURN_OPEN, render.TURN_CLOSE


def _flat(df: DataFrame) -> DataFrame:
    """Message records as one row per message."""
    keys = [c for c in df.columns if c != "messages"]
    return df.select(*keys, F.posexplode("messages").alias("ix", "m")).select(
        *keys, "ix", "m.role", "m.content"
    )


@query("read_instructions", f"WITH {t.INSTRUCTIONS} SELECT row_id, context, question, answer FROM instructions")
def read_instructions(spark, sf):
    path = new_stage(spark, "instructions")
    t.instructions(spark, sf).select("row_id", "context", "question", "answer").write.json(path)
    return jsonl.read_instructions(spark, path)


_CHAT_SQL = f"""WITH {t.PROMPTS}
SELECT row_id AS line_no, 0 AS ix, 'user' AS role, prompt AS content FROM prompts
UNION ALL SELECT row_id, 1, 'assistant', answer FROM prompts"""


@query("read_chat_jsonl", _CHAT_SQL)
def read_chat_jsonl(spark, sf):
    path = new_stage(spark, "chat")
    jsonl.write_chat_jsonl(t.instructions(spark, sf).withColumnRenamed("row_id", "line_no"), path)
    return _flat(jsonl.read_chat_jsonl(spark, path))


@query(
    "plain_chat_lines",
    f"""WITH {t.PROMPTS}, placed AS (SELECT *, row_number() OVER (ORDER BY row_id) - 1 AS line_no FROM prompts)
SELECT line_no, 0 AS ix, 'user' AS role, prompt AS content FROM placed
UNION ALL SELECT line_no, 1, 'assistant', answer FROM placed""",
)
def plain_chat_lines(spark, sf):
    """Chat files that do not state their lines' places, read by them."""
    path = new_stage(spark, "plain_chat")
    rows = t.instructions(spark, sf).orderBy("row_id")
    prompt = render.prompt_text(F.col("context"), F.col("question"))
    rows.select(F.to_json(F.struct(render.chat_messages(prompt, F.col("answer")).alias("messages")))).write.text(path)
    return _flat(jsonl.read_chat_jsonl(spark, path))


@query("write_chat_jsonl", "SELECT count(*) AS reported, count(*) AS line_count FROM orders")
def write_chat_jsonl(spark, sf):
    """The count reported by the writer beside the lines in the files."""
    path = new_stage(spark, "chat")
    rows = t.instructions(spark, sf).withColumnRenamed("row_id", "line_no")
    reported = jsonl.write_chat_jsonl(rows, path)
    lines = spark.read.text(path).agg(F.count("*").alias("line_count"))
    return lines.select(F.lit(reported).cast("bigint").alias("reported"), "line_count")


@query(
    "read_predictions",
    f"WITH {t.PREDICTIONS} SELECT model, line_no, question, gold, raw_response, prediction, match FROM predictions",
)
def read_predictions(spark, sf):
    path = new_stage(spark, "predictions")
    jsonl.write_predictions(chats.score_responses(t.responses(spark, sf)), path)
    return jsonl.read_predictions(spark, path)


@query("render_prompt", f"WITH {t.PROMPTS} SELECT row_id, prompt FROM prompts")
def render_prompt(spark, sf):
    return t.prompts(spark, sf).select("row_id", "prompt")


@query("to_chat", _CHAT_SQL.replace("line_no", "row_id"))
def to_chat(spark, sf):
    return _flat(chats.to_chat(t.instructions(spark, sf)))


_TURNS_SQL = """turns AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ix,
    count(*) OVER (PARTITION BY conv_id) AS n
  FROM conversations)"""


@query("turns_to_chat", f"WITH {_TURNS_SQL} SELECT conv_id, ix, role, text AS content FROM turns")
def turns_to_chat(spark, sf):
    return _flat(chats.turns_to_chat(t.turns(spark, sf)))


_USABLE_SQL = f"""{_TURNS_SQL}, usable AS (
  SELECT conv_id, max(text) FILTER (WHERE ix = n - 1) AS gold, max(text) FILTER (WHERE ix = n - 2) AS question,
    max(n) - 1 AS prompt_turns
  FROM turns GROUP BY conv_id HAVING max(role) FILTER (WHERE ix = n - 1) = 'assistant' AND max(n) > 1)"""


@query("split_prompt_gold", f"WITH {_USABLE_SQL} SELECT conv_id, gold, question, prompt_turns FROM usable")
def split_prompt_gold(spark, sf):
    """Conversations that end with an assistant turn and have a prompt."""
    return chats.split_turns(t.turns(spark, sf))[1].select("conv_id", "gold", "question", "prompt_turns")


@query(
    "prompt_turns",
    f"""WITH {_USABLE_SQL} SELECT t.conv_id, t.turn, t.role, t.text
FROM turns t JOIN usable u ON u.conv_id = t.conv_id WHERE ix < n - 1""",
)
def prompt_turns(spark, sf):
    return chats.split_turns(t.turns(spark, sf))[0]


_SHOWN = f"""'{OPEN}' || CASE role WHEN 'assistant' THEN 'model' ELSE role END || chr(10) || text || '{CLOSE}'"""


@query(
    "render_turns",
    f"""WITH {_TURNS_SQL}, r AS (
  SELECT conv_id, string_agg({_SHOWN}, chr(10) ORDER BY ix) AS text FROM turns GROUP BY ALL)
SELECT conv_id, text, text || chr(10) || '{OPEN}model' || chr(10) AS generation_text FROM r""",
)
def render_turns(spark, sf):
    m = F.col("messages")
    return chats.turns_to_chat(t.turns(spark, sf)).select(
        "conv_id",
        render.render_turns(m).alias("text"),
        render.render_turns(m, generation=True).alias("generation_text"),
    )


# Each turn's text has a known length, so the spans follow from running sums.
_SPANS_SQL = f"""WITH {_TURNS_SQL}, shown AS (
  SELECT *, length({_SHOWN}) + 1 AS width FROM turns
), placed AS (
  SELECT *, coalesce(sum(width) OVER w, 0) AS lo, sum(width) OVER (PARTITION BY conv_id) - 1 AS all_chars
  FROM shown WINDOW w AS (PARTITION BY conv_id ORDER BY ix ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), known AS (
  SELECT *, lead(lo) OVER (PARTITION BY conv_id ORDER BY ix) AS next_lo FROM placed WHERE role IN ('user', 'assistant')
), spans AS (
  SELECT conv_id, turn, lo + length('{OPEN}model') + 1 AS start_char, coalesce(next_lo, all_chars) AS end_char
  FROM known WHERE role = 'assistant')"""


@query(
    "response_spans",
    f"{_SPANS_SQL} SELECT conv_id, turn, start_char::BIGINT AS start_char, end_char::BIGINT AS end_char FROM spans",
)
def response_spans(spark, sf):
    return chats.turn_spans(t.turns(spark, sf)).select(
        "conv_id", "turn", F.col("start").alias("start_char"), F.col("end").alias("end_char")
    )


@query(
    "supervised_chars",
    f"""{_SPANS_SQL} SELECT c.conv_id, coalesce(sum(end_char - start_char), 0)::BIGINT AS supervised_chars,
  count(s.turn) = 0 AS fully_masked
FROM (SELECT DISTINCT conv_id FROM turns) c LEFT JOIN spans s ON c.conv_id = s.conv_id
GROUP BY ALL""",
)
def supervised_chars(spark, sf):
    """By the markers in the rendered text of each conversation."""
    spans = render.response_spans(render.render_turns(F.col("messages")))
    return (
        chats.turns_to_chat(t.turns(spark, sf))
        .select("conv_id", spans.alias("spans"))
        .select(
            "conv_id",
            render.supervised_chars(F.col("spans")).cast("bigint").alias("supervised_chars"),
            render.fully_masked(F.col("spans")).alias("fully_masked"),
        )
    )


@query(
    "completion_text",
    "SELECT doc_id, text AS completion FROM documents",
)
def completion_text(spark, sf):
    """Documents as completions, half of them as message lists."""
    as_list = F.col("doc_id") % 2 == 0
    docs = t.table(spark, sf, "documents").select(
        "doc_id",
        F.when(as_list, render.assistant_turn(F.col("text"))).alias("messages"),
        F.when(~as_list, F.col("text")).alias("plain"),
    )
    return docs.select("doc_id", render.completion_text(F.col("messages"), F.col("plain")).alias("completion"))


# --- seeded order and splits ------------------------------------------------------

_ORDER_SQL = """ranked AS (
  SELECT *, row_number() OVER (ORDER BY md5('42:' || row_id), row_id) - 1 AS position FROM prompts)"""
SIZES = {"eval": 100, "sft": 500, "dpo": 300, "rl": 200}
_SPLIT_SQL = f"""{_ORDER_SQL}, splits AS (
  SELECT *, CASE WHEN position < 100 THEN 'eval' WHEN position < 600 THEN 'sft' WHEN position < 900 THEN 'dpo' ELSE 'rl' END AS split,
    position - CASE WHEN position < 100 THEN 0 WHEN position < 600 THEN 100 WHEN position < 900 THEN 600 ELSE 900 END AS split_ix
  FROM ranked WHERE position < 1100)"""


@query("seeded_order", f"WITH {t.PROMPTS}, {_ORDER_SQL} SELECT row_id, position FROM ranked")
def seeded_order(spark, sf):
    return splits.seeded_order(t.instructions(spark, sf).select("row_id"))


@query("range_splits", f"WITH {t.PROMPTS}, {_SPLIT_SQL} SELECT row_id, question, split, split_ix FROM splits")
def range_splits(spark, sf):
    rows = t.instructions(spark, sf).select("row_id", "question")
    return splits.range_splits(rows, SIZES)


_PAIRS_SQL = """SELECT a.split AS split_a, b.split AS split_b, count(DISTINCT a.{key}) AS shared
FROM splits a JOIN splits b ON a.{key} = b.{key} AND a.split < b.split GROUP BY ALL"""


@query("split_overlap_rows", f"WITH {t.PROMPTS}, {_SPLIT_SQL} {_PAIRS_SQL.format(key='row_id')}")
def split_overlap_rows(spark, sf):
    """No row is in two splits: an empty result."""
    rows = splits.range_splits(t.instructions(spark, sf).select("row_id"), SIZES)
    return splits.split_overlap(rows, "row_id")


@query("split_overlap", f"WITH {t.PROMPTS}, {_SPLIT_SQL} {_PAIRS_SQL.format(key='prompt')}")
def split_overlap(spark, sf):
    """Prompts whose text is in two splits, though their rows differ."""
    rows = splits.range_splits(t.prompts(spark, sf).select("row_id", "prompt"), SIZES)
    return splits.split_overlap(rows, "prompt")


@query("limit_examples", f"WITH {t.PROMPTS} SELECT row_id AS line_no, prompt FROM prompts ORDER BY row_id LIMIT 100")
def limit_examples(spark, sf):
    rows = t.prompts(spark, sf).select(F.col("row_id").alias("line_no"), "prompt")
    return splits.limit_examples(rows, 100)


@query("training_columns", f"WITH {t.PROMPTS} SELECT prompt, answer AS chosen, candidate AS rejected FROM prompts")
def training_columns(spark, sf):
    """Preference rows without their provenance column."""
    rows = t.prompts(spark, sf).select(
        "prompt", F.col("answer").alias("chosen"), F.col("candidate").alias("rejected"), F.lit("mined").alias("source")
    )
    return pairs.training_columns(rows)
