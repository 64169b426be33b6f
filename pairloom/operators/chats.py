"""Rows and turns to chat records, and chat records to predictions."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import render, sqltext
from ..functions.sums import places
from ..staging import staged
from .positions import running_totals
from .skew import join_null_safe, salted_join


def to_chat(rows: DataFrame) -> DataFrame:
    """Instruction rows with their two-message record."""
    prompt = render.prompt_text(F.col("context"), F.col("question"))
    return rows.select("row_id", render.chat_messages(prompt, F.col("answer")).alias("messages"))


def turns_to_chat(turns: DataFrame) -> DataFrame:
    """Long (conv_id, turn, role, text) rows to one chat record per conversation.

    The record type is a list, so a conversation must fit in a row. Steps that only need
    some turns, or places in the text, have long forms below that gather nothing.
    """
    items = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    messages = F.transform("items", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    return turns.groupBy("conv_id").agg(items.alias("items")).select("conv_id", messages.alias("messages"))


def placed_turns(turns: DataFrame) -> DataFrame:
    """Every turn with its 1-based ``position`` and the ``n_turns`` of its conversation.

    The rows travel whole, once, so each comes out once: rows with one number stay apart, and
    a NULL id is a conversation.
    """
    counts = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    placed = running_totals(turns, ["conv_id"], "turn", {})
    return salted_join(placed, counts, ["conv_id"], "position", size="n_turns")


def split_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Long form of ``split_prompt_gold``: the prompt's turns, and gold and question.

    Of conversations with a prompt that end with an assistant's turn. The first result
    has all turns but the last; the second ``conv_id``, ``gold``, ``question`` and
    ``prompt_turns``. No conversation is gathered. Repeated turns are turns; see ``placed_turns``.
    """
    placed = staged(placed_turns(turns), "placed")
    usable = (F.col("position") == F.col("n_turns")) & (F.col("role") == "assistant") & (F.col("n_turns") > 1)
    gold = placed.filter(usable).select("conv_id", F.col("text").alias("gold"), (F.col("n_turns") - 1).alias("prompt_turns"))
    asked = placed.filter(F.col("position") == F.col("n_turns") - 1).select("conv_id", F.col("text").alias("question"))
    answers = join_null_safe(gold, asked, ["conv_id"])
    rest = placed.filter(F.col("position") < F.col("n_turns"))
    prompts = salted_join(rest, gold.select("conv_id", "prompt_turns"), ["conv_id"], "position", size="prompt_turns")
    return prompts.select("conv_id", "turn", "role", "text"), answers


def render_pieces(turns: DataFrame, generation: bool = False, **markers) -> DataFrame:
    """Long form of ``render_turns``: (conv_id, position, turn, start, piece).

    The pieces of a conversation in the order of ``position``, joined with nothing between them, are
    its text, and ``start`` is a piece's place in it, so a conversation may be longer than a
    row can hold. As there, turns without a role or a text are left out. ``generation`` adds the
    open turn as a last piece without a turn.
    """
    shown = turns.select("conv_id", "turn", render.turn_text(F.col("role"), F.col("text"), **markers).alias("piece"))
    shown = shown.filter("piece IS NOT NULL")
    counts = shown.groupBy("conv_id").agg(F.count("*").alias("n_turns"), F.sum(F.length("piece") + 1).alias("chars"))
    placed = running_totals(shown, ["conv_id"], "turn", {"until": F.length("piece") + 1})
    more = F.lit("\n") if generation else F.when(F.col("position") < F.col("n_turns"), "\n").otherwise("")
    pieces = salted_join(placed, counts, ["conv_id"], "position", size="n_turns").select(
        "conv_id", "position", "turn", (F.col("until") - F.length("piece") - 1).alias("start"), F.concat("piece", more).alias("piece")
    )
    if not generation:
        return pieces
    named = {k: v for k, v in markers.items() if k != "turn_close"}
    empty = turns.select("conv_id").distinct()
    opened = join_null_safe(empty, counts, ["conv_id"], "left").select(
        "conv_id",
        (F.coalesce("n_turns", F.lit(0)) + 1).alias("position"),
        F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"),
        F.coalesce("chars", F.lit(0)).alias("start"),
        F.lit(render.open_turn(**named)).alias("piece"),
    )
    return pieces.unionByName(opened)


def _overlap(a: str, b: str) -> bool:
    """Whether ``b`` can begin within ``a``."""
    return any(b.startswith(a[k:]) or a[k:].startswith(b) for k in range(1, len(a)))


def turn_spans(
    turns: DataFrame,
    response_marker: str = render.RESPONSE_MARKER,
    instruction_marker: str = render.INSTRUCTION_MARKER,
    **markers,
) -> DataFrame:
    """Long form of ``response_spans``: (conv_id, turn, start, end) in the rendered text.

    The markers are looked for in every turn, its text included, and across the ends of
    neighbours: a turn keeps the few characters at its ends that a marker could reach over. Only those
    and places travel. ``turn`` is the one in which the span's marker ends. Markers that could begin
    within one another, and turns whose frame is shorter than a marker, are refused.
    """
    kinds = {"response": response_marker, "instruction": instruction_marker}
    if any(_overlap(a, b) for a in kinds.values() for b in kinds.values()):
        raise ValueError("markers that overlap")
    reach = max(map(len, kinds.values())) - 1
    framed = {"turn_open": render.TURN_OPEN, "turn_close": render.TURN_CLOSE} | {k: v for k, v in markers.items() if k != "role_names"}
    if sum(map(len, framed.values())) + 1 < reach:
        raise ValueError("a marker that is longer than a turn's frame")
    piece = render.turn_text(F.col("role"), F.col("text"), **markers)
    narrow = turns.select("conv_id", "turn", piece.alias("piece")).filter("piece IS NOT NULL").select(
        "conv_id",
        "turn",
        F.length("piece").cast("bigint").alias("size"),
        F.substring("piece", F.lit(1), F.lit(reach)).alias("head"),
        F.right("piece", F.lit(reach)).alias("tail"),
        *(places(F.col("piece"), m).alias(k) for k, m in kinds.items()),
    )
    placed = staged(running_totals(narrow, ["conv_id"], "turn", {"until": F.col("size") + 1}), "placed")
    at = F.col("until") - F.col("size") - 1
    before = placed.select("conv_id", (F.col("position") + 1).alias("position"), "tail")
    seam = F.concat("tail", F.lit("\n"), "head")
    over = join_null_safe(placed.drop("tail"), before, ["conv_id", "position"])

    def found(rows: DataFrame, kind: str, spots: Column, start: Column) -> DataFrame:
        return rows.select("conv_id", "turn", start.alias("_at"), F.explode(spots).alias("_place")).select(
            "conv_id", "turn", (F.col("_at") + F.col("_place")).alias("at"), F.lit(kind).alias("kind")
        )

    events = []
    for kind, marker in kinds.items():
        across = F.filter(places(seam, marker), lambda p: (p <= F.length("tail")) & (p + len(marker) > F.length("tail")))
        events += [found(placed, kind, F.col(kind), at), found(over, kind, across, at - 1 - F.length("tail"))]
    lengths = placed.groupBy("conv_id").agg((F.max("until") - 1).alias("all_chars"), F.count("*").alias("n_turns"))
    # Each event beside the next one: their numbers along the text differ by one.
    numbered = staged(running_totals(reduce(DataFrame.unionByName, events), ["conv_id"], "at", {}), "events")
    following = numbered.select("conv_id", (F.col("position") - 1).alias("position"), F.col("at").alias("next_at"))
    answers = join_null_safe(numbered.filter("kind = 'response'"), following, ["conv_id", "position"], "left")
    ended = salted_join(answers, lengths, ["conv_id"], "position", size="n_turns")
    return ended.select(
        "conv_id", "turn", (F.col("at") + len(response_marker)).alias("start"), F.coalesce("next_at", "all_chars").alias("end")
    ).filter("end > start")


def split_prompt_gold(chats: DataFrame) -> DataFrame:
    """Adds ``prompt`` (all messages but the last), ``question`` and ``gold``."""
    m = F.col("messages")
    return chats.withColumns(
        {
            "prompt": render.prompt_messages(m),
            "question": render.question_text(m),
            "gold": render.gold_text(m),
        }
    )


def score_responses(responses: DataFrame) -> DataFrame:
    """Adds ``prediction`` (the SQL in ``raw_response``) and ``match`` with ``gold``.

    A missing response is no match; its prediction is NULL.
    """
    with_sql = responses.withColumn("prediction", sqltext.extract_sql(F.col("raw_response")))
    return with_sql.withColumn(
        "match", F.coalesce(sqltext.exact_match(F.col("prediction"), F.col("gold")), F.lit(False))
    )
