"""Prompts, chat records and training text as column expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: the prompt wording and turn markers of the record format ----
PROMPT_HEAD = "Given this database schema:\n\n"
PROMPT_ASK = (
    "\n\nWrite a SQL query to answer the following question. "
    "Reply with only the SQL query, no explanation or formatting.\n\nQuestion: "
)
TURN_OPEN = "<|turn>"
TURN_CLOSE = "<turn|>"
INSTRUCTION_MARKER = "<|turn>user\n"
RESPONSE_MARKER = "<|turn>model\n"
# ---- end of fixed values ----


def prompt_text(context: Column, question: Column) -> Column:
    """The instruction text for one schema and question."""
    return F.concat(F.lit(PROMPT_HEAD), context, F.lit(PROMPT_ASK), question)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_turn(content: Column) -> Column:
    return F.array(message("user", content))


def assistant_turn(content: Column) -> Column:
    return F.array(message("assistant", content))


def chat_messages(prompt: Column, answer: Column) -> Column:
    """A two-message record: the user asks, the assistant answers."""
    return F.array(message("user", prompt), message("assistant", answer))


def prompt_messages(messages: Column) -> Column:
    """All messages but the last."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def gold_text(messages: Column) -> Column:
    """Content of the last message; NULL for an empty record."""
    return F.get(messages, F.size(messages) - 1)["content"]


def question_text(messages: Column) -> Column:
    """Content of the last prompt message; NULL when there is no prompt."""
    return F.get(messages, F.size(messages) - 2)["content"]


ROLE_NAMES = {"assistant": "model"}


def turn_text(
    role: Column,
    content: Column,
    turn_open: str = TURN_OPEN,
    turn_close: str = TURN_CLOSE,
    role_names: dict[str, str] | None = None,
) -> Column:
    """One turn between its markers; NULL, and so left out, without a role or content."""
    shown = role
    for old, new in (ROLE_NAMES if role_names is None else role_names).items():
        shown = F.when(role == old, F.lit(new)).otherwise(shown)
    return F.concat(F.lit(turn_open), shown, F.lit("\n"), content, F.lit(turn_close))


def open_turn(turn_open: str = TURN_OPEN, role_names: dict[str, str] | None = None) -> str:
    """The start of an answer, ready to be continued."""
    return f"{turn_open}{(ROLE_NAMES if role_names is None else role_names).get('assistant', 'assistant')}\n"


def render_turns(
    messages: Column,
    generation: bool = False,
    turn_open: str = TURN_OPEN,
    turn_close: str = TURN_CLOSE,
    role_names: dict[str, str] | None = None,
) -> Column:
    """Messages as one text with turn markers.

    ``generation=True`` ends with an open model turn, ready to be continued.
    ``role_names`` renames roles; the assistant is called ``model`` by default.
    """
    text = F.array_join(
        F.transform(messages, lambda m: turn_text(m["role"], m["content"], turn_open, turn_close, role_names)), "\n"
    )
    if generation:
        opened = open_turn(turn_open, role_names)
        text = F.concat(text, F.when(F.size(messages) > 0, F.lit("\n")).otherwise(F.lit("")), F.lit(opened))
    return text


def response_spans(
    text: Column,
    response_marker: str = RESPONSE_MARKER,
    instruction_marker: str = INSTRUCTION_MARKER,
) -> Column:
    """Character spans [start, end) that carry loss, 0-based.

    A span runs from the end of a response marker to the next instruction marker,
    or to the next response marker or the end of the text. A marker that never
    occurs gives no span: the sample is fully masked.
    """
    pieces = F.split(text, re.escape(response_marker))
    width = len(response_marker)

    def step(acc: Column, piece: Column) -> Column:
        start = acc["pos"] + width
        stop = F.instr(piece, instruction_marker)
        kept = F.when(stop > 0, stop - 1).otherwise(F.length(piece))
        span = F.struct(start.alias("start"), (start + kept).alias("end"))
        return F.struct(
            (start + F.length(piece)).alias("pos"),
            F.array_append(acc["spans"], span).alias("spans"),
        )

    empty = F.array().cast("array<struct<start:int,end:int>>")
    zero = F.struct(F.length(F.get(pieces, F.lit(0))).alias("pos"), empty.alias("spans"))
    rest = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))
    spans = F.aggregate(rest, zero, step, lambda acc: acc["spans"])
    return F.filter(spans, lambda s: s["end"] > s["start"])


def supervised_chars(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0), lambda n, s: n + s["end"] - s["start"])


def fully_masked(spans: Column) -> Column:
    return F.size(spans) == 0


def completion_text(messages: Column, text: Column) -> Column:
    """A completion is a message list (its first content counts) or a plain text."""
    return F.coalesce(F.get(messages, F.lit(0))["content"], text)
