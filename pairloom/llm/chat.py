"""Chat formatting at the level of token ids, with a loss mask and reversible escapes.

A turn is ``OPEN role SEP text CLOSE``. Role and text are encoded as segments of their
own, so no token spans a border, and the three marks are ids past the vocabulary that
no text can produce. As text the marks read as in ``MARKS``; where a role or a text holds
such a string, a backslash goes inside it (and one before every backslash), so that
formatted text can be cut at its marks and read back too.

The loss mask is a prefix sum over segment borders: +1 where an assistant's text begins,
-1 where it ends. Turns are encoded one by one in whatever task holds their rows; only
the digest of a conversation needs its turns in order: they stream through a sorted
partition, in constant memory however long a conversation is.

Null roles and texts are empty. Turns are ordered by ``turn`` (null first), then by their
ids; repeated rows are turns of their own. A null conv_id is a conversation like any
other. An empty table gives no rows.
"""

import base64
import re
from hashlib import sha256

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, with_fields

#: How the marks read as text.
MARKS = {"open": "### ", "sep": ": ", "close": "</turn>\n"}
#: Control strings inside a role and inside a text.
ROLE_CONTROL = re.compile(r"\\|### |: |</turn>")
TEXT_CONTROL = re.compile(r"\\|### |</turn>")
TRAINED_ROLE = "assistant"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, control: re.Pattern = TEXT_CONTROL) -> str:
    """A backslash behind the first character of each control string; it holds none then."""
    return control.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Template:
    """A byte-level vocabulary and three ids past it."""

    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        first = max(ranks.values()) + 2  # the id after the ranks is the vocabulary's own end of text
        self.open, self.sep, self.close = first, first + 1, first + 2
        self.reads = dict(zip((self.open, self.sep, self.close), MARKS.values()))

    def turns(self, roles: list[str], texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, loss mask) of each turn."""
        segments, trained, per_turn = [], [], []
        for role, text in zip(roles, texts):
            body = self.encoding.encode_ordinary(escape(text))
            name = self.encoding.encode_ordinary(escape(role, ROLE_CONTROL))
            segments += [[self.open], name, [self.sep], body, [self.close]]
            trained += [0, 0, 0, int(role == TRAINED_ROLE), 0]
            per_turn.append(3 + len(name) + len(body))
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        ids = np.fromiter((i for s in segments for i in s), np.int32, int(sizes.sum()))
        border = np.concatenate([[0], np.cumsum(sizes)])
        step = np.zeros(len(ids) + 1, np.int32)
        np.add.at(step, border[:-1], trained)
        np.subtract.at(step, border[1:], trained)
        mask = np.cumsum(step)[:-1] > 0
        cut = np.cumsum(per_turn)[:-1]
        return list(zip(np.split(ids, cut), np.split(mask, cut))) if roles else []

    def text(self, ids: list[int]) -> str:
        return self.encoding.decode_bytes(ids).decode()

    def read(self, ids: list[int], mask: list[bool]) -> tuple[str, str, str, str]:
        """role, text, the text under the mask, and the turn as formatted text."""
        sep = ids.index(self.sep)
        role, body = self.text(ids[1:sep]), self.text(ids[sep + 1 : -1])
        under = self.text([i for i, m in zip(ids, mask) if m])
        formatted = self.reads[ids[0]] + role + self.reads[self.sep] + body + self.reads[ids[-1]]
        return unescape(role), unescape(body), unescape(under), formatted


_templates: dict[tuple, Template] = {}


def template(ranks_path: str, pattern: str) -> Template:
    """The worker's template for this vocabulary."""
    key = (ranks_path, pattern)
    if key not in _templates:
        _templates[key] = Template(*key)
    return _templates[key]


def _format(key: tuple):
    def fmt(batches):
        made = template(*key)
        for batch in slices(batches):
            turns = made.turns(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"),
                    batch.column("turn"),
                    pa.array([ids for ids, _ in turns], pa.list_(pa.int32())),
                    pa.array([mask for _, mask in turns], pa.list_(pa.bool_())),
                ],
                names=["conv_id", "turn", "ids", "mask"],
            )

    return fmt


def format_turns(
    rows: DataFrame,
    ranks_path: str,
    pattern: str,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """conv_id, turn, ids, mask: a row for each turn; a conversation is its turns' ids in order."""
    ship(rows.sparkSession)
    empty = F.lit("")
    source = rows.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), empty).alias("role"),
        F.coalesce(F.col(text_col), empty).alias("text"),
    )
    schema = with_fields(source, ["conv_id", "turn"], "ids array<int>, mask array<boolean>")
    return source.mapInArrow(_format((ranks_path, pattern)), schema)


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.turns, self.chars, self.loss_chars = conv_id, 0, 0, 0
        self.all, self.loss = sha256(), sha256()

    def add(self, role: str, text: str, under: str, formatted: str) -> None:
        self.turns += 1
        self.chars += len(formatted)
        self.loss_chars += len(under)
        self.all.update(f"{role}\n{text}\n".encode())
        self.loss.update(under.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_DIGESTS = [
    ("n_turns", pa.int64()),
    ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()),
    ("formatted_chars", pa.int64()),
]


def _digest(key: tuple):
    def digest(batches):
        made = template(*key)
        now = kind = None
        for batch in slices(batches):
            kind = batch.column("conv_id").type
            done = []
            for conv, ids, mask in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "ids", "mask"))):
                if now is None or now.conv_id != conv:
                    done += [now] if now else []
                    now = _Digest(conv)
                now.add(*made.read(ids, mask))
            yield _rows(done, kind)
        if now:
            yield _rows([now], kind)

    return digest


def _rows(done: list[_Digest], kind: pa.DataType) -> pa.RecordBatch:
    columns = list(zip(*(d.row() for d in done))) or [[]] * 6
    types = [kind, *(t for _, t in _DIGESTS)]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["conv_id", *(n for n, _ in _DIGESTS)]
    )


def digests(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """What the formatted conversations read back as: a row of counts and digests for each."""
    ship(turns.sparkSession)
    schema = with_fields(
        turns,
        ["conv_id"],
        "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(_digest((ranks_path, pattern)), schema)
