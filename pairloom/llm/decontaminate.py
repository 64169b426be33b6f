"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every word sequence that occurs in an item. A document's words are
streamed through it, one transition each, and the state tells the longest sequence of
item words that ends here. Where it reaches a window (``window`` words in a row of an
item, or the whole of a shorter item), the window's words are hit. Documents of any
length take constant memory beside their own words.

The items are broadcast as words, in blocks of at most ``block_words``; each block is a
pass that adds its hits to those of the blocks before. So no item is left out however
large the benchmark is, and what one task holds is bounded.

Null texts have no words. Items without words are no windows; an item without an id is
matched but not named. Repeated items and item ids are allowed: equal ids count once.
Repeated documents get equal results each. An empty benchmark leaves all documents clean.
"""

import re
import uuid
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import held, raw_text, ship, slices, with_fields

WINDOW = 13
#: A document is contaminated when hit words are at least this part of its words.
MAX_COVERAGE = (1, 20)
#: Item words per automaton: about 400 bytes of memory each.
BLOCK_WORDS = 400_000

# Lower-case A-Z; digits, letters and all bytes past ASCII are parts of words.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORD_BYTES).split()


@dataclass
class Automaton:
    """Suffix automaton of several word sequences, with the windows that end in each state."""

    window: int
    step: list[dict] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    #: State -> items that contain the state's sequences of ``window`` words or more.
    full: dict[int, set] = field(default_factory=dict)
    #: State -> {number of words: items} of the whole items that end there.
    whole: dict[int, dict] = field(default_factory=dict)
    #: State -> the fewest words that make a window there.
    least: list[int] = field(default_factory=list)
    #: State -> the state of its last ``window`` words.
    cut: dict[int, int] = field(default_factory=dict)

    def _new(self, step: dict, link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        return len(self.step) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for the sequences that reach it over ``state``."""
        copy = self._new(dict(self.step[target]), self.link[target], self.length[state] + 1)
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        target = self.step[last].get(word)
        if target is not None:  # known from an earlier item
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new, state = self._new({}, 0, self.length[last] + 1), last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    @classmethod
    def of(cls, items: list[tuple[str, list[bytes]]], window: int) -> "Automaton":
        """``items``: (id, words) with at least one word each."""
        made = cls(window)
        for _, words in items:
            last = 0
            for w in words:
                last = made._extend(last, w)
        order = sorted(range(1, len(made.step)), key=made.length.__getitem__)
        for s in order:  # the link of a state is shorter, so it is done before
            if made.length[s] >= window:
                up = made.link[s]
                made.cut[s] = made.cut[up] if made.length[up] >= window else s
        for name, words in items:
            state = 0
            for w in words:
                state = made.step[state][w]
                if state in made.cut:
                    made.full.setdefault(made.cut[state], set()).add(name)
            if len(words) < window:
                # The whole item is among its state's sequences: the walk from the start
                # reads no more than it.
                made.whole.setdefault(state, {}).setdefault(len(words), set()).add(name)
        never = 1 << 60
        made.least = [never] * len(made.step)
        for s in order:
            own = [*made.whole.get(s, ()), *([window] if s in made.cut else ())]
            made.least[s] = min([made.least[made.link[s]], *own])
        return made

    def windows(self, state: int, matched: int):
        """(words, items) of every window that ends here, given the matched words."""
        if matched >= self.window and state in self.cut:
            yield self.window, self.full[self.cut[state]]
        while state > 0:
            for n, names in self.whole.get(state, {}).items():
                if n <= matched:
                    yield n, names
            state = self.link[state]


def hits(automaton: Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Merged (start, end) word spans that windows cover, and the items they are of."""
    step, link, length, least = automaton.step, automaton.link, automaton.length, automaton.least
    spans: list[tuple[int, int]] = []
    items: set = set()
    state = matched = 0
    root = step[0]
    for i, w in enumerate(words):
        target = step[state].get(w) if state else root.get(w)
        if target is None:
            if not state:
                continue
            while state and target is None:
                state = link[state]
                target = step[state].get(w)
            if target is None:
                matched = 0
                continue
            matched = length[state]
        state = target
        matched += 1
        if matched >= least[state]:
            most = 0
            for n, names in automaton.windows(state, matched):
                items |= names
                most = max(most, n)
            start = i + 1 - most
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, i + 1))
    return spans, items


def _automaton(key: str, shared) -> Automaton:
    # One at a time: a worker's memory holds no other block's items.
    return held(f"automaton {key}", key, lambda: Automaton.of(*shared.value))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = "n_words bigint, spans array<struct<start: bigint, end: bigint>>, items array<string>"


def union_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans made one, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def without_spans(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between those words."""
    if not spans:
        return raw
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_WORD_BYTES))]
    kept, done = [], 0
    for start, end in spans:
        kept.append(raw[done : at[start][0]])
        done = at[end - 1][1]
    return b"".join([*kept, raw[done:]])


def _find(key: str, shared, last: bool, cleaned: bool):
    def find(batches):
        automaton = _automaton(key, shared)
        for batch in slices(batches, keep=True):
            n_words, spans, items, raws = [], [], [], batch.column("raw").to_pylist()
            earlier = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
            for raw, (old_spans, old_items) in zip(raws, earlier):
                words = words_of(raw)
                new_spans, new_items = hits(automaton, words)
                n_words.append(len(words))
                spans.append(union_spans([*new_spans, *((s["start"], s["end"]) for s in old_spans)]))
                items.append(sorted({*old_items, *new_items} - {None}))
            columns = {n: batch.column(n) for n in batch.schema.names if n not in ("raw", "n_words", "spans", "items")}
            if last and cleaned:
                texts = [without_spans(r, s).decode() for r, s in zip(raws, spans)]
                columns["cleaned"] = pa.array(texts, pa.string())
            elif not last:
                columns["raw"] = batch.column("raw")
            columns["n_words"] = pa.array(n_words, pa.int64())
            columns["spans"] = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], SPANS)
            columns["items"] = pa.array(items, pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*columns.values()], names=[*columns])

    return find


def _blocks(items: DataFrame, id_col: str, text_col: str, block_words: int):
    """Lists of (id, words), each of a bounded number of words but for one longer item."""
    block, size = [], 0
    rows = items.select(F.col(id_col).cast("string").alias("id"), raw_text(text_col).alias("raw"))
    for row in rows.filter(F.length("raw") > 0).distinct().toLocalIterator():
        words = words_of(bytes(row.raw))
        if not words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((row.id, words))
        size += len(words)
    yield block


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    cleaned: bool = False,
    **keep,
) -> DataFrame:
    """The ``keep`` columns of each document, n_words, spans (of word numbers, merged), items (ids as strings).

    With ``cleaned`` also the text without the words of the spans, as ``cleaned``.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(
        *(c.alias(n) for n, c in keep.items()),
        raw_text(text_col).alias("raw"),
        F.lit(0).cast("bigint").alias("n_words"),
        F.expr("cast(array() AS array<struct<start: bigint, end: bigint>>)").alias("spans"),
        F.expr("cast(array() AS array<string>)").alias("items"),
    )
    blocks = _blocks(items, item_id_col, item_text_col, block_words)
    block = next(blocks)
    while True:
        # The driver holds this block and the next one, executors one automaton a task.
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast((block, window))
        key = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
        last = following is None
        more = ("cleaned string, " if cleaned else "") if last else "raw binary, "
        rows = rows.mapInArrow(_find(key, shared, last, cleaned), with_fields(rows, [*keep], more + _FOUND))
        if last:
            return rows
        rows, block = staged(rows, "hits"), following
        shared.destroy()


def n_hit() -> Column:
    return F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")


def is_contaminated(coverage: tuple[int, int] = MAX_COVERAGE) -> Column:
    part, whole = coverage
    return (F.size("spans") > 0) & (whole * n_hit() >= part * F.col("n_words"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    coverage: tuple[int, int] = MAX_COVERAGE,
    **options,
) -> DataFrame:
    """``docs`` without its contaminated rows, and without the hit spans of the other rows.

    Columns and their order are unchanged; null texts stay null.
    """
    found = find_hits(docs, items, text_col, window=window, cleaned=True, row=F.struct("*"), **options)
    text = F.when(F.isnull(F.col("row")[text_col]), None).otherwise(F.col("cleaned"))
    return found.filter(~is_contaminated(coverage)).select(
        *(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns)
    )


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated: a row for each document."""
    found = find_hits(docs, items, text_col, doc_id=F.col(id_col))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )
