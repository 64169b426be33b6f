"""Bounded-space packing of documents into fixed windows of tokens.

Every partition packs its own documents as they stream by, holding a fixed number of
open windows: a document goes to the window it fits best; if it fits none and all are
open, the fullest is emitted. Documents of a window's size or more fill windows of
their own first. At the end of a partition its open windows are merged end to end,
which leaves one short window, and these short windows of all partitions are merged
once more by their lengths. There is no shuffle of texts or ids, and a task's memory is
the open windows beside a batch of documents.

Null texts are empty and hold the end id alone. Repeated documents are packed each. An
empty table gives no pieces.
"""

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import ship, slices, with_fields
from .wordtokens import CACHE_PIECES, encoder

WINDOW = 2048
OPEN_WINDOWS = 64
END_ID = 1
#: Partitions whose short windows are merged in one task.
MERGE_GROUP = 1024
#: Pieces of a result batch.
PIECES_AT_ONCE = 8192

_FIELDS = [
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()),
    ("offset", pa.int64()),
    ("short", pa.bool_()),
]
_SCHEMA = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, short boolean"


class Packer:
    """The open windows of one partition. A piece is (document, start, ids as bytes, document's tokens)."""

    def __init__(self, window: int, open_windows: int):
        self.window, self.most = window, open_windows
        self.open: list[list] = []
        self.free: list[int] = []

    def add(self, piece: tuple):
        """Place one document; yields the windows that are full or emitted."""
        doc, _, ids, total = piece
        start = 0
        while total - start >= self.window:
            yield [(doc, start, ids[4 * start : 4 * (start + self.window)], total)]
            start += self.window
        size = total - start
        if not size:
            return
        fits = [(room, k) for k, room in enumerate(self.free) if room >= size]
        if fits:
            _, k = min(fits)
        elif len(self.open) < self.most:
            self.open.append([])
            self.free.append(self.window)
            k = len(self.open) - 1
        else:
            k = min(range(self.most), key=self.free.__getitem__)
            yield self.open[k]
            self.open[k], self.free[k] = [], self.window
        self.open[k].append((doc, start, ids[4 * start :], total))
        self.free[k] -= size
        if not self.free[k]:
            yield self.open.pop(k)
            self.free.pop(k)

    def merged(self):
        """The open windows end to end, cut anew: all but the last are full."""
        now, room = [], self.window
        for doc, start, ids, total in (p for w in self.open for p in w):
            while ids:
                part = ids[: 4 * room]
                now.append((doc, start, part, total))
                start, ids, room = start + len(part) // 4, ids[4 * room :], room - len(part) // 4
                if not room:
                    yield now
                    now, room = [], self.window
        if now:
            yield now


def _pack(path: str, cache_pieces: int, window: int, open_windows: int, end_id: int, with_ids: bool):
    def pack(batches):
        encode = encoder(path, cache_pieces).encode
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(window, open_windows)
        number = TaskContext.get().partitionId() << 32
        docs_type = None
        rows: list[tuple] = []

        def put(pieces: list):
            nonlocal number
            offset = 0
            short = sum(len(p[2]) for p in pieces) < 4 * window
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids) // 4, crc32(ids), total, number, offset, short, ids))
                offset += len(ids) // 4
            number += 1

        def batch_of(part):
            columns = list(zip(*part))
            arrays = [pa.array(columns[0], docs_type)]
            arrays += [pa.array(c, t) for c, (_, t) in zip(columns[1:], _FIELDS)]
            names = ["doc_id", *(n for n, _ in _FIELDS)]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(i, "<u4").astype("i4") for i in columns[-1]], pa.list_(pa.int32())))
                names.append("ids")
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in slices(batches, keep=True):
            docs_type = batch.column("doc_id").type
            texts = batch.column("text").to_pylist()
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                for pieces in packer.add((doc, 0, ids, len(ids) // 4)):
                    put(pieces)
            while len(rows) >= PIECES_AT_ONCE:
                yield batch_of(rows[:PIECES_AT_ONCE])
                rows = rows[PIECES_AT_ONCE:]
        for pieces in packer.merged():
            put(pieces)
        if rows:
            yield batch_of(rows)

    return pack


def _merge_short(window: int):
    """Best-fit of short windows, longest first, into common ones."""

    def merge(key, frame):
        frame = frame.sort_values(["fill", "sequence_id"], ascending=[False, True])
        rooms: list[list[int]] = []
        into, shift = [], []
        for sequence, fill in zip(frame["sequence_id"].tolist(), frame["fill"].tolist()):
            fits = [r for r in rooms if r[1] >= fill]
            best = min(fits, key=lambda r: r[1]) if fits else [sequence, window]
            if not fits:
                rooms.append(best)
            into.append(best[0])
            shift.append(window - best[1])
            best[1] -= fill
        return frame.assign(into=into, shift=shift)[["sequence_id", "into", "shift"]]

    return merge


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    end_id: int = END_ID,
    with_ids: bool = False,
    cache_pieces: int = CACHE_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A document is its ids and ``end_id``. ``start`` counts the ids before the piece,
    ``offset`` the ids before it in its sequence. ``cache_pieces`` trades a worker's memory
    for time.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = with_fields(rows, ["doc_id"], _SCHEMA + ", ids array<int>" * with_ids)
    pieces = staged(
        rows.mapInArrow(_pack(tokenizer_path, cache_pieces, window, open_windows, end_id, with_ids), schema), "pieces"
    )
    # A partition has at most one merged short window; the emitted ones are padded as they are.
    tails = pieces.filter("short").groupBy("sequence_id").agg(F.sum("length").alias("fill"))
    last = tails.groupBy(F.shiftright("sequence_id", 32).alias("task")).agg(F.max("sequence_id").alias("sequence_id"))
    moved = (
        tails.join(last.select("sequence_id"), "sequence_id")
        .groupBy(F.floor(F.shiftright("sequence_id", 32) / MERGE_GROUP).alias("g"))
        .applyInPandas(_merge_short(window), "sequence_id bigint, into bigint, shift bigint")
    )
    return (
        pieces.join(F.broadcast(moved), "sequence_id", "left")  # one row per partition
        .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
        .withColumn("sequence_id", F.coalesce("into", "sequence_id"))
        .drop("into", "shift", "short")
    )
