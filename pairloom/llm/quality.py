"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

A text's features are its words (hashed, weighted by the logarithm of their counts, of
unit length together) and what its structure looks like: binned statistics such as the
share of capitals or of repeated lines, and the binned ``n_chars`` of the table. Every
pair of features interacts through factors of low rank; with the identity
``sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)``
a score takes time linear in the text's features.

Training uses at most ``TRAIN_ROWS`` labelled rows, those with the least hash of their
id: their features (not their texts) come to the driver. Scoring reads every whole text
where it lies, with no shuffle; the model it broadcasts has a fixed size.

Null texts are empty, and empty texts have a score (structure and metadata alone). Rows
without a label or an id are no training rows; repeated ones count each. With no
training rows, or of one class only, every score is that class's smoothed share.
"""

from collections import Counter
from dataclasses import dataclass
from math import log1p, log2, sqrt
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_text, ship, slices, with_fields

#: The most labelled rows to train on.
TRAIN_ROWS = 12_000
WORD_BUCKETS = 1 << 14
BINS = 32
RANK = 8
EPOCHS = 8
ROWS_PER_STEP = 128
RATE = 0.05
PENALTY = 1e-5
#: Weight of one structure feature beside the unit-length words.
STRUCTURE_WEIGHT = 0.5
#: Score from which a text counts as good.
GOOD = 0.3
FOLDS = 5
#: Texts scored together.
TEXTS_AT_ONCE = 256

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = bytes(range(48, 58))
_SPACE = bytes([32, *range(9, 14)])
_MARKS = bytes(b for b in range(33, 127) if b not in _LETTERS + _DIGITS)
_COMMON_MARKS = b".,;:'\"()-"


def _log_bin(x: float) -> int:
    return min(BINS - 2, int(2 * log2(x + 1)))


def _share_bin(part: float, whole: float) -> int:
    # Finer near zero, where most texts are.
    return int((BINS - 2) * sqrt(min(1.0, part / whole))) if whole else BINS - 1


def structure(raw: bytes, words: list[bytes], counts: Counter, n_chars: int | None) -> list[int]:
    """A bin for each statistic."""
    size, n = len(raw), len(words)

    def without(chars: bytes) -> int:
        return size - len(raw.translate(None, chars))

    lines = raw.split(b"\n")
    letters, marks = without(_LETTERS), without(_MARKS)
    return [
        _log_bin(size),
        _log_bin(n),
        _log_bin(len(lines)),
        _log_bin(size / len(lines)),
        _share_bin(size - without(_SPACE), 16 * n),
        _share_bin(without(_UPPER), letters),
        _share_bin(without(_DIGITS), size),
        _share_bin(marks, size),
        _share_bin(without(_COMMON_MARKS), marks),
        _share_bin(without(bytes(range(128, 256))), size),
        _share_bin(len(counts), n),
        _share_bin(max(counts.values(), default=0), n),
        _share_bin(sum(map(eq, words, words[1:])), n),
        _share_bin(len(lines) - len(set(lines)), len(lines)),
        _share_bin(raw.count(b"|"), n),
        _share_bin(raw.count(b"http"), n),
        BINS - 1 if n_chars is None or n_chars < 0 else _log_bin(n_chars),
    ]


STATISTICS = 17
FEATURES = WORD_BUCKETS + STATISTICS * BINS


def features(raw: bytes, n_chars: int | None) -> tuple[list[int], list[float]]:
    """Feature numbers and values of a UTF-8 text."""
    words = raw.lower().split()
    counts = Counter(words)
    at = [crc32(w) & (WORD_BUCKETS - 1) for w in counts]
    weights = [1.0 + log1p(c - 1) for c in counts.values()]
    norm = sqrt(sum(w * w for w in weights)) or 1.0
    bins = structure(raw, words, counts, n_chars)
    at += [WORD_BUCKETS + k * BINS + b for k, b in enumerate(bins)]
    return at, [*(w / norm for w in weights), *[STRUCTURE_WEIGHT] * len(bins)]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margins(self, at: np.ndarray, values: np.ndarray, starts: np.ndarray):
        """Scores before the logistic function, and the factor sums of each text."""
        vx = self.factors[at] * values[:, None]
        sums = np.add.reduceat(vx, starts)
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx**2, starts)).sum(1)
        return self.bias + np.add.reduceat(self.weights[at] * values, starts) + pairs, sums

    def scores(self, at: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return _logistic(self.margins(at, values, starts)[0])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _joined(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(at) for at, _ in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return (
        np.concatenate([np.asarray(at, np.int64) for at, _ in rows]),
        np.concatenate([np.asarray(v, np.float32) for _, v in rows]),
        starts,
    )


def fit(rows: list[tuple], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Logistic loss, minimised by mini-batches with a rate for each parameter (AdaGrad)."""
    draw = np.random.default_rng(seed)
    y = np.asarray(labels, np.float32)
    share = (y.sum() + 1) / (len(y) + 2)
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(FEATURES, np.float32),
        draw.normal(0, 0.01, (FEATURES, RANK)).astype(np.float32),
    )
    if len(y) == 0 or y.min() == y.max():
        machine.factors[:] = 0
        return machine
    seen_w = np.full(FEATURES, 1e-6, np.float32)
    seen_v = np.full((FEATURES, RANK), 1e-6, np.float32)
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for k in range(0, len(order), ROWS_PER_STEP):
            chosen = order[k : k + ROWS_PER_STEP]
            at, values, starts = _joined([rows[i] for i in chosen])
            margin, sums = machine.margins(at, values, starts)
            slope = ((_logistic(margin) - y[chosen]) / len(chosen)).astype(np.float32)
            text = np.repeat(np.arange(len(chosen)), np.diff([*starts, len(at)]))
            used, back = np.unique(at, return_inverse=True)
            gx = slope[text] * values
            g_w = np.bincount(back, gx, len(used)) + PENALTY * machine.weights[used]
            part = gx[:, None] * (sums[text] - machine.factors[at] * values[:, None])
            g_v = np.stack([np.bincount(back, part[:, f], len(used)) for f in range(RANK)], 1)
            g_v += PENALTY * machine.factors[used]
            seen_w[used] += g_w**2
            seen_v[used] += g_v**2
            machine.weights[used] -= RATE * g_w / np.sqrt(seen_w[used])
            machine.factors[used] -= RATE * g_v / np.sqrt(seen_v[used])
            machine.bias -= RATE * float(slope.sum())
    return machine


def _train_features(batches):
    for batch in slices(batches):
        raws, chars = batch.column("raw").to_pylist(), batch.column("n_chars").to_pylist()
        rows = [features(r, n) for r, n in zip(raws, chars)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("quality"),
                batch.column("place"),
                pa.array([at for at, _ in rows], pa.list_(pa.int32())),
                pa.array([v for _, v in rows], pa.list_(pa.float32())),
            ],
            names=["quality", "place", "at", "value"],
        )


def held_out(id_col: str = "doc_id"):
    """Rows of the test fold: crc32 of the id as text has no remainder by ``FOLDS``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _source(docs: DataFrame, text_col: str, chars_col: str, **keep) -> DataFrame:
    chars = F.col(chars_col).cast("bigint") if chars_col in docs.columns else F.lit(None).cast("bigint")
    return docs.select(
        *(c.alias(n) for n, c in keep.items()), raw_text(text_col).alias("raw"), chars.alias("n_chars")
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    chars_col: str = "n_chars",
    rows: int = TRAIN_ROWS,
) -> Machine:
    """Fit on a bounded sample of the labelled documents outside the test fold."""
    ship(docs.sparkSession)
    usable = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    place = F.xxhash64(F.col(id_col))
    sample = (
        usable.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("quality"), place.alias("place"))
        .orderBy("place", "label_id", "quality")
        .limit(rows)
    )
    found = (
        _source(docs, text_col, chars_col, doc_id=F.col(id_col))
        .join(F.broadcast(sample), F.col("doc_id") == F.col("label_id"))  # at most ``rows`` ids
        .select("quality", "place", "raw", "n_chars")
        .mapInArrow(_train_features, "quality int, place bigint, at array<int>, value array<float>")
        .toArrow()
    )
    found = found.combine_chunks().sort_by([("place", "ascending"), ("quality", "ascending")])
    at, value = (found[c].combine_chunks() for c in ("at", "value"))
    ends = at.offsets.to_numpy()
    at, value = at.values.to_numpy(), value.values.to_numpy()  # views: no Python object per feature
    return fit([(at[a:b], value[a:b]) for a, b in zip(ends, ends[1:])], found["quality"].to_pylist())


def _score(shared):
    def score(batches):
        machine: Machine = shared.value
        for batch in slices(batches):
            raws, chars = batch.column("raw").to_pylist(), batch.column("n_chars").to_pylist()
            out = [np.empty(0)]
            for k in range(0, len(raws), TEXTS_AT_ONCE):
                rows = [features(r, n) for r, n in zip(raws[k : k + TEXTS_AT_ONCE], chars[k : k + TEXTS_AT_ONCE])]
                out.append(machine.scores(*_joined(rows)))
            kept = [n for n in batch.schema.names if n not in ("raw", "n_chars")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(np.concatenate(out), pa.float64())],
                names=[*kept, "score"],
            )

    return score


def scored(
    docs: DataFrame, machine: Machine, text_col: str = "text", chars_col: str = "n_chars", **keep
) -> DataFrame:
    """The ``keep`` columns of each document and its ``score`` from 0 to 1."""
    spark = docs.sparkSession
    ship(spark)
    rows = _source(docs, text_col, chars_col, **keep)
    return rows.mapInArrow(
        _score(spark.sparkContext.broadcast(machine)), with_fields(rows, [*keep], "score double")
    )


def keep_good(docs: DataFrame, labels: DataFrame, good: float = GOOD, **columns) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``good``, columns unchanged."""
    machine = train(docs, labels, **columns)
    return scored(docs, machine, row=F.struct("*")).filter(F.col("score") >= good).select("row.*")
