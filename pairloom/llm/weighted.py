"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words (A-Z lower-cased, cut at ASCII white space), weighted by
their counts. For each of K samples a term draws r, c from Gamma(2, 1) and b from [0, 1),
all fixed by the term and the sample's number; with weight w it takes the step
``t = floor(ln w / r + b)`` and the rank ``ln a = ln c - r (t - b) - r``. The term of least
rank and its step are the sample. Two texts agree on a sample with a probability equal
to their generalised Jaccard similarity, sum of min weights / sum of max weights.

For weight 1 the step is 0, so ``ln a = base - r t`` with a ``base`` kept for each
term; a worker keeps the draws of its most recent terms, in tables of fixed size.

Null and word-less texts have one term, the empty one. Equal texts have equal fingerprints.
"""

from collections import Counter
from hashlib import sha256
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.staging import staged

from .common import held, ship, slices, with_fields

SAMPLES = 64
#: Terms whose draws a worker keeps: 768 bytes each with 64 samples.
KEPT_TERMS = 1 << 16
#: Terms of a text that are ranked together.
TERMS_AT_ONCE = 4096

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: two multiplications and three shifts."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Sampler:
    """Fingerprints of ``samples`` 16-bit samples."""

    def __init__(self, samples: int = SAMPLES, kept_terms: int = KEPT_TERMS):
        self.samples, self.kept = samples, kept_terms
        self.rows: dict[bytes, int] = {}
        self.hashes = np.empty(kept_terms, np.uint64)
        shape = (kept_terms, samples)
        self.base, self.r, self.b = (np.empty(shape, np.float32) for _ in range(3))
        self.number = np.arange(samples, dtype=np.uint64)

    def _uniform(self, hashes: np.ndarray, draw: int) -> np.ndarray:
        """Numbers in (0, 1), one per term and sample."""
        at = hashes[:, None] + (self.number * _U(5) + _U(draw + 1)) * _U(0x9E3779B97F4A7C15)
        return ((_mixed(at) >> _U(11)).astype(np.float64) + 0.5) / 2.0**53

    def _learn(self, terms: list[bytes]) -> None:
        if len(self.rows) + len(terms) > self.kept:
            self.rows.clear()
        first = len(self.rows)
        at = slice(first, first + len(terms))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, terms), np.uint64, len(terms))
        u = [self._uniform(hashes, k) for k in range(5)]
        r, c, b = -np.log(u[0] * u[1]), -np.log(u[2] * u[3]), u[4]
        self.hashes[at] = hashes
        self.r[at], self.b[at] = r, b
        self.base[at] = np.log(c) + r * b - r
        self.rows.update(zip(terms, range(first, first + len(terms))))

    def _least(self, terms: list[bytes], weights: list[int]) -> tuple[np.ndarray, ...]:
        """For each sample the least rank, its term's hash and step."""
        new = [t for t in terms if t not in self.rows]
        if new:
            self._learn(new)
            if len(new) < len(terms):  # the tables may have started anew
                new = [t for t in terms if t not in self.rows]
                if new:
                    self._learn(new)
        rows = np.fromiter(map(self.rows.__getitem__, terms), np.int64, len(terms))
        w = np.array(weights)
        rank = self.base[rows]
        step = np.zeros(rank.shape, np.float32)
        more = np.flatnonzero(w > 1)
        if len(more):
            r = self.r[rows[more]]
            step[more] = np.floor(np.log(w[more], dtype=np.float32)[:, None] / r + self.b[rows[more]])
            rank[more] -= r * step[more]
        best = rank.argmin(0)
        k = np.arange(self.samples)
        return rank[best, k], self.hashes[rows[best]], step[best, k]

    def fingerprint(self, text: str) -> bytes:
        counts = Counter(text.encode().lower().split()) or Counter([b""])
        terms, weights = list(counts), list(counts.values())
        found = None
        for start in range(0, len(terms), TERMS_AT_ONCE):
            part = self._least(terms[start : start + TERMS_AT_ONCE], weights[start : start + TERMS_AT_ONCE])
            if found is None:
                found = part
            else:
                lower = part[0] < found[0]
                found = tuple(np.where(lower, new, old) for new, old in zip(part, found))
        steps = found[2].astype(np.int64).view(np.uint64)
        mixed = _mixed(found[1] ^ _mixed(steps + self.number * _U(0x9E3779B97F4A7C15)))
        return (mixed >> _U(48)).astype("<u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The share of equal samples: an estimate of the generalised Jaccard similarity."""
    return float((np.frombuffer(a, "<u2") == np.frombuffer(b, "<u2")).mean())


def sampler(samples: int) -> Sampler:
    """The worker's sampler."""
    return held("samplers", samples, lambda: Sampler(samples))


def _signatures(samples: int):
    def signatures(batches):
        draw = sampler(samples)
        for batch in slices(batches, keep=True):
            kept = [n for n in batch.schema.names if n != "text"]
            prints = [draw.fingerprint(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in kept), pa.array(prints, pa.binary())], names=[*kept, "signature"]
            )

    return signatures


def signatures(docs: DataFrame, text_col: str = "text", samples: int = SAMPLES, **keep) -> DataFrame:
    """The ``keep`` columns of each document and its ``signature``, two bytes per sample."""
    ship(docs.sparkSession)
    rows = docs.select(*(c.alias(n) for n, c in keep.items()), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(_signatures(samples), with_fields(rows, [*keep], "signature binary"))


# --- each document beside the next one -----------------------------------------------

_FIELDS = [
    ("n_chars", pa.int64()),
    ("edited_sha256", pa.string()),
    ("fingerprint", pa.binary()),
    ("edited_fingerprint", pa.binary()),
    ("near_edited", pa.float64()),
    ("near_next", pa.float64()),
]
_RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double"
)


def edited(text: str, following: str) -> str:
    """The last quarter of a text replaced by the first characters of the next one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _compare(draw: Sampler, text: str, own: bytes, following: str, other: bytes) -> tuple:
    changed = edited(text, following)
    changed_print = draw.fingerprint(changed)
    return (
        len(text),
        sha256(changed.encode()).hexdigest(),
        own,
        changed_print,
        likeness(own, changed_print),
        likeness(own, other),
    )


def _walk(samples: int):
    """Documents in order: each beside the next; the partition's ends go out with their texts."""

    def batch_of(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        types = [kind, *(t for _, t in _FIELDS), pa.int32(), pa.string(), pa.string()]
        names = ["doc_id", *(n for n, _ in _FIELDS), "part", "edge", "text"]
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def walk(batches):
        draw, part = sampler(samples), TaskContext.get().partitionId()
        last = kind = None
        for batch in slices(batches, keep=True):
            kind = batch.column("doc_id").type
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = draw.fingerprint(text)
                if last is None:
                    rows.append((doc, *[None] * 6, part, "first", text))
                else:
                    before, before_text, before_print = last
                    rows.append((before, *_compare(draw, before_text, before_print, text, own), part, None, None))
                last = (doc, text, own)
            yield batch_of(rows, kind)
        if last:
            yield batch_of([(last[0], *[None] * 6, part, "last", last[1])], kind)

    return walk


def _ends(samples: int):
    def ends(batches):
        draw = sampler(samples)
        for batch in slices(batches, keep=True):
            rows = [
                (doc, *_compare(draw, text, draw.fingerprint(text), nxt, draw.fingerprint(nxt)))
                for doc, text, nxt in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "following")))
            ]
            columns = list(zip(*rows)) or [[]] * 7
            types = [batch.column("doc_id").type, *(t for _, t in _FIELDS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", *(n for n, _ in _FIELDS)]
            )

    return ends


def beside_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is by ascending doc_id (null first; equal ids by a hash of the
    text), after the last the first. Documents are range-partitioned once; within a partition
    they stream by in order, and only the first and last of each partition meet those
    of its neighbours in a second, small step.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    names = ["doc_id", *(n for n, _ in _FIELDS)]
    walked = staged(
        ordered.mapInArrow(_walk(samples), with_fields(rows, ["doc_id"], _RESULT + ", part int, edge string, text string")),
        "walked",
    )
    # One number per partition.
    parts = sorted(r.part for r in walked.filter("edge = 'first'").select("part").collect())
    pairs = spark.createDataFrame(list(zip(parts, [*parts[1:], *parts[:1]])), "part int, next_part int")
    lasts = walked.filter("edge = 'last'").select("doc_id", "text", "part")
    firsts = walked.filter("edge = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    edges = lasts.join(F.broadcast(pairs), "part").join(firsts, "next_part").select("doc_id", "text", "following")
    done = edges.mapInArrow(_ends(samples), with_fields(rows, ["doc_id"], _RESULT))
    return walked.filter("edge IS NULL").select(*names).unionByName(done)
