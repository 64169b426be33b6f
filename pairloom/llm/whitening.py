"""Embedding whitening from a bit-sliced scatter matrix.

An entry ``c`` becomes the whole number ``x = floor(64 c) + 1000000``. The covariance is taken
over the *fit list*, every distinct ``x`` vector once. For a block of rows each
dimension, shifted to start at zero, is cut into bit planes, and a plane is packed
across the rows into 64-bit words. Then ``sum_r u_r v_r = sum_{a,b} 2^(a+b) popcount(U_a & V_b)``
is exact, a plane of ones gives the sums and the row count in the same sweep, and blocks add up
as whole numbers in limbs of 32 bits, whatever the order and the number of rows. Centring,
``n sum xy - S_x S_y``, happens in whole numbers; only the finished covariance becomes double
and goes to ``eigh``.

What goes through the driver is bounded by the dimension, not by the rows: the scatter
matrix, and the model that every task gets (at most 16 components). The fit list is a
shuffle on packed vectors, one to eight bytes an entry, with repeats merged before it.

Rows whose vector is null, or holds null or non-finite entries, or entries of which
``64 c`` is not below 2^62, are dropped. The dimension is the most frequent length of
the distinct vectors (ties: the longest); rows of other lengths are dropped. Null and repeated ids keep
their rows. Components whose eigenvalue is below ``RANK_FLOOR`` of the largest are left out,
since doubles cannot scale them to unit variance: a table of equal vectors, and an empty
one, give no rows. Other columns of the table are not read.
"""

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from .common import ship, slices, with_fields

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
RANK_FLOOR = 1e-11
#: Entries that a block of rows has unpacked at once.
BLOCK_ENTRIES = 1 << 18
LIMBS = 4
_LIMB = (1 << 32) - 1
_LARGEST = float(1 << 62)


@dataclass
class Whitening:
    """A fitted model. ``sums`` are those of ``floor(64 c)``: the offset cancels in every difference."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, y: np.ndarray) -> np.ndarray:
        """``n x - S``, exact: whole numbers of 64 bits, or Python's where those are too short."""
        most = max(map(abs, self.sums), default=0)
        if y.size and int(np.abs(y).max()) * self.n + most >= 1 << 62:
            y = y.astype(object)
        return y * self.n - np.array(self.sums, y.dtype)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred / self.n).astype(float) @ (self.vectors / np.sqrt(self.values))


def _block_rows(dim: int) -> int:
    return max(64, min(4096, BLOCK_ENTRIES // max(dim, 1)) // 64 * 64)


def _rows_by_length(column: pa.ListArray):
    """(row numbers, ``floor(64 c)``) of the usable rows, for each length."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    entries = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    for length in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        with np.errstate(over="ignore", invalid="ignore"):
            y = np.floor(entries[offsets[rows][:, None] + np.arange(length)] * SCALE)
            usable = (np.abs(y) < _LARGEST).all(1)  # false for nulls and non-finite entries too
        yield rows[usable], y[usable].astype(np.int64)


def packed(y: np.ndarray) -> list[bytes]:
    """One name for each vector: the bytes an entry takes, then the entries."""
    wide = np.zeros(len(y), np.int8) + 8
    for width in (4, 2, 1):
        kind = np.iinfo(f"<i{width}")
        wide[(y.min(1) >= kind.min) & (y.max(1) <= kind.max)] = width
    out = [b""] * len(y)
    for width in np.unique(wide).tolist():
        rows = np.flatnonzero(wide == width)
        flat, step = y[rows].astype(f"<i{width}").tobytes(), width * y.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = bytes([width]) + flat[k * step : (k + 1) * step]
    return out


def unpacked(names: list[bytes], dim: int) -> np.ndarray:
    out = np.empty((len(names), dim), np.int64)
    widths = np.array([name[0] for name in names], np.int8)
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        flat = np.frombuffer(b"".join(names[r] for r in rows.tolist()), np.uint8).reshape(len(rows), -1)
        out[rows] = flat[:, 1:].copy().view(f"<i{width}")
    return out


def _distinct_in_batch(batches):
    for batch in slices(batches):
        found = {(y.shape[1], name) for _, y in _rows_by_length(batch.column("vector")) for name in packed(y)}
        dims, names = zip(*sorted(found)) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(dims, pa.int32()), pa.array(names, pa.binary())], names=["dim", "x"])


def cross_products(y: np.ndarray) -> np.ndarray:
    """Limbs of the exact sums of products of all columns of ``y`` and a column of ones.

    The result is upper triangular: (limb, i, j) with i <= j, where the last i and j are the ones.
    """
    n, dim = y.shape
    least = y.min(0)
    shifted = (y - least).astype(np.uint64)
    bits = [int(m).bit_length() for m in shifted.max(0)]
    words = -(-n // 64)

    def plane(column: np.ndarray) -> np.ndarray:
        room = np.zeros(words * 8, np.uint8)
        found = np.packbits(column)
        room[: len(found)] = found
        return room.view(np.uint64)

    planes = [plane((shifted[:, d] >> np.uint64(b)) & np.uint64(1) != 0) for d in range(dim) for b in range(bits[d])]
    planes = np.stack([*planes, plane(np.ones(n, bool))])
    owner = np.array([d for d in range(dim) for _ in range(bits[d])] + [dim])
    bit = np.array([b for d in range(dim) for b in range(bits[d])] + [0])
    wide = 2 * max(bits, default=0) + n.bit_length() >= 62 or n * max(1, int(np.abs(least).max(initial=0))) ** 2 >= 1 << 60
    kind = object if wide else np.int64
    sums = np.zeros((dim + 1, dim + 1), kind)
    for q in range(len(planes)):
        ones = np.bitwise_count(planes[q] & planes[q:]).sum(1, dtype=np.int64).astype(kind)
        shift = (bit[q] + bit[q:] + ((owner[q:] == owner[q]) & (np.arange(q, len(planes)) > q))).astype(kind)
        starts = np.flatnonzero(np.diff(owner[q:], prepend=-1))
        sums[owner[q], owner[q:][starts]] += np.add.reduceat(ones << shift, starts)
    # Back to where the columns were before the shift.
    low, part = np.array([*least.tolist(), 0], kind), sums[:, dim].copy()
    part[dim] = 0
    sums += np.triu(np.outer(low, part) + np.outer(part, low) + n * np.outer(low, low))
    sums[:dim, dim] += n * low[:dim]
    if not wide:
        return np.stack([sums & _LIMB, sums >> 32, *[np.zeros_like(sums)] * (LIMBS - 2)])
    high = sums >> 32 * (LIMBS - 1)
    return np.stack([*((sums >> 32 * k) & _LIMB for k in range(LIMBS - 1)), high]).astype(np.int64)


def _scatter(dim: int):
    def scatter(batches):
        total = np.zeros((LIMBS, dim + 1, dim + 1), np.int64)
        for batch in slices(batches, _block_rows(dim)):
            if batch.num_rows:
                total += cross_products(unpacked(batch.column("x").to_pylist(), dim))
        i, j = np.triu_indices(dim + 1)
        if total[0, dim, dim]:
            arrays = [i.astype(np.int32), j.astype(np.int32), *(t[i, j] for t in total)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["i", "j", *_LIMB_NAMES])

    return scatter


_LIMB_NAMES = [f"limb{k}" for k in range(LIMBS)]


def _model(total: pa.Table, dim: int, components: int) -> Whitening:
    sums = np.zeros((dim + 1, dim + 1), object)
    limbs = [total[name].to_pylist() for name in _LIMB_NAMES]
    for i, j, *parts in zip(total["i"].to_pylist(), total["j"].to_pylist(), *limbs):
        sums[i, j] = sums[j, i] = sum(p << 32 * k for k, p in enumerate(parts))
    n, s = sums[dim, dim], sums[:dim, dim]
    scaled = n * sums[:dim, :dim] - np.outer(s, s)  # n squared times the covariance
    values, vectors = np.linalg.eigh(np.array([[v / (n * n) for v in row] for row in scaled.tolist()]))
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = min(components, int((values > max(values[0], 0) * RANK_FLOOR).sum()))
    vectors = vectors[:, :kept]
    top = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[top, np.arange(kept)] < 0, -1.0, 1.0)
    return Whitening(n, s.tolist(), vectors, values[:kept], sum(np.diag(scaled)) / (n * n))


def _moments(shared, dim: int):
    def moments(batches):
        model: Whitening = shared.value
        total = np.zeros((len(model.values) + 1,) * 2)
        for batch in slices(batches, _block_rows(dim)):
            if batch.num_rows:
                w = model.whitened(model.centred(unpacked(batch.column("x").to_pylist(), dim)))
                w = np.column_stack([w, np.ones(len(w))])
                total += w.T @ w
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a.ravel()) for a in (i.astype(np.int32), j.astype(np.int32), total)], names=["i", "j", "total"]
        )

    return moments


def fit(embeddings: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS):
    """The model over the distinct vectors, and the largest error of their whitened covariance.

    ``None`` and 0.0 where no vector is usable.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vectors = embeddings.select(F.col(vector_col).alias("vector")).filter("vector IS NOT NULL")
    listed = staged(vectors.mapInArrow(_distinct_in_batch, "dim int, x binary").distinct(), "fit_list")
    lengths = listed.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return None, 0.0
    dim = lengths["dim"]
    listed = listed.filter(F.col("dim") == dim).select("x")
    limbs = ", ".join(f"{name} bigint" for name in _LIMB_NAMES)
    total = (
        listed.mapInArrow(_scatter(dim), f"i int, j int, {limbs}")
        .groupBy("i", "j")
        .agg(*[F.sum(name).alias(name) for name in _LIMB_NAMES])
        .toArrow()
    )
    model = _model(total, dim, components)
    kept = len(model.values)
    if not kept:
        return model, 0.0
    shared = spark.sparkContext.broadcast(model)
    moments = np.zeros((kept + 1, kept + 1))
    summed = listed.mapInArrow(_moments(shared, dim), "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    for row in summed.collect():
        moments[row["i"], row["j"]] = row["total"] / model.n
    shared.destroy()
    centred = moments[:kept, :kept] - np.outer(moments[:kept, kept], moments[:kept, kept])
    return model, float(np.abs(centred - np.eye(kept)).max())


_DEVIATION = pa.decimal128(38, 0)
_TOO_LONG = 10**38


def _deviations(centred: np.ndarray) -> pa.Array:
    most = int(np.abs(centred).max()) if centred.size else 0
    if centred.dtype != object and centred.shape[1] * most**2 < 1 << 62:
        return pa.array((centred**2).sum(1)).cast(pa.decimal128(19, 0)).cast(_DEVIATION)
    exact = (centred.astype(object) ** 2).sum(1).tolist()
    return pa.array([Decimal(v) if v < _TOO_LONG else None for v in exact], _DEVIATION)


def _project(shared, error: float):
    def project(batches):
        model: Whitening = shared.value
        dim, kept = model.vectors.shape
        explained = model.values / model.trace
        for batch in slices(batches, _block_rows(dim)):
            for rows, y in _rows_by_length(batch.column("vector")):
                if y.shape[1] != dim or not len(y):
                    continue
                centred = model.centred(y)
                whole = pa.array(np.repeat(rows, kept))
                count = len(whole)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(whole),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(y))),
                        pa.array(np.full(count, model.n)),
                        _deviations(centred).take(pa.array(np.repeat(np.arange(len(y)), kept))),
                        pa.array(model.whitened(centred).ravel()),
                        pa.array(np.tile(explained, len(y))),
                        pa.array(np.full(count, error)),
                    ],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return project


_RESULT = (
    "component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """A row for each usable vector and component, the strongest component first.

    The id, ``component``, ``n`` (rows of the fit list), ``deviation`` (the sum over dimensions of
    ``(n x - S)^2``; null past 38 digits), ``whitened`` (the centred vector's projection
    over the component's standard deviation), ``explained`` (the component's share of the variance)
    and ``identity_error`` (how far the whitened fit list's covariance is from the identity).
    """
    spark = embeddings.sparkSession
    model, error = fit(embeddings, vector_col, components)
    rows = embeddings.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    schema = with_fields(rows, ["id"], _RESULT)
    if model is None or not len(model.values):
        out = spark.createDataFrame([], schema)
    else:
        out = rows.filter("vector IS NOT NULL").mapInArrow(_project(spark.sparkContext.broadcast(model), error), schema)
    return out.withColumnRenamed("id", id_col)
