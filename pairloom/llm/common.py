"""Helpers that the operators share: worker code, staged tables, checked broadcasts."""

import ctypes
import gc
import io
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A table is broadcast only when its counted rows take less than this many bytes.
BROADCAST_BYTES = 32 << 20

#: Rows and bytes that a worker function has as Python objects at once (a longer row comes alone).
ROWS_AT_ONCE = 1024
BYTES_AT_ONCE = 4 << 20
#: Rows in a batch on its way to a worker, where the session has Spark's own number.
ROWS_PER_BATCH = 1000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application.

    Functions that run in tasks are then imported there by name, so what they load
    (tokenizers, automata) is kept between the tasks of a worker.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(ROWS_PER_BATCH))  # whole texts: ten thousand are too many for one batch
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    path = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    path.write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def slices(batches, rows: int = ROWS_AT_ONCE, size: int = BYTES_AT_ONCE, keep: bool = False):
    """Record batches cut small: what a worker makes of one batch is in memory at once.

    What other stages ``held`` in this worker goes first, unless this one holds something itself
    (``keep``), and what the task has freed goes back to the system at its end.
    """
    if not keep:
        _held.clear()
    _give_back()
    for batch in batches:
        k = 0
        while k < batch.num_rows:
            part = batch.slice(k, rows)
            while part.num_rows > 1 and part.nbytes > size:
                part = part.slice(0, part.num_rows // 2)
            k += part.num_rows
            yield part
        del batch
        pa.default_memory_pool().release_unused()
    _give_back()


def _give_back() -> None:
    """Freed memory that the allocators keep, back to the system, where they can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


_held: dict = {}


def held(kind: str, key, make):
    """What a worker keeps between its tasks, of one kind at a time.

    A worker outlives the stages of a pipeline; what one of them has loaded goes when the next one
    loads something else.
    """
    if kind not in _held:
        _held.clear()
        _held[kind] = {}
    if key not in _held[kind]:
        _held[kind][key] = make()
    return _held[kind][key]


def raw_text(column: str | Column) -> Column:
    """The UTF-8 bytes of a text; null is empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def lower_ascii(column: str | Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(column, upper, upper.lower())


def with_fields(df: DataFrame, kept: list[str], more: str) -> StructType:
    """The schema of a worker function that returns ``kept`` columns of ``df`` and ``more``."""
    return StructType([*(df.schema[n] for n in kept), *StructType.fromDDL(more)])


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, a staged table, marked for broadcast if its counted rows are within the limit.

    Beyond the limit the join that uses it shuffles both sides instead.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df
