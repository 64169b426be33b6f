"""Batches on their way through workers, and what workers keep."""

import pyarrow as pa

from pairloom.llm import common


def batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["i", "text"])


def test_long_texts_come_in_small_slices():
    texts = ["x" * 100_000] * 2048 + ["y"] * 3000 + ["z" * (20 << 20)] * 2 + [None, ""]
    seen = []
    for part in common.slices([batch(texts)]):
        assert part.num_rows == 1 or part.nbytes <= common.BYTES_AT_ONCE
        assert part.num_rows <= common.ROWS_AT_ONCE
        seen += part.column("i").to_pylist()
    assert seen == list(range(len(texts)))
    assert list(common.slices([batch([])])) == []


def test_a_worker_keeps_one_kind_of_thing():
    made = []
    make = lambda name: lambda: made.append(name) or name
    for kind, key in (("a", 1), ("a", 2), ("a", 1), ("b", 1), ("a", 1)):
        assert common.held(kind, key, make((kind, key))) == (kind, key)
    assert made == [("a", 1), ("a", 2), ("b", 1), ("a", 1)]
