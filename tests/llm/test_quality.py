from itertools import combinations
from zlib import crc32

import numpy as np
from awkward import documents, empty

from pairloom.llm import quality


def test_pairs_by_squares_equal_pairs_by_sums():
    draw = np.random.default_rng(1)
    machine = quality.Machine(
        0.3, draw.normal(size=quality.FEATURES), draw.normal(size=(quality.FEATURES, quality.RANK))
    )
    rows = [quality.features(t, n) for t, n in ((b"a b b c\nA!! d", 12), (b"", None), (b"x y", 3))]
    got, _ = machine.margins(*quality._joined(rows))
    for (at, values), margin in zip(rows, got):
        pairs = sum(
            machine.factors[i] @ machine.factors[j] * x * y for (i, x), (j, y) in combinations(zip(at, values), 2)
        )
        linear = sum(machine.weights[i] * x for i, x in zip(at, values))
        assert abs(margin - (0.3 + linear + pairs)) < 1e-4


def test_features_are_in_range():
    for raw in (b"", b"\n\n", b"A" * 100_000, b"|" * 50, "é".encode() * 9, b"1 2 3 http://x http://y"):
        for chars in (None, -1, 0, 10**12):
            at, values = quality.features(raw, chars)
            assert len(at) == len(values) and 0 <= min(at) and max(at) < quality.FEATURES
            assert len(quality.structure(raw, raw.split(), {}, chars)) == quality.STATISTICS


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.train(docs, labels, rows=3000)
    rows = quality.scored(docs.join(labels, "doc_id"), machine, doc_id=docs.doc_id, quality=labels.quality).collect()
    test = [r for r in rows if crc32(str(r.doc_id).encode()) % 5 == 0]
    right = sum((r.score >= quality.GOOD) == r.quality for r in test)
    assert len(test) > 300 and right >= 0.97 * len(test)


def test_awkward_documents(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(0, 1, 0), (0, 1, 0), (1, 1, 0), (3, 0, 1), (7, 0, 0), (None, 1, 0), (10, None, 0), (12, 2, 0), (99, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    machine = quality.train(docs, labels)
    again = quality.train(docs.repartition(5), labels.repartition(2))
    assert np.array_equal(machine.factors, again.factors)
    scores = quality.scored(docs, machine, doc_id=docs.doc_id).collect()
    assert len(scores) == docs.count() and all(0 <= r.score <= 1 for r in scores)
    kept = quality.keep_good(docs, labels, good=0.0)
    assert kept.schema == docs.schema and kept.count() == docs.count()
    assert quality.keep_good(docs, labels, good=1.1).count() == 0


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    machine = quality.train(documents(spark), none)
    assert {round(r.score, 6) for r in quality.scored(documents(spark), machine).collect()} == {0.5}
    assert quality.keep_good(empty(spark), none).count() == 0
