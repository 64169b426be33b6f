"""Spelling variants against all pairs of words in plain Python."""

import random
import re
from collections import Counter
from zlib import crc32

import awkward
import pytest
from pairloom.llm import variants

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_rule(counts: dict[str, int], ratio: int = 10) -> set[tuple]:
    close = {w: [u for u in counts if u != w and near(w, u)] for w in counts}
    form = {}
    for w, others in close.items():
        best = min(others, key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, counts[w], len(close[w]), form[w], counts.get(form[w]), root))
    return out


def counted(docs, least_length=7, least_count=2, slip_every=None) -> dict[str, int]:
    seen = Counter()
    for doc_id, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(UPPER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
            if slip_every and h % slip_every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least_length:
                seen[w] += 1
    return {w: n for w, n in seen.items() if n >= least_count}


def grouped(spark, counts, parts):
    rows = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return {tuple(r) for r in variants.group_variants(rows).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_equals_all_pairs(spark, parts):
    """Words of two letters, so that paths are shared over several partitions, and runs of a letter."""
    draw = random.Random(parts)
    counts = {"".join(draw.choice("ab") for _ in range(draw.randint(0, 7))): draw.choice([1, 2, 3, 30, 300, 4000]) for _ in range(250)}
    counts |= {"a" * k: 10**k for k in range(1, 12)} | {"é" * 3: 5, "é" * 2 + "ê": 50, "漢字": 3, "漢": 40, "\U0001f600漢": 1}
    assert grouped(spark, counts, parts) == by_rule(counts)


def test_long_words_cost_their_length(spark):
    draw = random.Random(1)
    long = "".join(draw.choice("abc") for _ in range(60_000))
    counts = {long: 2, long[:-1]: 30, long[:30_000] + long[30_001:]: 2, long[:100] + "x" + long[101:]: 4, "b" + long: 400}
    got = {r[0]: r for r in grouped(spark, counts, 3)}
    assert got[long][2:] == (4, "b" + long, 400, "b" + long)
    assert got[long[:-1]][2:] == (1, None, None, long[:-1])
    assert got["b" + long][2] == 1


def test_a_wide_group_is_not_expanded(spark):
    """Four thousand words that differ in one place: sixteen million pairs."""
    counts = {f"word{chr(0x4E00 + k)}end": 2 + k % 3 for k in range(4000)} | {"wordend": 100}
    got = grouped(spark, counts, 4)
    assert {r[2] for r in got} == {4000}
    assert all(r[3] == "wordend" for r in got if r[0] != "wordend")


def test_words_of_awkward_documents(spark):
    docs = awkward.documents(
        spark,
        extra=[
            (20, "Ünder-ÜNDERstand understand ünderstand9understand_understand"),
            (20, "x×÷ÿÿÿÿÿ ÀÉÎÕÜàéîõü " * 2),
            (21, "Straßenbahn straßenbahn STRAßENBAHN " + "q" * 50_000 + " " + "q" * 50_000),
        ],
    )
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    for settings in ({}, {"slip_every": 3}, {"least_length": 2, "least_count": 1, "slip_every": 2}):
        got = {r.word: r.n for r in variants.word_counts(docs, **settings).collect()}
        assert got == counted(rows, **settings)


def test_no_words(spark):
    words = variants.word_counts(awkward.empty(spark))
    out = variants.group_variants(words)
    assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"] and out.collect() == []


def test_one_word(spark):
    assert grouped(spark, {"lonesome": 3}, 4) == {("lonesome", 3, 0, None, None, "lonesome")}
