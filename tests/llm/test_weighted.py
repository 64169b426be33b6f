from collections import Counter
from hashlib import sha256

import numpy as np
from awkward import documents, empty, prose

from pairloom.llm import weighted


def true_likeness(a, b):
    a, b = (Counter(t.encode().lower().split()) for t in (a, b))
    return (a & b).total() / max(1, (a | b).total())


def test_estimates_the_weighted_jaccard_similarity():
    draw = weighted.Sampler(512)
    errors = []
    for seed in range(40):
        a = prose(seed, 200) + " the" * (seed % 9)
        b = " ".join(a.split()[: 40 + 4 * seed]) + " the" * (seed % 5) + " " + prose(seed + 99, 30)
        errors.append(weighted.likeness(draw.fingerprint(a), draw.fingerprint(b)) - true_likeness(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.05


def test_tables_start_anew_without_changing_results():
    texts = [prose(k, 400) for k in range(6)]
    large, tiny = weighted.Sampler(64), weighted.Sampler(64, kept_terms=weighted.TERMS_AT_ONCE)
    tiny._learn([b"t%d" % k for k in range(weighted.TERMS_AT_ONCE - 100)])
    assert [large.fingerprint(t) for t in texts] == [tiny.fingerprint(t) for t in texts]
    long = prose(5, 30_000)
    assert large.fingerprint(long) == tiny.fingerprint(long)


def test_awkward_documents(spark):
    docs = documents(spark)
    order = sorted(
        docs.selectExpr("doc_id", "coalesce(text, '') AS t", "xxhash64(coalesce(text, '')) AS h").collect(),
        key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h),
    )
    want = []
    for r, following in zip(order, [*order[1:], order[0]]):
        cut = len(r.t) // 4
        text = r.t[: len(r.t) - cut] + following.t[:cut]
        want.append((r.doc_id, len(r.t), sha256(text.encode()).hexdigest()))
    rows = weighted.beside_next(docs).collect()
    got = [(r.doc_id, r.n_chars, r.edited_sha256) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    prints = {}
    for r in weighted.signatures(docs, doc_id=docs.doc_id, t=docs.text).collect():
        assert prints.setdefault(r.t or "", r.signature) == r.signature
    assert prints[""] == prints[" \n\t\n "]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_one_and_no_document(spark):
    one = spark.createDataFrame([(3, "a b c d")], "doc_id bigint, text string")
    (row,) = weighted.beside_next(one).collect()
    assert row.edited_sha256 == sha256(b"a b c a").hexdigest() and row.near_next == 1
    assert weighted.beside_next(empty(spark)).count() == 0


def test_error_at_the_samples_in_production():
    draw, errors, spread = weighted.sampler(weighted.SAMPLES), [], []
    for seed in range(300):
        a = prose(seed, 200) + " the" * (seed % 9)
        b = " ".join(a.split()[: 40 + seed % 160]) + " the" * (seed % 5) + " " + prose(seed + 999, 30)
        true = true_likeness(a, b)
        errors.append(weighted.likeness(draw.fingerprint(a), draw.fingerprint(b)) - true)
        spread.append(true * (1 - true) / weighted.SAMPLES)
    assert abs(np.mean(errors)) < 0.015
    assert 0.8 < np.std(errors) / np.mean(spread) ** 0.5 < 1.2
