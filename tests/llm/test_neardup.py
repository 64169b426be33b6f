import random

from awkward import documents, empty, prose
from test_simhash import groups

import corpus_pipeline
from pairloom.llm import neardup


def sets_by_rule(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def is_near(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def kept_by_rule(rows):
    """The least id of each group that exact similarities join: every pair is compared."""
    found = [sets_by_rule(t) for _, t in rows]
    root = groups(range(len(rows)), lambda a, b: is_near(found[a], found[b]))
    return sorted({min(i for k, (i, _) in enumerate(rows) if root[k] == r) for r in root.values()})


def altered(text, seed, words):
    draw, out = random.Random(seed), text.split()
    for _ in range(words):
        out[draw.randrange(len(out))] = f"x{draw.randrange(10**6)}"
    return " ".join(out)


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    return sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())


def test_near_copies_against_all_pairs(spark):
    rows = []
    for seed in range(40):
        base = prose(seed, 60 + 11 * seed)
        n = len(base.split())
        for part in (0.005, 0.01, 0.018, 0.022, 0.026, 0.05):
            rows.append((len(rows), altered(base, len(rows), max(1, int(part * n)))))
        rows.append((len(rows), base))
    want = kept_by_rule(rows)
    assert 40 < len(want) < 200
    assert kept(spark, rows) == want


def test_a_large_group_is_joined_without_all_its_pairs(spark, monkeypatch):
    base = prose(7, 200)
    rows = [(k, altered(base, k, 1 + k % 4)) for k in range(250)] + [(900 + k, prose(50 + k, 30)) for k in range(20)]
    compared = []
    near = neardup._near

    def counted(pairs, sets):
        compared.append(pairs.count())
        return near(pairs, sets)

    monkeypatch.setattr(neardup, "_near", counted)
    assert kept(spark, rows) == kept_by_rule(rows)
    assert sum(compared) < 0.5 * 250 * 249 / 2


def test_short_texts_have_one_shingle():
    assert len(neardup.shingles(b"a b c")) == len(neardup.shingles(b"A b  c d\te")) == 1
    assert len(neardup.shingles(b" \n")) == 0 and neardup.band_keys(neardup.shingles(b"")) == []


def test_awkward_documents(spark):
    docs = documents(spark)
    left = neardup.keep_one(docs)
    assert left.schema == docs.schema
    found = {sets_by_rule(r.text) for r in docs.collect()}
    rows = left.collect()
    assert len(rows) == len(set(groups(range(len(found)), lambda a, b, s=list(found): is_near(s[a], s[b])).values()))
    assert {0, 4} <= {r.doc_id for r in rows} and not {1, 2, 3, 5, 6} & {r.doc_id for r in rows}
    assert neardup.keep_one(empty(spark)).count() == 0


def test_the_stage_meets_by_ball_hashing(spark, monkeypatch):
    """Candidates come from operator 1's balls; sets decide, so no pair below the similarity is linked."""
    base = prose(3, 2000)
    rows = [(0, base), (1, altered(base, 1, 2)), (2, prose(4, 300)), (3, "a b"), (4, "")]
    met, near = [], neardup._near

    def seen(pairs, sets):
        met.append(pairs.count())
        return near(pairs, sets)

    monkeypatch.setattr(neardup, "_near", seen)
    assert kept(spark, rows) == kept_by_rule(rows) == [0, 2, 3, 4]
    assert met[0] == 1
    sims = spark.createDataFrame([(10, 0), (11, 0), (12, 3), (13, -1), (14, 3 << 40 | 3)], "node bigint, sim bigint")
    pairs = {tuple(r) for r in neardup.met_in_balls(sims).collect()}
    assert (10, 11) in pairs and (10, 12) in pairs and (12, 14) in pairs and not any(13 in p for p in pairs)
