import random

import pytest
from awkward import documents, empty, plain, prose

from pairloom.llm import decontaminate as dc


def by_rule(words, items):
    """Hit positions and items, by looking at every window."""
    hit, met = set(), set()
    for name, item in items:
        n = min(13, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                met.add(name)
    return hit, met - {None}


@pytest.mark.parametrize("seed", range(6))
def test_automaton_finds_every_window(seed):
    draw = random.Random(seed)
    alphabet = [b"%d" % k for k in range(2 + seed % 3)]
    items = [(str(k % 7), draw.choices(alphabet, k=draw.choice([1, 2, 5, 12, 13, 14, 30]))) for k in range(12)]
    automaton = dc.Automaton.of(items, 13)
    for _ in range(30):
        words = draw.choices([*alphabet, b"x"], weights=[8] * len(alphabet) + [1], k=60)
        a, b = draw.choice(items)[1], draw.choice(items)[1]
        words = [*words[:20], *a, *words[20:40], *b[2:], *words[40:]]
        spans, met = dc.hits(automaton, words)
        hit, want = by_rule(words, items)
        assert {p for s, e in spans for p in range(s, e)} == hit
        assert met == want
        assert spans == dc.union_spans(spans)


def test_awkward_tables(spark):
    passage = prose(9, 60)
    docs = documents(spark, [(20, passage), (21, prose(1, 500) + "\n" + passage.upper() + "\n" + prose(2, 900)), (22, "Solo!")])
    items = spark.createDataFrame(
        [(1, passage), (2, passage[40:]), (2, passage), (3, None), (4, " .,"), (None, "solo"), (5, prose(6, 30_000)[:400]), (6, "one")],
        "item_id bigint, text string",
    )
    got = {}
    for block_words in (400_000, 50):  # one block, and several
        found = dc.find_hits(docs, items, block_words=block_words, doc_id=docs.doc_id, text=docs.text, cleaned=True)
        got[block_words] = found.collect()
    assert len(got[50]) == len(got[400_000]) == docs.count()
    pool = [(str(r.item_id) if r.item_id is not None else None, dc.words_of((r.text or "").encode())) for r in items.collect()]
    for rows in got.values():
        for r in rows:
            words = dc.words_of((r.text or "").encode())
            hit, met = by_rule(words, pool)
            assert (r.n_words, set(r["items"])) == (len(words), met)
            assert {p for s in r.spans for p in range(s.start, s.end)} == hit
            assert dc.words_of(r.cleaned.encode()) == [w for k, w in enumerate(words) if k not in hit]
            if not hit:
                assert r.cleaned == (r.text or "")
    left = dc.decontaminate(docs, items)
    assert left.schema == docs.schema
    ids = {r.doc_id for r in left.select("doc_id").collect()}
    assert 20 not in ids and 22 not in ids and 12 not in ids and {0, 4, 5, 6, 10} <= ids


def test_no_rows(spark):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert not any(r.contaminated for r in dc.contamination(documents(spark), items).collect())
    assert dc.contamination(empty(spark), items).count() == 0
    assert len(plain(dc.decontaminate(documents(spark), items), "doc_id")) == documents(spark).count()
