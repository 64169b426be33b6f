"""Personal data: the patterns against plain expressions, the chain against all label sequences."""

import random
import re
import time
from hashlib import sha256
from itertools import product

import awkward
import numpy as np
import pytest
from pairloom.llm import personal
from pairloom.llm.queries import QUERIES
from pyspark.sql import functions as F

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def by_rule(text):
    out = []
    for k, (kind, pattern) in enumerate(KINDS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fits:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns_equal_plain_expressions():
    draw = random.Random(2)
    for alphabet in ("a@.-1", "0123.", "01 -9", "+1()- .7", "a1.@+ -é\n"):
        for _ in range(1500):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 45)))
            assert personal.base_spans(text) == by_rule(text)
    for text in ("4111 1111 1111 1111", "x 192.168.0.256 000255.1.2.3", "a.b+c@d-e.f.gh@i.j", "+49 (30) 1234-567."):
        assert personal.base_spans(text) == by_rule(text)


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@a", "+1", "1 ", "a@", "a@b.c ", "+1234567890 ", "1.2.3.4 ", "- ", ". "])
def test_long_texts_take_linear_time(unit):
    text = unit * (300_000 // len(unit))
    begun = time.time()
    personal.base_spans(text)
    personal.tokens_of(text)
    assert time.time() - begun < 10


def test_tokens():
    text = "Dr. Müller-Weiß paid 12.50 €\n漢字 ok.  Then\x85x²"
    tokens = personal.tokens_of(text)
    assert [text[s:e] for s, e in zip(tokens.starts, tokens.ends)] == [
        "Dr", ".", "Müller", "-", "Weiß", "paid", "12", ".", "50", "€", "漢字", "ok", ".", "Then", "x", "²",
    ]
    assert tokens.sentence.tolist() == [0] * 10 + [1] * 6
    assert personal.tokens_of("Some words. Then").sentence.tolist() == [0, 0, 0, 1]
    assert len(personal.tokens_of("").starts) == len(personal.tokens_of(" \n").starts) == 0


@pytest.fixture(scope="module")
def chain():
    return personal.fit(personal.labelled_rows())


def all_scores(scores, follow, begin):
    for path in product(range(scores.shape[1]), repeat=len(scores)):
        total = begin[path[0]] + sum(scores[t, y] for t, y in enumerate(path))
        yield total + sum(follow[a, b] for a, b in zip(path, path[1:])), path


def test_decoding_and_expectations_equal_all_sequences():
    draw = np.random.default_rng(1)
    legal, may_begin = personal._legal(2)
    for _ in range(12):
        follow = np.where(legal, draw.normal(0, 1, legal.shape), personal._NEVER)
        begin = np.where(may_begin, draw.normal(0, 1, 5), personal._NEVER)
        lengths = np.array([4, 1, 3])
        starts = np.array([0, 4, 5])
        scores = draw.normal(0, 2, (8, 5))
        chain = personal.Chain(("a", "b"), np.zeros(0, np.uint64), np.zeros((1, 5)), follow, begin)
        out = np.zeros(8, np.int64)
        chain._decode(scores, starts, lengths, out)
        chance, moves, first = personal._expected(scores, starts, lengths, follow, begin)
        want_moves, want_first = np.zeros_like(follow), np.zeros(5)
        for s, n in zip(starts, lengths):
            found = list(all_scores(scores[s : s + n], follow, begin))
            assert tuple(out[s : s + n]) == max(found)[1]
            weights = np.exp(np.array([x for x, _ in found]) - max(found)[0])
            weights /= weights.sum()
            want = np.zeros((n, 5))
            for w, (_, path) in zip(weights, found):
                want[np.arange(n), path] += w
                want_first[path[0]] += w
                for a, b in zip(path, path[1:]):
                    want_moves[a, b] += w
            assert np.allclose(chance[s : s + n], want)
        assert np.allclose(moves, want_moves) and np.allclose(first, want_first)


def test_skipping_sentences_changes_no_label(chain):
    texts = [t for t, _ in personal.labelled_rows(2, seed=8)] + [awkward.prose(3, 300)]
    for text in texts:
        tokens = personal.tokens_of(text)
        starts = np.flatnonzero(np.diff(tokens.sentence, prepend=-1))
        whole = np.zeros(len(tokens.starts), np.int64)
        chain._decode(chain.emissions(tokens), starts, np.diff(np.append(starts, len(whole))), whole)
        assert (whole == chain.labels(tokens)).all()


def test_held_out_rows(chain):
    """Other fillings and other words around them than those trained on."""
    right = wrong = missed = 0
    for text, spans in personal.labelled_rows(5, seed=99):
        got = {(personal.FOUND_KINDS[k], s, e) for s, k, e in chain.spans(personal.tokens_of(text))}
        right, wrong, missed = right + len(got & {*spans}), wrong + len(got - {*spans}), missed + len({*spans} - got)
    assert right / (right + wrong) > 0.95 and right / (right + missed) > 0.95


def test_plain_prose_is_left_alone(spark, sf, chain):
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = [s for spans in personal._all_spans(chain, texts) for s in spans if s["kind"] in personal.FOUND_KINDS]
    assert len(found) <= 0.01 * len(texts)


def test_spans_beside_each_other(chain):
    text = "My name is Anna Lopez.\na@b.org\nTel: 030 1234567\n+49 30 1234567\nmy number is 555-0192."
    (spans,) = personal._all_spans(chain, [text])
    assert [(s["kind"], text[s["start"] : s["end"]]) for s in spans] == [
        ("person", "Anna Lopez"), ("email", "a@b.org"), ("contact", "030 1234567"), ("phone", "+49 30 1234567"), ("contact", "555-0192"),
    ]
    assert personal._apart([(0, 4, 3), (5, 4, 9), (12, 4, 13)], [(1, 0, 2), (1, 1, 2), (8, 2, 12)]) == [(12, 4, 13)]


def test_awkward_documents(spark, chain):
    many = "x@y.org 10.0.0.1 " * 6000
    docs = awkward.documents(spark, extra=[(30, many), (31, "My name is Anna Lopez."), (31, "My name is Anna Lopez.")])
    names = ["doc_id", "spans", "row", "a b", "kept", "fp"]
    keep = {f"k{k}": F.col(f"`{n}`") for k, n in enumerate(names)} | {"raw": F.col("text")}
    got = personal.find_personal(docs, chain, **keep).collect()
    want = docs.collect()
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), str(r[1]), str(r[2]))
    assert sorted(((r["k0"], r["raw"], r["k5"]) for r in got), key=key) == sorted(((r["doc_id"], r["text"], r["fp"]) for r in want), key=key)
    for r in got:
        base = [(s["start"], list(KINDS).index(s["kind"]), s["end"]) for s in r["spans"] if s["kind"] in KINDS]
        assert base == by_rule(r["raw"] or "")
    assert personal.find_personal(awkward.empty(spark), chain, doc_id=F.col("doc_id")).collect() == []


def test_nothing_to_train_on(spark):
    none = spark.createDataFrame([], f"text string, spans array<{personal.SPAN}>")
    some = spark.createDataFrame([(None, None), ("", None), ("words", None)], none.schema)
    for table in (none, some):
        chain = personal.train(table)
        (spans,) = personal._all_spans(chain, ["My name is Anna Lopez, a@b.org"])
        assert [s["kind"] for s in spans] == ["email"]
    assert len(personal.train(personal.labelled_table(spark, 1), rows=40).weights)


def test_registered_query(spark, sf):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_personal"](spark, sf).collect()
    assert {r.doc_id for r in rows} == texts.keys()
    for r in rows:
        base = by_rule(texts[r.doc_id])
        named = [f"{list(KINDS)[k]}:{s}:{e}" for s, k, e in base]
        assert r.base_sha256 == sha256(",".join(named).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in KINDS] == named
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in base) for i in range(4))
    assert sum(r.n_email for r in rows) and sum(r.n_card for r in rows)
