"""The registered queries on the smallest tables: against DuckDB, or against plain Python."""

import re
from hashlib import sha256
from zlib import crc32

import oracle
import pytest
from test_decontaminate import by_rule as hits_by_rule
from test_linededup import by_rule as lines_by_rule
from test_neardup import kept_by_rule
from test_packing import check as check_pieces
from test_rollups import by_rule as totals_by_rule
from test_simhash import by_rule as print_by_rule
from test_simhash import groups
from test_weighted import true_likeness

import __spark_entry__ as entry
import corpus_pipeline
from pairloom.llm import decontaminate, queries


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


def rows_of(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet").collect()


def test_all_are_registered():
    assert queries.QUERIES.keys() <= entry.queries().keys()
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf, con, name):
    assert oracle.compare(queries.QUERIES[name](spark, sf), con, queries.ORACLES[name]) is None


def test_simhash(spark, sf):
    prints = {r.doc_id: print_by_rule(r.text) for r in rows_of(spark, sf, "documents")}
    root = groups(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op1_simhash"](spark, sf).collect()}
    assert got == {i: (f"{p:016x}", root[i]) for i, p in prints.items()}


def test_rollups(spark, sf):
    docs = {r.doc_id: r for r in rows_of(spark, sf, "documents")}
    load = [("insert", 0, d.doc_id, d.source, d.lang, d.text) for d in docs.values()]
    review = [
        ("delete" if r.toxic else "revise", 0, d.doc_id, d.source, d.lang, d.text[: len(d.text) // 2])
        for r in rows_of(spark, sf, "labels")
        if (r.toxic or not r.quality) and (d := docs[r.doc_id])
    ]
    got = {
        (r.source, r.lang, {"word_bpe_49k": "bpe"}.get(r.tokenizer, r.tokenizer)): (r.n_docs, r.n_tokens)
        for r in queries.QUERIES["op8_rollups"](spark, sf).collect()
    }
    assert got == totals_by_rule([load, review])


def test_chat(spark, sf):
    rows = queries.QUERIES["op10_chat"](spark, sf).collect()
    turns = sorted(rows_of(spark, sf, "conversations"), key=lambda r: (r.conv_id, r.turn))
    by_id = {-7: [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")]}
    for t in turns:
        by_id.setdefault(t.conv_id, []).append((t.role, t.text or ""))
    assert {r.conv_id for r in rows} == by_id.keys()
    for r in rows:
        whole = "".join(f"{role}\n{text}\n" for role, text in by_id[r.conv_id])
        said = "".join(text for role, text in by_id[r.conv_id] if role == "assistant")
        assert (r.turns_sha256, r.loss_sha256) == tuple(sha256(s.encode()).hexdigest() for s in (whole, said))
        shown = 0
        for role, text in by_id[r.conv_id]:
            # A mark more for each control string: the marks of the template and the backslash itself.
            shown += len("### " + role + ": " + text + "</turn>\n") + len(re.findall(r"\\|### |: |</turn>", role))
            shown += len(re.findall(r"\\|### |</turn>", text))
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(by_id[r.conv_id]), len(said), shown)


def test_quality(spark):
    """Folds and decisions by rule, whole tables, and scores that tell held-out labels apart."""
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in rows_of(spark, sf, "documents")}
    rows = {r.doc_id: r for r in queries.QUERIES["op5_quality"](spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        assert r.held_out == (crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    told = [(rows[r.doc_id].score, r.quality) for r in rows_of(spark, sf, "labels") if rows[r.doc_id].held_out]
    good, poor = ([s for s, q in told if q == k] for k in (1, 0))
    assert sum((g > p) + (g == p) / 2 for g in good for p in poor) >= 0.9 * len(good) * len(poor)


def test_weighted(spark, sf):
    """Every row against the true weighted similarities: 64 samples have an error of 0.0625 at most, as deviations go."""
    docs = sorted((r.doc_id, r.text or "") for r in rows_of(spark, sf, "documents"))
    rows = {r.doc_id: r for r in queries.QUERIES["op9_weighted"](spark, sf).collect()}
    prints, errors = {}, []
    for (i, text), (_, following) in zip(docs, [*docs[1:], docs[0]]):
        r, cut = rows.pop(i), len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        assert (r.n_chars, r.edited_sha256) == (len(text), sha256(edited.encode()).hexdigest())
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint and prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        errors += [r.near_edited - true_likeness(text, edited), r.near_next - true_likeness(text, following)]
    assert not rows
    assert max(map(abs, errors)) < 0.35 and abs(sum(errors) / len(errors)) < 0.02
    assert (sum(e * e for e in errors) / len(errors)) ** 0.5 < 0.0625


def test_pipeline_stage_by_stage(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    inputs, outputs = {}, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if name != "pack":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        inputs[name] = docs.collect()
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        outputs[name] = docs.collect()
    labels = {r.doc_id: r.quality for r in rows_of(spark, sf, "labels")}
    kept = {r.doc_id for r in outputs["quality"]}
    good = [i for i, q in labels.items() if q]
    assert sum(i in kept for i in good) >= 0.99 * len(good)
    assert kept < {r.doc_id for r in inputs["quality"]}
    assert {(r.doc_id, r.text) for r in outputs["line_dedup"]} == set(
        lines_by_rule(sorted((r.doc_id, r.text) for r in inputs["line_dedup"]))
    )
    assert sorted(r.doc_id for r in outputs["near_dedup"]) == kept_by_rule(sorted((r.doc_id, r.text) for r in inputs["near_dedup"]))
    items = [(str(r.item_id), decontaminate.words_of(r.text.encode())) for r in rows_of(spark, sf, "benchmark")]
    left = {r.doc_id: r.text for r in outputs["decontaminate"]}
    for r in inputs["decontaminate"]:
        words = decontaminate.words_of(r.text.encode())
        hit, _ = hits_by_rule(words, items)
        assert (r.doc_id in left) == (not hit or 20 * len(hit) < len(words))
        if not hit:
            assert left[r.doc_id] == r.text
    check_pieces(outputs["pack"], {r.doc_id: [r.text] for r in inputs["pack"]}, 2048)
    again = {(r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, sf).collect()}
    assert {(i, n) for i, n, _ in again} >= {(r.doc_id, 0) for r in outputs["pack"]}
