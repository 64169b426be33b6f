import random

import public_tokenizers
from awkward import documents
from tokenizers import Tokenizer

from pairloom.llm.rollups import RollupStore
from pairloom.staging import new_stage

PATH = public_tokenizers.path("word_bpe_49k.json")
CHANGES = "op string, seq bigint, doc_id bigint, source string, lang string, text string, counts string"


def by_rule(batches):
    """Totals of the documents that are left, counted anew."""
    tokenizer, docs, nameless = Tokenizer.from_file(PATH), {}, []
    for batch in batches:
        last = {}
        for op, seq, i, source, lang, text in batch:
            if i is None:
                nameless += [(source, lang, text)] if op != "delete" else []
            elif i not in last or seq > last[i][0]:
                last[i] = (seq, op, source, lang, text)
        for i, (_, op, source, lang, text) in last.items():
            docs.pop(i, None)
            if op != "delete":
                docs[i] = (source, lang, text)
    totals = {}
    for source, lang, text in [*docs.values(), *nameless]:
        text = text or ""
        counts = {"words": len(text.split()), "bpe": len(tokenizer.encode(text, add_special_tokens=False).ids)}
        for name, n in counts.items():
            docs_before, tokens = totals.get((source, lang, name), (0, 0))
            totals[source, lang, name] = (docs_before + 1, tokens + n)
    return totals


def read(store):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_random_batches(spark):
    draw = random.Random(5)
    store, batches = RollupStore(spark, new_stage(spark, "rollups"), {"bpe": PATH}), []
    assert read(store) == {}
    for b in range(4):
        batch = []
        for seq in range(25):
            op = draw.choice(["insert", "insert", "revise", "delete"])
            i = draw.choice([None, *range(12)])
            text = draw.choice([None, "", "one two", "three Four, five!", "six " * draw.randint(1, 30)])
            batch.append((op, seq, i, draw.choice([None, "a", "b"]), draw.choice([None, "en"]), text))
        batches.append(batch)
        changes = spark.createDataFrame([(*r, "x") for r in batch], CHANGES)
        assert store.apply(f"b{b}", changes)
        assert not store.apply(f"b{b}", changes)  # the same batch again
        assert read(store) == by_rule(batches)
    assert store.apply("none", spark.createDataFrame([], CHANGES))
    again = RollupStore(spark, store.path, {"bpe": PATH})
    assert again.committed() == ["b0", "b1", "b2", "b3", "none"] and read(again) == by_rule(batches)


def test_a_batch_that_failed_half_way_is_written_anew(spark):
    store = RollupStore(spark, new_stage(spark, "rollups"), {})
    rows = spark.createDataFrame([("insert", 0, 1, "s", "en", "a b c", "x")], CHANGES)
    store.apply("one", rows)
    whole = read(store)
    fs, marker = store._files("batch=one/_COMMITTED")
    fs.delete(marker, False)
    assert read(store) == {}
    assert store.apply("one", rows) and read(store) == whole


def test_awkward_documents(spark):
    store = RollupStore(spark, new_stage(spark, "rollups"), {})
    docs = documents(spark).selectExpr("'insert' AS op", "0L AS seq", "*")
    store.apply("load", docs)
    named = documents(spark).filter("doc_id IS NOT NULL").select("doc_id").distinct().count()
    assert sum(n for n, _ in read(store).values()) == named + 3  # three rows have no id
    store.apply("clear", docs.selectExpr("'delete' AS op", "seq", "doc_id", "source", "lang", "text"))
    assert sum(n for n, _ in read(store).values()) == 3
