import zlib

import numpy as np
import public_tokenizers
import pytest
from awkward import documents, empty
from tokenizers import Tokenizer

from pairloom.llm import packing, wordtokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Hello, World! don't we'll (yes) A.B.C. 3.14 x1y2",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>",
    "é É é ΣΑΣ ß ﬁ K  nbsp em \x1cfs\x1d \x85nel",
    "",
    " \n\t ",
    "漢字かな \U0001f600\U0001f600! ...,, ?!? word.,; it's'",
    "a" * 5000,
]


def plain_ids(text):
    return Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def test_encoder_equals_the_tokenizer():
    small = wordtokens.WordEncoder(PATH, cache_pieces=5)
    for made in (wordtokens.WordEncoder(PATH), small):
        for _ in range(2):
            got = [np.frombuffer(raw, "<u4").tolist() for raw in made.encode(TEXTS)]
            assert got == [plain_ids(t) for t in TEXTS]


def check(pieces, rows, window):
    by_row = {}
    for p in pieces:
        by_row.setdefault(p.doc_id, []).append(p)
    tokenizer = Tokenizer.from_file(PATH)
    for doc, texts in rows.items():
        ids = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
        own = sorted(by_row[doc], key=lambda p: p.start)
        assert sum(p.length for p in own) == sum(map(len, ids))
        if len(ids) == 1:
            at = 0
            for p in own:
                part = np.array(ids[0][at : at + p.length], "<u4")
                assert (p.start, p.ids_crc32, p.doc_tokens) == (at, zlib.crc32(part.tobytes()), len(ids[0]))
                if "ids" in p:
                    assert p.ids == part.tolist()
                at += p.length
    windows = {}
    for p in pieces:
        windows.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for spans in windows.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at and length > 0
            at += length
        assert at <= window
    return [sum(n for _, n in spans) for spans in windows.values()]


@pytest.mark.parametrize("window,most", [(2048, 64), (64, 4), (16, 1)])
def test_every_id_is_in_one_piece(spark, window, most):
    docs = documents(spark, [(100 + k, t) for k, t in enumerate(TEXTS)])
    rows = {}
    for r in docs.collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    pieces = packing.pack(docs, PATH, window=window, open_windows=most, with_ids=window == 64).collect()
    fills = check(pieces, rows, window)
    assert sum(f < window for f in fills) <= len(fills)


def test_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = packing.pack(docs, PATH).collect()
    fills = check(pieces, {r.doc_id: [r.text] for r in docs.collect()}, 2048)
    assert 1 - sum(fills) / (2048 * len(fills)) < 0.03


def test_no_documents(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
