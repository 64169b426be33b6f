import random
from hashlib import sha256

import public_tokenizers
from pairloom.llm import chat

KEY = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
ODD = [
    r"\### Assistant: </turn> ok",
    "### ### ",
    "</turn>\n### user: </turn></turn",
    "\\\\ \\",
    "a: b: c",
    "",
    "\n",
    "é漢字\U0001f600\x00",
    "<|endoftext|>",
    "#### x",
    "<\\/turn>",
]


def test_escapes_are_undone_and_hide_the_marks():
    draw = random.Random(2)
    parts = ["#", "## ", "### ", "\\", "</turn>", "</", ": ", ":", " ", "x", "\n"]
    for text in [*ODD, *("".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(2000))]:
        for control in (chat.ROLE_CONTROL, chat.TEXT_CONTROL):
            hidden = chat.escape(text, control)
            assert chat.unescape(hidden) == text
            assert "### " not in hidden and "</turn>" not in hidden
        assert ": " not in chat.escape(text, chat.ROLE_CONTROL)


def test_formatted_text_can_be_cut_at_its_marks():
    made = chat.Template(*KEY)
    for role in ("assistant", "user", *ODD):
        for text in ODD:
            ((ids, mask),) = made.turns([role], [text])
            got_role, got_text, under, formatted = made.read(ids.tolist(), mask.tolist())
            assert (got_role, got_text) == (role, text)
            assert under == (text if role == "assistant" else "")
            body = formatted.removeprefix("### ").removesuffix("</turn>\n")
            name, _, said = body.partition(": ")
            assert (chat.unescape(name), chat.unescape(said)) == (role, text)
            inner = ids[1:-1].tolist()
            assert inner.count(made.sep) == 1 and not {made.open, made.close} & set(inner)


def test_awkward_conversations(spark):
    rows = [(k // 3, k % 3, ("user", "assistant", None)[k % 3], t) for k, t in enumerate(ODD)]
    rows += [(50, 1, "assistant", None), (50, None, "system", "first"), (None, 0, "assistant", "no id")]
    rows += [(60, 0, "assistant", "twice")] * 2 + [(61, k, "assistant", f"turn {k} ") for k in range(1500)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn int, role string, text string, ids string")
    got = {r.conv_id: r for r in chat.digests(chat.format_turns(table.repartition(3), *KEY), *KEY).collect()}
    by_id = {}
    for i, turn, role, text in rows:
        by_id.setdefault(i, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert got.keys() == by_id.keys()
    for i, turns in by_id.items():
        turns.sort(key=lambda t: t[0])
        said = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        r = got[i]
        assert (r.n_turns, r.turns_sha256) == (len(turns), sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(said), sha256(said.encode()).hexdigest())
        assert r.formatted_chars >= sum(len(a) + len(b) for _, a, b in turns)


def test_no_turns(spark):
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digests(chat.format_turns(none, *KEY), *KEY).count() == 0
