"""Files that do not state their lines' places, and conversations with awkward keys."""

import json
import random

import pytest
from pyspark.sql import functions as F

from pairloom.functions import render
from pairloom.operators import chats, positions, skew
from pairloom.plans import jobs
from pairloom.sources import jsonl, lines


@pytest.fixture
def small_splits(spark):
    def cut(size):
        for k in ("maxPartitionBytes", "openCostInBytes"):
            spark.conf.set(f"spark.sql.files.{k}", str(size if k == "maxPartitionBytes" else 1))

    yield cut
    for k in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{k}")


def chat(k, words=3):
    said = [{"role": "user", "content": f"é question {k}\n" + "w " * words}, {"role": "assistant", "content": f"SELECT {k}"}]
    return {"messages": said}


def write(path, records, end="\n"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(end.join(json.dumps(r, ensure_ascii=False) for r in records).encode())


@pytest.mark.parametrize("size,end", [(64, "\n"), (1000, "\r\n"), (4096, "\n\n"), (1 << 27, "\n")])
def test_places_do_not_depend_on_the_splits(spark, tmp_path, small_splits, size, end):
    draw = random.Random(size)
    write(tmp_path / "chat.jsonl", [chat(k, draw.choice([0, 1, 300])) for k in range(400 if size > 300 else 30)], end)
    small_splits(size)
    got = jsonl.read_chat_jsonl(spark, str(tmp_path / "chat.jsonl")).collect()
    assert sorted((r["line_no"], r["messages"][1]["content"]) for r in got) == [(k, f"SELECT {k}") for k in range(len(got))] and len(got) in (30, 400)


def test_files_count_on_in_the_order_of_their_names(spark, tmp_path, small_splits):
    small_splits(500)
    for name, first in (("b", 60), ("a", 0), ("c", 90)):
        write(tmp_path / "in" / f"{name}.jsonl", [chat(k) for k in range(first, first + 30 + 30 * (name == "a"))])
    (tmp_path / "in" / "d.jsonl").write_text("")
    found = lines.numbered_records(spark, str(tmp_path / "in"), jsonl.CHAT).collect()
    assert sorted((r["line_no"], r["record"]["messages"][1]["content"]) for r in found) == [(k, f"SELECT {k}") for k in range(120)]
    ends = {}
    for r in found:
        ends.setdefault(r["file"].rsplit("/", 1)[-1], []).append(r["file_line"])
    assert {f: sorted(n) for f, n in ends.items()} == {"a.jsonl": list(range(60)), "b.jsonl": list(range(30)), "c.jsonl": list(range(30))}


def test_plain_chat_files_are_scored(spark, tmp_path):
    write(tmp_path / "eval.jsonl", [chat(k) for k in range(50)])
    responses = spark.createDataFrame([(k, f"```sql\nselect  {k};\n```" if k % 5 else "no") for k in range(49)], "line_no bigint, raw_response string")
    got = jobs.evaluate_responses(jsonl.read_chat_jsonl(spark, str(tmp_path / "eval.jsonl")), responses, "m")
    assert {r["line_no"]: r["match"] for r in got.collect()} == {k: k % 5 > 0 and k < 49 for k in range(50)}


def test_a_lost_place_is_an_error_and_no_miss(spark, tmp_path):
    messages = chat(1)["messages"]
    write(tmp_path / "own.jsonl", [{"line_no": 0, "messages": messages}, {"messages": messages}])
    write(tmp_path / "mixed.jsonl", [{"messages": messages}, {"line_no": 0, "messages": messages}])
    (tmp_path / "broken.jsonl").write_text(json.dumps(chat(0)) + '\n{"messages": [\n')
    for name in ("own", "mixed", "broken"):
        with pytest.raises(Exception):
            jsonl.read_chat_jsonl(spark, str(tmp_path / f"{name}.jsonl")).collect()
    rows = "line_no bigint, messages array<struct<role: string, content: string>>"
    asked = spark.createDataFrame([(0, messages), (None, messages)], rows)
    said = spark.createDataFrame([(0, "x"), (None, "y")], "line_no bigint, raw_response string")
    for examples, responses in ((asked, said.limit(1)), (asked.filter("line_no = 0"), said)):
        with pytest.raises(Exception, match="line_no"):
            jobs.evaluate_responses(examples, responses, "m").collect()


def test_no_records(spark, tmp_path):
    (tmp_path / "none.jsonl").write_text("\n  \n")
    got = jsonl.read_chat_jsonl(spark, str(tmp_path / "none.jsonl"))
    assert got.columns == ["line_no", "messages"] and got.collect() == []


def test_plain_predictions_belong_to_the_model_of_their_file(spark, tmp_path, small_splits):
    small_splits(200)
    for name in ("predictions-base.jsonl", "predictions-tuned-7b.jsonl", "other model.jsonl"):
        write(tmp_path / name, [{"question": f"q{k}", "gold": f"SELECT {k}", "raw_response": name, "prediction": "p", "match": k == 1} for k in range(20)])
    got = jsonl.read_predictions(spark, str(tmp_path)).collect()
    assert sorted((r["model"], r["line_no"], r["gold"]) for r in got) == sorted(
        (m, k, f"SELECT {k}") for m in ("base", "tuned-7b", "other model") for k in range(20)
    )
    assert jsonl.read_predictions(spark, str(tmp_path), "x/tuned-7b").count() == 20


def test_the_first_line_of_plain_pair_files_wins(spark, tmp_path, small_splits):
    small_splits(300)
    turn = lambda role, text: [{"role": role, "content": text}]
    for f in "ab":
        write(tmp_path / f"{f}.jsonl", [
            {"prompt": turn("user", f"p{k % 10}"), "chosen": turn("assistant", f"{f}{k}"), "rejected": turn("assistant", "r"), "source": "mined"}
            for k in range(40 if f == "b" else 5)
        ])
    got = jobs.load_pair_files(spark, [str(tmp_path / "a.jsonl"), str(tmp_path / "b.jsonl")]).collect()
    want = {f"p{k}": f"a{k}" if k < 5 else f"b{k}" for k in range(10)}
    assert {r["prompt"][0]["content"]: r["chosen"][0]["content"] for r in got} == want and len(got) == 10


TURNS = [
    (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, 1, "assistant", "b"),
    (None, 0, "user", "nq"), (None, 1, "assistant", "na"),
    (2, None, "user", "first"), (2, 5, "assistant", "last"),
    (3, 0, "assistant", "alone"), (4, 0, "user", "x"), (4, 1, None, None),
]


def test_null_and_repeated_turns_are_kept_once(spark):
    turns = spark.createDataFrame(TURNS, "conv_id bigint, turn int, role string, text string").repartition(3)
    prompts, answers = chats.split_turns(turns)
    gold = {r["conv_id"]: (r["gold"], r["question"], r["prompt_turns"]) for r in answers.collect()}
    assert answers.count() == 3 and gold[None] == ("na", "nq", 1) and gold[2] == ("last", "first", 1)
    assert gold[1][2] == 3 and {gold[1][0], gold[1][1]} <= {"a", "b"}
    rest = sorted((str(r["conv_id"]), str(r["turn"]), r["text"]) for r in prompts.collect())
    kept = sorted([gold[1][0], *(t for c, _, t in rest if c == "1" and t != "q")])
    assert kept == ["a", "a", "b"] and len(rest) == 5
    placed = chats.placed_turns(turns).collect()
    assert len(placed) == len(TURNS)
    for c in {t[0] for t in TURNS}:
        here = sorted(r["position"] for r in placed if r["conv_id"] == c)
        assert here == list(range(1, len(here) + 1)) and {r["n_turns"] for r in placed if r["conv_id"] == c} == {len(here)}


def test_null_keys_meet_in_joins(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (7, 3)], "k int, v int")
    ones = spark.createDataFrame([(None, "n"), (7, "s")], "k int, w string")
    want = [(None, 1, "n"), (None, 2, "n"), (7, 3, "s")]
    for joined in (skew.join_null_safe(rows, ones, ["k"]), skew.salted_join(rows, ones, ["k"], "v", rows_per_task=1)):
        assert joined.columns == ["k", "v", "w"]
        assert sorted(map(tuple, joined.collect()), key=str) == sorted(want, key=str)
    totals = positions.running_totals(rows, ["k"], "v", {"sum": F.col("v")}).collect()
    assert sorted((str(r["k"]), r["position"], r["sum"]) for r in totals) == [("7", 1, 3), ("None", 1, 1), ("None", 2, 3)]


def rendered(turns):
    """Text and spans of each conversation in plain Python."""
    out = {}
    for c in {t[0] for t in turns}:
        own = [t for t in turns if t[0] == c and None not in t[2:]]
        parts = [f"{render.TURN_OPEN}{'model' if r == 'assistant' else r}\n{x}{render.TURN_CLOSE}" for _, _, r, x in sorted(own, key=lambda t: t[1])]
        out[c] = "\n".join(parts)
    return out


def spans_of(text, response=render.RESPONSE_MARKER, instruction=render.INSTRUCTION_MARKER):
    spans, at = [], text.find(response)
    while at >= 0:
        start = at + len(response)
        ends = [k for k in (text.find(response, start), text.find(instruction, start)) if k >= 0]
        spans.append((start, min(ends, default=len(text))))
        at = text.find(response, start)
    return [s for s in spans if s[1] > s[0]]


def marked_turns():
    draw = random.Random(12)
    bits = [render.RESPONSE_MARKER, render.INSTRUCTION_MARKER, render.TURN_OPEN, render.TURN_CLOSE, "model\n", "user\n", "a", "é \U0001f600", "\n", ""]
    rows = []
    for c in [None, *range(25)]:
        for k in range(draw.randint(1, 9)):
            role = draw.choice(["user", "assistant", "system", "model"])
            rows.append((c, 3 * k, role, "".join(draw.choices(bits, k=draw.randint(0, 8)))))
    return [*rows, (40, 0, None, "no role"), (40, 1, "user", None), (41, 0, "user", render.RESPONSE_MARKER * 3000)]


def test_pieces_join_to_the_rendered_text(spark):
    turns = spark.createDataFrame(marked_turns(), "conv_id bigint, turn int, role string, text string").repartition(4)
    texts = rendered(marked_turns())
    for generation in (False, True):
        pieces = chats.render_pieces(turns, generation).collect()
        for c, text in texts.items():
            own = sorted((r for r in pieces if r["conv_id"] == c), key=lambda r: r["position"])
            whole = text + ("\n" * bool(text) + render.open_turn()) * generation
            assert "".join(r["piece"] for r in own) == whole
            assert all(whole.startswith(r["piece"], r["start"]) for r in own)


def test_spans_of_texts_that_hold_markers(spark):
    turns = spark.createDataFrame(marked_turns(), "conv_id bigint, turn int, role string, text string").repartition(4)
    got = {}
    for r in chats.turn_spans(turns).collect():
        got.setdefault(r["conv_id"], []).append((r["start"], r["end"]))
    # Places in Python's strings are code points, as here.
    want = {c: spans_of(text) for c, text in rendered(marked_turns()).items()}
    assert {c: sorted(s) for c, s in got.items()} == {c: s for c, s in want.items() if s}


def test_markers_across_turns(spark):
    """Frames of other markers, so that one reaches over the end of a turn."""
    rows = [(1, k, r, x) for k, (r, x) in enumerate([("a", "x"), ("b", "yA"), ("a", "zA"), ("b", "w")])]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    text = "\n".join(f"[{r}\n{x}]" for _, _, r, x in rows)
    found = chats.turn_spans(turns, "]\n[", "zA", turn_open="[", turn_close="]", role_names={}).collect()
    assert sorted((r["start"], r["end"]) for r in found) == spans_of(text, "]\n[", "zA")
    with pytest.raises(ValueError):
        chats.turn_spans(turns, "aba", "user")
