"""Whole jobs, files, and the stream."""

import pytest
from pyspark.sql import functions as F

from pairloom.functions import render
from pairloom.operators import chats, metrics
from pairloom.plans import jobs
from pairloom.sources import jsonl
from pairloom.staging import new_stage
from pairloom.streaming import responses as stream

SCHEMA = "CREATE TABLE t (a INTEGER, b VARCHAR)"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(60).select(
        F.col("id").alias("row_id"),
        F.lit(SCHEMA).alias("context"),
        F.concat(F.lit("Question \"é\" "), F.col("id").cast("string"), F.lit("?\nNext")).alias("question"),
        F.lit("SELECT a FROM t WHERE b = 'x'").alias("answer"),
    )


def test_prepare_dataset(spark, rows):
    out = new_stage(spark, "prepared")
    assert jobs.prepare_dataset(rows, out, {"eval": 10, "sft": 30}) == {"eval": 10, "sft": 30}
    chat = jsonl.read_chat_jsonl(spark, f"{out}/sft.jsonl")
    assert sorted(r["line_no"] for r in chat.collect()) == list(range(30))
    first = chats.split_prompt_gold(chat).filter("line_no = 0").first()
    assert first["gold"] == "SELECT a FROM t WHERE b = 'x'"
    assert first["question"].startswith(render.PROMPT_HEAD + SCHEMA) and first["question"].endswith("?\nNext")
    held_out = jsonl.read_chat_jsonl(spark, f"{out}/eval.jsonl")
    assert held_out.join(chat, F.to_json(held_out["messages"]) == F.to_json(chat["messages"])).isEmpty()


@pytest.mark.parametrize("fmt", ["json", "csv", "parquet"])
def test_read_instructions(spark, rows, fmt):
    path = new_stage(spark, "rows")
    writer = rows.withColumnRenamed("row_id", "n").write.format(fmt)
    (writer.option("header", True).option("escape", '"') if fmt == "csv" else writer).save(path)
    got = jsonl.read_instructions(spark, path, fmt, row_id="n")
    assert got.exceptAll(rows).isEmpty() and got.count() == 60
    hashed = jsonl.read_instructions(spark, path, fmt, row_id=F.xxhash64("context", "question", "answer"))
    assert hashed.select("row_id").distinct().count() == 60


def test_evaluate_and_score(spark, rows):
    examples = chats.to_chat(rows.filter("row_id < 4")).withColumnRenamed("row_id", "line_no")
    answers = spark.createDataFrame(
        [(0, "```sql\nSELECT a FROM t WHERE b = \"x\";\n```"), (1, "SELECT a FROM t WHERE 'x' = b"), (2, "SELECT b FROM t"), (3, "SELECT nope FROM t")],
        "line_no bigint, raw_response string",
    )
    predictions = jobs.evaluate_responses(examples, answers, "models/tuned/")
    path = new_stage(spark, "predictions")
    assert jsonl.write_predictions(predictions, path) == 4
    assert jsonl.read_predictions(spark, path, "other").isEmpty()
    judged = jobs.score_predictions(jsonl.read_predictions(spark, path, "models/tuned"))
    got = {r["line_no"]: (r["match"], r["verdict"]) for r in judged.collect()}
    assert got == {0: (True, "match"), 1: (False, "match"), 2: (False, "mismatch"), 3: (False, "mismatch")}
    report = metrics.execution_report(judged).first()
    assert (report["matched"], report["mismatched"], report["exec_accuracy"]) == (2, 2, 0.5)
    assert (report["string_matches"], report["disagreements"]) == (1, 1)


def test_mining_to_band(spark, rows):
    prompts = rows.filter("row_id < 4").select(F.col("row_id").alias("prompt_id"), "context", "question", F.col("answer").alias("gold"))
    right, same, wrong, other = "SELECT a FROM t WHERE b = 'x'", "```SELECT a FROM t WHERE b LIKE 'x'```", "SELECT b FROM t", "SELECT nope FROM t"
    sampled = {0: [wrong, same, right, wrong], 1: [right, right], 2: [other, wrong], 3: [same, other]}
    samples = spark.createDataFrame(
        [(p, i, s) for p, ss in sampled.items() for i, s in enumerate(ss)], "prompt_id bigint, sample_ix int, response string"
    )
    records, outcomes = jobs.mine_preferences(prompts, samples, gold_chosen=True)
    assert {r["prompt_id"]: (r["outcome"], r["n_correct"], r["n_distinct"]) for r in outcomes.collect()} == {
        0: ("paired", 2, 3), 1: ("all_correct", 2, 1), 2: ("all_wrong", 0, 2), 3: ("paired", 1, 2)}
    path = new_stage(spark, "pairs")
    assert jsonl.write_pairs(records, path) == 3
    got = {r["line_no"]: (r["chosen"][0]["content"], r["rejected"][0]["content"], r["source"]) for r in jsonl.read_pairs(spark, [path])[0].collect()}
    bare = same.strip("`")
    assert got == {0: (bare, wrong, "mined"), 2: (right, other, "gold"), 3: (bare, other, "mined")}
    assert jobs.load_pair_files(spark, [path, path]).count() == 3

    slice_rows = prompts.select(render.prompt_text(F.col("context"), F.col("question")).alias("prompt_text"), "gold", F.col("prompt_id").alias("db_seed"))
    found, seen = jobs.band_prompts(jsonl.read_pairs(spark, [path]), slice_rows.filter("db_seed != 2"))
    assert sorted(r["db_seed"] for r in found.collect()) == [0, 3]
    assert seen.get == {"matched": 2, "unmatched": 1}


def test_screening_and_rewards(spark, rows):
    golds = {0: "SELECT a FROM t", 1: "SELECT nope FROM t", 2: "SELECT a FROM t WHERE a > 3 AND a < 2"}
    prompts = spark.createDataFrame(
        [(i, f"{render.PROMPT_HEAD}{SCHEMA}{render.PROMPT_ASK}q", g) for i, g in golds.items()], "db_seed bigint, user_content string, gold string"
    )
    assert [r["db_seed"] for r in jobs.screen_prompts(prompts).collect()] == [0]
    text = prompts.filter("db_seed = 0")
    completions = text.select(
        F.inline(F.array(
            F.struct(F.lit(1).cast("bigint").alias("completion_id"), render.assistant_turn(F.lit("```sql SELECT a FROM t```")).alias("messages"), F.lit(None).cast("string").alias("text")),
            F.struct(F.lit(2).cast("bigint").alias("completion_id"), F.lit(None).cast("array<struct<role:string,content:string>>").alias("messages"), F.lit("SELECT b FROM t").alias("text")),
        )), "user_content", "gold", "db_seed")
    assert {r["completion_id"]: r["reward"] for r in jobs.reward_completions(completions).collect()} == {1: 1.0, 2: 0.0}


def test_stream_equals_batch(spark, sf):
    from driver_queries import tables

    rows = tables.responses(spark, sf)
    source, sink = new_stage(spark, "arriving"), new_stage(spark, "scored")
    rows.repartition(4).write.json(source)
    query = stream.write_predictions(stream.read_responses(spark, source, files_per_trigger=2), sink)
    query.awaitTermination(120)
    assert query.exception() is None and not query.isActive
    got = jsonl.read_predictions(spark, sink)
    want = chats.score_responses(rows).select(got.columns)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()


def test_a_second_start_of_the_stream_goes_on(spark, sf):
    from driver_queries import tables

    rows = tables.responses(spark, sf)
    source, sink = new_stage(spark, "arriving"), new_stage(spark, "scored")
    for part in (rows.filter("line_no % 2 = 0"), rows.filter("line_no % 2 = 1")):
        part.coalesce(1).write.mode("append").json(source)
        query = stream.write_predictions(stream.read_responses(spark, source), sink)
        query.awaitTermination(120)
        assert query.exception() is None
    assert jsonl.read_predictions(spark, sink).count() == rows.count()


def test_a_missing_response_is_a_miss(spark, rows):
    examples = chats.to_chat(rows.filter("row_id < 3")).withColumnRenamed("row_id", "line_no")
    answers = spark.createDataFrame([(1, "SELECT a FROM t WHERE b = 'x'")], "line_no bigint, raw_response string")
    predictions = jobs.evaluate_responses(examples, answers, "m")
    assert {r["line_no"]: r["match"] for r in predictions.collect()} == {0: False, 1: True, 2: False}
    assert metrics.exact_match_accuracy(predictions).first()["accuracy"] == pytest.approx(1 / 3)


def test_models_are_written_and_scored_side_by_side(spark, rows):
    examples = chats.to_chat(rows.filter("row_id < 2")).withColumnRenamed("row_id", "line_no")
    path = new_stage(spark, "predictions")
    for model, text in (("a", "SELECT a FROM t WHERE b = 'x'"), ("b", "SELECT b FROM t")):
        answers = spark.createDataFrame([(k, text) for k in (0, 1)], "line_no bigint, raw_response string")
        jsonl.write_predictions(jobs.evaluate_responses(examples, answers, model), path)
    judged = jobs.score_predictions(jsonl.read_predictions(spark, path)).collect()
    assert sorted((r["model"], r["line_no"], r["verdict"]) for r in judged) == [
        ("a", 0, "match"), ("a", 1, "match"), ("b", 0, "mismatch"), ("b", 1, "mismatch")]


def test_rl_prompts_are_screened_and_counted(spark, rows):
    split = rows.filter("row_id < 3").select(
        F.col("row_id").alias("split_ix"), "context", "question",
        F.when(F.col("row_id") == 1, "SELECT nope FROM t").otherwise(F.col("answer")).alias("answer"))
    prompts, seen = jobs.rl_prompts(split)
    assert sorted(r["db_seed"] for r in prompts.collect()) == [0, 2]
    assert seen.get == {"kept": 2, "dropped": 1}


def test_live_band_keeps_mixed_groups(spark, rows):
    right, wrong = "SELECT a FROM t WHERE b = 'x'", "SELECT b FROM t"
    prompts = rows.filter("row_id < 3").select(
        F.col("row_id").alias("prompt_id"), render.prompt_text(F.col("context"), F.col("question")).alias("user_content"),
        F.col("answer").alias("gold"), F.col("row_id").cast("int").alias("db_seed"))
    sampled = {0: [right, wrong, wrong], 1: [right, right], 2: [wrong]}
    samples = spark.createDataFrame(
        [(p, i, s) for p, ss in sampled.items() for i, s in enumerate(ss)], "prompt_id bigint, sample_ix int, response string")
    got = jobs.live_band(prompts, samples).collect()
    assert [(r["prompt_id"], r["wins"], r["group_size"]) for r in got] == [(0, 1, 3)]


def test_a_long_conversation_stays_whole(spark):
    role = F.when(F.col("id") % 2 == 1, "assistant").otherwise("user")
    turns = spark.range(1030).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.col("id").cast("string").alias("text"))
    (record,) = chats.turns_to_chat(turns).collect()
    assert [m["content"] for m in record["messages"]] == [str(k) for k in range(1030)]
    prompts, answers = chats.split_turns(turns)
    assert [tuple(r) for r in answers.select("gold", "question", "prompt_turns").collect()] == [("1029", "1028", 1029)]
    assert prompts.count() == 1029


def test_turn_spans_equal_the_spans_of_the_text(spark):
    talk = [("system", "s"), ("user", "hi"), ("assistant", "yo"), ("system", "note"), ("assistant", ""), ("assistant", "ok"), ("tool", "x"), ("user", "u"), ("assistant", "end")]
    rows = [(c, k, r, t + str(c)) for c in range(3) for k, (r, t) in enumerate(talk[: 9 - 2 * c])]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    text = render.render_turns(F.col("messages"))
    want = chats.turns_to_chat(turns).select("conv_id", F.inline(render.response_spans(text))).collect()
    got = chats.turn_spans(turns).select("conv_id", "start", "end").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_large_places_seed_databases_of_their_own(spark, rows):
    """A seed times the stride, or the place itself, may pass 32 bits."""
    places = [3_000_000, 5_000_000_000]
    split = rows.filter("row_id < 2").select(
        F.get(F.array(*map(F.lit, places)), F.col("row_id").cast("int")).cast("bigint").alias("split_ix"), "context", "question", "answer")
    assert sorted(r["db_seed"] for r in jobs.rl_prompts(split)[0].collect()) == places
    narrow = split.filter(F.col("split_ix") == places[0]).select(
        F.col("split_ix").cast("int").alias("db_seed"), render.prompt_text(F.col("context"), F.col("question")).alias("user_content"), F.col("answer").alias("gold"))
    assert [r["db_seed"] for r in jobs.screen_prompts(narrow).collect()] == [places[0]]
