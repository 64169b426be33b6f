"""Splits, positions, pair mining, band selection and metrics against plain Python."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairloom.functions.render import user_turn, assistant_turn
from pairloom.operators import band, metrics, pairs, positions, splits
from pairloom.records import OUTCOMES


def test_seeded_order_is_a_permutation_independent_of_partitions(spark):
    one = splits.seeded_order(spark.range(5000).withColumnRenamed("id", "row_id"))
    other = splits.seeded_order(spark.range(0, 5000, 1, 3).withColumnRenamed("id", "row_id"))
    rows = dict(tuple(r) for r in one.collect())
    assert sorted(rows.values()) == list(range(5000))
    assert rows == dict(tuple(r) for r in other.collect())
    seven = splits.seeded_order(spark.range(5000).withColumnRenamed("id", "row_id"), seed=7)
    assert rows != dict(tuple(r) for r in seven.collect())


def test_range_splits(spark):
    rows = spark.range(4000).select(F.col("id").alias("row_id"), (F.col("id") % 50).alias("text"))
    sizes = {"eval": 30, "sft": 300, "dpo": 150}
    got = splits.range_splits(rows, sizes)
    by_split = defaultdict(list)
    for r in got.collect():
        by_split[r["split"]].append(r["split_ix"])
    assert {k: sorted(v) for k, v in by_split.items()} == {k: list(range(n)) for k, n in sizes.items()}
    assert splits.split_overlap(got, "row_id").isEmpty()
    shared = {(r["split_a"], r["split_b"]): r["shared"] for r in splits.split_overlap(got, "text").collect()}
    texts = defaultdict(set)
    for r in got.collect():
        texts[r["split"]].add(r["text"])
    names = sorted(sizes)
    assert shared == {(a, b): len(texts[a] & texts[b]) for a in names for b in names if a < b}


def test_range_splits_of_too_few_rows(spark):
    rows = spark.range(40).withColumnRenamed("id", "row_id")
    got = splits.range_splits(rows, {"eval": 30, "sft": 300})
    assert Counter(r["split"] for r in got.collect()) == {"eval": 30, "sft": 10}


@pytest.mark.parametrize("width", [1, 3, 40])
def test_running_totals(spark, width):
    rng = random.Random(1)
    rows = [(m, ix, rng.random() < 0.4) for m in "ab" for ix in rng.sample(range(500), 180)] + [("c", 9, True)]
    df = spark.createDataFrame(rows, "model string, line_no bigint, match boolean")
    got = positions.running_totals(df, ["model"], "line_no", {"correct": F.col("match").cast("int")}, width)
    want = {}
    for m in "abc":
        n = c = 0
        for _, ix, ok in sorted(r for r in rows if r[0] == m):
            n, c = n + 1, c + ok
            want[m, ix] = (n, c)
    assert {(r["model"], r["line_no"]): (r["position"], r["correct"]) for r in got.collect()} == want


def test_running_accuracy_every_ten(spark):
    df = spark.range(25).select(F.lit("m").alias("model"), F.col("id").alias("line_no"), (F.col("id") < 5).alias("match"))
    got = sorted(tuple(r) for r in metrics.running_accuracy(df).collect())
    assert got == [("m", 10, 5, 0.5), ("m", 20, 5, 0.25)]


def judged(seed, prompts=60):
    """Samples with a verdict by (prompt, candidate), all outcomes among them."""
    rng = random.Random(seed)
    kinds = ["match", "mismatch", "mismatch", "match", "gold_error", "non_discriminative"]
    rows = []
    for p in range(prompts):
        label = {c: kinds[rng.randrange(2 + 4 * (p % 10 == 0))] for c in "abcd"}
        if p % 7 == 1:
            label = dict.fromkeys("abcd", rng.choice(["match", "mismatch"]))
        rows += [(p, ix, c, label[c]) for ix, c in enumerate(rng.choices("abcd", k=rng.randint(1, 8)))]
    return rows


def plain_outcome(samples):
    verdicts = {c: v for _, _, c, v in samples}
    right = [c for _, _, c, v in samples if v == "match"]
    wrong = [c for _, _, c, v in samples if v == "mismatch"]
    for bad in ("gold_error", "non_discriminative"):
        if bad in verdicts.values():
            return f"skipped_{bad}", None, None
    if not right:
        return "all_wrong", None, wrong[0]
    if not wrong:
        return "all_correct", right[0], None
    return "paired", right[0], wrong[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_pair_mining(spark, seed):
    rows = judged(seed)
    by_prompt = defaultdict(list)
    for r in rows:
        by_prompt[r[0]].append(r)
    want = {p: plain_outcome(s) for p, s in by_prompt.items()}
    samples = spark.createDataFrame(rows, "prompt_id bigint, sample_ix int, candidate string, verdict string").repartition(7)
    distinct = pairs.distinct_candidates(samples)
    outcomes = pairs.prompt_outcomes(distinct)
    assert {r["prompt_id"]: r["outcome"] for r in outcomes.collect()} == {p: o for p, (o, _, _) in want.items()}
    mined = {r["prompt_id"]: (r["chosen"], r["rejected"]) for r in pairs.mine_pairs(outcomes).collect()}
    assert mined == {p: (c, w) for p, (o, c, w) in want.items() if o == "paired"}
    prompts = spark.createDataFrame([(p, f"gold{p}") for p in by_prompt], "prompt_id bigint, gold string")
    gold = {r["prompt_id"]: (r["chosen"], r["rejected"]) for r in pairs.gold_chosen_pairs(outcomes, prompts).collect()}
    assert gold == {p: (f"gold{p}", w) for p, (o, _, w) in want.items() if o == "all_wrong"}

    counts = Counter(o for o, _, _ in want.values())
    got = {r["outcome"]: r["prompts"] for r in metrics.pair_yield(outcomes, gold_chosen=True).collect()}
    assert list(got) == list(OUTCOMES)
    assert got == {o: counts[o] for o in OUTCOMES} | {"paired_gold_chosen": counts["all_wrong"]}
    assert sum(got.values()) - got["paired_gold_chosen"] == len(by_prompt)
    none = {r["outcome"]: r["prompts"] for r in metrics.pair_yield(outcomes).collect()}
    assert none["paired_gold_chosen"] == 0

    right = Counter(sum(v == "match" for *_, v in s) for p, s in by_prompt.items() if not want[p][0].startswith("skipped"))
    hist = {r["k"]: r["prompts"] for r in metrics.success_histogram(outcomes, samples=8).collect()}
    assert hist == {k: right[k] for k in range(9)}
    kinds = Counter(len({c for _, _, c, _ in s}) for s in by_prompt.values())
    hist = {r["k"]: r["prompts"] for r in metrics.distinct_histogram(outcomes, samples=8).collect()}
    assert hist == {k: kinds[k] for k in range(1, 9)}
    mean = metrics.mean_distinct(outcomes).first()
    assert mean["mean_distinct"] == pytest.approx(sum(k * n for k, n in kinds.items()) / len(by_prompt))

    labelled = pairs.label_candidates(samples.drop("verdict"), distinct)
    assert sorted(tuple(r) for r in labelled.select("prompt_id", "sample_ix", "candidate", "verdict").collect()) == sorted(rows)


def test_histogram_spine_crosses_its_step(spark):
    k = metrics.SPINE_STEP * 2 + 3
    outcomes = spark.createDataFrame([(1, "paired", k, k, 1)], "prompt_id int, outcome string, n_samples bigint, n_correct bigint, n_distinct bigint")
    hist = metrics.success_histogram(outcomes)
    assert (hist.count(), hist.agg(F.sum("prompts")).first()[0]) == (k + 1, 1)
    assert hist.select("k").distinct().count() == k + 1
    assert metrics.distinct_histogram(outcomes).agg(F.min("k"), F.max("k"), F.count("*")).first() == (1, k, k)


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "prompt_id int, outcome string, n_samples bigint, n_correct bigint, n_distinct bigint")
    assert metrics.mean_distinct(none).first() == (0, 0.0)
    assert metrics.success_histogram(none).isEmpty()
    assert [r["prompts"] for r in metrics.pair_yield(none).collect()] == [0] * 6
    judged_rows = spark.createDataFrame([], "match boolean, verdict string")
    assert metrics.exact_match_accuracy(judged_rows).first() == (0, 0, None)
    assert metrics.exec_match_accuracy(judged_rows).first()["exec_accuracy"] is None


def pair_file(spark, rows):
    df = spark.createDataFrame(rows, "line_no bigint, p string, c string, source string")
    return df.select("line_no", user_turn(F.col("p")).alias("prompt"), assistant_turn(F.col("c")).alias("chosen"),
                     assistant_turn(F.lit("w")).alias("rejected"), "source")


def test_load_pairs_first_file_and_line_win(spark):
    files = [
        pair_file(spark, [(1, "x", "second", "mined"), (0, "x", "first", "mined"), (2, "y", "y0", None)]),
        pair_file(spark, [(0, "x", "late", "gold"), (1, "z", "z1", "gold")]),
    ]
    got = pairs.load_pairs([f.repartition(3) for f in files])
    assert "source" not in got.columns
    assert {r["prompt"][0]["content"]: r["chosen"][0]["content"] for r in got.collect()} == {"x": "first", "y": "y0", "z": "z1"}


def test_band(spark):
    files = [pair_file(spark, [(0, "x", "a", None), (1, "x", "b", "mined"), (2, "y", "c", "mined"), (3, "q", "d", "gold"), (4, "u", "e", "mined")])]
    rows = spark.createDataFrame([("x", "gx", 0), ("y", "gy", 1), ("y", "gy2", 5), ("q", "gq", 3)], "prompt_text string, gold string, db_seed int")
    found = band.band_lookup(pairs.union_files(files), rows)
    got = {r["user_content"]: (r["gold"], r["db_seed"], r["band_source"], r["matched"]) for r in found.collect()}
    assert got == {"x": ("gx", 0, "unknown", True), "y": ("gy2", 5, "mined", True), "q": ("gq", 3, "gold", True), "u": (None, None, "mined", False)}
    assert [r["user_content"] for r in band.band_source_filter(found.filter("matched")).collect()] == ["y"]
    untagged = found.filter("band_source <> 'mined'")
    assert {r["user_content"] for r in band.band_source_filter(untagged).collect()} == {"x", "q"}
    counts = metrics.screening_counts(found, F.col("matched")).first()
    assert counts == (3, 1, 4)


def test_group_rewards(spark):
    rows = [(1, 1.0), (1, 0.0), (1, 0.0), (1, 0.0), (2, 1.0), (2, 1.0), (3, 0.0)]
    rewards = spark.createDataFrame([(p, i, r) for i, (p, r) in enumerate(rows)], "prompt_id int, sample_ix int, reward double")
    adv = sorted((r["prompt_id"], r["advantage"]) for r in band.group_advantage(rewards).collect())
    assert adv == [(1, -0.25), (1, -0.25), (1, -0.25), (1, 0.75), (2, 0.0), (2, 0.0), (3, 0.0)]
    scaled = band.group_advantage(rewards, scale_by_std=True).filter("prompt_id = 1 AND reward = 1").first()
    assert scaled["advantage"] == pytest.approx(1.5)
    prompts = rewards.select("prompt_id").distinct()
    assert [r[0] for r in band.mixed_reward_filter(prompts, rewards).collect()] == [1]
    share = band.dead_group_share(band.group_reward_stats(rewards)).first()
    assert tuple(share) == (3, 2, pytest.approx(2 / 3))
