"""Plans and skew: what must hold when the tables are a million times larger."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pairloom.operators import metrics, pairs, positions, skew, splits


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


# These write and run tables of their own while they are built.
BUILT_BY_RUNNING = {"score_pairs", "score_texts", "rl_prompts", "live_band"}


@pytest.mark.parametrize("name", sorted(set(entry.QUERIES) - BUILT_BY_RUNNING))
def test_no_cross_join_no_python(spark, sf, name):
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan


def test_scans_read_only_what_they_need(spark, sf):
    plan = entry.queries()["group_reward_stats"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["l_orderkey:bigint,l_returnflag:string"]
    plan = entry.queries()["seeded_order"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"ReadSchema: struct<([^>]*)>", plan)) == {"o_orderkey:bigint"}


@pytest.fixture
def skewed(spark):
    """One prompt holds a third of the samples."""
    return spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("prompt_id"),
        F.col("id").alias("sample_ix"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("candidate"),
        F.when(F.col("id") % 4 == 1, "match").otherwise("mismatch").alias("verdict"),
    )


def test_hot_prompt_combines_before_the_shuffle(spark, skewed):
    hot = pairs.prompt_outcomes(pairs.distinct_candidates(skewed)).filter("prompt_id = 0").first()
    assert (hot["n_samples"], hot["n_distinct"], hot["outcome"]) == (20_000, 4, "paired")
    plan = final_plan(pairs.distinct_candidates(skewed))
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_hot_prompt_is_dealt_over_tasks(spark, skewed):
    """The largest partition of the join holds a small share of the hot prompt."""
    stats = skewed.groupBy("prompt_id").agg(F.count("*").alias("n"))
    joined = skew.salted_join(skewed, stats, ["prompt_id"], "sample_ix", rows_per_task=1000)
    want = skewed.join(stats, "prompt_id").select(joined.columns)
    assert joined.exceptAll(want).isEmpty() and joined.count() == 60_000
    salts = skewed.filter("prompt_id = 0").select(F.pmod(F.xxhash64("sample_ix"), F.lit(20)).alias("s"))
    assert salts.groupBy("s").count().agg(F.max("count")).first()[0] < 1200
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(prompt_id#\d+L, _salt#|Join \[prompt_id#\d+L, _salt#", plan)
    assert "Window" not in plan


def test_running_accuracy_spreads_one_model(spark):
    """One model holds every row under hashed line numbers, yet no bucket holds many."""
    df = spark.range(0, 50_000, 1, 8).select(
        F.lit("only").alias("model"), F.xxhash64("id").alias("line_no"), (F.col("id") % 3 == 0).alias("match")
    )
    values = {"correct": F.col("match").cast("int")}
    totals = positions.running_totals(df, ["model"], "line_no", values, buckets=25)
    last = totals.orderBy(F.desc("position")).first()
    assert (last["position"], last["correct"]) == (50_000, 16_667)
    assert totals.orderBy("line_no").limit(3).agg(F.max("position")).first()[0] == 3
    ranged = totals._jdf.queryExecution().optimizedPlan().toString()
    assert "_bucket" in ranged
    staged_rows = totals.sparkSession.read.parquet(totals.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in staged_rows.groupBy("_bucket").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 5000
    assert metrics.running_accuracy(df).count() == 5000


def test_splits_shuffle_only_the_buckets_they_need(spark):
    rows = spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "row_id")
    got = splits.range_splits(rows, {"eval": 100, "sft": 200})
    plan = final_plan(got)
    assert got.count() == 300
    # The window over the rows comes after the join that drops the other buckets.
    assert plan.index("Window [row_number()") < plan.index("BroadcastHashJoin")


def test_sort_keys_lead_with_a_hash(spark, sf):
    plan = entry.queries()["load_pairs"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortAggregate\(key=\[_groupingexpression#\d+L|SortAggregate\(key=\[_h#|SortAggregate\(key=\[xxhash64", plan)
