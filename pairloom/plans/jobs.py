"""Whole jobs: preparation, evaluation, pair mining, band selection."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import render, sqltext
from ..operators import band, chats, pairs, splits
from ..operators.verdicts import reward
from ..sources import jsonl, lines
from ..staging import staged
from .scoring import score_pairs


def prepare_dataset(
    rows: DataFrame, out_dir: str, sizes: dict[str, int] | None = None, seed: int = splits.DEFAULT_SEED
) -> dict[str, int]:
    """Shuffle, split and write chat files; returns the rows written per split."""
    sizes = splits.DEFAULT_SIZES if sizes is None else sizes
    parts = staged(splits.range_splits(rows, sizes, seed), "splits")
    written = {}
    for name in sizes:
        part = parts.filter(F.col("split") == name).withColumn("line_no", F.col("split_ix"))
        written[name] = jsonl.write_chat_jsonl(part, f"{out_dir.rstrip('/')}/{name}.jsonl")
    return written


def evaluate_responses(examples: DataFrame, responses: DataFrame, model: str) -> DataFrame:
    """Prediction rows from chat examples and the model's responses by ``line_no``.

    An example without a response counts as a miss. A row without a place, on either side,
    is an error and no miss.
    """
    place = lines.required(F.col("line_no"), "line_no").alias("line_no")
    asked = chats.split_prompt_gold(examples).select(place, "question", "gold")
    answered = asked.join(responses.select(place, "raw_response"), "line_no", "left")
    return chats.score_responses(answered).select(
        F.lit(jsonl.model_label(model)).alias("model"),
        "line_no",
        "question",
        "gold",
        "raw_response",
        "prediction",
        "match",
    )


def score_predictions(predictions: DataFrame) -> DataFrame:
    """Prediction rows, of any number of models, with the verdict of running both queries.

    A row is (model, line_no); the line number is the seed of its databases, so that all
    models are judged on the same ones. A missing prediction cannot run.
    """
    rows = staged(predictions.withColumn("pair_id", F.monotonically_increasing_id()), "scored")
    judged = score_pairs(
        rows.select(
            "pair_id",
            F.col("line_no").alias("seed"),
            sqltext.extract_schema(F.col("question")).alias("schema"),
            "gold",
            F.coalesce("prediction", F.lit("")).alias("candidate"),
        )
    )
    return rows.join(judged, "pair_id").drop("pair_id")


def mine_preferences(
    prompts: DataFrame, samples: DataFrame, gold_chosen: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Preference records and prompt outcomes from sampled responses.

    ``prompts``: ``prompt_id`` (its place in the split), ``context``, ``question``,
    ``gold``. ``samples``: ``prompt_id``, ``sample_ix``, ``response``. Each distinct
    text of a prompt is judged once.
    """
    texts = samples.select("prompt_id", "sample_ix", sqltext.extract_sql(F.col("response")).alias("candidate"))
    distinct = staged(
        # The table is written once, so the numbers stay; no hash stands for a text.
        pairs.distinct_candidates(texts).withColumn("pair_id", F.monotonically_increasing_id()),
        "candidates",
    )
    asked = prompts.withColumn("prompt", render.prompt_text(F.col("context"), F.col("question")))
    verdicts = score_pairs(
        distinct.join(asked, "prompt_id").select(
            "pair_id",
            F.col("prompt_id").alias("seed"),
            sqltext.extract_schema(F.col("prompt")).alias("schema"),
            "gold",
            "candidate",
        )
    )
    outcomes = staged(pairs.prompt_outcomes(distinct.join(verdicts, "pair_id")), "outcomes")
    mined = pairs.mine_pairs(outcomes)
    if gold_chosen:
        mined = mined.unionByName(pairs.gold_chosen_pairs(outcomes, prompts))
    records = mined.join(asked.select("prompt_id", F.col("prompt").alias("_text")), "prompt_id").select(
        F.col("prompt_id").alias("line_no"),
        *pairs.pair_record(F.col("_text"), F.col("chosen"), F.col("rejected")),
        "source",
    )
    return records, outcomes


def screen_prompts(prompts: DataFrame) -> DataFrame:
    """Prompts whose gold query matches itself; others would be rewarded at random.

    ``prompts``: ``db_seed``, ``user_content``, ``gold``.
    """
    judged = score_pairs(
        prompts.select(
            F.col("db_seed").cast("bigint").alias("pair_id"),
            F.col("db_seed").cast("bigint").alias("seed"),
            sqltext.extract_schema(F.col("user_content")).alias("schema"),
            "gold",
            F.col("gold").alias("candidate"),
        )
    )
    kept = judged.filter(F.col("verdict") == "match").select(F.col("pair_id").alias("db_seed"))
    return prompts.join(kept, "db_seed", "left_semi")


def rl_prompts(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Prompts for sampling from split rows, screened by their own gold query.

    ``rows``: ``split_ix`` (the seed of the databases), ``context``, ``question``, ``answer``.
    The observation has ``kept`` and ``dropped`` once the prompts were written or collected.
    """
    text = render.prompt_text(F.col("context"), F.col("question"))
    prompts = rows.select(
        render.user_turn(text).alias("prompt"),
        F.col("answer").alias("gold"),
        text.alias("user_content"),
        F.col("split_ix").cast("bigint").alias("db_seed"),
    )
    kept = screen_prompts(prompts).select("db_seed", F.lit(True).alias("_kept"))
    seen = Observation()
    marked = prompts.join(kept, "db_seed", "left").observe(
        seen, F.count("_kept").alias("kept"), F.count_if(F.isnull("_kept")).alias("dropped")
    )
    return marked.filter("_kept").select(*prompts.columns), seen


def live_band(prompts: DataFrame, samples: DataFrame) -> DataFrame:
    """Prompts of which some sampled answers match and some do not.

    ``prompts``: ``prompt_id``, ``user_content``, ``gold``, ``db_seed``. ``samples``:
    ``prompt_id``, ``sample_ix``, ``response``. Adds ``wins`` and ``group_size``.
    """
    texts = samples.select("prompt_id", "sample_ix", sqltext.extract_sql(F.col("response")).alias("candidate"))
    distinct = staged(
        pairs.distinct_candidates(texts).withColumn("pair_id", F.monotonically_increasing_id()), "candidates"
    )
    judged = score_pairs(
        distinct.join(prompts, "prompt_id").select(
            "pair_id",
            F.col("db_seed").cast("bigint").alias("seed"),
            sqltext.extract_schema(F.col("user_content")).alias("schema"),
            "gold",
            "candidate",
        )
    )
    won = F.when(F.col("verdict") == "match", F.col("copies")).otherwise(F.lit(0))
    groups = distinct.join(judged, "pair_id").groupBy("prompt_id").agg(
        F.sum(won).alias("wins"), F.sum("copies").alias("group_size")
    )
    return prompts.join(groups.filter("wins > 0 AND wins < group_size"), "prompt_id")


def band_prompts(pair_files: list[DataFrame], rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Prompts of pair files that are in the slice, mined ones only if any is tagged.

    The lookup's result is read twice, for the tag and for the rows, so it is staged. The
    observation has the counts ``matched`` and ``unmatched``.
    """
    seen = Observation()
    found = band.band_lookup(pairs.union_files(pair_files), rows).observe(
        seen, F.count_if("matched").alias("matched"), F.count_if(~F.col("matched")).alias("unmatched")
    )
    staged_rows = staged(found, "band").filter("matched")
    return band.band_source_filter(staged_rows).drop("matched"), seen


def reward_completions(completions: DataFrame) -> DataFrame:
    """Rewards for (completion_id, user_content, gold, db_seed, messages, text) rows."""
    texts = completions.withColumn(
        "candidate",
        sqltext.extract_sql(render.completion_text(F.col("messages"), F.col("text"))),
    )
    judged = score_pairs(
        texts.select(
            F.col("completion_id").alias("pair_id"),
            F.col("db_seed").alias("seed"),
            sqltext.extract_schema(F.col("user_content")).alias("schema"),
            "gold",
            "candidate",
        )
    )
    return completions.join(
        judged.select(F.col("pair_id").alias("completion_id"), reward(F.col("verdict")).alias("reward")),
        "completion_id",
    )


def load_pair_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Training records of several pair files, one per prompt."""
    return pairs.load_pairs(jsonl.read_pairs(spark, paths))
