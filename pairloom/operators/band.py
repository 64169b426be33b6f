"""Prompts in the inconsistency band, and rewards in their groups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pairs import keep_first
from .skew import salted_join


def band_lookup(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Prompts of a pair file with gold and seed found by their rendered text.

    ``pairs``: the columns of a pair file with ``file_ix`` and ``line_no``; of equal
    prompts the first counts. ``rows``: ``prompt_text``, ``gold``, ``db_seed``; of
    equal texts the last counts. Rows without a partner have ``matched`` false.
    Both sides are reduced on (hash, text) and joined on the same two, so the join
    adds no shuffle and equal hashes are checked by text.
    """
    text = F.get("prompt", F.lit(0))["content"]
    wanted = keep_first(
        pairs.select(
            "prompt",
            text.alias("user_content"),
            F.coalesce("source", F.lit("unknown")).alias("band_source"),
            "file_ix",
            "line_no",
        ),
        F.col("user_content"),
        ["file_ix", "line_no"],
    ).withColumn("_h", F.xxhash64("user_content"))
    known = (
        keep_first(rows.select("prompt_text", "gold", "db_seed"), F.col("prompt_text"), ["db_seed"], last=True)
        .withColumn("_h", F.xxhash64("prompt_text"))
        .withColumnRenamed("prompt_text", "user_content")
    )
    return wanted.join(known, ["_h", "user_content"], "left").select(
        "prompt",
        "gold",
        "user_content",
        "db_seed",
        "band_source",
        F.col("db_seed").isNotNull().alias("matched"),
    )


def band_source_filter(band: DataFrame) -> DataFrame:
    """Only ``mined`` prompts if any prompt is tagged so, else all of them."""
    any_mined = band.agg(F.coalesce(F.bool_or(F.col("band_source") == "mined"), F.lit(False))).scalar()
    return band.filter((F.col("band_source") == "mined") | ~any_mined)


def win_counts(rewards: DataFrame) -> DataFrame:
    """Wins and group size per prompt."""
    return rewards.groupBy("prompt_id").agg(
        F.count_if(F.col("reward") > 0).alias("wins"), F.count("*").alias("group_size")
    )


def mixed_reward_filter(prompts: DataFrame, rewards: DataFrame) -> DataFrame:
    """Prompts with at least one win and at least one miss."""
    mixed = win_counts(rewards).filter((F.col("wins") > 0) & (F.col("wins") < F.col("group_size")))
    return prompts.join(mixed.select("prompt_id"), "prompt_id", "left_semi")


def group_reward_stats(rewards: DataFrame) -> DataFrame:
    """Mean, spread and dead flag of each group."""
    return rewards.groupBy("prompt_id").agg(
        F.count("*").alias("group_size"),
        F.avg("reward").alias("mean_reward"),
        F.stddev_samp("reward").alias("std_reward"),
        (F.min("reward") == F.max("reward")).alias("dead"),
    )


def dead_group_share(stats: DataFrame) -> DataFrame:
    """Share of groups without any spread."""
    return stats.agg(
        F.count("*").alias("groups"),
        F.count_if("dead").alias("dead_groups"),
        F.avg(F.col("dead").cast("int")).alias("dead_share"),
    )


def group_advantage(rewards: DataFrame, scale_by_std: bool = False) -> DataFrame:
    """Reward less the group mean; zero throughout a dead group.

    The mean is joined back rather than taken over a window, which would put a very
    large group in one task. Rows of such a group are dealt out by ``sample_ix``.
    """
    stats = group_reward_stats(rewards).select("prompt_id", "group_size", "mean_reward", "std_reward")
    centred = F.col("reward") - F.col("mean_reward")
    if scale_by_std:
        centred = F.when(F.col("std_reward") > 0, centred / F.col("std_reward")).otherwise(F.lit(0.0))
    joined = salted_join(rewards, stats, ["prompt_id"], "sample_ix", size="group_size")
    return joined.select(*rewards.columns, centred.alias("advantage"))
