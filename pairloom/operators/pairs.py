"""Candidates to preference pairs.

``samples``: ``prompt_id``, ``sample_ix`` (any order value), ``candidate`` and,
once judged, ``verdict``, which depends on prompt and candidate only.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.render import assistant_turn, user_turn
from .skew import salted_join


def distinct_candidates(samples: DataFrame) -> DataFrame:
    """Each distinct text of a prompt once, with its first place and its copies.

    Copies combine before the shuffle, and the key holds the candidate, so a prompt
    with very many samples is spread out.
    """
    keys = ["prompt_id", "candidate", *(["verdict"] if "verdict" in samples.columns else [])]
    return samples.groupBy(*keys).agg(
        F.min("sample_ix").alias("first_ix"), F.count("*").alias("copies")
    )


def label_candidates(samples: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Every sample, copies included, with the verdict of its text.

    ``verdicts`` has one row per (prompt_id, candidate). A text that fills much of a
    very large prompt is dealt over several tasks; ``copies``, if it is there, tells which.
    """
    size = "copies" if "copies" in verdicts.columns else None
    judged = verdicts.select("prompt_id", "candidate", "verdict", *([size] if size else []))
    return salted_join(samples, judged, ["prompt_id", "candidate"], "sample_ix", size=size).select(
        *samples.columns, "verdict"
    )


def prompt_outcomes(distinct: DataFrame) -> DataFrame:
    """One row per prompt from its judged distinct candidates.

    Outcome, counts, and the first matching and first mismatching text. The input
    has one row per distinct text, so copies weigh nothing here. All later pair and
    yield steps read this one result.
    """
    verdict = F.col("verdict")
    copies = lambda v: F.coalesce(F.sum(F.when(verdict == v, F.col("copies"))), F.lit(0))
    place = F.struct("first_ix", "candidate")
    first = lambda v: F.min(F.when(verdict == v, place))["candidate"]
    return (
        distinct.groupBy("prompt_id")
        .agg(
            F.sum("copies").alias("n_samples"),
            F.count("*").alias("n_distinct"),
            copies("match").alias("n_correct"),
            copies("mismatch").alias("n_wrong"),
            F.bool_or(verdict == "gold_error").alias("_gold_error"),
            F.bool_or(verdict == "non_discriminative").alias("_non_discriminative"),
            first("match").alias("first_correct"),
            first("mismatch").alias("first_wrong"),
        )
        .withColumn(
            "outcome",
            F.when(F.col("_gold_error"), "skipped_gold_error")
            .when(F.col("_non_discriminative"), "skipped_non_discriminative")
            .when(F.col("n_correct") == 0, "all_wrong")
            .when(F.col("n_wrong") == 0, "all_correct")
            .otherwise("paired"),
        )
        .drop("_gold_error", "_non_discriminative")
    )


def mine_pairs(outcomes: DataFrame) -> DataFrame:
    """Prompts with both kinds: first matching text chosen, first mismatching rejected."""
    return outcomes.filter(F.col("outcome") == "paired").select(
        "prompt_id",
        F.col("first_correct").alias("chosen"),
        F.col("first_wrong").alias("rejected"),
        F.lit("mined").alias("source"),
    )


def gold_chosen_pairs(outcomes: DataFrame, prompts: DataFrame) -> DataFrame:
    """All-wrong prompts: the gold answer chosen, the first wrong text rejected."""
    wrong = outcomes.filter(F.col("outcome") == "all_wrong")
    return wrong.join(prompts.select("prompt_id", "gold"), "prompt_id").select(
        "prompt_id",
        F.col("gold").alias("chosen"),
        F.col("first_wrong").alias("rejected"),
        F.lit("gold").alias("source"),
    )


def pair_record(prompt: Column, chosen: Column, rejected: Column) -> list[Column]:
    """The three message arrays of a preference record."""
    return [
        user_turn(prompt).alias("prompt"),
        assistant_turn(chosen).alias("chosen"),
        assistant_turn(rejected).alias("rejected"),
    ]


def canonical(col: Column) -> Column:
    """Text that two message lists share exactly when they are equal."""
    return F.to_json(col)


def keep_first(df: DataFrame, key: Column, order: list[str], last: bool = False) -> DataFrame:
    """One whole row per key: the first along ``order`` (or the last).

    A hash of the key leads the grouping, because rendered prompts share a long
    head and sorting them by text would compare all of it. The text itself stays in
    the key, so equal hashes of unequal texts do not merge. Copies combine before
    the shuffle.
    """
    pick = F.max_by if last else F.min_by
    whole = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(F.xxhash64(key).alias("_h"), key.alias("_key"))
        .agg(pick(whole, F.struct(*order)).alias("_row"))
        .select("_row.*")
    )


def union_files(files: list[DataFrame]) -> DataFrame:
    """Files in the given order, with their place as ``file_ix``."""
    numbered = [f.withColumn("file_ix", F.lit(i)) for i, f in enumerate(files)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def load_pairs(files: list[DataFrame]) -> DataFrame:
    """One record per prompt over all files; the first file and line wins.

    ``source`` is provenance and is not carried into training columns.
    """
    rows = union_files(files)
    return training_columns(keep_first(rows, canonical(F.col("prompt")), ["file_ix", "line_no"]))


def training_columns(df: DataFrame) -> DataFrame:
    return df.drop("source")
