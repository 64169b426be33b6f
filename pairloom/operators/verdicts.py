"""From query results to verdicts and rewards.

``results`` holds one row per result row: ``pair_id``, ``db_ix``, ``side``
(``gold`` or ``candidate``), ``row_key``, ``all_null`` and optionally ``copies``.
``runs`` holds one row per pair and database: ``pair_id``, ``db_ix``, ``built``,
``gold_ok``, ``candidate_ok``. Runs and results are united before the first
aggregate, so a side without rows needs no outer join.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _net_counts(results: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per pair, database and row key: gold copies less candidate copies.

    Sums, so copies combine before the shuffle and a pair with very many rows is
    spread over its row keys.
    """
    copies = F.col("copies") if "copies" in results.columns else F.lit(1)
    signed = F.when(F.col("side") == "gold", copies).otherwise(-copies)
    true, none = F.lit(True), F.lit(None).cast("string")
    rows = results.select(
        "pair_id",
        "db_ix",
        "row_key",
        signed.cast("bigint").alias("net"),
        ((F.col("side") == "gold") & ~F.col("all_null")).alias("gold_live"),
        true.alias("built"),
        true.alias("gold_ok"),
        true.alias("candidate_ok"),
    )
    marks = runs.select(
        "pair_id",
        "db_ix",
        none.alias("row_key"),
        F.lit(0).cast("bigint").alias("net"),
        F.lit(False).alias("gold_live"),
        "built",
        "gold_ok",
        "candidate_ok",
    )
    return (
        rows.unionByName(marks)
        .groupBy("pair_id", "db_ix", "row_key")
        .agg(
            F.sum("net").alias("net"),
            F.bool_or("gold_live").alias("gold_live"),
            F.bool_and("built").alias("built"),
            F.bool_and("gold_ok").alias("gold_ok"),
            F.bool_and("candidate_ok").alias("candidate_ok"),
        )
    )


def multiset_equal(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Per pair and database: are both results the same rows with the same copies?

    Two empty sides are equal. Adds ``gold_empty`` (no rows, or all cells NULL).
    """
    return (
        _net_counts(results, runs)
        .groupBy("pair_id", "db_ix")
        .agg(
            F.bool_and(F.col("net") == 0).alias("equal"),
            (~F.bool_or("gold_live")).alias("gold_empty"),
        )
    )


def result_empty(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Per pair, database and side: no rows, or no cell that is not NULL."""
    sides = runs.select(
        "pair_id", "db_ix", F.explode(F.array(F.lit("gold"), F.lit("candidate"))).alias("side"),
        F.lit(True).alias("all_null"),
    )
    return (
        results.select("pair_id", "db_ix", "side", "all_null")
        .unionByName(sides)
        .groupBy("pair_id", "db_ix", "side")
        .agg(F.bool_and("all_null").alias("empty"))
    )


def exec_verdict(results: DataFrame, runs: DataFrame) -> DataFrame:
    """One verdict per pair, folding over its databases in order.

    The first database that ends the matter decides: it cannot be built or gold
    fails (``gold_error``), else the candidate fails or differs (``mismatch``).
    If none does, ``match`` when gold was ever non-empty, else
    ``non_discriminative``. The first ending is the least ``2 * db_ix + kind``,
    one number, so both aggregates stay hash aggregates.
    """
    gold_error = ~F.col("built") | ~F.col("gold_ok")
    mismatch = ~F.col("candidate_ok") | (F.col("net") != 0)
    place = F.col("db_ix").cast("bigint") * 2
    ending = F.when(gold_error, place).when(mismatch, place + 1)
    return (
        _net_counts(results, runs)
        .groupBy("pair_id")
        .agg(F.min(ending).alias("_end"), F.bool_or("gold_live").alias("_live"))
        .select(
            "pair_id",
            F.when(F.col("_end").isNotNull(), F.when(F.col("_end").bitwiseAND(F.lit(1)) == 0, "gold_error").otherwise("mismatch"))
            .when(F.col("_live"), "match")
            .otherwise("non_discriminative")
            .alias("verdict"),
        )
    )


def reward(verdict: Column) -> Column:
    """1.0 for ``match``, 0.0 for every other verdict."""
    return F.when(verdict == "match", F.lit(1.0)).otherwise(F.lit(0.0))


def self_screen(prompts: DataFrame, self_verdicts: DataFrame, key: str = "pair_id") -> DataFrame:
    """Prompts whose gold query, run against itself, gives ``match``."""
    return prompts.join(
        self_verdicts.filter(F.col("verdict") == "match").select(key), key, "left_semi"
    )
