"""Accuracy, yield and histogram reports."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..records import OUTCOMES
from .positions import running_totals

SPINE_STEP = 10_000


def exact_match_accuracy(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Correct, total and their ratio; the ratio of nothing is NULL."""
    return predictions.groupBy(*(by or [])).agg(
        F.count_if("match").alias("correct"),
        F.count("*").alias("total"),
        F.avg(F.col("match").cast("int")).alias("accuracy"),
    )


def running_accuracy(predictions: DataFrame, every: int = 10, order: str = "line_no") -> DataFrame:
    """Accuracy so far per model, after each ``every`` rows in file order."""
    totals = running_totals(
        predictions.select("model", order, "match"),
        ["model"],
        order,
        {"correct": F.coalesce(F.col("match").cast("int"), F.lit(0))},
    )
    return totals.filter(F.pmod("position", F.lit(every)) == 0).select(
        "model", "position", "correct", (F.col("correct") / F.col("position")).alias("accuracy")
    )


def _verdict_counts() -> list[Column]:
    verdict = F.col("verdict")
    count = lambda v: F.count_if(verdict == v)
    return [
        count("match").alias("matched"),
        count("mismatch").alias("mismatched"),
        count("gold_error").alias("gold_error"),
        count("non_discriminative").alias("non_discriminative"),
        F.try_divide(count("match"), count("match") + count("mismatch")).alias("exec_accuracy"),
    ]


def exec_match_accuracy(judged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Matches among the scored rows; excluded verdicts are counted apart."""
    return judged.groupBy(*(by or [])).agg(*_verdict_counts())


def metric_disagreement(judged: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows the string metric and the execution metric judge differently."""
    return judged.groupBy(*(by or [])).agg(*_disagreement_counts())


def _disagreement_counts() -> list[Column]:
    return [
        F.count_if("match").alias("string_matches"),
        F.count_if(F.col("match") != (F.col("verdict") == "match")).alias("disagreements"),
        F.count("*").alias("total"),
    ]


def execution_report(judged: DataFrame) -> DataFrame:
    """Execution accuracy, excluded counts and disagreement with the string metric."""
    return judged.agg(*_verdict_counts(), *_disagreement_counts())


def model_comparison(judged: DataFrame) -> DataFrame:
    """String and execution accuracy of each model side by side."""
    return judged.groupBy("model").agg(
        F.count("*").alias("total"),
        F.avg(F.col("match").cast("int")).alias("accuracy"),
        *_verdict_counts(),
    )


def _spine(first: int, last: DataFrame) -> DataFrame:
    """Integers from ``first`` to the single value in ``last`` (column ``k``).

    In two steps, so that no row holds an array longer than the step.
    """
    blocks = last.filter(F.col("k").isNotNull()).select(
        "k", F.explode(F.sequence(F.lit(0), F.floor(F.col("k") / SPINE_STEP))).alias("b")
    )
    lo = F.greatest(F.col("b") * SPINE_STEP, F.lit(first).cast("bigint"))
    hi = F.least(F.col("b") * SPINE_STEP + SPINE_STEP - 1, F.col("k"))
    return blocks.filter(lo <= hi).select(F.explode(F.sequence(lo, hi)).alias("k"))


def _histogram(bins: DataFrame, first: int, last: DataFrame) -> DataFrame:
    return (
        _spine(first, last)
        .join(bins, "k", "left")
        .select("k", F.coalesce("prompts", F.lit(0)).alias("prompts"))
    )


def success_histogram(outcomes: DataFrame, samples: int | None = None) -> DataFrame:
    """Prompts by number of correct samples, 0..K with the gaps filled.

    K is ``samples``, or the largest group when groups differ. Skipped prompts are
    left out; all-wrong prompts count at 0.
    """
    seen = outcomes.filter(~F.col("outcome").startswith("skipped_"))
    bins = seen.groupBy(F.col("n_correct").alias("k")).agg(F.count("*").alias("prompts"))
    return _histogram(bins, 0, _largest(outcomes, samples))


def distinct_histogram(outcomes: DataFrame, samples: int | None = None) -> DataFrame:
    """Prompts by number of distinct texts, 1..K with the gaps filled; none left out."""
    bins = outcomes.groupBy(F.col("n_distinct").alias("k")).agg(F.count("*").alias("prompts"))
    return _histogram(bins, 1, _largest(outcomes, samples))


def _largest(outcomes: DataFrame, samples: int | None) -> DataFrame:
    k = F.max("n_samples") if samples is None else F.lit(samples).cast("bigint")
    return outcomes.agg(k.alias("k"))


def mean_distinct(outcomes: DataFrame) -> DataFrame:
    """Mean number of distinct texts per prompt, 0 without prompts."""
    return outcomes.agg(
        F.count("*").alias("prompts"),
        F.coalesce(F.try_divide(F.sum("n_distinct"), F.count("*")), F.lit(0.0)).alias("mean_distinct"),
    )


def pair_yield(outcomes: DataFrame, gold_chosen: bool = False) -> DataFrame:
    """Prompts per outcome, zeros included, in report order (``outcome_ix``).

    ``paired_gold_chosen`` repeats ``all_wrong`` when those prompts get a pair: a
    prompt counts in both. One aggregate row, then unpivoted.
    """
    def count(name: str) -> Column:
        if name == "paired_gold_chosen":
            return F.count_if(F.col("outcome") == "all_wrong") if gold_chosen else F.lit(0).cast("bigint")
        return F.count_if(F.col("outcome") == name)

    row = outcomes.agg(*[count(name).alias(name) for name in OUTCOMES])
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("outcome_ix"), F.lit(n).alias("outcome"), F.col(n).alias("prompts"))
            for i, n in enumerate(OUTCOMES)
        ]
    )
    return row.select(F.inline(entries))


def screening_counts(flags: DataFrame, kept: Column) -> DataFrame:
    """How many prompts a screening step keeps and drops."""
    return flags.agg(
        F.count_if(kept).alias("kept"),
        F.count_if(~kept).alias("dropped"),
        F.count("*").alias("total"),
    )
