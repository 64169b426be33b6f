"""Accuracy, yield and histogram reports."""

from pyspark.sql import functions as F

from pairloom.operators import chats, metrics
from pairloom.staging import staged

from . import tables as t
from .judging import _SELF_SQL, self_verdicts, verdict_rows
from .preferences import outcomes, _band, _BAND
from .registry import query


def predictions(spark, sf):
    return chats.score_responses(t.responses(spark, sf))


@query(
    "exact_match_accuracy",
    f"WITH {t.PREDICTIONS} SELECT count(*) FILTER (WHERE match) AS correct, count(*) AS total, avg(match::INT) AS accuracy FROM predictions",
)
def exact_match_accuracy(spark, sf):
    return metrics.exact_match_accuracy(predictions(spark, sf))


@query(
    "running_accuracy",
    f"""WITH {t.PREDICTIONS}, r AS (SELECT model, row_number() OVER w AS position, sum(match::INT) OVER w AS correct
  FROM predictions WINDOW w AS (PARTITION BY model ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT model, position, correct::BIGINT AS correct, correct / position AS accuracy FROM r WHERE position % 10 = 0""",
)
def running_accuracy(spark, sf):
    """Over a written table, as predictions are: the texts are matched once."""
    scored = predictions(spark, sf).select("model", "line_no", "match")
    return metrics.running_accuracy(staged(scored, "predictions"))


# Orders judged by execution, with a string metric that looks at the price only.
_JUDGED = f"""{t.RESULTS}, judged AS (
  SELECT o_orderpriority AS model, o_totalprice > 200000 AS match, verdict
  FROM orders JOIN verdicts ON pair_id = o_orderkey)"""
_COUNTS = """count(*) FILTER (WHERE verdict = 'match') AS matched, count(*) FILTER (WHERE verdict = 'mismatch') AS mismatched,
  count(*) FILTER (WHERE verdict = 'gold_error') AS gold_error,
  count(*) FILTER (WHERE verdict = 'non_discriminative') AS non_discriminative,
  count(*) FILTER (WHERE verdict = 'match') / nullif(count(*) FILTER (WHERE verdict IN ('match', 'mismatch')), 0) AS exec_accuracy"""


def judged(spark, sf):
    rows = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("pair_id"),
        F.col("o_orderpriority").alias("model"),
        (F.col("o_totalprice") > 200000).alias("match"),
    )
    return rows.join(verdict_rows(spark, sf), "pair_id")


@query("exec_match_accuracy", f"WITH {_JUDGED} SELECT {_COUNTS} FROM judged")
def exec_match_accuracy(spark, sf):
    return metrics.exec_match_accuracy(judged(spark, sf))


@query(
    "metric_disagreement",
    f"""WITH {_JUDGED} SELECT count(*) FILTER (WHERE match) AS string_matches,
  count(*) FILTER (WHERE match <> (verdict = 'match')) AS disagreements, count(*) AS total FROM judged""",
)
def metric_disagreement(spark, sf):
    return metrics.metric_disagreement(judged(spark, sf))


@query(
    "model_comparison",
    f"WITH {_JUDGED} SELECT model, count(*) AS total, avg(match::INT) AS accuracy, {_COUNTS} FROM judged GROUP BY model",
)
def model_comparison(spark, sf):
    return metrics.model_comparison(judged(spark, sf))


def _histogram_sql(first: int, col: str, where: str) -> str:
    return f"""WITH {t.OUTCOMES}, bins AS (SELECT {col} AS k, count(*) AS n FROM outcomes WHERE {where} GROUP BY ALL)
SELECT s.k, coalesce(n, 0) AS prompts
FROM (SELECT unnest(range({first}, (SELECT max(n_samples) FROM outcomes) + 1)) AS k) s LEFT JOIN bins ON bins.k = s.k"""


@query("success_histogram", _histogram_sql(0, "n_correct", "outcome NOT LIKE 'skipped%'"))
def success_histogram(spark, sf):
    return metrics.success_histogram(outcomes(spark, sf))


@query("distinct_histogram", _histogram_sql(1, "n_distinct", "true"))
def distinct_histogram(spark, sf):
    return metrics.distinct_histogram(outcomes(spark, sf))


@query(
    "mean_distinct",
    f"WITH {t.OUTCOMES} SELECT count(*) AS prompts, sum(n_distinct) / count(*) AS mean_distinct FROM outcomes",
)
def mean_distinct(spark, sf):
    return metrics.mean_distinct(outcomes(spark, sf))


@query(
    "pair_yield",
    f"""WITH {t.OUTCOMES}, names(outcome_ix, outcome, counted) AS (VALUES (0, 'paired', 'paired'),
  (1, 'paired_gold_chosen', 'all_wrong'), (2, 'all_correct', 'all_correct'), (3, 'all_wrong', 'all_wrong'),
  (4, 'skipped_gold_error', 'skipped_gold_error'), (5, 'skipped_non_discriminative', 'skipped_non_discriminative'))
SELECT outcome_ix, n.outcome, count(o.prompt_id) AS prompts
FROM names n LEFT JOIN outcomes o ON o.outcome = n.counted GROUP BY ALL""",
)
def pair_yield(spark, sf):
    return metrics.pair_yield(outcomes(spark, sf), gold_chosen=True)


@query(
    "screening_counts",
    f"""WITH {_SELF_SQL} SELECT count(*) FILTER (WHERE verdict = 'match') AS kept,
  count(*) FILTER (WHERE verdict <> 'match') AS dropped, count(*) AS total FROM self_verdicts""",
)
def screening_counts(spark, sf):
    return metrics.screening_counts(self_verdicts(spark, sf), F.col("verdict") == "match")


@query(
    "band_counts",
    f"WITH {_BAND} SELECT count(*) FILTER (WHERE matched) AS kept, count(*) FILTER (WHERE NOT matched) AS dropped, count(*) AS total FROM band",
)
def band_counts(spark, sf):
    return metrics.screening_counts(_band(spark, sf), F.col("matched"))
