"""Candidates, preference pairs, the band, rewards in groups."""

from pyspark.sql import functions as F

from pairloom.operators import band, pairs
from pairloom.operators.verdicts import reward
from pairloom.plans import jobs
from pairloom.sources import jsonl
from pairloom.staging import new_stage

from . import tables as t
from .registry import query


@query("distinct_candidates", f"WITH {t.DISTINCT} SELECT prompt_id, candidate, verdict, first_ix, copies FROM candidates")
def distinct_candidates(spark, sf):
    return pairs.distinct_candidates(t.samples(spark, sf))


@query("label_candidates", f"WITH {t.SAMPLES} SELECT prompt_id, candidate, sample_ix, verdict FROM samples")
def label_candidates(spark, sf):
    samples = t.samples(spark, sf)
    judged = pairs.distinct_candidates(samples)
    return pairs.label_candidates(samples.drop("verdict"), judged)


def outcomes(spark, sf):
    return pairs.prompt_outcomes(pairs.distinct_candidates(t.samples(spark, sf)))


@query(
    "prompt_outcome",
    f"WITH {t.OUTCOMES} SELECT prompt_id, outcome, n_samples, n_distinct, n_correct, n_wrong FROM outcomes",
)
def prompt_outcome(spark, sf):
    return outcomes(spark, sf).select("prompt_id", "outcome", "n_samples", "n_distinct", "n_correct", "n_wrong")


_MINED = "SELECT prompt_id, first_correct AS chosen, first_wrong AS rejected, 'mined' AS source FROM outcomes WHERE outcome = 'paired'"
_GOLD = "SELECT o.prompt_id, gold AS chosen, first_wrong AS rejected, 'gold' AS source FROM outcomes o JOIN sampled_prompts p ON p.prompt_id = o.prompt_id WHERE outcome = 'all_wrong'"


@query("mine_pairs", f"WITH {t.OUTCOMES} {_MINED}")
def mine_pairs(spark, sf):
    return pairs.mine_pairs(outcomes(spark, sf))


@query("gold_chosen_pairs", f"WITH {t.OUTCOMES}, {t.SAMPLED_PROMPTS} {_GOLD}")
def gold_chosen_pairs(spark, sf):
    return pairs.gold_chosen_pairs(outcomes(spark, sf), t.sampled_prompts(spark, sf))


def all_pairs(spark, sf):
    found = outcomes(spark, sf)
    prompts = t.sampled_prompts(spark, sf)
    both = pairs.mine_pairs(found).unionByName(pairs.gold_chosen_pairs(found, prompts))
    return both.join(prompts.select("prompt_id", "prompt_text"), "prompt_id")


def records(df):
    return df.select(
        F.col("prompt_id").alias("line_no"),
        *pairs.pair_record(F.col("prompt_text"), F.col("chosen"), F.col("rejected")),
        "source",
    )


def _shown(df):
    turn = lambda c: F.concat(F.get(c, F.lit(0))["role"], F.lit(": "), F.get(c, F.lit(0))["content"])
    return df.select("line_no", *[turn(c).alias(c) for c in ("prompt", "chosen", "rejected")], *(
        ["source"] if "source" in df.columns else []))


ALL_PAIRS = f"{t.OUTCOMES}, {t.SAMPLED_PROMPTS}, all_pairs AS ({_MINED} UNION ALL {_GOLD})"
_RECORDS = f"""WITH {ALL_PAIRS} SELECT a.prompt_id AS line_no, 'user: ' || prompt_text AS prompt,
  'assistant: ' || chosen AS chosen, 'assistant: ' || rejected AS rejected, source
FROM all_pairs a JOIN sampled_prompts p ON p.prompt_id = a.prompt_id"""


@query("pair_record", _RECORDS)
def pair_record(spark, sf):
    return _shown(records(all_pairs(spark, sf)))


@query("write_pairs", _RECORDS)
def write_pairs(spark, sf):
    path = new_stage(spark, "pairs")
    jsonl.write_pairs(records(all_pairs(spark, sf)), path)
    return _shown(jsonl.read_pairs(spark, [path])[0])


def pair_files(spark, sf):
    """Two runs of mining: the mined pairs, then all pairs with other texts."""
    rows = all_pairs(spark, sf)
    second = rows.withColumns(
        {"chosen": F.concat("chosen", F.lit(" -- 2")), "rejected": F.concat("rejected", F.lit(" -- 2"))}
    )
    return [records(rows.filter(F.col("source") == "mined")), records(second)]


_FIRST_WINS = f"""{ALL_PAIRS}, first_wins AS (
  SELECT a.prompt_id AS line_no, prompt_text, source,
    chosen || CASE source WHEN 'mined' THEN '' ELSE ' -- 2' END AS chosen,
    rejected || CASE source WHEN 'mined' THEN '' ELSE ' -- 2' END AS rejected
  FROM all_pairs a JOIN sampled_prompts p ON p.prompt_id = a.prompt_id)"""


@query(
    "load_pairs",
    f"""WITH {_FIRST_WINS} SELECT line_no, 'user: ' || prompt_text AS prompt, 'assistant: ' || chosen AS chosen,
  'assistant: ' || rejected AS rejected FROM first_wins""",
)
def load_pairs(spark, sf):
    return _shown(pairs.load_pairs(pair_files(spark, sf)))


# --- the band ---------------------------------------------------------------------


def slice_rows(spark, sf):
    """The mining slice: text, gold and seed of all orders.

    Orders that are neither urgent nor low have another text, so their prompts are
    unmatched. Each text occurs twice; the later seed counts.
    """
    rows = t.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("prompt_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "5-LOW"), "").otherwise(" (other wording)").alias("tail"),
    )
    prompts = t.sampled_prompts(spark, sf).join(rows, "prompt_id")
    again = F.explode(F.array(F.lit(0), F.lit(1)))
    return prompts.select("prompt_id", "prompt_text", "tail", "gold", again.alias("again")).select(
        F.concat("prompt_text", "tail").alias("prompt_text"),
        F.concat("gold", F.lit("#"), F.col("again").cast("string")).alias("gold"),
        (F.col("prompt_id") * 2 + F.col("again")).alias("db_seed"),
    )


_BAND = f"""{_FIRST_WINS}, band AS (
  SELECT prompt_text AS user_content, source AS band_source, o_orderkey IS NOT NULL AS matched,
    'SELECT gold' || o_orderkey || '#1' AS gold, o_orderkey * 2 + 1 AS db_seed
  FROM first_wins LEFT JOIN orders ON o_orderkey = line_no AND o_orderpriority IN ('1-URGENT', '5-LOW'))"""


def _band(spark, sf):
    return band.band_lookup(pairs.union_files(pair_files(spark, sf)), slice_rows(spark, sf))


@query("band_lookup", f"WITH {_BAND} SELECT user_content, band_source, matched, gold, db_seed FROM band")
def band_lookup(spark, sf):
    return _band(spark, sf).select("user_content", "band_source", "matched", "gold", "db_seed")


@query(
    "band_source_filter",
    f"WITH {_BAND} SELECT user_content, band_source, gold, db_seed FROM band WHERE matched AND band_source = 'mined'",
)
def band_source_filter(spark, sf):
    found, _ = jobs.band_prompts(pair_files(spark, sf), slice_rows(spark, sf))
    return found.select("user_content", "band_source", "gold", "db_seed")


@query(
    "band_source_filter_untagged",
    f"WITH {_BAND} SELECT user_content, 'unknown' AS band_source, gold, db_seed FROM band WHERE matched",
)
def band_source_filter_untagged(spark, sf):
    """Files from before the tag: every matched prompt stays."""
    files = [f.withColumn("source", F.lit(None).cast("string")) for f in pair_files(spark, sf)]
    found, _ = jobs.band_prompts(files, slice_rows(spark, sf))
    return found.select("user_content", "band_source", "gold", "db_seed")


def rewards(spark, sf):
    return t.samples(spark, sf).select("prompt_id", "sample_ix", reward(F.col("verdict")).alias("reward"))


REWARDS = f"{t.SAMPLES}, rewards AS (SELECT prompt_id, sample_ix, (verdict = 'match')::INT::DOUBLE AS reward FROM samples)"


@query(
    "mixed_reward_filter",
    f"""WITH {REWARDS}, {t.SAMPLED_PROMPTS}, w AS (SELECT prompt_id, sum(reward) AS wins, count(*) AS k FROM rewards GROUP BY ALL)
SELECT p.prompt_id, prompt_text FROM sampled_prompts p JOIN w ON w.prompt_id = p.prompt_id WHERE wins > 0 AND wins < k""",
)
def mixed_reward_filter(spark, sf):
    prompts = t.sampled_prompts(spark, sf).select("prompt_id", "prompt_text")
    return band.mixed_reward_filter(prompts, rewards(spark, sf))


@query(
    "group_reward_stats",
    f"""WITH {REWARDS} SELECT prompt_id, count(*) AS group_size, avg(reward) AS mean_reward,
  round(stddev_samp(reward), 9) AS std_reward, min(reward) = max(reward) AS dead FROM rewards GROUP BY ALL""",
)
def group_reward_stats(spark, sf):
    stats = band.group_reward_stats(rewards(spark, sf))
    return stats.withColumn("std_reward", F.round("std_reward", 9))


@query(
    "dead_group_share",
    f"""WITH {REWARDS}, s AS (SELECT min(reward) = max(reward) AS dead FROM rewards GROUP BY prompt_id)
SELECT count(*) AS groups, count(*) FILTER (WHERE dead) AS dead_groups, avg(dead::INT) AS dead_share FROM s""",
)
def dead_group_share(spark, sf):
    return band.dead_group_share(band.group_reward_stats(rewards(spark, sf)))


@query(
    "group_advantage",
    f"WITH {REWARDS} SELECT prompt_id, sample_ix, reward, reward - avg(reward) OVER (PARTITION BY prompt_id) AS advantage FROM rewards",
)
def group_advantage(spark, sf):
    return band.group_advantage(rewards(spark, sf))
