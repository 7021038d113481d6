"""The whole investigation as one flow: marts, episodes, comparison days, facts, verdicts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.fixed_values import CHANCE_MIN_GAP, CHANCE_SIGMAS, MIN_CALLS
from tallywatch.operators import episodes, facts, scoring, verdicts
from tallywatch.session import settle, settle_all, shared_dir


def all_facts(plan: DataFrame, days: DataFrame, tr: DataFrame, tx: DataFrame, bl: DataFrame, payments: DataFrame,
              health: DataFrame, pipeline: DataFrame, min_calls: int = MIN_CALLS) -> DataFrame:
    """Every fact of every episode in `plan`, one wide row each.

    Each group is written before the groups meet, so a lost executor repeats one group and not the whole plan. The
    groups do not depend on one another and run at the same time.
    """
    shared_dir(plan.sparkSession)
    moves = facts.day_moves(days, tr)
    failures, transfers, volume, integrity, context = settle_all(
        lambda: facts.facts_failure(days, tx), lambda: facts.facts_transfers(days, moves), lambda: facts.facts_volume(days, moves),
        lambda: facts.facts_integrity(days, tr, tx, bl, payments, health, pipeline),
        lambda: facts.facts_context(days, payments, health, pipeline, min_calls))
    behaviour = failures.unionByName(transfers, allowMissingColumns=True).unionByName(volume, allowMissingColumns=True)
    return (plan.join(behaviour, "episode_id", "left").join(integrity, "episode_id", "left")
            .join(context, "episode_id", "left"))


def nested_facts(wide: DataFrame) -> DataFrame:
    """Facts grouped for the JSON lines: pipeline, behaviour, context."""
    own = {"episode_id", "metric", "token", "direction", "peak", "wave_start", "baseline", "nb"}
    integrity = ["missing_blocks", "duplicate_blocks", "load_lag_vs_usual", "last_block_time", "blocks", "day_complete",
                 "pct_rows_late", "duplicate_rows", "pct_rows_late_baseline", "pct_failed_rows_late", "raw_value", "mart_value",
                 "mart_matches_raw"]
    context = ["token_ratios", "fee_ratio", "segment_band", "segment_route", "segment_extra", "segment_share"]
    rest = [c for c in wide.columns if c not in own and c not in integrity and c not in context]
    return wide.select("episode_id", F.struct(*integrity).alias("pipeline"), F.struct(*rest).alias("behaviour"),
                       F.struct(*context).alias("context"), F.col("baseline").alias("baseline_days"), "wave_start")


def investigate(tr: DataFrame, tx: DataFrame, bl: DataFrame, payments: DataFrame, health: DataFrame, pipeline: DataFrame,
                max_episodes: int | None = None, min_calls: int = MIN_CALLS, min_gap: float = CHANCE_MIN_GAP,
                sigmas: float = CHANCE_SIGMAS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Episodes with their verdicts, the facts behind them, and the days the pipeline flags.

    `payments`, `health` and `pipeline` are the published marts. All episodes are found and investigated; with
    `max_episodes` only the most severe ones are, and the others carry investigated = false.
    """
    scored = scoring.scored_days(scoring.daily_series(payments, health, min_calls))
    flagged = episodes.flagged_days(pipeline)
    found = settle(episodes.waves(episodes.episodes(scoring.unusual_days(scored, min_gap, sigmas), flagged)))
    chosen = episodes.most_severe(found, max_episodes)
    plan = settle(episodes.baseline_days(chosen, scored, flagged))
    days = settle(episodes.plan_days(plan))
    wide = settle(all_facts(plan, days, tr, tx, bl, payments, health, pipeline, min_calls))
    judged = verdicts.verdicts(wide)
    out = found.join(judged.drop("metric", "token", "direction").withColumn("investigated", F.lit(True)), "episode_id", "left")
    return out.withColumn("investigated", F.coalesce("investigated", F.lit(False))), wide, flagged
