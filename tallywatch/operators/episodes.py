"""Group unusual days into episodes and plan which days each is compared with."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import (BASELINE_BACK_DAYS, BASELINE_DAYS, BASELINE_MAX_SCORE, BASELINE_MIN_DAYS,
                                     EPISODE_GAP_DAYS, LAG_FACTOR, WAVE_GAP_DAYS)
from tallywatch.functions.columns import ratio, single
from tallywatch.functions.positions import with_position

SERIES = ["metric", "token", "direction"]


def _islands(df: DataFrame, by: list[str], order: str, starts_new) -> DataFrame:
    """Number runs of consecutive rows; `starts_new` is true on the first row of a run."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("run", F.sum(F.when(starts_new(w), 1).otherwise(0)).over(w))


def episodes(flags: DataFrame, flagged: DataFrame | None = None, gap_days: int = EPISODE_GAP_DAYS) -> DataFrame:
    """Unusual days of one series closer than the gap become one episode, described by its biggest move."""
    runs = _islands(flags, SERIES, "date",
                    lambda w: F.coalesce(F.datediff("date", F.lag("date").over(w)), F.lit(99)) > gap_days)
    size = F.when(F.col("ratio") > 0, F.abs(F.ln("ratio"))).otherwise(0.0)
    # The earliest day wins a tie.
    peak = F.max_by(F.struct("date", "value", "usual", "ratio", "score"), F.struct(size, -F.unix_date("date")))
    out = runs.groupBy(*SERIES, "run").agg(
        F.min("date").alias("start"), F.max("date").alias("end"), F.count(F.lit(1)).alias("days"),
        F.array_sort(F.collect_list("date")).alias("day_list"), peak.alias("peak"),
        F.max(F.abs("score")).alias("severity"))
    out = out.select(
        F.concat_ws("-", "metric", "token", "direction", "start").alias("episode_id"), *SERIES, "start", "end", "days",
        "day_list", *[F.col(f"peak.{c}").alias(f"peak_{c}") for c in ("date", "value", "usual", "ratio", "score")], "severity")
    if flagged is None:
        return out
    bad = (out.select("episode_id", F.explode("day_list").alias("date")).join(flagged.select("date"), "date", "left_semi")
           .groupBy("episode_id").agg(F.array_sort(F.collect_list("date")).alias("pipeline_flagged_days")))
    return out.join(bad, "episode_id", "left").withColumn(
        "pipeline_flagged_days", F.coalesce("pipeline_flagged_days", F.array().cast("array<date>")))


def _with_usual_lag(pipeline: DataFrame) -> DataFrame:
    """One row per day plus the median day's lag."""
    usual = pipeline.agg(F.percentile("max_load_lag_hours", F.lit(0.5)).alias("usual_lag"))
    return pipeline.withColumn("usual_lag", single(usual))


def _issue(late: str, missing: str, duplicate: str):
    return (F.when(F.col("missing_blocks") > 0, missing).when(F.col("duplicate_blocks") > 0, duplicate)
            .when(F.col("max_load_lag_hours") > LAG_FACTOR * F.col("usual_lag"), late))


def flagged_days(pipeline: DataFrame) -> DataFrame:
    """Days the pipeline itself puts in doubt, with the reason."""
    return (_with_usual_lag(pipeline)
            .withColumn("issue", _issue("late or rewritten", "missing blocks", "duplicate blocks"))
            .where(F.col("issue").isNotNull())
            .select("date", "missing_blocks", "duplicate_blocks", "max_load_lag_hours",
                    ratio(F.col("max_load_lag_hours"), F.col("usual_lag")).alias("lag_vs_usual"), "issue"))


def day_flags(pipeline: DataFrame) -> DataFrame:
    """Every day with its state, OK included."""
    issue = F.coalesce(_issue("Late or rewritten", "Missing blocks", "Duplicate blocks"), F.lit("OK"))
    return _with_usual_lag(pipeline).select("date", issue.alias("pipeline"))


def rewritten_days(flagged: DataFrame) -> DataFrame:
    """How many days were written late or rewritten: stands beside the agreement with known cases."""
    return flagged.agg(F.expr("count_if(issue = 'late or rewritten')").alias("rewritten_days"))


def issues(pipeline: DataFrame, payments: DataFrame) -> DataFrame:
    """Days to check before explaining any move: block problems first, then the longest delay."""
    moved = payments.groupBy("date").agg(F.sum("transfers").alias("transfers"))
    found = (day_flags(pipeline).where(F.col("pipeline") != "OK")
             .join(pipeline.select("date", "missing_blocks", "duplicate_blocks", "max_load_lag_hours"), "date")
             .join(moved, "date", "left"))
    return with_position(found, F.col("pipeline") == "Late or rewritten", F.col("max_load_lag_hours").desc(), "date").orderBy("position")


def waves(eps: DataFrame, gap_days: int = WAVE_GAP_DAYS) -> DataFrame:
    """`wave_start`: episodes of one series less than the gap apart are one wave."""
    runs = _islands(eps, SERIES, "start",
                    lambda w: F.coalesce(F.datediff("start", F.lag("end").over(w)) > gap_days, F.lit(True)))
    return (runs.withColumn("wave_start", F.min("start").over(Window.partitionBy(*SERIES, "run"))).drop("run"))


def most_severe(eps: DataFrame, n: int | None = None) -> DataFrame:
    """The episodes to investigate: all, or the n most severe."""
    return eps if n is None else eps.orderBy(F.col("severity").desc(), "episode_id").limit(n)


def baseline_days(eps: DataFrame, scored: DataFrame, flagged: DataFrame, n: int = BASELINE_DAYS,
                  back: int = BASELINE_BACK_DAYS) -> DataFrame:
    """The plan: one row per episode with its peak and the days it is compared with.

    Those are the latest ordinary days on the peak's weekday before the wave; with too few of them, the same weekday
    of the weeks before. `eps` needs `wave_start`.
    """
    quiet = (scored.where(F.abs("score") < BASELINE_MAX_SCORE).select("metric", "token", "date")
             .withColumn("weekday", F.dayofweek("date")).join(flagged.select("date"), "date", "left_anti"))
    plan = eps.select("episode_id", *SERIES, F.col("peak_date").alias("peak"), "wave_start",
                      F.dayofweek("peak_date").alias("weekday"))
    near = (plan.join(quiet, ["metric", "token", "weekday"])
            .where((F.col("date") < F.col("wave_start")) & (F.col("date") >= F.date_sub("wave_start", back))))
    latest = (near.withColumn("rk", F.row_number().over(Window.partitionBy("episode_id").orderBy(F.col("date").desc())))
              .where(F.col("rk") <= n).groupBy("episode_id").agg(F.array_sort(F.collect_list("date")).alias("found")))
    shift = F.pmod(F.dayofweek("wave_start") - F.col("weekday"), F.lit(7))
    last = F.date_sub("wave_start", F.when(shift == 0, 7).otherwise(shift))
    weekly = F.sequence(F.date_sub(last, 7 * (n - 1)), last, F.expr("interval 7 days"))
    found = F.coalesce("found", F.array().cast("array<date>"))
    return plan.join(latest, "episode_id", "left").select(
        "episode_id", *SERIES, "peak", "wave_start",
        F.when(F.size(found) >= BASELINE_MIN_DAYS, found).otherwise(weekly).alias("baseline")
    ).withColumn("nb", F.size("baseline"))


def plan_days(plan: DataFrame) -> DataFrame:
    """One row per episode and day to read."""
    return plan.select(
        "episode_id", "metric", "token", "direction", "nb",
        F.array_max("baseline").alias("latest"),
        F.explode(F.array_union(F.array("peak"), F.col("baseline"))).alias("date"), "peak",
    ).withColumn("is_peak", F.col("date") == F.col("peak")).withColumn("is_latest", F.col("date") == F.col("latest"))


def case_overlap(eps: DataFrame, cases: DataFrame) -> DataFrame:
    """Known cases and the episodes that overlap them, one row per case and token; unmatched cases stay.

    Equality on metric and token leads the join; the day ranges only filter its matches.
    """
    wanted = cases.withColumn("token", F.explode("tokens")).select(
        "case", "metric", "token", F.col("start").alias("case_start"), F.col("end").alias("case_end"), "families", "hand_verdict")
    pairs = wanted.join(eps, ["metric", "token"]).where(
        (F.col("start") <= F.col("case_end")) & (F.col("end") >= F.col("case_start")))
    return wanted.join(pairs.drop("families", "hand_verdict", "case_start", "case_end"), ["case", "metric", "token"], "left")


def agreement(eps: DataFrame, cases: DataFrame) -> DataFrame:
    """Did the rules find each known case and give it the same kind of verdict?

    `eps` carries `investigated`, `family` and `label`. The most severe investigated episode speaks for the case,
    or the most severe one when none was investigated.
    """
    done = F.coalesce("investigated", F.lit(False))
    best = F.max_by(F.struct("peak_date", "family", "label", done.alias("investigated")),
                    F.when(F.col("episode_id").isNotNull(), F.struct(done, "severity", "episode_id")))
    return (case_overlap(eps, cases).groupBy("case", "token", "families", "hand_verdict")
            .agg(F.count("episode_id").alias("episodes"), best.alias("best"))
            .select("case", "token", (F.col("episodes") > 0).alias("found"), "episodes",
                    F.coalesce("best.investigated", F.lit(False)).alias("investigated"),
                    F.when(F.col("best.investigated"), F.col("best.label")).otherwise("").alias("verdict"),
                    F.coalesce(F.col("best.investigated") & F.array_contains("families", F.col("best.family")), F.lit(False)).alias("agrees"),
                    "hand_verdict", F.col("best.peak_date").alias("peak")))
