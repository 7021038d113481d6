"""How unusual is a day? Robust seasonal scores, spikes and outliers over daily series.

Every window here is partitioned over daily rows (days per token), never over raw rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import (CHANCE_MIN_GAP, CHANCE_SIGMAS, HISTORY_ROWS, LOG_FLOOR, MAD_TO_SIGMA, METRICS,
                                     MIN_CALLS, MIN_MOVE, MIN_SCORE, MIN_SPREAD, OUTLIER_FACTOR, SPIKE_FACTOR, SPIKE_ROWS)
from tallywatch.functions.columns import ratio
from tallywatch.functions.quantiles import array_mad, array_median


def _by_metric(values: dict[str, float]):
    out = F.lit(None).cast("double")
    for m in reversed(METRICS):
        out = F.when(F.col("metric") == m, F.lit(float(values[m]))).otherwise(out)
    return out


def daily_series(payments: DataFrame, health: DataFrame, min_calls: int = MIN_CALLS) -> DataFrame:
    """One long series: metric, token, date, value; calls and failed for the failure rate."""
    none = F.lit(None).cast("double")
    days = payments.groupBy("date", "token").agg(F.sum("transfers").cast("double").alias("transfers"),
                                                 F.sum("volume").alias("volume"))
    moved = days.select("date", "token", F.explode(F.array(
        F.struct(F.lit("transfers").alias("metric"), F.col("transfers").alias("value")),
        F.struct(F.lit("volume").alias("metric"), F.col("volume").alias("value")))).alias("m"))
    moved = moved.select("m.metric", "date", "token", "m.value", none.alias("calls"), none.alias("failed"))
    failures = health.where(F.col("direct_calls") >= min_calls).select(
        F.lit("failure_rate").alias("metric"), "date", "token", F.col("failure_rate").alias("value"),
        F.col("direct_calls").cast("double").alias("calls"), F.col("failed_calls").cast("double").alias("failed"))
    return moved.unionByName(failures)


def _weekday_history(df: DataFrame, keys: list[str], value: str, rows: int) -> DataFrame:
    """`past`: the values of the previous rows on the same weekday; only days with a full history."""
    w = (Window.partitionBy(*keys, F.dayofweek("date")).orderBy("date").rowsBetween(-rows, -1))
    return df.withColumn("past", F.collect_list(value).over(w)).where(F.size("past") == rows)


def scored_days(series: DataFrame, weeks: int = HISTORY_ROWS, min_spread: float = MIN_SPREAD) -> DataFrame:
    """Each day's usual level and score: log scale, same weekday, median and MAD of the previous weeks."""
    logged = (series.where(F.col("value").isNotNull())
              .withColumn("lv", F.ln(F.greatest(F.col("value"), _by_metric(LOG_FLOOR)))))
    past = _weekday_history(logged, ["metric", "token"], "lv", weeks).withColumn("usual_lv", array_median(F.col("past")))
    spread = F.greatest(MAD_TO_SIGMA * array_mad(F.col("past"), F.col("usual_lv")), F.lit(min_spread))
    return past.select("date", "metric", "token", "value", "calls", "failed", F.exp("usual_lv").alias("usual"),
                       (F.col("value") / F.exp("usual_lv")).alias("ratio"),
                       ((F.col("lv") - F.col("usual_lv")) / spread).alias("score"))


def unusual_days(scored: DataFrame, min_gap: float = CHANCE_MIN_GAP, sigmas: float = CHANCE_SIGMAS) -> DataFrame:
    """Days that move far and by a meaningful amount; a failure rate must also beat chance."""
    least = _by_metric(MIN_MOVE)
    expected = F.col("usual") * F.col("calls")
    gap = F.abs(F.col("failed") - expected)
    beyond_chance = (gap >= min_gap) & (gap >= sigmas * F.sqrt(F.greatest(expected, F.lit(1.0))))
    return (scored.where(F.abs("score") >= MIN_SCORE)
            .where((F.col("ratio") >= least) | (F.col("ratio") <= 1 / least))
            .where((F.col("metric") != "failure_rate") | beyond_chance)
            .withColumn("direction", F.when(F.col("score") > 0, "up").otherwise("down")))


def unusual_linear(series: DataFrame, flags: DataFrame, k: int | None = 12, weeks: int = HISTORY_ROWS) -> DataFrame:
    """The k days furthest from usual on the plain scale, with the pipeline's word on each day.

    `series` has date, segment, value; `flags` has date, pipeline. k None keeps every scored day.
    """
    past = _weekday_history(series, ["segment"], "value", weeks).withColumn("usual", array_median(F.col("past")))
    past = past.withColumn("spread", array_mad(F.col("past"), F.col("usual"))).where(F.col("spread") > 0)
    out = (past.withColumn("score", (F.col("value") - F.col("usual")) / (MAD_TO_SIGMA * F.col("spread")))
           .join(flags.select("date", "pipeline"), "date", "left")
           .select("date", "segment", "value", "usual", "score", F.coalesce("pipeline", F.lit("No record")).alias("pipeline")))
    return out if k is None else out.orderBy(F.abs("score").desc(), "date", "segment").limit(k)


def spike_days(health: DataFrame, first: str | None = None, last: str | None = None, tokens: list[str] | None = None,
               factor: float = SPIKE_FACTOR, rows: int = SPIKE_ROWS, min_calls: int = MIN_CALLS) -> DataFrame:
    """Days whose failure rate is over `factor` times its trailing median. The window sees days before `first` too."""
    if tokens:
        health = health.where(F.col("token").isin(tokens))
    w = Window.partitionBy("token").orderBy("date").rowsBetween(-rows, -1)
    usual = F.percentile("failure_rate", F.lit(0.5)).over(w)
    out = (health.select("date", "token", "direct_calls", "failed_calls", "failure_rate", usual.alias("usual_rate"))
           .where((F.col("failure_rate") > factor * F.col("usual_rate")) & (F.col("direct_calls") >= min_calls)))
    if first:
        out = out.where(F.col("date") >= F.lit(first).cast("date"))
    if last:
        out = out.where(F.col("date") <= F.lit(last).cast("date"))
    return out.withColumn("times_usual", ratio(F.col("failure_rate"), F.col("usual_rate")))


def value_outliers(payments: DataFrame, factor: float = OUTLIER_FACTOR) -> DataFrame:
    """Token-days whose value is over `factor` times the token's median day."""
    daily = payments.groupBy("date", "token").agg(F.sum("volume").alias("volume"))
    usual = F.percentile("volume", F.lit(0.5)).over(Window.partitionBy("token"))
    return (daily.withColumn("usual", usual).where(F.col("volume") > factor * F.col("usual"))
            .select("date", "token", "volume", ratio(F.col("volume"), F.col("usual")).alias("times_usual")))


def payments_value(payments: DataFrame, outliers: DataFrame) -> DataFrame:
    """The cube without outlier token-days."""
    return payments.join(outliers.select("date", "token"), ["date", "token"], "left_anti")


def outlier_reasons(outliers: DataFrame, reasons: DataFrame) -> DataFrame:
    """Outliers with the known reason and its source, where there is one."""
    return outliers.join(reasons, ["token", "date"], "left")
