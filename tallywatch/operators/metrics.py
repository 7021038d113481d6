"""Figures for pages, from the daily marts. Windows hold one token's days."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import LAG_FACTOR, MIN_CALLS
from tallywatch.functions.columns import beside, single
from tallywatch.functions.positions import rolling
from tallywatch.functions.quantiles import array_median
from tallywatch.operators.facts import aggs


def last_full_month(pipeline: DataFrame) -> DataFrame:
    """One row: the newest month with every day present."""
    months = pipeline.groupBy("month").agg(*aggs("count(distinct date) as days", "max(day(last_day(date))) as in_month"))
    return months.where("days = in_month").agg(F.max("month").alias("month"))


def _last_two(pipeline: DataFrame) -> DataFrame:
    """The last full month and the one before it: two rows at most."""
    last = last_full_month(pipeline)
    return last.selectExpr("explode(array(month, date_format(add_months(to_date(concat(month, '-01')), -1), 'yyyy-MM'))) as month")


def month_kpis(payments: DataFrame, payments_value: DataFrame, pipeline: DataFrame) -> DataFrame:
    months = F.broadcast(_last_two(pipeline))
    moved = payments.join(months, "month").groupBy("month").agg(*aggs(
        "sum(transfers) as transfers", "try_divide(sum(transfers) filter (where route = 'via contract'), sum(transfers)) as via_share"))
    value = payments_value.join(months, "month").groupBy("month").agg(F.sum("volume").alias("volume"))
    return moved.join(value, "month")


def month_health(health: DataFrame, pipeline: DataFrame) -> DataFrame:
    return health.join(F.broadcast(_last_two(pipeline)), "month").groupBy("month").agg(*aggs(
        "sum(direct_calls) as calls", "sum(failed_calls) as failed", "try_divide(sum(failed_calls), sum(direct_calls)) as rate",
        "percentile(median_fee_eth, 0.5) as fee"))


def monthly_transfers(payments: DataFrame) -> DataFrame:
    return payments.groupBy("month", "token").agg(F.sum("transfers").alias("transfers"))


def monthly_bands(payments_value: DataFrame) -> DataFrame:
    return payments_value.groupBy("month", "amount_band", "amount_band_order").agg(F.sum("volume").alias("volume"))


def monthly_route_share(payments: DataFrame) -> DataFrame:
    return payments.groupBy("month", "token").agg(*aggs(
        "try_divide(sum(transfers) filter (where route = 'via contract'), sum(transfers)) as via_share"))


def monthly_failed(health: DataFrame) -> DataFrame:
    return health.groupBy("month", "token").agg(F.sum("failed_calls").alias("failed"))


def band_mix(payments_value: DataFrame, pipeline: DataFrame) -> DataFrame:
    """Share of the count and of the value per band in the last full month. The window holds one row per band."""
    bands = (payments_value.join(F.broadcast(last_full_month(pipeline)), "month").groupBy("amount_band", "amount_band_order")
             .agg(F.sum("transfers").alias("n"), F.sum("volume").alias("v")))
    whole = bands.agg(F.sum("n").alias("all_n"), F.sum("v").alias("all_v"))
    return bands.withColumn("whole", single(whole)).selectExpr(
        "amount_band", "amount_band_order", "try_divide(n, whole.all_n) as count_share", "try_divide(v, whole.all_v) as value_share")


def month_pivot(payments: DataFrame, payments_value: DataFrame, tokens: list[str], months: int = 12) -> DataFrame:
    """The last months as rows, tokens as columns."""
    newest = payments.agg(F.expr(f"date_format(add_months(max(date), -{months}), 'yyyy-MM') as after"))   # one row
    moved = payments.groupBy("month", "token").agg(F.sum("transfers").alias("transfers"))
    value = payments_value.groupBy("month", "token").agg(F.sum("volume").alias("volume"))
    return (moved.join(value, ["month", "token"], "left").withColumn("after", single(newest)).where("month > after")
            .groupBy("month").pivot("token", tokens).agg(F.first("transfers").alias("transfers"), F.first("volume").alias("volume")))


def totals(payments: DataFrame, pipeline: DataFrame) -> DataFrame:
    moved = payments.groupBy("date").agg(F.sum("transfers").alias("t"), F.max("month").alias("m")).agg(*aggs(
        "sum(t) as transfers", "min(date) as first_day", "max(date) as last_day", "count(*) as days", "count(distinct m) as months"))
    blocks = pipeline.agg(*aggs("sum(blocks) as blocks", "sum(missing_blocks) + sum(duplicate_blocks) as gaps"))
    return beside(moved, blocks)


def coverage(pipeline: DataFrame) -> DataFrame:
    return beside(pipeline.agg(*aggs(
        "min(date) as first", "max(date) as last", "count(distinct date) as days", "datediff(max(date), min(date)) + 1 as expected_days",
        "sum(missing_blocks) + sum(duplicate_blocks) as gaps", "percentile(max_load_lag_hours, 0.5) as usual_lag")),
        days_late(pipeline))


def days_late(pipeline: DataFrame) -> DataFrame:
    usual = pipeline.agg(F.expr("percentile(max_load_lag_hours, 0.5) as u"))
    return pipeline.withColumn("u", single(usual)).agg(F.expr(
        f"count_if(missing_blocks = 0 and duplicate_blocks = 0 and max_load_lag_hours > {LAG_FACTOR} * u) as days_late"))


def _average_rank(column: str, w_all, w_same):
    """Rank with ties averaged."""
    return F.rank().over(w_all) + (F.count(F.lit(1)).over(w_same) - 1) / 2


def rank_corr(health: DataFrame, pipeline: DataFrame, min_calls: int = MIN_CALLS) -> DataFrame:
    """Rank correlation of a day's failure rate with its network fee, per token."""
    rows = (health.where(F.col("direct_calls") >= min_calls).select("date", "token", "failure_rate")
            .join(pipeline.select("date", "avg_base_fee_gwei"), "date").where("failure_rate is not null and avg_base_fee_gwei is not null"))
    for column, rank in (("failure_rate", "r1"), ("avg_base_fee_gwei", "r2")):
        rows = rows.withColumn(rank, _average_rank(column, Window.partitionBy("token").orderBy(column), Window.partitionBy("token", column)))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("days"), F.corr("r1", "r2").alias("rho"))


def rolling7(payments: DataFrame, health: DataFrame) -> DataFrame:
    """Seven-row rolling transfers, failure rate and fee per token."""
    w = Window.partitionBy("token").orderBy("date").rowsBetween(-6, 0)
    moved = payments.groupBy("date", "token").agg(F.sum("transfers").alias("t"))
    moved = moved.select("date", "token", F.avg("t").over(w).alias("transfers7"))
    failures = health.select("date", "token", F.try_divide(F.sum("failed_calls").over(w), F.sum("direct_calls").over(w)).alias("rate7"),
                             array_median(F.collect_list("median_fee_eth").over(w)).alias("fee7"))
    return moved.join(failures, ["date", "token"], "full")


def rolling_source_share(pipeline: DataFrame) -> DataFrame:
    """Entity transfers as a share of the source's rows over seven days: one row per day over the whole history."""
    days = pipeline.select("date", "stablecoin_transfers", "source_transfer_rows")
    sums = rolling(days, 7, "date", ours="sum(stablecoin_transfers)", theirs="sum(source_transfer_rows)")
    return sums.selectExpr("date", "try_divide(ours, theirs) as share7")
