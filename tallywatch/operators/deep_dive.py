"""Tables for looking into failure spikes, value outliers and rewritten days by hand.

The days of a case are few and joined first; senders are reduced to one row per day before anything is ranked.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import BIG_SUPPLY_AMOUNT, REWRITE_SAMPLE, SPIKE_BASELINE_DAYS, WEI_PER_GWEI, ZERO40
from tallywatch.functions.columns import beside, is_zero, last40, minutes_crossed, single
from tallywatch.functions.quantiles import exact_quantiles
from tallywatch.operators.facts import LATE, aggs
from tallywatch.session import settle

CASE = ["date", "token", "spike_day"]
PCT = "round(100.0D * try_divide({}, {}), {})"


def pct(top: str, bottom: str, digits: int = 1) -> str:
    return PCT.format(top, bottom, digits)


# Failure spikes

def case_days(spikes: DataFrame, before: int = SPIKE_BASELINE_DAYS) -> DataFrame:
    """The spike days, and the ordinary calendar days before the first of them."""
    first = spikes.agg(F.min("date").alias("first")).where("first is not null")
    base = first.select(F.explode(F.expr(f"sequence(date_sub(first, {before}), date_sub(first, 1))")).alias("date"), F.lit(False).alias("spike_day"))
    return base.unionByName(spikes.select("date", F.lit(True).alias("spike_day")).distinct())


def case_calls(tx: DataFrame, days: DataFrame, tokens: list[str]) -> DataFrame:
    """Direct calls on the days of a case. The day list is written first, so the planner knows its size."""
    rows = tx.where(F.col("direct_token").isin(tokens)).selectExpr(
        "date", "block_timestamp", "hash", "from_address as sender", "direct_token as token", "receipt_status = 1 as succeeded",
        "receipt_gas_used as gas_used", f"receipt_effective_gas_price / {WEI_PER_GWEI} as gas_price_gwei", f"{LATE} as late")
    return rows.join(settle(days), "date")


def context(health: DataFrame, payments: DataFrame, pipeline: DataFrame, spikes: DataFrame, tokens: list[str], last: str,
            before: int = SPIKE_BASELINE_DAYS) -> DataFrame:
    first = spikes.agg(F.date_sub(F.min("date"), before).alias("first"))   # one row
    moved = payments.groupBy("date", "token").agg(*aggs(
        "sum(transfers) as transfers", "sum(transfers) filter (where amount_band = 'under 10') as transfers_under_10"))
    return (health.where(F.col("token").isin(tokens)).withColumn("first", single(first))
            .where(f"date >= first and date <= date'{last}'")
            .join(moved, ["date", "token"], "left").join(pipeline.select("date", "avg_base_fee_gwei"), "date", "left")
            .selectExpr("date", "token", "direct_calls", "failed_calls", "round(100 * failure_rate, 3) as pct_failed", "transfers",
                        "transfers_under_10", f"{pct('transfers_under_10', 'transfers')} as pct_transfers_under_10",
                        "round(avg_base_fee_gwei, 3) as avg_base_fee_gwei"))


def integrity(calls: DataFrame, pipeline: DataFrame) -> DataFrame:
    rows = calls.groupBy("date", "spike_day").agg(*aggs(
        "count(*) as direct_calls", "count(*) - count(distinct hash) as duplicate_hashes",
        f"{pct('count_if(late)', 'count(*)', 2)} as pct_rows_late",
        f"{pct('count_if(late and not succeeded)', 'count_if(not succeeded)', 2)} as pct_failed_rows_late"))
    marts = pipeline.selectExpr("date", "blocks", "missing_blocks", "duplicate_blocks", "round(max_load_lag_hours, 1) as max_load_lag_hours")
    return rows.join(marts, "date", "left")


def sender_days(calls: DataFrame) -> DataFrame:
    return calls.groupBy(*CASE, "sender").agg(*aggs("count(*) as calls", "count_if(not succeeded) as failed"))


def rank_senders(senders: DataFrame, k: int | None = None) -> DataFrame:
    """Senders by failures per day and token: all, or the first k (the rest is then dropped before the shuffle)."""
    w = Window.partitionBy("date", "token").orderBy(F.col("failed").desc(), F.col("calls").desc(), "sender")
    ranked = senders.withColumn("rank", F.row_number().over(w))
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def concentration(senders: DataFrame) -> DataFrame:
    """Failure rates with and without the top senders: totals less the ranked few."""
    top = rank_senders(senders, 10).groupBy("date", "token").agg(*aggs(
        "max(failed) filter (where rank = 1) as f1", "max(calls) filter (where rank = 1) as c1", "sum(failed) as f10", "sum(calls) as c10"))
    whole = senders.groupBy(*CASE).agg(*aggs("sum(calls) as calls", "sum(failed) as failed", "count_if(failed > 0) as failing_senders"))
    return whole.join(top, ["date", "token"]).selectExpr(
        *CASE, "calls", "failed", f"{pct('failed', 'calls', 3)} as pct_failed", f"{pct('f1', 'failed')} as pct_failures_from_top_sender",
        f"{pct('f10', 'failed')} as pct_failures_from_top_10", f"{pct('failed - f1', 'calls - c1', 3)} as pct_failed_without_top_sender",
        f"{pct('failed - f10', 'calls - c10', 3)} as pct_failed_without_top_10", "failing_senders")


def always_failing(senders: DataFrame) -> DataFrame:
    s = senders.withColumn("always", F.expr("calls >= 5 and failed >= 0.9 * calls"))
    return s.groupBy(*CASE).agg(*aggs(
        "count_if(always) as always_failing_senders", "coalesce(sum(failed) filter (where always), 0) as their_failed_calls",
        f"{pct('coalesce(sum(failed) filter (where always), 0)', 'sum(failed)')} as pct_failures_from_them",
        f"{pct('sum(failed) filter (where not always)', 'sum(calls) filter (where not always)', 3)} as pct_failed_everyone_else"))


def _known(senders: DataFrame) -> DataFrame:
    return senders.where("not spike_day").select("token", "sender", F.lit(True).alias("known")).distinct()


def with_known(senders: DataFrame) -> DataFrame:
    """`known`: the sender was active on a baseline day."""
    return senders.join(_known(senders), ["token", "sender"], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def sender_profile(senders: DataFrame) -> DataFrame:
    """Failing senders: new or known, one call or many. The median runs over distinct call counts with weights."""
    failing = with_known(senders)
    n = "count_if(failed > 0)"
    shares = failing.groupBy(*CASE).agg(*aggs(
        f"{n} as failing_senders", f"{pct('count_if(failed > 0 and not known)', n)} as pct_not_seen_on_baseline_days",
        f"{pct('count_if(failed > 0 and calls = 1)', n)} as pct_with_a_single_call",
        f"{pct('count_if(failed > 0 and failed < calls)', n)} as pct_that_also_succeeded"))
    medians = (senders.where("failed > 0").groupBy(*CASE, "calls").agg(F.count(F.lit(1)).alias("n")).groupBy("date", "token")
               .agg(F.percentile("calls", F.lit(0.5), F.col("n")).alias("median_calls_per_failing_sender")))
    return shares.join(medians, ["date", "token"], "left")


def known_and_new(senders: DataFrame, recent: int = 6) -> DataFrame:
    """Failure rates of known and new senders on spike days and the last baseline days."""
    last = senders.where("not spike_day").agg(F.date_sub(F.max("date"), recent).alias("since"))   # one row
    rows = with_known(senders).withColumn("since", single(last)).where("spike_day or date >= since")
    f_known, c_known = "sum(failed) filter (where known)", "sum(calls) filter (where known)"
    f_new, c_new = "sum(failed) filter (where not known)", "sum(calls) filter (where not known)"
    return rows.groupBy(*CASE).agg(*aggs(
        f"{c_known} as calls_known", f"{pct(f_known, c_known, 3)} as pct_failed_known", f"{c_new} as calls_new",
        f"{pct(f_new, c_new, 3)} as pct_failed_new", f"{pct(f_new, 'sum(failed)')} as pct_failures_from_new"))


def signature(calls: DataFrame, least: float = 0.5) -> DataFrame:
    """Failure rates without the calls that carry the spike's most common gas value."""
    modes = calls.where("spike_day and not succeeded").groupBy("token", "gas_used").agg(F.count(F.lit(1)).alias("n"))
    best = (modes.groupBy("token").agg(*aggs("max_by(gas_used, struct(n, -gas_used)) as fingerprint_gas", "max(n) as n", "sum(n) as whole"))
            .where(f"n / whole >= {least}").selectExpr("token", "fingerprint_gas", "round(100.0D * n / whole, 1) as pct_of_spike_failures"))
    # One row per token of the case.
    rows = calls.join(F.broadcast(best), "token")
    per_sender = rows.groupBy(*CASE, "fingerprint_gas", "pct_of_spike_failures", "sender").agg(*aggs(
        "count(*) as n", "count_if(not succeeded) as f", "count_if(gas_used = fingerprint_gas) as m",
        "count_if(not succeeded and gas_used <> fingerprint_gas) as fo"))
    return per_sender.groupBy(*CASE, "fingerprint_gas", "pct_of_spike_failures").agg(*aggs(
        "sum(m) as calls_with_fingerprint", "count_if(m > 0) as senders_with_fingerprint", f"{pct('sum(f)', 'sum(n)', 3)} as pct_failed",
        f"{pct('sum(fo)', 'sum(n - m)', 3)} as pct_failed_without_fingerprint"))


def gas_modes(calls: DataFrame, k: int = 5) -> DataFrame:
    modes = calls.where("not succeeded").groupBy("token", "spike_day", "gas_used").agg(F.count(F.lit(1)).alias("failed_calls"))
    whole = modes.groupBy("token", "spike_day").agg(F.sum("failed_calls").alias("whole"))
    w = Window.partitionBy("token", "spike_day").orderBy(F.col("failed_calls").desc(), "gas_used")
    top = modes.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.join(whole, ["token", "spike_day"]).selectExpr(
        "token", "spike_day", "gas_used", "failed_calls", f"{pct('failed_calls', 'whole')} as pct_of_failed", "rank")


def top_senders(senders: DataFrame, k: int = 5) -> DataFrame:
    return rank_senders(senders.where("spike_day"), k).where("failed > 0").selectExpr(
        "date", "token", "rank", "sender", "calls", "failed", f"{pct('failed', 'calls')} as pct_of_own_calls_failed")


def repeat_senders(senders: DataFrame, k: int = 5) -> DataFrame:
    return (top_senders(senders, k).groupBy("sender").agg(*aggs(
        "count(distinct date) as spike_days_in_top_5", "sum(failed) as failed", "sum(calls) as calls")).where("spike_days_in_top_5 > 1"))


def top_sender_history(senders: DataFrame) -> DataFrame:
    """Every day of the sender that failed most over the days it led."""
    top = (rank_senders(senders.where("spike_day"), 1).groupBy("sender").agg(F.sum("failed").alias("f"))
           .orderBy(F.col("f").desc(), "sender").limit(1).select("sender"))   # one row
    return senders.join(F.broadcast(top), "sender").select(*CASE, "calls", "failed")


def hourly_calls(calls: DataFrame) -> DataFrame:
    return calls.where("spike_day").groupBy("date", "token", F.expr("hour(block_timestamp)").alias("hour_utc")).agg(*aggs(
        "count(*) as calls", "count_if(not succeeded) as failed"))


def gas_profile(calls: DataFrame) -> DataFrame:
    """Gas and price by outcome. A group may hold most of the rows, so quantiles are selected, not collected."""
    keys = ["token", "spike_day", "succeeded"]
    counts = calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"))
    gas = exact_quantiles(calls, keys, F.col("gas_used"), [0.5]).select(*keys, F.col("q")[0].alias("median_gas_used"))
    price = exact_quantiles(calls, keys, F.col("gas_price_gwei"), [0.5, 0.9]).selectExpr(
        *keys, "round(q[0], 3) as median_gas_price_gwei", "round(q[1], 3) as p90_gas_price_gwei")
    return counts.join(gas, keys, "left").join(price, keys, "left")


def case_kpis(spikes: DataFrame, ctx: DataFrame, known: DataFrame) -> DataFrame:
    """One row: the peak, shares of new senders, and fee and small-transfer share before and at the peak."""
    peak = spikes.agg(F.expr("max_by(date, struct(failure_rate, -unix_date(date))) as peak_day"), F.min("date").alias("first_spike"))
    new = known.where("spike_day").agg(*aggs(
        "try_divide(sum(calls_new) filter (where calls_new is not null), sum(calls_new + coalesce(calls_known, 0))) as share_calls_new",
        """try_divide(sum(coalesce(calls_new * pct_failed_new, 0)), sum(coalesce(calls_new * pct_failed_new, 0)
           + coalesce(calls_known * pct_failed_known, 0))) as share_failures_new"""))
    days = ctx.withColumn("p", single(peak)).select("*", "p.peak_day", "p.first_spike")
    fees = days.agg(*aggs(
        "percentile(avg_base_fee_gwei, 0.5) filter (where date < first_spike) as fee_before",
        "percentile(avg_base_fee_gwei, 0.5) filter (where date = peak_day) as fee_at_peak",
        "percentile(pct_transfers_under_10, 0.5) filter (where date < first_spike) as small_before",
        "percentile(pct_transfers_under_10, 0.5) filter (where date = peak_day) as small_at_peak"))
    return beside(peak, new, fees)


# Value outliers

def on_days(tr: DataFrame, outliers: DataFrame) -> DataFrame:
    return tr.join(settle(outliers.select("date", "token")), ["date", "token"])


def usual_volume(payments: DataFrame, outliers: DataFrame) -> DataFrame:
    """Median value moved on a day, for every token that has an outlier. Daily rows only."""
    days = payments.groupBy("date", "token").agg(F.sum("volume").alias("volume"))
    return (days.join(outliers.select("token").distinct(), "token", "left_semi")
            .groupBy("token").agg(F.expr("percentile(volume, 0.5)").alias("median_day_volume")))


def supply_events(tr: DataFrame, least: float = BIG_SUPPLY_AMOUNT) -> DataFrame:
    """Large mints and burns with the party on the other side."""
    minted = is_zero(F.col("from_address"))
    return (tr.where(minted | is_zero(F.col("to_address"))).where(F.col("amount") >= least).select(
        "block_timestamp", "block_number", "token", F.when(minted, "mint").otherwise("burn").alias("kind"), "amount", "transaction_hash",
        F.concat(F.lit("0x"), last40(F.when(minted, F.col("to_address")).otherwise(F.col("from_address")))).alias("counterparty")))


def value_composition(tr: DataFrame) -> DataFrame:
    mint, burn = f"right(from_address, 40) = '{ZERO40}'", f"right(to_address, 40) = '{ZERO40}'"
    return tr.groupBy("date", "token").agg(*aggs(
        "count(*) as transfers", "sum(amount) as value_moved", f"sum(amount) filter (where {mint}) as minted",
        f"sum(amount) filter (where {burn}) as burned", f"sum(amount) filter (where not {mint} and not {burn}) as moved_between_holders",
        "max(amount) as largest_transfer"))


def largest_transfers(tr: DataFrame, k: int = 10) -> DataFrame:
    w = Window.partitionBy("date", "token").orderBy(F.col("amount").desc(), "transaction_hash", "log_index")
    return (tr.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        "date", "token", "block_timestamp", "amount", F.concat(F.lit("0x"), last40(F.col("from_address"))).alias("from_address"),
        F.concat(F.lit("0x"), last40(F.col("to_address"))).alias("to_address"), "transaction_hash", "rank"))


def mint_burn_match(events: DataFrame, tol: float = 1e-9, scale: float = 1e6) -> DataFrame:
    """Each token's largest mint, the burn that returned it, a smaller correct mint, and a burn that came before.

    One row per token meets that token's events once, and only aggregates leave the join: no pairs are listed.
    """
    big = events.where("kind = 'mint'").groupBy("token").agg(F.expr(
        "max_by(struct(amount, block_timestamp, counterparty, kind, transaction_hash), struct(amount, -unix_micros(cast(block_timestamp as timestamp)), transaction_hash)) as big"))

    def close(a: str, b: str) -> str:
        return f"abs({a} - {b}) <= {tol}D * greatest(abs({a}), abs({b}))"

    later, earlier = "block_timestamp > big.block_timestamp", "block_timestamp < big.block_timestamp"
    same = "counterparty = big.counterparty"
    burn_back = f"kind = 'burn' and {same} and {later} and {close('amount', 'big.amount')}"
    smaller = f"kind = 'mint' and {same} and {later} and {close(f'amount * {scale}D', 'big.amount')}"
    before = f"kind = 'burn' and {earlier} and {close(f'amount * {scale}D', 'big.amount')}"
    # As many rows as tokens: bounded by the events' own tokens.
    rows = events.join(settle(big), "token")
    return rows.groupBy("token", "big").agg(*aggs(
        f"min(block_timestamp) filter (where {burn_back}) as burned_at", f"count_if({smaller}) as n_smaller",
        f"min(block_timestamp) filter (where {smaller}) as smaller_mint_at", f"count_if({before}) as n_before",
        f"max(block_timestamp) filter (where {before}) as earlier_burn_at")).selectExpr(
        "token", "big.amount as amount", "big.block_timestamp as at", "big.kind as kind", "big.counterparty as counterparty", "burned_at",
        "(unix_micros(cast(burned_at as timestamp)) - unix_micros(cast(big.block_timestamp as timestamp))) / 6e7 as minutes_until_burned",
        "smaller_mint_at", "if(n_smaller > 0, n_before, 0) as earlier_burns", "if(n_smaller > 0, earlier_burn_at, null) as earlier_burn_at")


# Rewritten days

def rewrite_patterns(manifest: DataFrame) -> DataFrame:
    """Each table-day: when it was first and last written after its end, and which pattern that is."""
    end = F.expr("cast(date_add(date, 1) as timestamp_ntz)")
    usual = manifest.groupBy("source_table").agg(F.expr("percentile(max_lag_s / 3600.0D, 0.5) as usual_max_lag"))
    return (manifest.join(usual, "source_table").select(
        "source_table", "date", "rows", "files",
        (minutes_crossed(end, F.col("first_written")) / 60.0).alias("first_written_hours_after_day"),
        (minutes_crossed(end, F.col("last_written")) / 60.0).alias("last_written_hours_after_day"),
        F.expr("max_lag_s / 3600.0D").alias("max_lag_hours"), "usual_max_lag")
        .withColumn("pattern", F.expr("""case when max_lag_hours <= 2 * usual_max_lag then 'normal'
            when first_written_hours_after_day > 2 * usual_max_lag then 'whole day written late' else 'written on time, then patched' end"""))
        .drop("usual_max_lag"))


def pattern_counts(patterns: DataFrame) -> DataFrame:
    return patterns.groupBy("source_table", "pattern").agg(*aggs(
        "count(*) as days", "round(percentile(last_written_hours_after_day, 0.5), 1) as median_hours_until_last_write",
        "round(max(last_written_hours_after_day), 1) as max_hours_until_last_write"))


def rewritten_transfer_days(patterns: DataFrame) -> DataFrame:
    return patterns.where("source_table = 'token_transfers' and pattern <> 'normal'")


def rewrite_sample(patterns: DataFrame, k: int = REWRITE_SAMPLE) -> DataFrame:
    """The worst rewritten days, to be looked at row by row."""
    return rewritten_transfer_days(patterns).orderBy(F.col("max_lag_hours").desc(), "date").limit(k)


def rewrite_summary(patterns: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row: whole days late, patched days, whether the three tables agree, and days only partly late."""
    odd = patterns.where("pattern <> 'normal'")
    tables = odd.groupBy("date").agg(F.count_distinct("source_table").alias("tables")).agg(
        F.coalesce(F.expr("every(tables = 3)"), F.lit(False)).alias("same_in_all"))
    days = odd.where("source_table = 'token_transfers'").agg(*aggs(
        "count_if(pattern = 'whole day written late') as whole_days", "count_if(pattern = 'written on time, then patched') as patched_days",
        "max(last_written_hours_after_day) as worst_hours"))
    partial = blocks.where("blocks_entirely_late < blocks_with_transfers and blocks_entirely_late > 0").agg(*aggs(
        "count(*) as partial_days", "max(blocks_entirely_late / blocks_with_transfers) as largest_partial_share"))
    return beside(days, tables, partial)


def on_sample(df: DataFrame, sample: DataFrame) -> DataFrame:
    """The rows of the sampled rewritten days; the written list prunes partitions."""
    return df.join(settle(sample.select("date").distinct()), "date", "left_semi")


def late_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("late", F.expr(LATE))


def late_share(tr: DataFrame) -> DataFrame:
    return late_rows(tr).groupBy("date", "token").agg(*aggs(
        "count(*) as transfers", "count_if(late) as late_transfers", f"{pct('count_if(late)', 'count(*)', 2)} as pct_late",
        "sum(amount) filter (where late) as late_value", f"{pct('sum(amount) filter (where late)', 'sum(amount)', 2)} as pct_value_late"))


def late_blocks(tr: DataFrame) -> DataFrame:
    per_block = late_rows(tr).groupBy("date", "block_number").agg(*aggs("bool_and(late) as all_late", "bool_or(late) as any_late"))
    return per_block.groupBy("date").agg(*aggs(
        "count(*) as blocks_with_transfers", "count_if(any_late) as blocks_with_late_rows", "count_if(all_late) as blocks_entirely_late",
        "min(block_number) filter (where any_late) as first_late_block", "max(block_number) filter (where any_late) as last_late_block"))


def write_hours(tr: DataFrame) -> DataFrame:
    return tr.groupBy("date", F.expr("date_trunc('hour', last_modified)").cast("timestamp_ntz").alias("written_hour")).agg(
        F.count(F.lit(1)).alias("transfers"))


def late_by_status(tx: DataFrame) -> DataFrame:
    return late_rows(tx).groupBy("date", F.expr("receipt_status = 1").alias("succeeded")).agg(*aggs(
        "count(*) as transactions", f"{pct('count_if(late)', 'count(*)', 2)} as pct_late"))
