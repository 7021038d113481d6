"""Facts about every episode at once, from the raw rows of its peak day and of its comparable days.

`days` (see `episodes.plan_days`) has one row per episode and day. Raw transfers of the days that any episode uses are
read once (`day_moves`) and reduced per day, not per episode: a day that many episodes use is not copied. Sums, ranks
and histograms are taken per day, too, and only these few rows meet the episodes. Ranks keep only their first rows
before the shuffle, so no task ever holds a day's rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import LATE_HOURS, MIN_CALLS, ZERO40
from tallywatch.functions.columns import single
from tallywatch.functions.quantiles import exact_quantiles
from tallywatch.session import settle, settle_all

LATE = (f"cast(cast(last_modified as timestamp) as bigint) - cast(cast(block_timestamp as timestamp) as bigint) "
        f"> {LATE_HOURS} * 3600")
PEAK_AND_BASE = ["episode_id", "date", "is_peak", "is_latest", "nb"]


def aggs(*lines: str):
    return [F.expr(line) for line in lines]


def _of(days: DataFrame, *metrics: str) -> DataFrame:
    return days.where(F.col("metric").isin(*metrics))


def _calls(days: DataFrame, tx: DataFrame) -> DataFrame:
    rows = tx.where("direct_token is not null").selectExpr(
        "date", "direct_token as token", "from_address as sender", "receipt_status = 0 as failed", "receipt_gas_used as gas",
        "hash", f"{LATE} as late")
    return rows.join(_of(days, "failure_rate"), ["date", "token"])


def _moves(days: DataFrame, tr: DataFrame, *metrics: str) -> DataFrame:
    return tr.join(_of(days, *metrics), ["date", "token"])


MOVE = ["date", "token", "hour", "from_address", "to_address", "amount"]


def day_moves(days: DataFrame, tr: DataFrame) -> DataFrame:
    """Transfers of all days that some episode needs: `moves` per hour, sender, receiver and amount, written once.

    What it returned may be given again in place of the raw transfers, so fact groups share one raw pass.
    """
    if "moves" in tr.columns:
        return tr
    needed = _of(days, "transfers", "volume").select("date", "token").distinct()
    rows = tr.withColumn("hour", F.expr("hour(block_timestamp)"))
    have = [c for c in MOVE if c in rows.columns]
    return settle(rows.select(*have).join(needed, ["date", "token"], "left_semi").groupBy(*have).agg(F.count(F.lit(1)).alias("moves")))


def _per_day(days: DataFrame, reduced: DataFrame, metric: str) -> DataFrame:
    """Rows reduced per day, given to every episode that uses the day."""
    return reduced.join(_of(days, metric), ["date", "token"])


def _top(df: DataFrame, by: list[str], k: int, *order) -> DataFrame:
    """The first k rows per group. The filter on row_number lets Spark drop the rest before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k).drop("rk")


def _episodes_of(days: DataFrame, *metrics: str) -> DataFrame:
    return _of(days, *metrics).where("is_peak").select("episode_id", "nb").distinct()


# Failure rate

def calls_by_sender_gas(days: DataFrame, tx: DataFrame) -> DataFrame:
    return _calls(days, tx).groupBy("episode_id", "sender", "gas").agg(*aggs(
        "count_if(is_peak) as pc", "count_if(is_peak and failed) as pf",
        "count_if(not is_peak) as bc", "count_if(not is_peak and failed) as bf"))


def calls_by_sender(by_gas: DataFrame) -> DataFrame:
    """One row per episode and sender. A regular sender has calls on the comparable days: no join is needed."""
    return by_gas.groupBy("episode_id", "sender").agg(*aggs(
        "sum(pc) as pc", "sum(pf) as pf", "sum(bc) as bc", "sum(bf) as bf"))


def regular_and_new(senders: DataFrame) -> DataFrame:
    regular = "sender is not null and bc > 0"
    sums = senders.groupBy("episode_id").agg(*aggs(
        "sum(pc) as calls", "sum(pf) as failed",
        f"sum(if({regular}, pc, 0)) as calls_regular", f"sum(if({regular}, pf, 0)) as failed_regular",
        f"sum(if({regular}, 0, pc)) as calls_new", f"sum(if({regular}, 0, pf)) as failed_new",
        "try_divide(sum(bf), sum(bc)) as usual_rate"))
    return sums.selectExpr(
        "*", "try_divide(failed, calls) as rate", "try_divide(failed_regular, calls_regular) as rate_regular",
        "try_divide(failed_new, calls_new) as rate_new", "try_divide(calls_new, calls) as share_calls_new",
        "try_divide(failed_new, failed) as share_failures_new")


def fingerprint(by_gas: DataFrame) -> DataFrame:
    """The most common gas value among the peak's failures, and the failure rate without it."""
    gases = by_gas.groupBy("episode_id", "gas").agg(*aggs(
        "sum(pc) as pc", "sum(pf) as pf", "sum(bf) as bf", "count_if(pc > 0 and sender is not null) as senders"))
    best = gases.groupBy("episode_id").agg(*aggs(
        "max_by(struct(gas, pc, pf, bf, senders), struct(pf, -gas)) filter (where pf > 0) as top",
        "sum(pc) as pc", "sum(pf) as pf", "sum(bf) as bf"))
    return best.selectExpr(
        "episode_id", "top.gas as fingerprint_gas", "try_divide(coalesce(top.pf, 0), pf) as fingerprint_share_of_failures",
        "top.pc as fingerprint_calls", "top.senders as fingerprint_senders",
        "try_divide(pf - top.pf, pc - top.pc) as rate_without_fingerprint",
        "try_divide(top.bf, bf) as fingerprint_share_baseline")


def concentration(senders: DataFrame) -> DataFrame:
    """Share of the ten senders that fail most. What is left is the total minus these ten: the rest is never ranked."""
    active = senders.where("pc > 0")
    ten = (_top(active, ["episode_id"], 10, F.col("pf").desc(), F.col("pc").desc(), F.col("sender"))
           .groupBy("episode_id").agg(*aggs("sum(pf) as tf", "sum(pc) as tc")))
    whole = active.groupBy("episode_id").agg(*aggs("sum(pf) as pf", "sum(pc) as pc"))
    return whole.join(ten, "episode_id").selectExpr(
        "episode_id", "try_divide(tf, pf) as top10_share_of_failures", "try_divide(pf - tf, pc - tc) as rate_without_top10")


def always_failing(senders: DataFrame) -> DataFrame:
    always = "pc >= 5 and pf >= 0.9 * pc"
    return senders.where("pc > 0").groupBy("episode_id").agg(*aggs(
        f"count_if({always}) as always_failing_senders",
        f"try_divide(sum(pf) filter (where {always}), sum(pf)) as always_failing_share",
        f"try_divide(sum(pf) filter (where not ({always})), sum(pc) filter (where not ({always}))) as rate_without_always_failing"))


def absent_senders(senders: DataFrame) -> DataFrame:
    """Share of the usual failures that came from senders silent on the peak day."""
    return senders.groupBy("episode_id").agg(*aggs(
        "try_divide(sum(if(pc = 0, bf, 0)), sum(bf)) as baseline_failures_from_absent_senders"))


def facts_failure(days: DataFrame, tx: DataFrame) -> DataFrame:
    # Written once: every part below reads these reduced rows instead of the raw ones.
    by_gas = settle(calls_by_sender_gas(days, tx))
    senders = calls_by_sender(by_gas)
    out = _episodes_of(days, "failure_rate").drop("nb")
    for part in (regular_and_new(senders), fingerprint(by_gas), concentration(senders), always_failing(senders),
                 absent_senders(senders)):
        out = out.join(part, "episode_id", "left")
    return out


# Transfers

def sends(days: DataFrame, tr: DataFrame) -> DataFrame:
    """Transfers per episode, day and sender. From raw transfers, only what senders need is folded, and nothing is written."""
    if "moves" not in tr.columns:
        needed = _of(days, "transfers").select("date", "token").distinct()
        tr = tr.select("date", "token", "from_address", "amount", F.lit(1).alias("moves")).join(needed, ["date", "token"], "left_semi")
    per_sender = tr.groupBy("date", "token", F.col("from_address").alias("sender")).agg(*aggs(
        "sum(moves) as n", "sum(if(amount < 1, moves, 0)) as dust"))
    return _per_day(days, per_sender, "transfers").select(*PEAK_AND_BASE, "sender", "n", "dust")


def sends_by_sender(per_day: DataFrame) -> DataFrame:
    return per_day.groupBy("episode_id", "nb", "sender").agg(*aggs(
        "sum(if(is_peak, n, 0)) as p", "sum(if(is_peak, 0, n)) as b", "sum(if(is_latest, n, 0)) as l",
        "sum(if(not is_peak and not is_latest, n, 0)) as o"))


def counts_and_dust(per_day: DataFrame) -> DataFrame:
    return per_day.groupBy("episode_id", "nb").agg(*aggs(
        "sum(if(is_peak, n, 0)) as transfers", "sum(if(is_peak, 0, n)) / nb as baseline_avg",
        "sum(if(is_peak, dust, 0)) as dust", "sum(if(is_peak, 0, dust)) / nb as dust_baseline_avg")).drop("nb")


def new_senders(senders: DataFrame) -> DataFrame:
    """Transfers of senders not seen on the other days; the usual level comes from the latest comparable day."""
    return senders.groupBy("episode_id").agg(*aggs(
        "sum(if(b = 0, p, 0)) as new_sender_transfers",
        "sum(if(o = 0, l, 0)) * 7 / 6 as new_sender_transfers_baseline"))


def _daily_top10(per_day: DataFrame, value: str, name: str) -> DataFrame:
    """The sum of a day's ten largest, on the peak and on average over the comparable days that have rows."""
    best = _top(per_day, ["episode_id", "date"], 10, F.col(value).desc())
    daily = best.groupBy("episode_id", "date", "is_peak").agg(F.sum(value).alias("s"))
    return _peak_and_usual(daily, name)


def _peak_and_usual(daily: DataFrame, name: str) -> DataFrame:
    return daily.groupBy("episode_id").agg(*aggs(
        f"sum(s) filter (where is_peak) as {name}", f"avg(s) filter (where not is_peak) as {name}_baseline"))


def top_senders(per_day: DataFrame) -> DataFrame:
    return _daily_top10(per_day, "n", "top10_sender_transfers")


def lost_top50(senders: DataFrame) -> DataFrame:
    """Transfers the fifty usually busiest senders lost."""
    fifty = _top(senders.where("b > 0"), ["episode_id"], 50, F.col("b").desc(), F.col("sender"))
    return fifty.groupBy("episode_id").agg(*aggs("sum(b / nb - p) as lost_from_top50"))


def empty_hours(days: DataFrame, tr: DataFrame, least: int = 10) -> DataFrame:
    per_hour = day_moves(days, tr).groupBy("date", "token", "hour").agg(F.sum("moves").alias("n"))
    hours = _per_day(days, per_hour, "transfers").groupBy("episode_id", "nb", "hour").agg(*aggs(
        "sum(if(is_peak, n, 0)) as p", "sum(if(is_peak, 0, n)) as b"))
    return hours.groupBy("episode_id").agg(*aggs(f"count_if(p = 0 and b / nb >= {least}) as empty_hours"))


def facts_transfers(days: DataFrame, tr: DataFrame) -> DataFrame:
    moves = day_moves(days, tr)
    per_day = settle(sends(days, moves))
    senders = sends_by_sender(per_day)
    out = _episodes_of(days, "transfers").drop("nb")
    for part in (counts_and_dust(per_day), new_senders(senders), top_senders(per_day), lost_top50(senders),
                 empty_hours(days, moves)):
        out = out.join(part, "episode_id", "left")
    return out.fillna(0, ["transfers", "empty_hours", "new_sender_transfers", "new_sender_transfers_baseline"])


# Value moved

MINT, BURN = f"right(from_address, 40) = '{ZERO40}'", f"right(to_address, 40) = '{ZERO40}'"


def supply_and_holders(days: DataFrame, tr: DataFrame) -> DataFrame:
    held = f"not ({MINT}) and not ({BURN})"
    daily = day_moves(days, tr).groupBy("date", "token").agg(*aggs(
        "sum(moves) as n", "sum(amount * moves) as v", f"sum(amount * moves) filter (where {MINT}) as mint",
        f"sum(amount * moves) filter (where {BURN}) as burn", f"sum(amount * moves) filter (where {MINT} or {BURN}) as supply",
        f"sum(amount * moves) filter (where {held}) as held"))
    return _per_day(days, daily, "volume").groupBy("episode_id", "nb").agg(*aggs(
        "sum(v) filter (where is_peak) as volume",
        "coalesce(sum(mint) filter (where is_peak), 0.0D) as minted",
        "coalesce(sum(burn) filter (where is_peak), 0.0D) as burned",
        "sum(held) filter (where is_peak) as between_holders",
        "sum(if(is_peak, n, 0)) as transfers",
        "sum(v) filter (where not is_peak) / nb as baseline_avg",
        "coalesce(sum(supply) filter (where not is_peak), 0.0D) / nb as supply_baseline_avg",
        "sum(held) filter (where not is_peak) / nb as between_holders_baseline_avg",
        "sum(if(is_peak, 0, n)) / nb as transfers_baseline_avg")).drop("nb")


def _day_top10(rows: DataFrame, value: str, times: str = "1") -> DataFrame:
    """Sum of the ten largest values per day, where a row stands for `times` equal values."""
    day = Window.partitionBy("date", "token").orderBy(F.col(value).desc(), "rk")
    best = _top(rows, ["date", "token"], 10, F.col(value).desc()).withColumn("rk", F.monotonically_increasing_id())
    taken = best.withColumn("before", F.expr(f"sum({times})").over(day) - F.expr(times))
    return taken.groupBy("date", "token").agg(F.expr(f"sum({value} * least({times}, greatest(10 - before, 0)))").alias("s"))


def top_value(days: DataFrame, tr: DataFrame) -> DataFrame:
    """The ten largest transfers, senders and receivers by value."""
    moves = day_moves(days, tr)
    equal = moves.groupBy("date", "token", "amount").agg(F.sum("moves").alias("moves"))
    out = _peak_and_usual(_per_day(days, _day_top10(equal, "amount", "moves"), "volume"), "top10_transfer_volume")
    for side, column in (("sender", "from_address"), ("receiver", "to_address")):
        per_party = moves.groupBy("date", "token", column).agg(F.expr("sum(amount * moves)").alias("v"))
        daily = _day_top10(per_party, "v")
        out = out.join(_peak_and_usual(_per_day(days, daily, "volume"), f"top10_{side}_volume"), "episode_id", "left")
    return out


QUARTILES = [0.25, 0.5, 0.75]


def amount_quartiles(days: DataFrame, tr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quartiles of the amounts: over the comparable days, and on the peak before and after each cut hour.

    Amounts are counted per day and hour. Episodes, and the 47 overlapping groups of each, are built from histograms of
    these, so neither raw rows nor counts are multiplied.
    """
    amounts = day_moves(days, tr).groupBy("date", "token", "hour", "amount").agg(F.sum("moves").alias("moves"))
    plan = _of(days, "volume").select("date", "token", "episode_id", "is_peak")

    def usual_days(cells: DataFrame) -> DataFrame:
        return cells.join(plan.where("not is_peak"), ["date", "token"])

    def around_cuts(cells: DataFrame) -> DataFrame:
        return (cells.join(plan.where("is_peak"), ["date", "token"]).withColumn("cut", F.explode(F.expr("sequence(0, 23)")))
                .withColumn("tail", F.expr("hour >= cut")))

    weight = F.col("moves")
    base = exact_quantiles(amounts, ["date", "token"], F.col("amount"), QUARTILES, weight, within=usual_days,
                           groups=["episode_id"]).selectExpr("episode_id", "q as usual")
    parts = exact_quantiles(amounts, ["date", "token", "hour"], F.col("amount"), QUARTILES, weight, within=around_cuts,
                            groups=["episode_id", "cut", "tail"])
    cuts = parts.groupBy("episode_id", "cut").agg(*aggs(
        "max(q) filter (where tail) as tail_q", "max(q) filter (where not tail) as head_q", "max(total) filter (where tail) as n_tail"))
    return base, cuts


def median_amounts(base: DataFrame, cuts: DataFrame) -> DataFrame:
    """The middle quartile: of the whole peak (everything from hour 0 on) and of the comparable days."""
    peak = cuts.where("cut = 0").selectExpr("episode_id", "tail_q[1] as median_amount")
    return peak.join(base.selectExpr("episode_id", "usual[1] as median_amount_baseline"), "episode_id", "full")


def units_shift(base: DataFrame, cuts: DataFrame, tol: float = 0.2, least: int = 30) -> DataFrame:
    """Did amounts change by a power of ten from some hour on?

    For every cut hour the quartiles after it must all sit at the same power of ten of the usual quartiles, and those
    before it must be unchanged. The best fit wins, the earliest cut on a tie.
    """
    logs = "transform(arrays_zip({q}, usual), z -> if(z.{q} > 0, log10(z.{q} / z.usual), null))"
    fits = (cuts.join(base.where("array_min(usual) > 0"), "episode_id")
            .withColumn("n", F.max(F.expr("if(cut = 0, n_tail, null)")).over(Window.partitionBy("episode_id")))
            .where(f"tail_q is not null and n_tail >= greatest({least}, 0.03 * n)")
            .withColumn("t", F.expr(logs.format(q="tail_q")))
            .withColumn("h", F.expr(f"if(cut = 0, array(0.0D), {logs.format(q='head_q')})"))
            .withColumn("k", F.expr("cast(bround(array_sort(t)[1]) as int)"))
            .where(f"k <> 0 and forall(t, x -> coalesce(abs(x - k) < {tol}, false)) "
                   f"and forall(h, x -> coalesce(abs(x) < {tol}, false))")
            .withColumn("fit", F.expr("array_max(transform(t, x -> abs(x - k))) + array_max(transform(h, x -> abs(x)))")))
    return (fits.groupBy("episode_id").agg(F.expr("min_by(struct(k, cut), struct(fit, cut)) as best"))
            .selectExpr("episode_id", "best.k as units_shift_power", "best.cut as units_shift_from_hour"))


def facts_volume(days: DataFrame, tr: DataFrame) -> DataFrame:
    moves = day_moves(days, tr)
    base, cuts = settle_all(*(lambda df=df: df for df in amount_quartiles(days, moves)))   # a few rows per episode
    out = _episodes_of(days, "volume").drop("nb")
    for part in (supply_and_holders(days, moves), top_value(days, moves), median_amounts(base, cuts), units_shift(base, cuts)):
        out = out.join(part, "episode_id", "left")
    return out.fillna(0, ["transfers", "minted", "burned"])


# Is the data itself in doubt?

def _rows_in_doubt(rows: DataFrame, key: str) -> DataFrame:
    """Late and repeated rows on the peak, and the median day's late share before. The rows are read once and reduced per episode and day;
    keys are told apart on peaks only."""
    per_day = rows.groupBy("episode_id", "date", "is_peak").agg(*aggs(
        "count(*) as n", "count_if(late) as late", "count_if(failed) as failed", "count_if(late and failed) as late_failed",
        "sum(amount) as amount", f"count(distinct if(is_peak, {key}, null)) as kinds"))
    peak = "filter (where is_peak)"
    return per_day.groupBy("episode_id").agg(*aggs(
        f"100.0D * sum(late) {peak} / sum(n) {peak} as pct_rows_late", f"sum(n - kinds) {peak} as duplicate_rows",
        f"try_divide(100.0D * sum(late_failed) {peak}, sum(failed) {peak}) as pct_failed_rows_late",
        f"cast(sum(n) {peak} as double) as n", f"sum(amount) {peak} as amount", f"try_divide(sum(failed) {peak}, sum(n) {peak}) as rate",
        "percentile(100.0D * late / n, 0.5) filter (where not is_peak) as pct_rows_late_baseline"))


def facts_integrity(days: DataFrame, tr: DataFrame, tx: DataFrame, bl: DataFrame, payments: DataFrame, health: DataFrame,
                    pipeline: DataFrame) -> DataFrame:
    """Blocks, completeness, late and repeated rows, and whether the mart agrees with the raw rows."""
    peaks = days.where("is_peak").select("episode_id", "metric", "token", "date")
    usual = pipeline.agg(F.expr("percentile(max_load_lag_hours, 0.5) as usual_lag"))
    marts = pipeline.withColumn("usual_lag", single(usual)).selectExpr(
        "date", "missing_blocks", "duplicate_blocks", "try_divide(max_load_lag_hours, usual_lag) as load_lag_vs_usual")
    blocks = (bl.select("date", "timestamp").join(peaks.select("date").distinct(), "date", "left_semi").groupBy("date")
              .agg(*aggs("date_format(cast(max(timestamp) as timestamp), 'HH:mm') as last_block_time", "count(*) as blocks")))
    moved = (_moves(days, tr, "transfers", "volume")
             .selectExpr("episode_id", "date", "is_peak", "amount", "concat(transaction_hash, '-', log_index) as k",
                         f"{LATE} as late", "false as failed"))
    called = _calls(days, tx).selectExpr("episode_id", "date", "is_peak", "0.0D as amount", "hash as k", "late", "failed")
    rows = _rows_in_doubt(moved.unionByName(called), "k")
    cube = payments.groupBy("date", "token").agg(*aggs("cast(sum(transfers) as double) as m_transfers", "sum(volume) as m_volume"))
    rates = health.select("date", "token", F.col("failure_rate").alias("m_rate"))
    out = (peaks.join(marts, "date", "left").join(blocks, "date", "left").join(rows, "episode_id", "left")
           .join(cube, ["date", "token"], "left").join(rates, ["date", "token"], "left"))
    pick = "case metric when 'transfers' then {} when 'volume' then {} else {} end"
    return out.selectExpr(
        "episode_id", "missing_blocks", "duplicate_blocks", "load_lag_vs_usual", "last_block_time",
        "coalesce(blocks, 0) as blocks", "coalesce(last_block_time >= '23:50', false) as day_complete",
        "pct_rows_late", "coalesce(duplicate_rows, 0) as duplicate_rows", "pct_rows_late_baseline",
        "if(metric = 'failure_rate', pct_failed_rows_late, null) as pct_failed_rows_late",
        pick.format("coalesce(n, 0.0D)", "amount", "rate") + " as raw_value",
        pick.format("m_transfers", "m_volume", "m_rate") + " as mart_value",
    ).withColumn("mart_matches_raw", F.expr(
        "coalesce(abs(raw_value - mart_value) <= 1e-6 * greatest(abs(mart_value), 1e-9), false)"))


# Context from the marts

def token_ratios(days: DataFrame, payments: DataFrame, health: DataFrame, min_calls: int = MIN_CALLS) -> DataFrame:
    """Every token's peak against its comparable days, per episode."""
    plan = days.select("episode_id", "metric", "nb", "date", "is_peak")
    values = payments.groupBy("date", "token").agg(*aggs("cast(sum(transfers) as double) as transfers", "sum(volume) as volume"))
    moved = (values.join(_of(plan, "transfers", "volume"), "date")
             .withColumn("v", F.expr("if(metric = 'transfers', transfers, volume)"))
             .groupBy("episode_id", "nb", "token").agg(*aggs(
                 "try_divide(sum(v) filter (where is_peak), sum(v) filter (where not is_peak) / nb) as ratio")).drop("nb"))
    rates = (health.where(F.col("direct_calls") >= min_calls).join(_of(plan, "failure_rate"), "date")
             .groupBy("episode_id", "token").agg(*aggs(
                 "try_divide(avg(failure_rate) filter (where is_peak), avg(failure_rate) filter (where not is_peak)) as ratio")))
    return moved.unionByName(rates)


def segments(days: DataFrame, payments: DataFrame) -> DataFrame:
    """The band and route whose change from a comparable day is largest, and its share of the whole change."""
    cells = (payments.join(_of(days, "transfers", "volume"), ["date", "token"])
             .withColumn("v", F.expr("if(metric = 'transfers', cast(transfers as double), volume)"))
             .groupBy("episode_id", "nb", "amount_band", "route").agg(*aggs(
                 "sum(v) filter (where is_peak) - coalesce(sum(v) filter (where not is_peak), 0.0D) / nb as extra")))
    # At most bands x routes rows per episode.
    return cells.groupBy("episode_id").agg(*aggs(
        "min_by(struct(amount_band, route, extra), struct(-abs(extra), amount_band, route)) filter (where extra is not null) as s",
        "sum(extra) as whole")).selectExpr(
        "episode_id", "s.amount_band as segment_band", "s.route as segment_route", "s.extra as segment_extra",
        "try_divide(s.extra, whole) as segment_share")


def fee_ratios(days: DataFrame, pipeline: DataFrame) -> DataFrame:
    return (pipeline.select("date", "avg_base_fee_gwei").join(days.select("episode_id", "date", "is_peak"), "date")
            .groupBy("episode_id").agg(*aggs(
                "try_divide(avg(avg_base_fee_gwei) filter (where is_peak), avg(avg_base_fee_gwei) filter (where not is_peak)) as fee_ratio")))


def facts_context(days: DataFrame, payments: DataFrame, health: DataFrame, pipeline: DataFrame,
                  min_calls: int = MIN_CALLS) -> DataFrame:
    ratios = (token_ratios(days, payments, health, min_calls).groupBy("episode_id")
              .agg(F.expr("map_from_entries(array_sort(collect_list(struct(token, ratio)))) as token_ratios")))
    return (days.where("is_peak").select("episode_id").join(ratios, "episode_id", "left")
            .join(fee_ratios(days, pipeline), "episode_id", "left").join(segments(days, payments), "episode_id", "left"))
