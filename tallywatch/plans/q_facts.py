"""Facts per episode, for every episode found in the benchmark tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.operators import facts
from tallywatch.plans.catalog import query
from tallywatch.plans.oracle_base import piece
from tallywatch.plans.q_detect import MIN_CALLS, detected
from tallywatch.sources.adapters import Raw

piece("z_pdays", """
    select episode_id, metric, token, direction, nb, peak, date, date = peak as is_peak, date = list_max(baseline) and date <> peak as is_latest
    from (select *, unnest(list_distinct(list_append(baseline, peak))) as date from z_plan)""")
piece("z_calls_ep", """
    select d.episode_id, d.is_peak, x.date, x.from_address as sender, x.receipt_status = 0 as failed, x.receipt_gas_used as gas, x.hash,
           date_diff('second', x.block_timestamp, x.last_modified) > 48 * 3600 as late
    from z_tx x join z_pdays d on d.metric = 'failure_rate' and d.date = x.date and d.token = x.direct_token""")
piece("z_peakcalls", """
    select c.*, r.sender is not null as is_regular from z_calls_ep c
    left join (select distinct episode_id, sender from z_calls_ep where not is_peak) r using (episode_id, sender) where c.is_peak""")
piece("z_feps", "select episode_id from z_plan where metric = 'failure_rate'")
piece("z_rn", """
    select e.episode_id, p.*exclude(episode_id), b.usual_rate, failed / nullif(calls, 0) as rate, failed_regular / nullif(calls_regular, 0) as rate_regular,
           failed_new / nullif(calls_new, 0) as rate_new, calls_new / nullif(calls, 0) as share_calls_new,
           failed_new / nullif(failed, 0) as share_failures_new
    from z_feps e left join (select episode_id, count(*) as calls, count(*) filter (where failed) as failed,
                 count(*) filter (where is_regular) as calls_regular, count(*) filter (where is_regular and failed) as failed_regular,
                 count(*) filter (where not is_regular) as calls_new, count(*) filter (where not is_regular and failed) as failed_new
          from z_peakcalls group by 1) p using (episode_id)
    left join (select episode_id, count(*) filter (where failed) / count(*) as usual_rate from z_calls_ep where not is_peak group by 1) b
    using (episode_id)""")
piece("z_fp", """
    select e.episode_id, f.gas as fingerprint_gas, f.n / f.all_n as fingerprint_share_of_failures,
           (select count(*) from z_peakcalls c where c.episode_id = e.episode_id and c.gas = f.gas) as fingerprint_calls,
           (select count(distinct sender) from z_peakcalls c where c.episode_id = e.episode_id and c.gas = f.gas) as fingerprint_senders,
           (select count(*) filter (where failed and gas <> f.gas) / nullif(count(*) filter (where gas <> f.gas), 0)
            from z_peakcalls c where c.episode_id = e.episode_id) as rate_without_fingerprint,
           (select count(*) filter (where gas = f.gas) / nullif(count(*), 0) from z_calls_ep c
            where c.episode_id = e.episode_id and failed and not is_peak) as fingerprint_share_baseline
    from z_feps e left join (
        select *, row_number() over (partition by episode_id order by n desc, gas) as rk, sum(n) over (partition by episode_id) as all_n
        from (select episode_id, gas, count(*) as n from z_peakcalls where failed group by all)) f
    on f.episode_id = e.episode_id and f.rk = 1""")
piece("z_fsenders", "select episode_id, sender, count(*) as calls, count(*) filter (where failed) as failed from z_peakcalls group by all")
piece("z_conc", """
    select episode_id, sum(failed) filter (where rk <= 10) / nullif(sum(failed), 0) as top10_share_of_failures,
           coalesce(sum(failed) filter (where rk > 10), 0) / nullif(coalesce(sum(calls) filter (where rk > 10), 0), 0) as rate_without_top10
    from (select *, row_number() over (partition by episode_id order by failed desc, calls desc, sender) as rk from z_fsenders) group by 1""")
piece("z_always", """
    select episode_id, count(*) filter (where always) as always_failing_senders,
           sum(failed) filter (where always) / nullif(sum(failed), 0) as always_failing_share,
           sum(failed) filter (where not always) / nullif(sum(calls) filter (where not always), 0) as rate_without_always_failing
    from (select *, calls >= 5 and failed >= 0.9 * calls as always from z_fsenders) group by 1""")
piece("z_absent", """
    select c.episode_id, count(*) filter (where c.failed and p.sender is null) / nullif(count(*) filter (where c.failed), 0)
               as baseline_failures_from_absent_senders
    from z_calls_ep c left join z_fsenders p using (episode_id, sender) where not c.is_peak group by 1""")

RATES = "usual_rate rate rate_regular rate_new share_calls_new share_failures_new"
FP = "fingerprint_share_of_failures rate_without_fingerprint fingerprint_share_baseline"


@query("regular_and_new", "select * from z_rn where calls is not null", rounds=RATES)
def _(raw: Raw):
    return facts.regular_and_new(facts.calls_by_sender(facts.calls_by_sender_gas(detected(raw).days, raw.transactions)))


@query("fingerprint", "select * replace (case when fingerprint_gas is not null then fingerprint_share_baseline end as fingerprint_share_baseline) from z_fp where episode_id in (select episode_id from z_calls_ep)", rounds=FP)
def _(raw: Raw):
    got = facts.fingerprint(facts.calls_by_sender_gas(detected(raw).days, raw.transactions))
    # The SQL counts nothing as zero calls where no call failed.
    return got.fillna(0, ["fingerprint_calls", "fingerprint_senders"]).withColumn(
        "fingerprint_share_of_failures", F.expr("if(fingerprint_gas is null, null, fingerprint_share_of_failures)")).withColumn(
        "fingerprint_share_baseline", F.expr("""if(fingerprint_gas is null, null, fingerprint_share_baseline)"""))


@query("concentration", "select * from z_conc", rounds="top10_share_of_failures rate_without_top10")
def _(raw: Raw):
    return facts.concentration(facts.calls_by_sender(facts.calls_by_sender_gas(detected(raw).days, raw.transactions)))


@query("always_failing", "select * from z_always", rounds="always_failing_share rate_without_always_failing")
def _(raw: Raw):
    return facts.always_failing(facts.calls_by_sender(facts.calls_by_sender_gas(detected(raw).days, raw.transactions)))


@query("absent_senders", """
    select e.episode_id, a.baseline_failures_from_absent_senders from (select distinct episode_id from z_calls_ep) e
    left join z_absent a using (episode_id)""", rounds="baseline_failures_from_absent_senders")
def _(raw: Raw):
    return facts.absent_senders(facts.calls_by_sender(facts.calls_by_sender_gas(detected(raw).days, raw.transactions)))


@query("facts_failure", """
    select r.episode_id, r.calls, r.failed, r.usual_rate, r.rate_regular, r.share_failures_new, c.top10_share_of_failures,
           a.always_failing_senders, b.baseline_failures_from_absent_senders
    from z_rn r left join z_conc c using (episode_id) left join z_always a using (episode_id)
    left join z_absent b using (episode_id)""",
       rounds="usual_rate rate_regular share_failures_new top10_share_of_failures baseline_failures_from_absent_senders")
def _(raw: Raw):
    return facts.facts_failure(detected(raw).days, raw.transactions).select(
        "episode_id", "calls", "failed", "usual_rate", "rate_regular", "share_failures_new", "top10_share_of_failures",
        "always_failing_senders", "baseline_failures_from_absent_senders")


piece("z_moves", """
    select d.episode_id, d.metric, d.nb, d.is_peak, d.is_latest, x.date, x.from_address, x.to_address, x.amount, x.transaction_hash, x.log_index,
           hour(x.block_timestamp) as hr, right(x.from_address, 40) = repeat('0', 40) as mint, right(x.to_address, 40) = repeat('0', 40) as burn,
           date_diff('second', x.block_timestamp, x.last_modified) > 48 * 3600 as late
    from z_tr x join z_pdays d on d.metric in ('transfers', 'volume') and d.date = x.date and d.token = x.token""")
piece("z_tmoves", "select *, from_address as sender from z_moves where metric = 'transfers'")
piece("z_vmoves", "select * from z_moves where metric = 'volume'")
piece("z_counts", """
    select episode_id, count(*) filter (where is_peak) as transfers, count(*) filter (where not is_peak) / any_value(nb) as baseline_avg,
           count(*) filter (where is_peak and amount < 1) as dust,
           count(*) filter (where not is_peak and amount < 1) / any_value(nb) as dust_baseline_avg from z_tmoves group by 1""")
piece("z_new", """
    select m.episode_id, count(*) filter (where m.is_peak and b.sender is null) as new_sender_transfers,
           count(*) filter (where m.is_latest and o.sender is null) * 7 / 6 as new_sender_transfers_baseline
    from z_tmoves m
    left join (select distinct episode_id, sender from z_tmoves where not is_peak) b using (episode_id, sender)
    left join (select distinct episode_id, sender from z_tmoves where not is_peak and not is_latest) o using (episode_id, sender)
    group by 1""")
piece("z_top10s", """
    select episode_id, sum(n) filter (where is_peak) as top10_sender_transfers,
           (sum(n) filter (where not is_peak)) / (count(distinct date) filter (where not is_peak)) as top10_sender_transfers_baseline
    from (select *, row_number() over (partition by episode_id, date order by n desc, sender) as rk
          from (select episode_id, date, is_peak, sender, count(*) as n from z_tmoves group by all))
    where rk <= 10 group by 1""")
piece("z_lost", """
    select b.episode_id, sum(b.usual - coalesce(p.n, 0)) as lost_from_top50
    from (select episode_id, sender, count(*) / any_value(nb) as usual,
                 row_number() over (partition by episode_id order by count(*) desc, sender) as rk
          from z_tmoves where not is_peak group by episode_id, sender) b
    left join (select episode_id, sender, count(*) as n from z_tmoves where is_peak group by 1, 2) p using (episode_id, sender)
    where b.rk <= 50 group by 1""")
piece("z_empty", """
    select episode_id, count(*) filter (where p = 0 and usual >= 1) as empty_hours from (
        select episode_id, hr, count(*) filter (where is_peak) as p, count(*) filter (where not is_peak) / any_value(nb) as usual
        from z_tmoves group by 1, 2) group by 1""")


def _per_sender(raw: Raw):
    return facts.sends_by_sender(facts.sends(detected(raw).days, raw.transfers))


@query("facts_transfers", """
    select e.episode_id, coalesce(c.transfers, 0) as transfers, c.baseline_avg, c.dust, c.dust_baseline_avg,
           coalesce(n.new_sender_transfers, 0) as new_sender_transfers, t.top10_sender_transfers::bigint as top10_sender_transfers,
           l.lost_from_top50
    from (select episode_id from z_plan where metric = 'transfers') e left join z_counts c using (episode_id)
    left join z_new n using (episode_id) left join z_top10s t using (episode_id) left join z_lost l using (episode_id)""",
       rounds="baseline_avg dust_baseline_avg lost_from_top50")
def _(raw: Raw):
    return facts.facts_transfers(detected(raw).days, raw.transfers).select(
        "episode_id", "transfers", "baseline_avg", "dust", "dust_baseline_avg", "new_sender_transfers",
        "top10_sender_transfers", "lost_from_top50")


@query("new_senders", "select * from z_new", rounds="new_sender_transfers_baseline")
def _(raw: Raw):
    return facts.new_senders(_per_sender(raw))


@query("top_senders", "select * replace (top10_sender_transfers::bigint as top10_sender_transfers) from z_top10s",
       rounds="top10_sender_transfers_baseline")
def _(raw: Raw):
    return facts.top_senders(facts.sends(detected(raw).days, raw.transfers))


@query("lost_top50", "select * from z_lost", rounds="lost_from_top50")
def _(raw: Raw):
    return facts.lost_top50(_per_sender(raw))


@query("empty_hours", "select * from z_empty")
def _(raw: Raw):
    return facts.empty_hours(detected(raw).days, raw.transfers, least=1)


piece("z_supply", """
    select episode_id, sum(amount) filter (where is_peak) as volume, coalesce(sum(amount) filter (where is_peak and mint), 0) as minted,
           coalesce(sum(amount) filter (where is_peak and burn), 0) as burned,
           sum(amount) filter (where is_peak and not mint and not burn) as between_holders, count(*) filter (where is_peak) as transfers,
           sum(amount) filter (where not is_peak) / any_value(nb) as baseline_avg,
           coalesce(sum(amount) filter (where not is_peak and (mint or burn)), 0) / any_value(nb) as supply_baseline_avg,
           sum(amount) filter (where not is_peak and not mint and not burn) / any_value(nb) as between_holders_baseline_avg,
           count(*) filter (where not is_peak) / any_value(nb) as transfers_baseline_avg from z_vmoves group by 1""")


def _top10(name: str, inner: str) -> str:
    return f"""
    select episode_id, sum(s) filter (where is_peak) as {name}, avg(s) filter (where not is_peak) as {name}_baseline
    from (select episode_id, date, is_peak, sum(v) as s from (
            select *, row_number() over (partition by episode_id, date order by v desc) as rk from ({inner})) where rk <= 10 group by all)
    group by 1"""


piece("z_topt", _top10("top10_transfer_volume", "select episode_id, date, is_peak, amount as v from z_vmoves"))
for _side, _column in (("sender", "from_address"), ("receiver", "to_address")):
    piece(f"z_top{_side[0]}", _top10(f"top10_{_side}_volume",
          f"select episode_id, date, is_peak, sum(amount) as v from z_vmoves group by episode_id, date, is_peak, {_column}"))
piece("z_med", """
    select episode_id, median(amount) filter (where is_peak) as median_amount, median(amount) filter (where not is_peak) as median_amount_baseline
    from z_vmoves group by 1""")
SUPPLY = ("volume:2 minted:2 burned:2 between_holders:2 baseline_avg:4 supply_baseline_avg:4 between_holders_baseline_avg:4 "
          "transfers_baseline_avg")
TOPS = " ".join(f"top10_{s}_volume:2 top10_{s}_volume_baseline:4" for s in ("transfer", "sender", "receiver"))


@query("supply_and_holders", "select * from z_supply", rounds=SUPPLY)
def _(raw: Raw):
    return facts.supply_and_holders(detected(raw).days, raw.transfers)


@query("top_value", """
    select * from z_topt left join z_tops using (episode_id) left join z_topr using (episode_id)""", rounds=TOPS)
def _(raw: Raw):
    return facts.top_value(detected(raw).days, raw.transfers)


@query("median_amounts", "select * from z_med", rounds="median_amount median_amount_baseline")
def _(raw: Raw):
    return facts.median_amounts(*facts.amount_quartiles(detected(raw).days, raw.transfers))


@query("facts_volume", """
    select e.episode_id, s.volume, coalesce(s.transfers, 0) as transfers, s.baseline_avg, t.top10_transfer_volume, m.median_amount
    from (select episode_id from z_plan where metric = 'volume') e left join z_supply s using (episode_id)
    left join z_topt t using (episode_id) left join z_med m using (episode_id)""",
       rounds="volume:2 baseline_avg:4 top10_transfer_volume:2 median_amount")
def _(raw: Raw):
    return facts.facts_volume(detected(raw).days, raw.transfers).select(
        "episode_id", "volume", "transfers", "baseline_avg", "top10_transfer_volume", "median_amount")


# Units: amounts of some peak days are given a power of ten from noon on, so there is something to find.
piece("z_uvol", """
    select *, case when is_peak and hr >= 12 and date_diff('day', date '1995-01-01', date) % 2 = 0 then amount * 1000 else amount end as a from z_vmoves
    """)
piece("z_ubase", "select episode_id, quantile_cont(a, [0.25, 0.5, 0.75]) as usual from z_uvol where not is_peak group by 1")
piece("z_ucut", """
    select v.episode_id, h.cut, quantile_cont(a, [0.25, 0.5, 0.75]) filter (where hr >= cut) as tail_q,
           quantile_cont(a, [0.25, 0.5, 0.75]) filter (where hr < cut) as head_q, count(*) filter (where hr >= cut) as n_tail, count(*) as n
    from z_uvol v, (select unnest(range(24)) as cut) h where v.is_peak group by 1, 2""")
piece("z_ulog", """
    select c.*, list_transform([1, 2, 3], lambda i: log10(tail_q[i] / usual[i])) as t,
           case when cut = 0 then [0.0::double] else list_transform([1, 2, 3], lambda i: log10(head_q[i] / usual[i])) end as hd
    from z_ucut c join z_ubase b using (episode_id) where usual[1] > 0 and tail_q is not null and tail_q[1] > 0
      and (cut = 0 or head_q[1] > 0) and n_tail >= greatest(3, 0.03 * n)""")
piece("z_ufit", """
    select episode_id, cut, round_even(t[2], 0)::int as k, t, hd from z_ulog""")


@query("units_shift", """
    select episode_id, first(k order by fit, cut) as units_shift_power, first(cut order by fit, cut)::int as units_shift_from_hour
    from (select *, list_max(list_transform(t, lambda x: abs(x - k))) + list_max(list_transform(hd, lambda x: abs(x))) as fit from z_ufit
          where k <> 0 and list_max(list_transform(t, lambda x: abs(x - k))) < 0.45 and list_max(list_transform(hd, lambda x: abs(x))) < 0.45)
    group by 1""")
def _(raw: Raw):
    # Shifted copies of the rows stand under names of their own, and peaks read these.
    days = detected(raw).days.withColumn("token", F.expr("if(is_peak, concat(token, ' shifted'), token)"))
    even = "datediff(date, date'1995-01-01') % 2 = 0 and hour(block_timestamp) >= 12"
    copies = raw.transfers.withColumns({"token": F.expr("concat(token, ' shifted')"),
                                        "amount": F.expr(f"if({even}, amount * 1000, amount)")})
    parts = facts.amount_quartiles(days, raw.transfers.unionByName(copies))
    return facts.units_shift(*parts, tol=0.45, least=3)


piece("z_inrows", """
    select episode_id, date, is_peak, late, false as failed, amount, transaction_hash || '-' || log_index as k from z_moves
    union all select episode_id, date, is_peak, late, failed, 0, hash from z_calls_ep""")
piece("z_integrity", """
    select p.episode_id, m.missing_blocks, m.duplicate_blocks, m.max_load_lag_hours / l.usual_lag as load_lag_vs_usual, b.last_block_time,
           coalesce(b.blocks, 0) as blocks, coalesce(b.last_block_time >= '23:50', false) as day_complete, r.pct_rows_late,
           coalesce(r.duplicate_rows, 0) as duplicate_rows, s.pct_rows_late_baseline,
           case when p.metric = 'failure_rate' then r.pct_failed_rows_late end as pct_failed_rows_late,
           case p.metric when 'transfers' then coalesce(r.n, 0)::double when 'volume' then r.amount else r.rate end as raw_value,
           case p.metric when 'transfers' then c.m_transfers::double when 'volume' then c.m_volume else h.failure_rate end as mart_value
    from z_plan p cross join z_lag l left join z_pipe m on m.date = p.peak
    left join (select date, strftime(max(timestamp), '%H:%M') as last_block_time, count(*) as blocks from z_bl group by date) b on b.date = p.peak
    left join (select episode_id, 100.0 * count(*) filter (where late) / count(*) as pct_rows_late, count(*) - count(distinct k) as duplicate_rows,
                      100.0 * count(*) filter (where late and failed) / nullif(count(*) filter (where failed), 0) as pct_failed_rows_late,
                      count(*) as n, sum(amount) as amount, count(*) filter (where failed) / count(*) as rate
               from z_inrows where is_peak group by 1) r using (episode_id)
    left join (select episode_id, median(x) as pct_rows_late_baseline from (
                   select episode_id, date, 100.0 * count(*) filter (where late) / count(*) as x from z_inrows where not is_peak group by 1, 2)
               group by 1) s using (episode_id)
    left join (select date, token, sum(transfers) as m_transfers, sum(volume) as m_volume from z_pay group by 1, 2) c on c.date = p.peak and c.token = p.token
    left join z_health h on h.date = p.peak and h.token = p.token""")


@query("facts_integrity", """
    select *, coalesce(abs(raw_value - mart_value) <= 1e-6 * greatest(abs(mart_value), 1e-9), false) as mart_matches_raw from z_integrity""",
       rounds="load_lag_vs_usual pct_rows_late pct_rows_late_baseline pct_failed_rows_late raw_value:4 mart_value:4")
def _(raw: Raw):
    found = detected(raw)
    return facts.facts_integrity(found.days, raw.transfers, raw.transactions, raw.blocks, found.payments, found.health, found.pipeline)


piece("z_ratios", f"""
    select d.episode_id, v.token, sum(v.value) filter (where d.is_peak) / nullif((sum(v.value) filter (where not d.is_peak)) / any_value(d.nb), 0) as ratio
    from z_pdays d join z_series v on v.date = d.date and v.metric = d.metric where d.metric <> 'failure_rate' group by 1, 2
    union all
    select d.episode_id, v.token, avg(v.failure_rate) filter (where d.is_peak) / nullif(avg(v.failure_rate) filter (where not d.is_peak), 0)
    from z_pdays d join z_health v using (date) where d.metric = 'failure_rate' and v.direct_calls >= {MIN_CALLS} group by 1, 2""")


@query("token_ratios", "select * from z_ratios", rounds="ratio")
def _(raw: Raw):
    found = detected(raw)
    return facts.token_ratios(found.days, found.payments, found.health, MIN_CALLS)


piece("z_seg", """
    select episode_id, first(amount_band order by abs(extra) desc, amount_band, route) as segment_band,
           first(route order by abs(extra) desc, amount_band, route) as segment_route,
           first(extra order by abs(extra) desc, amount_band, route) as segment_extra, sum(extra) as whole from (
        select d.episode_id, p.amount_band, p.route, (sum(case d.metric when 'transfers' then transfers else volume end) filter (where d.is_peak)
                 - coalesce(sum(case d.metric when 'transfers' then transfers else volume end) filter (where not d.is_peak), 0) / any_value(d.nb))::double as extra
        from z_pdays d join z_pay p on p.date = d.date and p.token = d.token where d.metric <> 'failure_rate' group by 1, 2, 3)
    where extra is not null group by 1""")
piece("z_fee", """
    select episode_id, avg(avg_base_fee_gwei) filter (where is_peak) / nullif(avg(avg_base_fee_gwei) filter (where not is_peak), 0) as fee_ratio
    from z_pdays join z_pipe using (date) group by 1""")


@query("facts_context", """
    select p.episode_id, f.fee_ratio, round(s.segment_extra, 3) as segment_extra, case when abs(s.whole) > 1e-6 then s.segment_extra / s.whole end as segment_share,
           (select count(*) from z_ratios r where r.episode_id = p.episode_id) as tokens
    from z_plan p left join z_fee f using (episode_id) left join z_seg s using (episode_id)""",
       rounds="fee_ratio segment_extra:3 segment_share:4")
def _(raw: Raw):
    found = detected(raw)
    got = facts.facts_context(found.days, found.payments, found.health, found.pipeline, MIN_CALLS)
    # A change that cancels out leaves only rounding in the denominator: neither side compares it.
    share = F.expr("if(abs(segment_extra / segment_share) > 1e-6, segment_share, null)").alias("segment_share")
    return got.select("episode_id", "fee_ratio", "segment_extra", share,
                      F.coalesce(F.size("token_ratios"), F.lit(0)).cast("long").alias("tokens"))
