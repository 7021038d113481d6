"""Verdicts for every episode of the benchmark tables, and how they agree with known cases."""
from __future__ import annotations

from pyspark.sql import functions as F

from tallywatch.functions.columns import single
from tallywatch.operators import episodes, verdicts
from tallywatch.plans import watch
from tallywatch.plans.catalog import query
from tallywatch.plans.oracle_base import piece
from tallywatch.plans.q_detect import EPISODE_ROUNDS, MIN_CALLS, cases, detected
from tallywatch.session import settle
from tallywatch.sources.adapters import Raw

piece("z_unit_none", "select episode_id, null::int as units_shift_power, null::int as units_shift_from_hour from z_plan")
piece("z_wide", """
    select p.episode_id, p.metric, p.token, p.direction, i.* exclude (episode_id),
           coalesce(abs(i.raw_value - i.mart_value) <= 1e-6 * greatest(abs(i.mart_value), 1e-9), false) as mart_matches_raw,
           r.usual_rate, r.rate, r.rate_regular, r.rate_new, r.share_failures_new, f.fingerprint_gas, f.fingerprint_share_of_failures,
           f.rate_without_fingerprint, f.fingerprint_share_baseline, c.top10_share_of_failures, a.always_failing_share,
           a.rate_without_always_failing, b.baseline_failures_from_absent_senders, coalesce(t.transfers, s.transfers, 0) as transfers,
           coalesce(t.baseline_avg, s.baseline_avg) as baseline_avg, t.dust, t.dust_baseline_avg, n.new_sender_transfers,
           n.new_sender_transfers_baseline, ts.top10_sender_transfers, ts.top10_sender_transfers_baseline, l.lost_from_top50,
           s.volume, s.minted, s.burned, s.between_holders, s.between_holders_baseline_avg, s.supply_baseline_avg,
           tt.top10_transfer_volume, tt.top10_transfer_volume_baseline, tv.top10_sender_volume, tv.top10_sender_volume_baseline,
           tr.top10_receiver_volume, tr.top10_receiver_volume_baseline, eh.empty_hours,
           (select count(*) from z_ratios q where q.episode_id = p.episode_id and q.token <> p.token
             and (case when p.direction = 'up' then q.ratio >= case p.metric when 'transfers' then 1.3 else 1.5 end
                       else q.ratio <= 1 / case p.metric when 'transfers' then 1.3::double else 1.5::double end end)) as together
    from z_plan p left join z_integrity i using (episode_id) left join z_rn r using (episode_id) left join z_fp f using (episode_id)
    left join z_conc c using (episode_id) left join z_always a using (episode_id) left join z_absent b using (episode_id)
    left join z_counts t using (episode_id) left join z_new n using (episode_id) left join z_top10s ts using (episode_id)
    left join z_lost l using (episode_id) left join z_supply s using (episode_id) left join z_topt tt using (episode_id)
    left join z_tops tv using (episode_id) left join z_topr tr using (episode_id) left join z_empty10 eh using (episode_id)""")
piece("z_empty10", """
    select episode_id, count(*) filter (where p = 0 and usual >= 10) as empty_hours from (
        select episode_id, hr, count(*) filter (where is_peak) as p, count(*) filter (where not is_peak) / any_value(nb) as usual
        from z_tmoves group by 1, 2) group by 1""")
piece("z_gap", """
    select *, coalesce(usual_rate, 0) as usual, case metric when 'failure_rate' then coalesce(rate, 0) - coalesce(usual_rate, 0)
              when 'transfers' then transfers - coalesce(baseline_avg, 0) else coalesce(volume, 0) - coalesce(baseline_avg, 0) end as gap
    from z_wide""")
piece("z_rule", """
    select *, greatest(1.5 * usual, usual + 0.001) as near,
    case
      when missing_blocks > 0 or duplicate_blocks > 0 or (blocks > 0 and not day_complete) or duplicate_rows > 0 or not mart_matches_raw then 'pipeline'
      when (direction = 'up' and gap <= 0) or (direction = 'down' and gap >= 0) then 'noise'
      when metric = 'failure_rate' and rate is not null and direction = 'down' then
        case when baseline_failures_from_absent_senders >= 0.6 then 'absent_failers' end
      when metric = 'failure_rate' and rate is not null then
        case when fingerprint_share_of_failures >= 0.5 and fingerprint_share_of_failures >= 2 * coalesce(fingerprint_share_baseline, 0) then 'one_program'
             when share_failures_new >= 0.6 and coalesce(rate_regular <= greatest(1.5 * usual, usual + 0.001), false) then 'new_failing'
             when share_failures_new >= 0.6 then 'new_failing_mixed' when always_failing_share >= 0.6 then 'over_and_over'
             when top10_share_of_failures >= 0.6 then 'ten_failing'
             when rate_regular >= 1.5 * usual and coalesce(share_failures_new, 0) < 0.5 then 'regular_failing' end
      when metric = 'transfers' and direction = 'down' then
        case when coalesce(dust_baseline_avg, 0) - coalesce(dust, 0) >= 0.6 * -gap then 'dust_ended'
             when coalesce(lost_from_top50, 0) >= 0.6 * -gap then 'busiest_less' when empty_hours >= 2 then 'empty_hours' end
      when metric = 'transfers' then
        case when coalesce(dust, 0) - coalesce(dust_baseline_avg, 0) >= 0.6 * gap then 'dust'
             when coalesce(top10_sender_transfers, 0) - coalesce(top10_sender_transfers_baseline, 0) >= 0.6 * gap then 'ten_sending'
             when coalesce(new_sender_transfers, 0) - coalesce(new_sender_transfers_baseline, 0) >= 0.6 * gap then 'newcomers' end
      when direction = 'down' then
        case when coalesce(top10_transfer_volume_baseline, 0) - coalesce(top10_transfer_volume, 0) >= 0.6 * -gap then 'large_missing' end
      else
        case when coalesce(minted, 0) + coalesce(burned, 0) - coalesce(supply_baseline_avg, 0) >= 0.6 * gap then 'supply'
             when coalesce(top10_sender_volume, 0) - coalesce(top10_sender_volume_baseline, 0) >= 0.6 * gap then 'ten_sent'
             when coalesce(top10_receiver_volume, 0) - coalesce(top10_receiver_volume_baseline, 0) >= 0.6 * gap then 'ten_received'
             when coalesce(top10_transfer_volume, 0) - coalesce(top10_transfer_volume_baseline, 0) >= 0.6 * gap then 'large' end
    end as first_rule from z_gap""")
piece("z_judged", """
    select *, case rule when 'pipeline' then 'pipeline' when 'noise' then 'noise' when 'supply' then 'supply' when 'newcomers' then 'newcomers'
                when 'empty_hours' then 'doubt' when 'rewritten' then 'doubt' when 'regular_failing' then 'broad' when 'market' then 'broad'
                when 'broad' then 'broad' when 'one_program' then 'bots' when 'new_failing' then 'bots' when 'new_failing_mixed' then 'bots'
                when 'over_and_over' then 'bots' when 'dust' then 'bots' when 'dust_ended' then 'bots' else 'few' end as family,
           case when rule in ('pipeline', 'new_failing', 'dust', 'dust_ended', 'ten_sending', 'ten_sent', 'ten_received')
                  or (rule = 'one_program' and rate_without_fingerprint <= near) or (rule = 'over_and_over' and rate_without_always_failing <= near)
                  or (rule = 'supply' and coalesce(between_holders, 0) / nullif(between_holders_baseline_avg, 0) <= 2)
                  or (rule = 'large' and baseline_avg - coalesce(top10_transfer_volume_baseline, 0) <> 0 and volume - coalesce(top10_transfer_volume, 0)
                        <= 2 * (baseline_avg - coalesce(top10_transfer_volume_baseline, 0)))
                then 'strong' else 'moderate' end as confidence
    from (select *, coalesce(first_rule, case when pct_rows_late >= 50 and coalesce(pct_rows_late_baseline, 0) < 10 then 'rewritten'
                                              when together > 0 then 'market' else 'broad' end) as rule from z_rule)""")
piece("z_labels", """
    select * from (values ('pipeline', 'Pipeline'), ('doubt', 'Data in doubt'), ('bots', 'Bots and automation'), ('few', 'A few actors'),
        ('supply', 'Supply event'), ('newcomers', 'New senders'), ('broad', 'Broad real change'), ('noise', 'No clear move')) as t(family, label)""")

_JUDGED: dict[tuple[str, str], object] = {}


def judged(raw: Raw):
    """All episodes judged, written once per application and folder."""
    key = (raw.spark.sparkContext.applicationId, raw.sf_dir)
    if key not in _JUDGED:
        found = detected(raw)
        wide = watch.all_facts(found.plan, found.days, raw.transfers, raw.transactions, raw.blocks, found.payments, found.health,
                               found.pipeline, MIN_CALLS)
        _JUDGED[key] = settle(verdicts.verdicts(settle(wide)))
    return _JUDGED[key]


@query("verdicts", "select episode_id, rule, family, label, confidence from z_judged join z_labels using (family)")
def _(raw: Raw):
    return judged(raw).select("episode_id", "rule", "family", "label", "confidence")


@query("verdict_counts", "select family, label, count(*) as episodes from z_judged join z_labels using (family) group by all")
def _(raw: Raw):
    return verdicts.verdict_counts(judged(raw))


@query("verdict_evidence")
def _(raw: Raw):
    """Titles, evidence and caveats are text for people; the rule behind them is compared in `verdicts`."""
    return judged(raw).select("episode_id", "title", F.array_join("evidence", " | ").alias("evidence"),
                              F.array_join("caveats", " | ").alias("caveats"))


def judged_episodes(raw: Raw):
    found = detected(raw)
    eps = found.episodes.join(judged(raw).select("episode_id", "family", "label", "confidence"), "episode_id", "left")
    top = episodes.most_severe(found.episodes, 25).select("episode_id", F.lit(True).alias("investigated"))
    return eps.join(top, "episode_id", "left").withColumn("investigated", F.coalesce("investigated", F.lit(False)))


piece("z_judgedeps", """
    select e.*, j.family, l.label, row_number() over (order by severity desc, e.episode_id) <= 25 as investigated
    from z_eps e join z_judged j using (episode_id) join z_labels l using (family)""")


@query("most_severe", "select episode_id, metric, token, direction, peak_ratio, severity from z_judgedeps where investigated",
       rounds="peak_ratio severity")
def _(raw: Raw):
    return episodes.most_severe(detected(raw).episodes, 25).select("episode_id", "metric", "token", "direction", "peak_ratio", "severity")


@query("investigated_all", "select e.episode_id, e.metric, e.token, j.rule, l.label, true as investigated from z_eps e join z_judged j using (episode_id) join z_labels l using (family)")
def _(raw: Raw):
    """Every episode has a verdict: nothing is left out by severity."""
    eps = episodes.most_severe(detected(raw).episodes)
    return eps.join(judged(raw).select("episode_id", "rule", "label"), "episode_id").select("episode_id", "metric", "token", "rule", "label", F.lit(True).alias("investigated"))


@query("agreement", """
    with wanted as (select * from (values ('first', 'transfers', 'A', date '1996-01-01', date '1996-12-31', ['broad', 'few'], 'x'),
        ('first', 'transfers', 'N', date '1996-01-01', date '1996-12-31', ['broad', 'few'], 'x'),
        ('second', 'volume', 'R', date '1998-03-01', date '1999-02-28', ['few'], 'y'),
        ('third', 'failure_rate', 'A', date '2010-01-01', date '2010-02-01', ['bots'], 'z')) as c("case", metric, token, s, e, families, hand_verdict)),
    m as (select k."case", k.token, k.families, k.hand_verdict, e.episode_id, e.investigated, e.label, e.family, e.peak_date,
                 row_number() over (partition by k."case", k.token order by e.investigated desc nulls last, e.severity desc nulls last, e.episode_id desc) as rk,
                 count(e.episode_id) over (partition by k."case", k.token) as episodes
          from wanted k left join z_judgedeps e on e.metric = k.metric and e.token = k.token and e.start <= k.e and e."end" >= k.s)
    select "case", token, episodes > 0 as found, episodes, coalesce(investigated, false) as investigated,
           case when investigated then label else '' end as verdict, coalesce(investigated and list_contains(families, family), false) as agrees,
           hand_verdict, peak_date as peak from m where rk = 1""")
def _(raw: Raw):
    return episodes.agreement(judged_episodes(raw), cases(raw))


@query("rewritten_days", "select count(*) as rewritten_days from z_flagged where issue = 'late or rewritten'")
def _(raw: Raw):
    return episodes.rewritten_days(detected(raw).flagged)


@query("newest_top_move", """
    select episode_id, token, metric, peak_date, peak_ratio, label from z_judgedeps
    where peak_date >= (select date_trunc('month', max(date)) from z_pay) - interval 2 year and investigated
    order by case when peak_ratio > 0 then abs(ln(peak_ratio)) else 0 end desc, episode_id limit 1""", rounds="peak_ratio")
def _(raw: Raw):
    return newest_top_move(judged_episodes(raw), detected(raw).payments, months_back=24)


def newest_top_move(eps, payments, months_back: int = 0):
    """The investigated episode furthest from usual that peaks in the newest month (or in the months before it)."""
    newest = payments.agg(F.trunc(F.max("date"), "month").alias("newest"))   # one row
    size = F.expr("if(peak_ratio > 0, abs(ln(peak_ratio)), 0)")
    return (eps.where("investigated").withColumn("newest", single(newest)).where(F.expr(f"peak_date >= add_months(newest, -{months_back})"))
            .orderBy(size.desc(), "episode_id").limit(1)
            .select("episode_id", "token", "metric", "peak_date", "peak_ratio", "label"))
