"""From facts to a verdict: the data first, then a group that explains the move, then a broad change.

One select over the fact table. A chain of conditions picks a rule; family, title, confidence and evidence follow
from the rule.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.fixed_values import EXPLAINS, FAMILY_LABELS, MOVED_TOGETHER, RESTORED, TITLES

# The family each rule belongs to.
FAMILY_OF = {
    "pipeline": "pipeline", "noise": "noise",
    "absent_failers": "few", "one_program": "bots", "new_failing": "bots", "new_failing_mixed": "bots",
    "over_and_over": "bots", "ten_failing": "few", "regular_failing": "broad",
    "dust_ended": "bots", "busiest_less": "few", "empty_hours": "doubt", "dust": "bots", "ten_sending": "few",
    "newcomers": "newcomers", "large_missing": "few", "supply": "supply", "ten_sent": "few", "ten_received": "few",
    "large": "few", "rewritten": "doubt", "market": "broad", "broad": "broad",
}

# The columns rules read; absent ones are null, so facts of one metric alone can be judged too.
NUMBERS = """
    missing_blocks duplicate_blocks blocks duplicate_rows pct_rows_late pct_rows_late_baseline pct_failed_rows_late
    raw_value mart_value units_shift_power units_shift_from_hour transfers transfers_baseline_avg baseline_avg
    rate usual_rate rate_regular rate_new share_calls_new share_failures_new fingerprint_gas
    fingerprint_share_of_failures fingerprint_share_baseline fingerprint_calls fingerprint_senders
    rate_without_fingerprint top10_share_of_failures always_failing_share always_failing_senders
    rate_without_always_failing baseline_failures_from_absent_senders dust dust_baseline_avg lost_from_top50 empty_hours
    top10_sender_transfers top10_sender_transfers_baseline new_sender_transfers new_sender_transfers_baseline
    volume minted burned supply_baseline_avg between_holders between_holders_baseline_avg
    top10_transfer_volume top10_transfer_volume_baseline top10_sender_volume top10_sender_volume_baseline
    top10_receiver_volume top10_receiver_volume_baseline fee_ratio segment_share""".split()


def z(column: str) -> str:
    return f"coalesce({column}, 0)"


def restored(without: str) -> str:
    return f"coalesce({without} <= greatest({RESTORED} * usual, usual + 0.001), false)"


def pct(x: str, digits: int = 1) -> str:
    return (f"case when {x} is null then '–' when {x} > 0 and {x} < 0.001 then '<0.1%' "
            f"else concat(format_string('%.{digits}f', cast(100 * {x} as double)), '%') end")


def big(x: str) -> str:
    sizes = ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "k"))
    cases = " ".join(f"when abs({x}) >= {s:.0f}D then concat(format_string('%.2f', {x} / {s:.0f}D), '{n}')" for s, n in sizes)
    return f"case when {x} is null then '–' {cases} else format_string('%.0f', cast({x} as double)) end"


def whole(x: str) -> str:
    return f"format_number({x}, 0)"


def text(*parts: str) -> str:
    """Joined text; parts that start with a bar are literals."""
    return "concat(" + ", ".join("'" + p[1:].replace("'", "''") + "'" if p.startswith("|") else p for p in parts) + ")"


def _problems() -> dict[str, tuple[str, str, str]]:
    """What is wrong with the rows themselves: condition, title, evidence."""
    count_ratio = "try_divide(transfers, transfers_baseline_avg)"
    when = "if(units_shift_from_hour = 0, 'all day', format_string('from %02d:00 UTC', cast(units_shift_from_hour as int)))"
    factor = "if(units_shift_power > 0, format_number(pow(10, units_shift_power), 0), cast(pow(10, units_shift_power) as string))"
    units = TITLES["units"]
    return {
        "blocks_missing": ("missing_blocks > 0", f"'{TITLES['blocks_missing']}'",
                           text(whole("missing_blocks"), "| block numbers have no row on the peak day.")),
        "blocks_twice": ("duplicate_blocks > 0", f"'{TITLES['blocks_twice']}'",
                         text(whole("duplicate_blocks"), "| block rows repeat a number.")),
        "incomplete": ("blocks > 0 and not day_complete", f"format_string('{TITLES['incomplete']}', last_block_time)",
                       text("|The last block is at ", "last_block_time", "|; the day should run to midnight.")),
        "rows_twice": ("duplicate_rows > 0", f"'{TITLES['rows_twice']}'",
                       text(whole("duplicate_rows"), "| raw rows repeat another row's key.")),
        "mart_differs": ("not mart_matches_raw", f"'{TITLES['mart_differs']}'",
                         text("|Mart ", big("mart_value"), "|, raw rows ", big("raw_value"), "|.")),
        "units": (f"metric = 'volume' and units_shift_power <> 0 and {count_ratio} between 0.5 and 2",
                  f"format_string('{units}', {when}, {factor}, if(units_shift_power > 0, 'large', 'small'))",
                  text("|Quartiles moved by ten to the ", "cast(cast(units_shift_power as int) as string)",
                       "| together; the count is ", f"format_string('%.2f', {count_ratio})", "|× a comparable day.")),
    }


def _rule() -> str:
    """The first rule that holds."""
    up, down = "direction = 'up'", "direction = 'down'"
    fail, move, value = "metric = 'failure_rate'", "metric = 'transfers'", "metric = 'volume'"
    dust_drop = f"{z('dust_baseline_avg')} - {z('dust')}"
    ordered = [
        ("pipeline", "size(problems) > 0"),
        ("noise", "not moved"),
        ("absent_failers", f"{fail} and rate is not null and {down} and baseline_failures_from_absent_senders >= {EXPLAINS}"),
        ("one_program", f"{fail} and {up} and fingerprint_share_of_failures >= 0.5 "
                        f"and fingerprint_share_of_failures >= 2 * {z('fingerprint_share_baseline')}"),
        ("new_failing", f"{fail} and {up} and share_failures_new >= {EXPLAINS} and {restored('rate_regular')}"),
        ("new_failing_mixed", f"{fail} and {up} and share_failures_new >= {EXPLAINS}"),
        ("over_and_over", f"{fail} and {up} and always_failing_share >= {EXPLAINS}"),
        ("ten_failing", f"{fail} and {up} and top10_share_of_failures >= {EXPLAINS}"),
        ("regular_failing", f"{fail} and {up} and rate is not null and rate_regular >= {RESTORED} * usual "
                            f"and {z('share_failures_new')} < 0.5"),
        ("dust_ended", f"{move} and {down} and {dust_drop} >= {EXPLAINS} * -gap"),
        ("busiest_less", f"{move} and {down} and {z('lost_from_top50')} >= {EXPLAINS} * -gap"),
        ("empty_hours", f"{move} and {down} and empty_hours >= 2"),
        ("dust", f"{move} and {up} and {z('dust')} - {z('dust_baseline_avg')} >= {EXPLAINS} * gap"),
        ("ten_sending", f"{move} and {up} and {z('top10_sender_transfers')} - {z('top10_sender_transfers_baseline')} >= {EXPLAINS} * gap"),
        ("newcomers", f"{move} and {up} and {z('new_sender_transfers')} - {z('new_sender_transfers_baseline')} >= {EXPLAINS} * gap"),
        ("large_missing", f"{value} and {down} and {z('top10_transfer_volume_baseline')} - {z('top10_transfer_volume')} >= {EXPLAINS} * -gap"),
        ("supply", f"{value} and {up} and {z('minted')} + {z('burned')} - {z('supply_baseline_avg')} >= {EXPLAINS} * gap"),
        ("ten_sent", f"{value} and {up} and {z('top10_sender_volume')} - {z('top10_sender_volume_baseline')} >= {EXPLAINS} * gap"),
        ("ten_received", f"{value} and {up} and {z('top10_receiver_volume')} - {z('top10_receiver_volume_baseline')} >= {EXPLAINS} * gap"),
        ("large", f"{value} and {up} and {z('top10_transfer_volume')} - {z('top10_transfer_volume_baseline')} >= {EXPLAINS} * gap"),
        ("rewritten", "rewritten"),
        ("market", "size(together) > 0"),
    ]
    return "case " + " ".join(f"when {condition} then '{name}'" for name, condition in ordered) + " else 'broad' end"


def _confidence() -> str:
    rest = f"{z('volume')} - {z('top10_transfer_volume')}"
    rest_usual = f"({z('baseline_avg')} - {z('top10_transfer_volume_baseline')})"
    strong = {
        "one_program": restored("rate_without_fingerprint"),
        "over_and_over": restored("rate_without_always_failing"),
        "supply": f"coalesce(try_divide({z('between_holders')}, between_holders_baseline_avg) <= 2, false)",
        "large": f"{rest_usual} <> 0 and {rest} <= 2 * {rest_usual}",
    }
    always = "'pipeline', 'new_failing', 'dust_ended', 'dust', 'ten_sending', 'ten_sent', 'ten_received'"
    return (f"case when rule in ({always}) then 'strong' "
            + " ".join(f"when rule = '{r}' and {c} then 'strong'" for r, c in strong.items()) + " else 'moderate' end")


def _evidence() -> str:
    """The numbers behind the rule, one line; null where the rule has none of its own."""
    lines = {
        "noise": text("|Against comparable days the peak is not ", "direction", "|."),
        "absent_failers": text(pct("baseline_failures_from_absent_senders", 0), "| of the usual failures came from senders silent on the peak day."),
        "one_program": text(whole("fingerprint_calls"), "| calls of ", whole("fingerprint_senders"), "| senders used the same gas; ",
                            pct("fingerprint_share_of_failures", 0), "| of failures, usually ", pct(z("fingerprint_share_baseline"), 0),
                            "|. Without them the rate is ", pct("rate_without_fingerprint", 2), "|."),
        "new_failing": text(pct("share_failures_new", 0), "| of failures came from new senders."),
        "new_failing_mixed": text(pct("share_failures_new", 0), "| of failures came from new senders."),
        "over_and_over": text(whole("always_failing_senders"), "| senders that nearly always fail made ", pct("always_failing_share", 0),
                              "| of failures. Without them the rate is ", pct("rate_without_always_failing", 2), "|."),
        "ten_failing": text("|Ten senders made ", pct("top10_share_of_failures", 0), "| of failures."),
        "regular_failing": text("|Regular senders failed at ", pct("rate_regular", 2), "|, usually ", pct("usual", 2), "|."),
        "dust_ended": text(whole("dust"), "| transfers under 1 unit, usually ", whole("dust_baseline_avg"), "|."),
        "dust": text(whole("dust"), "| transfers under 1 unit, usually ", whole("dust_baseline_avg"), "|."),
        "busiest_less": text("|The fifty busiest senders lost ", whole("lost_from_top50"), "| transfers."),
        "empty_hours": text(whole("empty_hours"), "| hours that always have transfers had none."),
        "ten_sending": text("|The ten busiest senders made ", whole("top10_sender_transfers"), "| transfers, usually ",
                            whole("top10_sender_transfers_baseline"), "|."),
        "newcomers": text("|New senders made ", whole("new_sender_transfers"), "| transfers, usually ", whole("new_sender_transfers_baseline"), "|."),
        "large_missing": text("|The ten largest transfers moved ", big("top10_transfer_volume"), "|, usually ", big("top10_transfer_volume_baseline"), "|."),
        "supply": text("|Minted ", big("minted"), "|, burned ", big("burned"), "|; holders moved ", big("between_holders"), "|."),
        "ten_sent": text("|Ten senders moved ", big("top10_sender_volume"), "|, usually ", big("top10_sender_volume_baseline"), "|."),
        "ten_received": text("|Ten receivers took ", big("top10_receiver_volume"), "|, usually ", big("top10_receiver_volume_baseline"), "|."),
        "large": text("|The ten largest transfers moved ", big("top10_transfer_volume"), "|, usually ", big("top10_transfer_volume_baseline"), "|."),
        "market": "'No problem in the rows, and no single group explains the move.'",
        "broad": "'No problem in the rows, and no group accounts for most of the move.'",
    }
    return "case rule " + " ".join(f"when '{r}' then {line}" for r, line in lines.items()) + " end"


def _lookup(values: dict[str, str], key: str) -> str:
    return f"case {key} " + " ".join("when '{}' then '{}'".format(k, v.replace("'", "''")) for k, v in values.items()) + " end"


def _together() -> str:
    least = "case metric " + " ".join(f"when '{m}' then {v}" for m, v in MOVED_TOGETHER.items()) + " end"
    return (f"filter(map_entries(coalesce(token_ratios, map())), e -> e.key <> token and e.value is not null and "
            f"if(direction = 'up', e.value >= {least}, e.value <= 1 / ({least})))")


def verdicts(facts: DataFrame) -> DataFrame:
    """`facts`: one row per episode with metric, token, direction and the columns of the fact operators.

    Adds rule, family, label, title, confidence, evidence and caveats.
    """
    have = set(facts.columns)
    absent = {c: F.lit(None).cast("double") for c in NUMBERS if c not in have}
    others = {"day_complete": "boolean", "last_block_time": "string", "mart_matches_raw": "boolean",
              "token_ratios": "map<string,double>", "segment_band": "string", "segment_route": "string"}
    absent |= {c: F.lit(None).cast(t) for c, t in others.items() if c not in have}
    rows = facts.withColumns(absent) if absent else facts

    problems = _problems()
    found = ", ".join(f"if({c}, struct({t} as title, {e} as line), null)" for c, t, e in problems.values())
    gap = (f"case metric when 'failure_rate' then {z('rate')} - {z('usual_rate')} when 'transfers' "
           f"then {z('transfers')} - {z('baseline_avg')} else {z('volume')} - {z('baseline_avg')} end")
    rows = rows.selectExpr("*", f"{z('usual_rate')} as usual", f"{gap} as gap", f"array_compact(array({found})) as problems",
                           f"{_together()} as together",
                           "coalesce(pct_rows_late >= 50, false) and coalesce(pct_rows_late_baseline, 0) < 10 as rewritten")
    rows = rows.selectExpr("*", "if(direction = 'up', gap > 0, gap < 0) as moved")
    rows = rows.selectExpr("*", f"{_rule()} as rule")
    gas = f"format_string('{TITLES['one_program']}', {whole('fingerprint_gas')})"
    titled = _lookup({k: t for k, t in TITLES.items() if "%s" not in t}, "rule")
    context = [
        f"if(size(together) > 0, concat('Other tokens moved the same way: ', array_join(transform(together, "
        f"e -> format_string('%s %.2f×', e.key, e.value)), ', '), '.'), null)",
        "if(fee_ratio >= 2 or fee_ratio <= 0.5, format_string('The network fee was %.1f× a comparable day.', fee_ratio), null)",
        "if(abs(segment_share) >= 0.5, " + text(pct("least(segment_share, 1)", 0), "| of the change is in the band ", "segment_band", "|, ",
                                                "segment_route", "|.") + ", null)",
    ]
    late = text("format_string('%.0f', pct_rows_late)", "|% of the day's rows were written over 48 hours late.")
    alike = ("if(metric = 'failure_rate' and abs(pct_failed_rows_late - pct_rows_late) < 10, "
             "'Failed rows were rewritten no more than the others.', null)")
    caveats = f"if(rewritten, array_compact(array({late}, {alike})), array())"
    rows = rows.selectExpr("*", f"{_lookup(FAMILY_OF, 'rule')} as family",
                           f"case rule when 'pipeline' then array_join(transform(problems, p -> p.title), '; ') "
                           f"when 'one_program' then {gas} else {titled} end as title",
                           f"{_confidence()} as confidence", f"array_compact(array({', '.join(context)})) as context",
                           f"{caveats} as found_caveats")
    return rows.selectExpr(
        "episode_id", "metric", "token", "direction", "rule", "family", f"{_lookup(FAMILY_LABELS, 'family')} as label", "title",
        "confidence",
        f"case when rule = 'pipeline' then transform(problems, p -> p.line) when rule = 'noise' then array({_evidence()}) "
        f"when rule = 'rewritten' then concat(found_caveats, context) "
        f"else concat(array_compact(array({_evidence()})), context) end as evidence",
        "if(rule in ('pipeline', 'noise', 'rewritten'), array(), found_caveats) as caveats")


def verdict_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("family", "label").agg(F.count(F.lit(1)).alias("episodes"))
