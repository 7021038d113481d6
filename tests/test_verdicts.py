"""Every rule is reached by a planted set of facts."""
import pytest
from pyspark.sql import functions as F

from tallywatch.operators.verdicts import NUMBERS, verdicts

CLEAN = {"missing_blocks": 0, "duplicate_blocks": 0, "blocks": 7200, "day_complete": True, "duplicate_rows": 0, "mart_matches_raw": True}
FAIL = {"metric": "failure_rate", "rate": 0.2, "usual_rate": 0.01}
MOVE = {"metric": "transfers", "transfers": 2000, "baseline_avg": 1000.0}
DROP = {"metric": "transfers", "direction": "down", "transfers": 500, "baseline_avg": 1000.0}
VALUE = {"metric": "volume", "volume": 2000.0, "baseline_avg": 1000.0, "transfers": 100, "transfers_baseline_avg": 100.0}

CASES = [
    ("pipeline", "strong", {**MOVE, "missing_blocks": 3}), ("pipeline", "strong", {**MOVE, "duplicate_blocks": 1}),
    ("pipeline", "strong", {**MOVE, "day_complete": False, "last_block_time": "15:00"}), ("pipeline", "strong", {**MOVE, "duplicate_rows": 4}),
    ("pipeline", "strong", {**MOVE, "mart_matches_raw": False}),
    ("pipeline", "strong", {**VALUE, "units_shift_power": 6, "units_shift_from_hour": 12}),
    ("broad", "moderate", {**VALUE, "units_shift_power": 6, "units_shift_from_hour": 12, "transfers": 300}),
    ("noise", "moderate", {**MOVE, "transfers": 900}),
    ("one_program", "strong", {**FAIL, "fingerprint_share_of_failures": 0.7, "fingerprint_gas": 46109, "fingerprint_calls": 9, "fingerprint_senders": 8, "rate_without_fingerprint": 0.012}),
    ("one_program", "moderate", {**FAIL, "fingerprint_share_of_failures": 0.7, "fingerprint_gas": 46109, "rate_without_fingerprint": 0.1}),
    ("new_failing", "strong", {**FAIL, "fingerprint_share_of_failures": 0.7, "fingerprint_share_baseline": 0.5, "share_failures_new": 0.8, "rate_regular": 0.01}),
    ("new_failing_mixed", "moderate", {**FAIL, "share_failures_new": 0.8, "rate_regular": 0.1}),
    ("over_and_over", "strong", {**FAIL, "always_failing_share": 0.9, "rate_without_always_failing": 0.01, "share_failures_new": 0.5}),
    ("ten_failing", "moderate", {**FAIL, "top10_share_of_failures": 0.6}),
    ("regular_failing", "moderate", {**FAIL, "rate_regular": 0.05, "share_failures_new": 0.2}),
    ("absent_failers", "moderate", {**FAIL, "direction": "down", "rate": 0.001, "baseline_failures_from_absent_senders": 0.7}),
    ("dust", "strong", {**MOVE, "dust": 900, "dust_baseline_avg": 10.0}), ("dust_ended", "strong", {**DROP, "dust": 10, "dust_baseline_avg": 400.0}),
    ("ten_sending", "strong", {**MOVE, "top10_sender_transfers": 900, "top10_sender_transfers_baseline": 100.0}),
    ("newcomers", "moderate", {**MOVE, "new_sender_transfers": 800, "new_sender_transfers_baseline": 100.0}),
    ("busiest_less", "moderate", {**DROP, "lost_from_top50": 400.0}), ("empty_hours", "moderate", {**DROP, "empty_hours": 2}),
    ("supply", "strong", {**VALUE, "minted": 900.0, "burned": 0.0, "between_holders": 1100.0, "between_holders_baseline_avg": 1000.0}),
    ("supply", "moderate", {**VALUE, "minted": 900.0, "burned": 0.0, "between_holders": 3000.0, "between_holders_baseline_avg": 1000.0}),
    ("ten_sent", "strong", {**VALUE, "top10_sender_volume": 900.0, "top10_sender_volume_baseline": 100.0}),
    ("ten_received", "strong", {**VALUE, "top10_receiver_volume": 900.0, "top10_receiver_volume_baseline": 100.0}),
    ("large", "strong", {**VALUE, "top10_transfer_volume": 900.0, "top10_transfer_volume_baseline": 100.0}),
    ("large_missing", "moderate", {**VALUE, "direction": "down", "volume": 400.0, "top10_transfer_volume": 10.0, "top10_transfer_volume_baseline": 500.0}),
    ("rewritten", "moderate", {**MOVE, "pct_rows_late": 60.0, "pct_rows_late_baseline": 1.0}),
    ("market", "moderate", {**MOVE, "token_ratios": {"A": 2.0, "N": 1.4}}), ("broad", "moderate", {**MOVE, "token_ratios": {"A": 2.0, "N": 1.1}}),
]


@pytest.fixture(scope="module")
def judged(spark):
    schema = ("episode_id string, metric string, token string, direction string, day_complete boolean, last_block_time string, "
              "mart_matches_raw boolean, token_ratios map<string,double>, segment_band string, segment_route string, "
              + ", ".join(f"{c} double" for c in NUMBERS))
    names = [f.split()[0] for f in schema.split(", ")]
    rows = []
    for i, (_, _, facts) in enumerate(CASES):
        f = {**CLEAN, "episode_id": str(i), "token": "A", "direction": "up", **facts}
        rows.append(tuple(float(f[n]) if n in NUMBERS and n in f else f.get(n) for n in names))
    return {r.episode_id: r for r in verdicts(spark.createDataFrame(rows, schema)).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{i}-{c[0]}" for i, c in enumerate(CASES)])
def test_rule(judged, i):
    rule, confidence, _ = CASES[i]
    assert (judged[str(i)].rule, judged[str(i)].confidence) == (rule, confidence)
    assert judged[str(i)].title and judged[str(i)].label


def test_titles(judged):
    by_rule = {c[0]: judged[str(i)] for i, c in reversed(list(enumerate(CASES)))}
    assert judged["2"].title == "Incomplete day: nothing after 15:00 UTC"
    assert judged["5"].title == "Units changed from 12:00 UTC: amounts 1,000,000× too large"
    assert by_rule["one_program"].title == "One program: failed calls share an exact gas fingerprint (46,109 gas)"
    assert by_rule["one_program"].evidence and by_rule["rewritten"].evidence and not by_rule["rewritten"].caveats
    assert {r.family for r in judged.values()} == {"pipeline", "doubt", "bots", "few", "supply", "newcomers", "broad", "noise"}


def test_every_rule_is_planted():
    from tallywatch.operators.verdicts import FAMILY_OF
    assert {c[0] for c in CASES} == set(FAMILY_OF)
