"""Shapes of the plans that the large tables need: what is shuffled, read and written, and how often."""
import datetime as dt
from collections import Counter, defaultdict
from types import SimpleNamespace

from pyspark.sql import functions as F

from tallywatch.operators import facts, gates, marts, rules
from tallywatch.plans import q_detect, q_marts
from tallywatch.sources.adapters import ENTITIES

DAY = dt.date(2024, 1, 31)
TR = "date date, token string, transaction_hash string, amount double, from_address string, to_address string"
ROWS = [(DAY, "A", "h1", 5.0, "s1", "r1"), (DAY, "A", "h1", 6.0, "s1", "r2"), (DAY, "A", "h2", 7.0, None, "r1"), (DAY, None, None, 5e3, "s2", None),
        (None, "A", "h1", None, "s1", "r1"), (DAY, "R", "h9", 2e6, "s3", "r3"), (DAY, "A", "twice", 1.0, "s1", "r1")]
TX = [("h1", "A"), ("h2", None), ("twice", "A"), ("twice", "N"), (None, "A")]


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cube_of(spark, tmp_path):
    spark.createDataFrame(ROWS, TR).write.parquet(str(tmp_path / "tr"))
    spark.createDataFrame(TX, "hash string, direct_token string").write.parquet(str(tmp_path / "tx"))
    return spark.read.parquet(str(tmp_path / "tr")), spark.read.parquet(str(tmp_path / "tx"))


def cells():
    """The cube by a plain loop: a left join, then counts that leave out nulls."""
    out = defaultdict(list)
    for date, token, h, amount, sender, receiver in ROWS:
        routes = ["direct" if d == token and token is not None else "via contract" for x, d in TX if h is not None and x == h] or ["via contract"]
        band = "100k and over" if amount is None else "under 10" if amount < 10 else "10 to 1k" if amount < 1e3 else "1k to 100k" if amount < 1e5 else "100k and over"
        for r in routes:
            out[date, token, band, r].append((h, sender, receiver, amount))
    return out


def test_gates_sort_no_hashes_and_rules_read_blocks_once(spark, tmp_path, monkeypatch):
    """Null and repeated keys on both sides; transactions of another month do not count as there."""
    ts = dt.datetime(2024, 1, 31, 5)
    rows = [(DAY, "h1", 1, 5), (DAY, "h1", 1, 5), (DAY, "h1", None, 5), (DAY, "h1", None, 5), (DAY, None, 1, 5), (DAY, "gone", 2, 6), (DAY, "later", 3, None),
            (dt.date(2024, 2, 1), "later", 3, 7), (None, "nowhere", 1, 5)]
    tr = spark.createDataFrame([(d, h, i, n, ts, None if h == "gone" else 1.0, "s", "r") for d, h, i, n in rows],
                               "date date, transaction_hash string, log_index long, block_number long, block_timestamp timestamp_ntz, amount double, from_address string, to_address string")
    tx = spark.createDataFrame([(DAY, "h1"), (DAY, "h1"), (DAY, None), (dt.date(2024, 2, 2), "later"), (dt.date(2024, 3, 1), "alone")], "date date, hash string")
    bl = spark.createDataFrame([(DAY, 5), (DAY, 5), (DAY, 8)], "date date, number long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checks = gates.gate_months(tr, tx, bl)
        got = defaultdict(dict)
        for r in checks.collect():
            got[r.month][r.nr] = r.result
        plan = plan_text(checks).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got["2024-01"] == {0: 1, 1: 2, 2: 1, 3: 2, 4: 1, 5: 2, 6: 1} and [got["2024-02"][n] for n in range(5)] == [1, 0, 0, 0, 1]
    assert not [line for line in plan.splitlines() if "SortMergeJoin" in line and "transaction_hash" in line]

    written, settle = [], rules.settle
    monkeypatch.setattr(rules, "settle", lambda df: written.append(df.columns) or settle(df))
    blocks = bl.distinct().selectExpr("date", "number", "'a' as hash", "'b' as parent_hash", "timestamp_ntz'2024-01-31 05:00:00' as timestamp", "1L as transaction_count",
                           "1L as gas_used", "2L as gas_limit", "1L as base_fee_per_gas")
    calls = tx.selectExpr("date", "hash", "1L as transaction_index", "5L as block_number", "timestamp_ntz'2024-01-31 05:00:00' as block_timestamp", "'A' as direct_token",
                          "'0xaaaa' as to_address", "if(hash = 'h1', 0L, 1L) as receipt_status", "1L as receipt_effective_gas_price").dropDuplicates(["date", "hash"])
    found = {(r.date, r.check): (r.checked, r.violations) for r in rules.rules_daily(tr, calls, blocks, ENTITIES).collect()}
    assert found[DAY, "transfer in a failed transaction"] == (7, 4) and found[DAY, "transfer time differs from its block"][1] == 2
    assert any("parent_hash" in columns for columns in written)


def test_cube_shuffles_transfers_once(spark, tmp_path):
    tr, tx = cube_of(spark, tmp_path)
    cube = marts.mart_payments(tr.drop("from_address", "to_address"), tx, distinct=None)
    got = {(r.date, r.token, r.amount_band, r.route): (r.transfers, r.volume) for r in cube.collect()}
    assert got == {k: (len(v), sum(a for *_, a in v if a is not None) if any(a is not None for *_, a in v) else None) for k, v in cells().items()}
    keyed = [line for line in plan_text(cube).splitlines() if "HashAggregate" in line and "transaction_hash" in line.split("functions=")[0]]
    assert not keyed   # no shuffle of rows folded per hash before that of the join


def test_estimates_and_exact_counts_share_one_join(spark, tmp_path, monkeypatch):
    tr, tx = cube_of(spark, tmp_path)
    joins, plain = [], marts.spread_join
    monkeypatch.setattr(marts, "spread_join", lambda *a, **k: joins.append(a) or plain(*a, **k))
    monkeypatch.setattr(q_marts.staging, "transfers", lambda x: x)
    monkeypatch.setattr(q_marts.staging, "transactions", lambda x: x)
    rows = q_marts._counted(SimpleNamespace(spark=spark, transfers=tr.where("date is not null"), transactions=tx), "token", "route")
    got = {(r.token, r.route): (r.transfers, r.transactions, r.senders, r.receivers, r.within_three_errors) for r in rows.collect()}
    assert got == {("A", "direct"): (3, 2, 1, 2, True), ("A", "via contract"): (2, 2, 1, 1, True), ("R", "via contract"): (1, 1, 1, 1, True)}
    assert len(joins) == 1 and "Expand" not in plan_text(rows)


def test_marts_are_written_when_needed(spark):
    asked = []

    class Source:
        def __getattr__(self, name):
            asked.append(name)
            return spark.range(3).withColumn("mart", F.lit(name))

    source = Source()
    source.spark = spark
    found = q_detect.Detected(source)
    assert found.pipeline.count() == 3 and asked == ["pipeline"]
    payments, pipeline = found.marts("payments", "pipeline")
    assert payments.first().mart == "payments" and pipeline.first().mart == "pipeline" and sorted(asked) == ["payments", "pipeline"]
    assert found.health.count() == 3 and found.payments.count() == 3 and sorted(asked) == ["health", "payments", "pipeline"]


def test_rows_in_doubt_are_read_once(spark, tmp_path):
    days = [("e", dt.date(2024, 1, d), d == 9) for d in (1, 2, 9)] + [("base only", dt.date(2024, 1, 1), False)]
    spark.createDataFrame([(e, d, p, 1.5 * i, k, i % 3 == 0, i % 2 == 0) for e, d, p in days for i, k in enumerate(["x", "x", None, "y", "z"])],
                          "episode_id string, date date, is_peak boolean, amount double, k string, late boolean, failed boolean").write.parquet(str(tmp_path / "r"))
    out = facts._rows_in_doubt(spark.read.parquet(str(tmp_path / "r")), "k")
    got = {r.episode_id: r for r in out.collect()}
    e, b = got["e"], got["base only"]
    assert (e.pct_rows_late, e.duplicate_rows, e.n, e.amount, e.rate) == (40.0, 2, 5.0, 15.0, 0.6) and abs(e.pct_failed_rows_late - 100 / 3) < 1e-9
    assert e.pct_rows_late_baseline == b.pct_rows_late_baseline == 40.0 and b.n is None and b.duplicate_rows is None and b.pct_rows_late is None
    assert plan_text(out).split("Initial Plan")[0].count("FileScan") == 1


def test_sends_fold_raw_rows_by_sender_alone(spark, monkeypatch):
    """The same rows as from the shared moves, without writing these. Null and repeated senders, amounts, days."""
    ts = dt.datetime(2024, 1, 31, 5)
    tr = spark.createDataFrame([(d, t, s, r, a, ts) for d, t, _, a, s, r in ROWS * 2], "date date, token string, from_address string, to_address string, amount double, block_timestamp timestamp_ntz")
    days = spark.createDataFrame([("e", "transfers", DAY, "A", True, False, 3), ("f", "transfers", DAY, "A", False, True, 2), ("v", "volume", DAY, "R", True, False, 1)],
                                 "episode_id string, metric string, date date, token string, is_peak boolean, is_latest boolean, nb long")
    moves = facts.day_moves(days, tr)
    written = []
    monkeypatch.setattr(facts, "settle", lambda df: written.append(df.columns) or df)
    raw, shared = facts.sends(days, tr), facts.sends(days, moves)
    assert not written and raw.dtypes == shared.dtypes
    got = Counter(map(tuple, raw.collect()))
    assert got == Counter(map(tuple, shared.collect()))
    assert got == Counter((e, DAY, peak, not peak, nb, s, n, 0) for e, peak, nb in (("e", True, 3), ("f", False, 2)) for s, n in (("s1", 6), (None, 2)))


def test_values_of_a_mart_are_shuffled_once(spark, tmp_path):
    """All four uses of the counted fees read one exchange."""
    spark.range(2000).selectExpr("date_add(date'2024-01-01', cast(id % 5 as int)) as date", "if(id % 9 = 0, null, 'A') as direct_token",
                                 "id % 4 > 0 as succeeded", "rand(3) as fee_eth").write.parquet(str(tmp_path / "tx"))
    health = marts.mart_health(spark.read.parquet(str(tmp_path / "tx")))
    assert health.count() == 5
    health.collect()
    final = plan_text(health).split("Initial Plan")[0]
    assert final.count("FileScan") == 2 and final.count("ReusedExchange") >= 3   # sums, counted fees


def test_exact_counts_copy_no_rows(spark, tmp_path):
    tr, tx = cube_of(spark, tmp_path)
    cube = marts.mart_payments(tr, tx, distinct="exact")
    got = {(r.date, r.token, r.amount_band, r.route): (r.transfers, r.transactions, r.senders, r.receivers) for r in cube.collect()}
    assert got == {k: (len(v), *(len({x[i] for x in v} - {None}) for i in range(3))) for k, v in cells().items()}
    assert "Expand" not in plan_text(cube)
