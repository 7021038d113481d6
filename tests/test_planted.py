"""Small tables with one planted fault each."""
import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.operators import deep_dive, episodes, facts, gates, rules, snapshots
from tallywatch.plans import watch
from tallywatch.sources.tables import keep_others, publish, scan, schema_of

ENTITIES = {"A": "0xaaaa"}
T0 = dt.datetime(2024, 3, 1)


def tables(spark, days=3):
    """Clean days: a block an hour, a call and a transfer per block."""
    bl, tx, tr = [], [], []
    for n in range(days * 24):
        ts = T0 + dt.timedelta(hours=n, minutes=55 if n % 24 == 23 else 0)
        seen = ts + dt.timedelta(hours=1)
        bl.append((ts.date(), n, f"h{n}", f"h{n - 1}", ts, 5, 10, 100, 7, seen))
        tx.append((ts.date(), ts, n, 0, f"x{n}", "0x1", "0xaaaa", "A", 1, 21000, 9, 2, seen))
        tr.append((ts.date(), ts, n, 0, f"x{n}", "A", "0x1", "0x2", 5.0, seen))
    return tuple(spark.createDataFrame(r, schema_of(s)) for r, s in ((tr, "transfers"), (tx, "transactions"), (bl, "blocks")))


def change(df, where, **columns):
    return df.withColumns({c: F.when(F.expr(where), v).otherwise(F.col(c)).cast(df.schema[c].dataType) for c, v in columns.items()})


FAULTS = [
    ("none", {}, {}),
    ("failed", {"tx": ("hash = 'x5'", {"receipt_status": 0})}, {"transfer in a failed transaction": 1}),
    ("negative", {"tr": ("block_number = 5", {"amount": -1.0})}, {"negative amount": 1}),
    ("moved", {"tx": ("hash = 'x5'", {"block_number": 6, "block_timestamp": T0 + dt.timedelta(hours=6)})},
     {"transfer and its transaction in different blocks": 1, "repeated transaction index in a block": 1}),
    ("cheap", {"tx": ("hash = 'x5'", {"receipt_effective_gas_price": 6})}, {"fee below the block's base fee": 1}),
    ("index", {"tx": ("hash = 'x5'", {"transaction_index": 5})}, {"transaction index beyond the block's size": 1}),
    ("label", {"tx": ("hash = 'x5'", {"to_address": "0xbbbb"})}, {"direct call labelled with the wrong token": 1}),
    ("parent", {"bl": ("number = 5", {"parent_hash": "bad"})}, {"parent hash does not match the previous block": 1}),
    ("gas", {"bl": ("number = 5", {"gas_used": 101})}, {"block over its gas limit": 1}),
    ("day", {"bl": ("number = 30", {"date": T0.date()})}, {"block stored under the wrong day": 1}),
    ("tr day", {"tr": ("block_number = 30", {"date": T0.date()})}, {"transfer stored under the wrong day": 1}),
    ("tx day", {"tx": ("block_number = 30", {"date": T0.date()})}, {"transaction stored under the wrong day": 1}),
    ("time", {"bl": ("number = 5", {"timestamp": T0 + dt.timedelta(hours=4)})},
     {"block time not after the previous block": 1, "transfer time differs from its block": 1, "transaction time differs from its block": 1}),
]


def broken(tr, tx, bl):
    return {r.check: r.v for r in rules.rules_daily(tr, tx, bl, ENTITIES).groupBy("check").agg(F.sum("violations").alias("v")).where("v > 0").collect()}


@pytest.mark.parametrize("name,faults,expected", FAULTS, ids=[f[0] for f in FAULTS])
def test_rules_find_only_the_planted_fault(spark, name, faults, expected):
    parts = dict(zip(("tr", "tx", "bl"), tables(spark)))
    for table, (where, columns) in faults.items():
        parts[table] = change(parts[table], where, **columns)
    assert broken(parts["tr"], parts["tx"], parts["bl"]) == expected


def test_chain_holds_over_chunks_gaps_and_copies(spark, monkeypatch):
    monkeypatch.setattr(rules, "NUMBERS_PER_CHUNK", 7)
    _, _, bl = tables(spark, 4)
    gone = bl.where("number not between 10 and 30").unionByName(bl.where("number = 40")).unionByName(bl.where("number = 40"))
    month = gone.withColumn("month_of", F.lit("2024-03"))
    got = {r["check"]: r.v for r in rules.rules_blocks(month).groupBy("check").agg(F.sum("violations").alias("v")).collect()}
    assert got["parent hash does not match the previous block"] == 0
    assert got["block time not after the previous block"] == 2      # the two further copies of block 40


def test_gate_names_what_failed(spark):
    tr, tx, bl = tables(spark, 31)
    months = spark.createDataFrame([("2024-03",), ("2024-04",)], "month string")
    clean = gates.gate_months(tr, tx, bl)
    assert [r.passed for r in clean.collect()] == [True] * 7
    assert [(r.month, r.problems) for r in gates.gate_failed(clean, months).collect()] == [("2024-04", ["no checks ran"])]
    bad = gates.gate_months(tr.unionByName(tr.where("block_number = 3")), tx.where("hash <> 'x9'"), bl.where("number <> 50"))
    failed = {r.check: r.result for r in bad.where("not passed").collect()}
    assert failed == {"Duplicate transfers (same hash and log index)": 1, "Transfers whose transaction is missing": 1,
                      "Transfers whose block is missing": 1, "Missing blocks in the month's range": 1}
    with pytest.raises(ValueError, match="2024-03"):
        gates.require_passed(bad, months)


def volume_plan(spark, base=7):
    peak = T0.date() + dt.timedelta(days=7 * base)
    days = [T0.date() + dt.timedelta(days=7 * i) for i in range(base)]
    plan = spark.createDataFrame([("e", "volume", "A", "up", peak, days[0], days, base)],
                                 "episode_id string, metric string, token string, direction string, peak date, wave_start date, baseline array<date>, nb int")
    return episodes.plan_days(plan), peak, days


@pytest.mark.parametrize("factor,expected", [(1e6, (6, 12)), (1e-3, (-3, 12)), (None, None)])
def test_units_shift(spark, factor, expected):
    days, peak, base = volume_plan(spark)
    rows = []
    for d in [*base, peak]:
        for hour in range(24):
            for i, amount in enumerate([1.0, 5.0, 20.0, 80.0, 500.0]):
                if d == peak and hour >= 12:
                    # A change of the mix moves the quartiles by different factors.
                    amount = amount * factor if factor else amount * (10 ** i)
                rows.append((d, dt.datetime.combine(d, dt.time(hour)), "A", amount))
    tr = spark.createDataFrame(rows, "date date, block_timestamp timestamp_ntz, token string, amount double")
    got = facts.units_shift(*facts.amount_quartiles(days, tr)).collect()
    assert [(r.units_shift_power, r.units_shift_from_hour) for r in got] == ([expected] if expected else [])


def test_snapshot_events_come_once(spark):
    day, other, early = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.datetime(2024, 3, 2, 3)

    def visit(at, rows, amount=None, first=early, d=day):
        return (at, "blocks", d, rows, 1 if rows else 0, "n" if rows else None, 1 if rows else None, rows or None, first if rows else None,
                first if rows else None, None, amount, None)

    schema = ("taken_at timestamp_ntz, source_table string, date date, rows bigint, files bigint, file_names string, min_block bigint, max_block bigint, "
              "first_written timestamp_ntz, last_written timestamp_ntz, stable_rows bigint, stable_amount double, stable_failed bigint")
    at = [dt.datetime(2024, 3, 5 + i) for i in range(5)]
    snaps = spark.createDataFrame([visit(at[0], 0), visit(at[1], 10, 5.0), visit(at[2], 10, 5.0000001), visit(at[3], 1200), visit(at[4], 0),
                                   visit(at[4], 0, d=other)], schema)
    manifest = spark.createDataFrame([("blocks", day, 10, 1, 1, 10, early, early)],
                                     "source_table string, date date, rows bigint, files bigint, min_block bigint, max_block bigint, first_written timestamp_ntz, last_written timestamp_ntz")
    ev = snapshots.source_events(snaps, manifest, "2024-03-09 01:00:00")
    got = [(r.kind, r.detail) for r in ev.orderBy("kind", "seen_at").collect()]
    assert [k for k, _ in got] == ["arrived", "changed", "changed", "late", "republished"]
    assert got[0][1] == "first written 3.0 hours after the day ended"
    assert got[1][1] == "rows 10 → 1,200; max block 10 → 1,200"
    assert got[4][1] == "since this project loaded it: no longer in the source (it had 10 rows)"
    assert snapshots.new_events(ev, ev).count() == 0 and snapshots.new_events(ev, None).count() == 4
    status = snapshots.source_status(snaps, manifest, ev).first()
    assert (status.snapshots, status.compared_table_days, status.republished_days, status.late) == (5, 1, 1, 1)


def test_published_table_prunes_and_replaces(spark, tmp_path):
    tr, _, _ = tables(spark, 31)
    path = str(tmp_path / "tr")
    publish(tr, path, "date", ["block_number", "log_index"])
    publish(tr.where("date = '2024-03-05'").withColumn("amount", F.lit(9.0)), path, "date", ["block_number"])
    back = scan(spark, path, schema_of("transfers"))
    assert back.count() == tr.count() and back.where("amount = 9").count() == 24
    assert back.columns == tr.columns
    days = {f.split("/date=")[1][:10] for f in back.inputFiles()}
    month = scan(spark, path, months=["2024-03"])
    assert {f.split("/date=")[1][:10] for f in month.inputFiles()} == {d for d in days if d.startswith("2024-03")} and month.count() == back.where("month(date) = 3").count()
    wanted = spark.createDataFrame([(dt.date(2024, 3, 5),)], "date date")
    some = scan(spark, path, days=wanted)
    assert some.count() == 24
    assert "dynamicpruning" in some._jdf.queryExecution().executedPlan().toString().lower()
    assert scan(spark, str(tmp_path / "absent"), schema_of("blocks")).count() == 0


def test_scan_of_days_opens_their_folders_only(spark, tmp_path):
    """A thousand folders, all but three with a file that is no Parquet: the three days are read all the same."""
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=i) for i in range(1000)]
    good = [days[5], days[500], days[999]]
    spark.createDataFrame([(d, i) for i, d in enumerate(good)], "date date, v int").write.partitionBy("date").parquet(str(tmp_path / "t"))
    for d in set(days) - set(good):
        (tmp_path / "t" / f"date={d}").mkdir()
        (tmp_path / "t" / f"date={d}" / "part-0.parquet").write_text("not parquet")
    wanted = spark.createDataFrame([(d,) for d in [*good, good[0], None, dt.date(1999, 1, 1)]], "date date")
    for schema in (None, T.StructType.fromDDL("date date, v bigint, absent string")):
        got = scan(spark, str(tmp_path / "t"), schema, days=wanted)
        assert sorted((r.date, r.v) for r in got.collect()) == [(d, i) for i, d in enumerate(good)]
    nothing = scan(spark, str(tmp_path / "t"), T.StructType.fromDDL("date date, v bigint"), days=wanted.where("date < '2000-01-01'"))
    assert nothing.count() == 0


def test_keep_others(spark):
    old = spark.createDataFrame([("2024-01", 1), ("2024-02", 1)], "month string, v int")
    new = spark.createDataFrame([("2024-02", 2, "x")], "month string, v int, extra string")
    assert sorted((r.month, r.v) for r in keep_others(old, new).collect()) == [("2024-01", 1), ("2024-02", 2)]


def test_top_k_is_cut_before_the_shuffle(spark):
    days, peak, base = volume_plan(spark)
    tr = spark.createDataFrame([(peak, T0, "A", "a", "b", 1.0)], "date date, block_timestamp timestamp_ntz, token string, from_address string, to_address string, amount double")
    assert "WindowGroupLimit" in facts.top_value(days, tr)._jdf.queryExecution().executedPlan().toString()


def test_fact_groups_share_one_raw_pass(spark, tmp_path, monkeypatch):
    """The raw folder is scanned once, by the shared reduction; the facts of value and of transfers read what it wrote."""
    days, peak, base = volume_plan(spark)
    both = days.unionByName(days.withColumn("metric", F.lit("transfers")).withColumn("episode_id", F.lit("f")))
    rows = [(d, dt.datetime.combine(d, dt.time(h)), "A", f"s{h % 3}", "r", float(v)) for d in [*base, peak] for h in range(24)
            for v in (1, 1, 1, 7, 7, 50, h)]
    spark.createDataFrame(rows, "date date, block_timestamp timestamp_ntz, token string, from_address string, to_address string, amount double"
                          ).write.partitionBy("date").parquet(str(tmp_path / "raw"))
    tr = spark.read.parquet(str(tmp_path / "raw"))
    moves = facts.day_moves(both, tr)
    top = facts.top_value(both, tr).first()
    assert top.top10_transfer_volume == 500 and top.top10_sender_volume == sum(range(24)) + 24 * 67
    for out in (facts.facts_volume(both, tr), facts.facts_transfers(both, tr), facts.facts_volume(both, moves)):
        assert not [f for f in out.inputFiles() if "/raw/" in f]
    monkeypatch.setattr(facts, "settle", lambda df: df)
    plan = facts.day_moves(both, tr)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/raw]") == 1


def test_whole_investigation_finds_a_dust_wave(spark):
    """Twenty weeks of even traffic, then one day of dust from many senders."""
    n = spark.range(20 * 7 * 40).selectExpr("cast(id / 40 as int) as d", "cast(id % 40 as int) as i")
    wave = spark.range(400).selectExpr("120 as d", "cast(id + 1000 as int) as i")
    tr = n.withColumn("amount", F.expr("cast(10 + i as double)")).unionByName(wave.withColumn("amount", F.lit(0.5))).selectExpr(
        "date_add(date'2024-01-01', d) as date", "cast(date_add(date'2024-01-01', d) as timestamp_ntz) + make_dt_interval(0, i % 24) as block_timestamp",
        "cast(d * 24 + i % 24 as bigint) as block_number", "cast(i as bigint) as log_index", "concat('x', d, '-', i) as transaction_hash", "'A' as token",
        "concat('0x', i) as from_address", "'0x2' as to_address", "amount",
        "cast(date_add(date'2024-01-01', d) as timestamp_ntz) + make_dt_interval(0, i % 24 + 1) as last_modified")
    bl = spark.range(140 * 24).selectExpr(
        "date_add(date'2024-01-01', cast(id / 24 as int)) as date", "id as number",
        "cast(date_add(date'2024-01-01', cast(id / 24 as int)) as timestamp_ntz) + make_dt_interval(0, cast(id % 24 as int), 55) as timestamp")
    tx = spark.createDataFrame([], schema_of("transactions"))
    payments = tr.groupBy("date", "token").agg(F.count(F.lit(1)).alias("transfers"), F.sum("amount").alias("volume")).withColumns(
        {"amount_band": F.lit("under 10"), "route": F.lit("direct")})
    health = spark.createDataFrame([], "date date, token string, direct_calls bigint, failed_calls bigint, failure_rate double")
    pipeline = bl.groupBy("date").agg(F.expr("0L as missing_blocks"), F.expr("0L as duplicate_blocks"), F.expr("3.0D as max_load_lag_hours"),
                                      F.expr("20.0D as avg_base_fee_gwei"))
    found, wide, flagged = watch.investigate(tr, tx, bl, payments, health, pipeline)
    rows = found.collect()
    assert [(r.metric, r.direction, str(r.peak_date), r.rule, r.confidence) for r in rows] == [("transfers", "up", "2024-04-30", "dust", "strong")]
    assert rows[0].investigated and flagged.count() == 0
    assert watch.nested_facts(wide).first().behaviour.transfers == 440


def test_mistaken_mint_at_the_real_tolerance(spark):
    """The largest mint counts, not a larger burn; only equal amounts (to a billionth) of the same party are matched."""
    at = lambda h: T0 + dt.timedelta(hours=h)
    rows = [(at(0), "A", "burn", 5e6, "b0", "y"), (at(1), "A", "mint", 5e12, "m1", "x"), (at(2), "A", "burn", 5e12 * (1 + 1e-8), "b1", "x"),
            (at(2), "A", "burn", 5e12, "b2", "z"), (at(3), "A", "burn", 5e12, "b3", "x"), (at(4), "A", "mint", 5e6, "m2", "x"),
            (at(5), "A", "mint", 5.1e6, "m3", "x"), (at(6), "A", "burn", 9e13, "b4", "x"),
            (at(1), "N", "mint", 7e12, "m4", "x"), (at(2), "N", "mint", 7e6, "m5", "y"), (at(0), "N", "burn", 7e6, "b5", "y"),
            (at(1), "R", "burn", 7e12, "b6", "x")]
    events = spark.createDataFrame(rows, "block_timestamp timestamp_ntz, token string, kind string, amount double, transaction_hash string, counterparty string")
    got = {r.token: r for r in deep_dive.mint_burn_match(events).collect()}
    assert set(got) == {"A", "N"}
    a, n = got["A"], got["N"]
    assert (a.amount, a.at, a.burned_at, a.minutes_until_burned, a.smaller_mint_at, a.earlier_burns, a.earlier_burn_at) == (
        5e12, at(1), at(3), 120.0, at(4), 1, at(0))
    assert (n.burned_at, n.smaller_mint_at, n.earlier_burns, n.earlier_burn_at) == (None, None, 0, None)
