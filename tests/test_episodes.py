"""Grouping, waves and comparison days against plain loops over small tables."""
import datetime as dt
import random

from pyspark.sql import functions as F

from tallywatch.operators import episodes, scoring


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def flags(spark, days, metric="transfers", token="A", direction="up"):
    rows = [(metric, token, direction, day(n), 10.0, 5.0, 2.0 + n / 1000, 6.0) for n in days]
    return spark.createDataFrame(rows, "metric string, token string, direction string, date date, value double, usual double, ratio double, score double")


def test_one_quiet_day_joins_and_two_split(spark):
    one = episodes.episodes(flags(spark, [0, 1, 3])).collect()
    assert len(one) == 1 and one[0].days == 3 and one[0].peak_date == day(3)
    two = episodes.waves(episodes.episodes(flags(spark, [0, 1, 4]))).orderBy("start").collect()
    assert [e.days for e in two] == [2, 1]
    assert {e.wave_start for e in two} == {day(0)}
    assert two[0].episode_id == "transfers-A-up-2024-01-01"


def test_first_day_wins_a_tied_peak(spark):
    df = flags(spark, [0, 1, 2]).withColumn("ratio", F.lit(3.0))
    assert episodes.episodes(df).first().peak_date == day(0)


def loop_wave(start, runs):
    while True:
        earlier = [r for r in runs if r[1] < start and r[1] >= start - dt.timedelta(days=30)]
        if not earlier:
            return start
        start = min(r[0] for r in earlier)


def test_waves_and_baselines_equal_a_loop(spark):
    rng = random.Random(3)
    days = sorted(rng.sample(range(400), 40))
    eps = episodes.waves(episodes.episodes(flags(spark, days)))
    got = eps.collect()
    runs = [(e.start, e.end) for e in got]
    for e in got:
        assert e.wave_start == loop_wave(e.start, runs)
    scored = [("transfers", "A", day(n), rng.choice([0.5, 1.0, 3.5])) for n in range(400)]
    bad = {day(n) for n in range(0, 400, 17)}
    plan = episodes.baseline_days(eps, spark.createDataFrame(scored, "metric string, token string, date date, score double"),
                                  spark.createDataFrame([(d,) for d in bad], "date date")).collect()
    by_id = {e.episode_id: e for e in got}
    for p in plan:
        e = by_id[p.episode_id]
        quiet = [d for _, _, d, s in scored if d < e.wave_start and d >= e.wave_start - dt.timedelta(days=180) and abs(s) < 3
                 and d.weekday() == e.peak_date.weekday() and d not in bad][-7:]
        if len(quiet) < 3:
            last = e.wave_start - dt.timedelta(days=(e.wave_start.weekday() - e.peak_date.weekday()) % 7 or 7)
            quiet = [last - dt.timedelta(weeks=i) for i in range(6, -1, -1)]
        assert p.baseline == quiet and p.nb == len(quiet)


def test_chance_guards_the_failure_rate_only(spark):
    rows = [("failure_rate", 0.02, 0.01, 1000.0, 20.0, 2.0, 9.0), ("failure_rate", 0.2, 0.01, 1000.0, 200.0, 20.0, 9.0),
            ("transfers", 2.0, 1.0, None, None, 2.0, 9.0), ("transfers", 1.2, 1.0, None, None, 1.2, 9.0), ("volume", 1.5, 1.0, None, None, 1.5, 9.0)]
    df = spark.createDataFrame(rows, "metric string, value double, usual double, calls double, failed double, ratio double, score double")
    assert sorted((r.metric, r.value) for r in scoring.unusual_days(df).collect()) == [("failure_rate", 0.2), ("transfers", 2.0)]
