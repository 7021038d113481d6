"""Places and rolling windows over a whole table, against plain lists."""
import random

import pytest
from pyspark.sql import functions as F

from tallywatch.functions.positions import rolling, with_position
from tallywatch.operators.metrics import rolling_source_share


def test_places_follow_the_order(spark):
    random.seed(5)
    rows = [(i, random.choice(["a", "b", None]), random.choice([1.5, 2.5, None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, k string, v double").repartition(7)
    got = with_position(df, F.col("k").asc_nulls_first(), F.col("v").desc_nulls_last(), "id").collect()
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", r[2] is None, -(r[2] or 0), r[0]))
    assert [r.id for r in sorted(got, key=lambda r: r.position)] == [r[0] for r in want]
    assert sorted(r.position for r in got) == list(range(1, 3001)) and set(got[0].asDict()) == {"id", "k", "v", "position"}


def test_equal_and_no_rows(spark):
    same = spark.range(500).selectExpr("1 as v")
    assert sorted(r.position for r in with_position(same, "v").collect()) == list(range(1, 501))
    assert with_position(same.where("v = 2"), "v").count() == 0
    assert rolling(same.where("v = 2"), 3, "v", s="sum(v)").count() == 0


@pytest.mark.parametrize("stretch,rows", [(7, 7), (10, 7), (64, 1), (4096, 100)])
def test_windows_cross_stretches(spark, stretch, rows):
    df = spark.range(1000).selectExpr("id", "id * id % 37 as v").repartition(5)
    values = [i * i % 37 for i in range(1000)]
    got = {r.id: (r.s, r.n) for r in rolling(df, rows, "id", stretch=stretch, s="sum(v)", n="count(*)").collect()}
    assert got == {i: (sum(values[max(0, i - rows + 1):i + 1]), min(i + 1, rows)) for i in range(1000)}
    with pytest.raises(ValueError):
        rolling(df, stretch + 1, "id", stretch=stretch, s="sum(v)")


def test_source_share_over_twenty_thousand_days(spark):
    """Rows may skip days; the window counts rows. No task of the plan reads them all."""
    days = spark.range(20_000).selectExpr(
        "date_add(date'1900-01-01', cast(id * 2 as int)) as date", "id % 11 as stablecoin_transfers", "if(id < 10, 0, id % 5 + 1) as source_transfer_rows")
    out = rolling_source_share(days)
    got = [r.share7 for r in out.sort("date").collect()]
    a, b = [i % 11 for i in range(20_000)], [0 if i < 10 else i % 5 + 1 for i in range(20_000)]
    want = [(sum(a[max(0, i - 6):i + 1]) / s if (s := sum(b[max(0, i - 6):i + 1])) else None) for i in range(20_000)]
    assert got == want
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
