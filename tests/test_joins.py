"""Joins with a key that holds a third of the rows, and merged sketches."""
import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tallywatch.functions import joins
from tallywatch.operators import marts

ROWS = 30_000


def hot_rows(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 300 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 7001).cast("string")))
    return spark.range(ROWS).select(key.alias("k"), F.col("id").alias("v"))


def test_frequent_keys_are_found_and_few(spark):
    rows = hot_rows(spark)
    assert joins.frequent(rows, "k").first()["keys"] == ["hot"]
    assert joins.frequent(rows.where("false"), "k").first()["keys"] in ([], None)
    assert len(joins.frequent(rows.select((F.col("v") % 900).cast("string").alias("k")), "k").first()["keys"]) <= joins.FREQUENT


def test_spread_join_is_a_left_join_whose_tasks_are_even(spark):
    rows = hot_rows(spark)
    unique = rows.where("k is not null").select("k").distinct().where("k <> 'k5'").withColumn("w", F.concat(F.lit("w"), "k"))
    want = Counter(map(tuple, rows.join(unique, "k", "left").collect()))
    got = joins.spread_join(rows, unique, "k")
    assert got.columns == ["k", "v", "w"] and Counter(map(tuple, got.collect())) == want
    none = spark.createDataFrame([], "k string, w string")
    assert joins.spread_join(rows, none, "k").where("w is null").count() == ROWS
    assert joins.spread_join(rows.where("false"), unique, "k").count() == 0
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(old, ("-1", "false", "32")):
            spark.conf.set(k, v)
        per_task = [r["count"] for r in joins.spread_join(rows, unique, "k").groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("w")).collect()]
        plain = [r["count"] for r in rows.join(unique, "k", "left").groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("w")).collect()]
        plan = joins.spread_join(rows, unique, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert max(plain) > ROWS / 3 and max(per_task) < ROWS / 8
    assert "SortMergeJoin" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_tasks_of_a_spread_join_follow_the_rows(spark, monkeypatch):
    """Adaptive execution would merge these partitions into a few; a task's sort must not grow with the table. Repeated and null keys on both sides."""
    rows = hot_rows(spark)
    unique = (rows.select("k").distinct().union(spark.createDataFrame([("k6",), ("k7",), ("alone",)], "k string"))
              .withColumn("w", F.concat(F.lit("w"), "k")))
    want = Counter(map(tuple, rows.join(unique, "k", "left").collect()))
    total = ROWS + unique.count()
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        monkeypatch.setattr(joins, "FEW", 0, raising=False)
        for size in (1000, 3000):
            monkeypatch.setattr(joins, "ROWS_PER_TASK", size, raising=False)
            got = joins.spread_join(rows, unique, "k").cache()
            assert got.columns == ["k", "v", "w"] and Counter(map(tuple, got.collect())) == want
            per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert total / size * 0.7 < len(per_task) <= -(-total // size) and max(per_task) < 2 * size
            got.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_few_right_rows_are_left_to_the_planner(spark, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_TASK", 1000, raising=False)
    few = spark.createDataFrame([("hot", "w"), ("k1", "x")], "k string, w string")
    plan = joins.spread_join(hot_rows(spark), few, "k")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" not in plan


def test_sketches_merge_over_days_and_routes(spark):
    """A hash with a third of the transfers; receivers that come again each day, so daily counts don't add up."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 60).cast("int"))
    tr = spark.range(60_000).select(day.alias("date"), F.lit("A").alias("token"), (F.col("id") % 5000).cast("double").alias("amount"),
                                    F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("transaction_hash"),
                                    (F.col("id") % 20_011).cast("string").alias("from_address"), (F.col("id") % 97).cast("string").alias("to_address"))
    tx = spark.createDataFrame([("hot", "A"), ("1", "A"), ("2", None)], "hash string, direct_token string")
    cube = marts.mart_sketches(tr, tx)
    assert {(r.date, r.amount_band, r.route): (r.transfers, r.volume) for r in cube.collect()} == {
        (r.date, r.amount_band, r.route): (r.transfers, r.volume) for r in marts.mart_payments(tr, tx, distinct=None).collect()}
    for keys in (["token"], ["month"], ["amount_band", "route"]):
        merged = marts.merged_counts(cube, *keys)
        exact = marts.labelled_transfers(tr, tx).withColumn("month", F.date_format("date", "yyyy-MM")).groupBy(*keys).agg(
            *[F.count_distinct(c).alias(f"exact_{m}") for m, c in marts.COUNTED.items()])
        rows = merged.join(exact, keys).select(*[marts.within_error(F.col(m), F.col(f"exact_{m}")).alias(m) for m in marts.COUNTED], "receivers", "exact_receivers").collect()
        assert rows and all(r.transactions and r.senders for r in rows)
    assert marts.merged_counts(marts.mart_sketches(tr.where("false"), tx), "token").count() == 0
