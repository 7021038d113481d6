import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywatch.functions.quantiles import array_mad, array_median, exact_quantiles, value_code


def test_equals_numpy_over_magnitudes_and_skew(spark):
    rng = np.random.default_rng(7)
    groups = {"hot": np.concatenate([np.full(3000, 5.0), rng.lognormal(0, 6, 2001)]), "small": np.array([-3.0, 2.5, 0.0, 1e12]),
              "one": np.array([7.25]), "dust": rng.uniform(0, 1e-6, 500)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r.q for r in exact_quantiles(df, ["g"], F.col("v"), [0.25, 0.5, 0.9]).collect()}
    for g, vs in groups.items():
        assert np.allclose(got[g], np.quantile(vs, [0.25, 0.5, 0.9]), rtol=1e-12)


def test_counts_are_shuffled_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 3 as g", "rand(1) as v").write.parquet(str(tmp_path / "t"))
    out = exact_quantiles(spark.read.parquet(str(tmp_path / "t")), ["g"], F.col("v"), [0.5])
    out.collect()
    assert "ReusedExchange" in plan_text(out)


def test_a_million_unlike_values_in_one_bucket(spark):
    """All values lie within 0.2 %, a third of them within a billionth: the parts that are sorted stay small."""
    wide = spark.range(700_000).selectExpr("1000 + 1.5 * pmod(id * 7919, 700001) / 700001 as v")
    tight = spark.range(350_000).selectExpr("1000.25 + 1e-6 * id / 350000 as v")
    df = wide.unionByName(tight).selectExpr("'a' as g", "v")
    probs = [0.0, 0.1, 0.25, 0.4, 0.5, 1.0]
    got = exact_quantiles(df, ["g"], F.col("v"), probs).first()
    values = np.array([r.v for r in df.select("v").toLocalIterator(prefetchPartitions=True)])
    assert got.total == len(values) and np.allclose(got.q, np.quantile(values, probs), rtol=1e-13, atol=0)
    code = value_code(F.col("v"))
    sizes = (df.select(F.shiftright(code, 30).alias("b"), F.shiftright(code, 15).alias("p"), code.alias("c"), "v").distinct())
    assert sizes.select("b").distinct().count() <= 2
    assert sizes.groupBy("b").agg(F.countDistinct("p").alias("n")).agg(F.max("n")).first()[0] <= 1 << 15
    assert sizes.groupBy("p").agg(F.countDistinct("c").alias("n")).agg(F.max("n")).first()[0] <= 1 << 15
    assert sizes.groupBy("c").count().agg(F.max("count")).first()[0] <= 10_000


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(-1e15, 1e15), min_size=2, max_size=40))
def test_codes_keep_the_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    codes = [r.c for r in df.select(F.col("v"), value_code(F.col("v")).alias("c")).sort("v").collect()]
    assert codes == sorted(codes)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=10, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=9))
def test_array_median_and_mad(spark, values):
    row = (spark.createDataFrame([(values,)], "a array<double>").withColumn("m", array_median(F.col("a")))
           .withColumn("d", array_mad(F.col("a"), F.col("m"))).first())
    assert np.isclose(row.m, np.median(values)) and np.isclose(row.d, np.median(np.abs(np.array(values) - np.median(values))))
