"""Exact medians and quantiles, for arrays of a few values and for groups of any size."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_E_FOLD = 512      # one bucket spans about 0.2% of a value
SMALLEST_STEP = 1e9           # values this much below one unit still get their own bucket
SPLIT_BITS = 15               # a bucket that holds a wanted rank is split into 2**15 parts, and such a part once more
SPLITS = 2


def array_median(values: Column) -> Column:
    """Median of a short array; null when it is empty."""
    ordered = F.array_sort(values)
    n = F.size(values)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def array_mad(values: Column, middle: Column) -> Column:
    """Median absolute deviation of a short array around `middle`."""
    return array_median(F.transform(values, lambda x: F.abs(x - middle)))


def value_code(value: Column) -> Column:
    """A number that never decreases with the value: its bucket, followed by `SPLITS` digits of `SPLIT_BITS` bits.

    Values of one code differ by less than 2**-38 of their size, so at most some 2**15 different doubles share one
    (values below 1e-20 aside).
    """
    position = F.signum(value) * F.log1p(F.abs(value) * SMALLEST_STEP) * BUCKETS_PER_E_FOLD
    return F.floor(position * float(1 << SPLIT_BITS * SPLITS)).cast("long")


def _holding(cells: DataFrame, by: list[str]) -> DataFrame:
    """The cells that hold a wanted rank: `ranks` keeps only these, `below` counts what lies before the cell."""
    return (cells.withColumn("below", F.col("upto") - F.col("n"))
            .withColumn("ranks", F.filter("ranks", lambda e: (e.rank >= F.col("below")) & (e.rank < F.col("upto"))))
            .where(F.size("ranks") > 0).select(*by, "bucket", "below", "total", "ranks"))


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, probs: list[float],
                    weight: Column | None = None, within: Callable[[DataFrame], DataFrame] | None = None,
                    groups: list[str] | None = None) -> DataFrame:
    """Interpolated exact quantiles per group, with no group ever held by one task.

    `percentile` keeps every distinct value of a group in one task's memory, which fails on a day that holds a third
    of all rows. Here values are first counted (hot values collapse before the shuffle), then a histogram with a
    bounded number of buckets tells which bucket holds each wanted rank. That bucket is split by a finer histogram, and
    the part that holds the rank once more: what is sorted in the end are the different values of one code (see
    `value_code`), however many rows or values a bucket has. Keys must not be null.

    `within` maps counted cells to overlapping groups (for example hours to "before/after each cut"): it receives a
    frame with `keys` and adds the columns named in `groups`. Only histogram cells, and the rows of wanted buckets,
    are ever multiplied.

    Returns the group columns, `total` and `q`: one value per probability, in order.
    """
    by = groups or keys
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    # The joins below imply that keys, value, bucket and the parts of the code are not null. Saying so here keeps all uses of the
    # counts one plan, so they are shuffled once and the exchange is reused.
    parts_of = [f"shiftright(code, {SPLIT_BITS * left})" for left in range(SPLITS)]
    present = " and ".join(f"{c} is not null" for c in [*keys, "v", "bucket", *parts_of])
    rows = (df.withColumn("v", value.cast("double")).withColumn("code", value_code(F.col("v")))
            .withColumn("bucket", F.shiftright("code", SPLIT_BITS * SPLITS)).where(present))
    counts = rows.groupBy(*keys, "bucket", "code", "v").agg(n.alias("n"))

    cells = counts.groupBy(*keys, "bucket").agg(F.sum("n").alias("n"))
    if within is not None:
        cells = within(cells).groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*by)
    ends = [F.struct(F.lit(2 * i + side).alias("slot"), end(F.lit(p) * (F.col("total") - 1)).cast("long").alias("rank"))
            for i, p in enumerate(probs) for side, end in enumerate((F.floor, F.ceil))]
    wanted = _holding(cells.withColumn("upto", F.sum("n").over(whole.orderBy("bucket")))
                      .withColumn("total", F.sum("n").over(whole)).withColumn("ranks", F.array(*ends)), by)

    rows = counts
    if within is not None:
        shared = [k for k in keys if k in by]
        rows = within(counts.join(wanted.select(*shared, "bucket").distinct(), [*shared, "bucket"], "left_semi"))
        rows = rows.groupBy(*by, "bucket", "code", "v").agg(F.sum("n").alias("n"))
    for left in reversed(range(SPLITS)):
        parts = (rows.join(wanted, [*by, "bucket"]).withColumn("part", F.shiftright("code", SPLIT_BITS * left))
                 .groupBy(*by, "bucket", "part", "below", "total", "ranks").agg(F.sum("n").alias("n"))
                 .withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy(*by, "bucket").orderBy("part"))))
        wanted = _holding(parts.drop("bucket").withColumnRenamed("part", "bucket"), by)
        rows = rows.withColumn("bucket", F.shiftright("code", SPLIT_BITS * left))
    ranked = (rows.join(wanted, [*by, "bucket"])
              .withColumn("upto", F.col("below") + F.sum("n").over(Window.partitionBy(*by, "bucket").orderBy("v"))))
    found = (ranked.withColumn("hit", F.explode(F.filter("ranks", lambda e: (e.rank >= F.col("upto") - F.col("n"))
                                                         & (e.rank < F.col("upto")))))
             .groupBy(*by).agg(F.max("total").alias("total"),
                               *[F.max(F.when(F.col("hit.slot") == s, F.col("v"))).alias(f"e{s}")
                                 for s in range(2 * len(probs))]))

    def between(i: int, p: float) -> Column:
        position = F.lit(p) * (F.col("total") - 1)
        low, high = F.col(f"e{2 * i}"), F.col(f"e{2 * i + 1}")
        return low + (high - low) * (position - F.floor(position))

    return found.select(*by, "total", F.array(*[between(i, p) for i, p in enumerate(probs)]).alias("q"))
