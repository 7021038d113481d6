"""Joins that stay even where one key holds a large part of the rows."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.columns import single

#: Keys that may be spread, keys counted while looking for them, and the places each is spread over. A key with more than about
#: 3.5 / TRACKED of the rows is always counted, so every key that could fill a task is among the frequent ones.
FREQUENT, TRACKED, COPIES = 200, 4096, 64

#: Rows of both sides that one task of a large join sorts, and the size up to which a right side is left to the planner, which may broadcast it.
ROWS_PER_TASK, FEW = 1_400_000, 100_000


def frequent(rows: DataFrame, key: str, least_share: float = 0.001) -> DataFrame:
    """One row, `keys`: an array of at most FREQUENT keys that hold at least `least_share` of the rows with a key each. The counting is a mergeable
    sketch of fixed size, so the answer is as small as that for any number of rows. No rows: an empty array."""
    found = rows.where(F.col(key).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {FREQUENT}, {TRACKED})").alias("top"))
    return found.select(F.transform(F.filter("top", lambda t: t["count"] >= F.greatest(F.col("n") * least_share, F.lit(2))), lambda t: t["item"]).alias("keys"))


def spread_join(rows: DataFrame, unique: DataFrame, key: str, least_share: float = 0.001, copies: int = COPIES, also: tuple[str, ...] = ()) -> DataFrame:
    """`rows` left-joined with `unique` (at most one row for a key) on `key`, and on the columns `also` that both have.

    Rows of a frequent key are dealt over `copies` places and the one row they need is copied there; all other keys are joined as
    they are. Null keys match nothing and are dealt over all places. The result is that of a plain left join.

    The number of tasks follows the number of rows. Adaptive execution would merge partitions up to a size of shuffled, compressed bytes, and
    what a task sorts is several times that: it would spill as soon as a table is large enough for merged partitions to reach that size."""
    hot = single(frequent(rows, key, least_share))
    other = [c for c in rows.columns if c != key]
    place = F.when(F.array_contains(F.col("_hot"), F.col(key)) | F.col(key).isNull(), F.pmod(F.xxhash64(*other), F.lit(copies))).otherwise(F.lit(0)).cast("int")
    dealt = rows.withColumn("_hot", hot).withColumn("_place", place).drop("_hot")
    places = F.when(F.array_contains(F.col("_hot"), F.col(key)), F.sequence(F.lit(0), F.lit(copies - 1))).otherwise(F.array(F.lit(0)))
    copied = unique.withColumn("_hot", hot).withColumn("_place", F.explode(places)).drop("_hot")
    on, right = [key, *also, "_place"], unique.count()
    tasks = -(-(rows.count() + right) // ROWS_PER_TASK) if right > FEW else 0
    if tasks > rows.sparkSession.sparkContext.defaultParallelism:
        dealt, copied = dealt.repartition(tasks, *on), copied.repartition(tasks, *on)
    return dealt.join(copied, on, "left").drop("_place")
