"""Places of rows in one order over a whole table, without a task that sees all rows."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.session import settle

#: Consecutive rows that one window of `rolling` holds, the rows handed over aside.
STRETCH = 4096


def with_position(df: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """Adds each row's place in the order, from 1.

    Rows are range-partitioned and written; a place is the number of rows in the ranges before (one count per range
    reaches the driver) plus the place within the range. Rows equal in the order share a range, and which of them comes
    first is open, so the order should end with a key. Nulls stand where Spark's order puts them.
    """
    part, before = f"{name}_range", f"{name}_before"
    placed = settle(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    offsets, total = [], 0
    for row in sorted(placed.groupBy(part).count().collect()):
        offsets.append((row[0], total))
        total += row[1]
    sums = df.sparkSession.createDataFrame(offsets, f"{part} int, {before} bigint")
    within = F.row_number().over(Window.partitionBy(part).orderBy(*order))
    # One row per range: as many as the session has shuffle partitions.
    return placed.join(F.broadcast(sums), part).withColumn(name, F.col(before) + within).drop(part, before)


def rolling(df: DataFrame, rows: int, *order: Column | str, stretch: int = STRETCH, **values: str) -> DataFrame:
    """Adds aggregates (SQL text per name) over each row and the `rows - 1` before it in the order.

    Rows are dealt to stretches by their place; the last `rows - 1` of a stretch are handed to the next one, too.
    """
    if not 0 < rows <= stretch:
        raise ValueError(f"rows must be between 1 and {stretch}")
    at = with_position(df, *order, name="rolling_at")
    own = F.expr(f"rolling_at div {stretch}")
    dealt = (at.withColumn("rolling_own", own)
             .withColumn("rolling_in", F.explode(F.expr(f"array_distinct(array(rolling_own, (rolling_at + {rows - 1}) div {stretch}))"))))
    w = Window.partitionBy("rolling_in").orderBy("rolling_at").rowsBetween(1 - rows, 0)
    out = dealt.select("*", *[F.expr(text).over(w).alias(name) for name, text in values.items()])
    return out.where("rolling_in = rolling_own").drop("rolling_at", "rolling_own", "rolling_in")
