"""Column expressions shared by the operators. All are built-ins: they stay inside code generation."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.fixed_values import AMOUNT_BANDS, ROUTES, ZERO40


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, not an error, on a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def count_if(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def sum_if(condition: Column, value: Column) -> Column:
    """Null when no row meets the condition, like a filtered SQL sum."""
    return F.sum(F.when(condition, value))


def seconds_between(start: Column, end: Column) -> Column:
    return end.cast("timestamp").cast("long") - start.cast("timestamp").cast("long")


def minutes_crossed(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, not whole minutes elapsed."""
    def minute(c: Column) -> Column:
        return F.floor(c.cast("timestamp").cast("long") / 60)
    return minute(end) - minute(start)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def amount_band(amount: Column) -> Column:
    """The first band whose upper bound is above the amount; a null amount falls in the last one."""
    return _band(amount, 1)


def amount_band_order(amount: Column) -> Column:
    return _band(amount, 2)


def _band(amount: Column, field: int) -> Column:
    *bounded, last = AMOUNT_BANDS
    return reduce(lambda rest, band: F.when(amount < band[0], F.lit(band[field])).otherwise(rest),
                  reversed(bounded), F.lit(last[field]))


def route(direct_token: Column, token: Column) -> Column:
    return F.when(direct_token == token, ROUTES[0]).otherwise(ROUTES[1])


def last40(address: Column) -> Column:
    """Addresses come 20 or 32 bytes wide: both agree on the last 40 characters."""
    return F.right(address, F.lit(40))


def is_zero(address: Column) -> Column:
    return last40(address) == ZERO40


def entity_of(address: Column, entities: dict[str, str]) -> Column:
    """The entity an address belongs to, or null. Chained equality, so no per-row map lookup."""
    lowered = F.lower(address)
    return reduce(lambda rest, item: F.when(lowered == item[1], item[0]).otherwise(rest),
                  reversed(list(entities.items())), F.lit(None).cast("string"))


def address_of(entity: Column, entities: dict[str, str]) -> Column:
    return reduce(lambda rest, item: F.when(entity == item[0], item[1]).otherwise(rest),
                  reversed(list(entities.items())), F.lit(None).cast("string"))


def single(one_row: DataFrame) -> Column:
    """A one-row frame as a value: a scalar subquery, so no join carries it. Several columns come as a struct."""
    if len(one_row.columns) > 1:
        one_row = one_row.select(F.struct(*one_row.columns).alias("s"))
    return one_row.scalar()


def beside(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row frames side by side as one row."""
    for other in others:
        names = other.columns
        value = other.select(F.struct(*names).alias("s")).scalar()
        first = first.withColumn("other", value).select(*first.columns, *[F.col("other")[n].alias(n) for n in names])
    return first
