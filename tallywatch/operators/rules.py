"""Sixteen rules no row may break, counted per day over all months at once.

Transfers meet their transactions in one shuffle of the columns the rules read. A transaction that holds a large part of
the rows is spread, so it does not become one task's join key.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.fixed_values import ENTITY_ADDRESSES, ROW_RULES
from tallywatch.functions.columns import address_of, month_key
from tallywatch.functions.joins import spread_join
from tallywatch.session import settle

NUMBERS_PER_CHUNK = 10_000


def _tally(rows: DataFrame, key: str, rules: dict[str, str], checked: str = "sum(n)") -> DataFrame:
    """Per day: rows checked, and per rule the weight and the smallest key of the rows that break it."""
    out = []
    for i, condition in enumerate(rules.values()):
        out += [F.expr(f"coalesce(sum(n) filter (where {condition}), 0) as v{i}"),
                F.expr(f"min({key}) filter (where {condition}) as e{i}")]
    days = rows.groupBy("date").agg(F.expr(f"{checked} as checked"), *out)
    cells = ", ".join("struct('{}' as check, v{i} as violations, e{i} as example)".format(r.replace("'", "\\'"), i=i)
                      for i, r in enumerate(rules))
    return days.select("date", "checked", F.explode(F.expr(f"array({cells})")).alias("c")).select("date", "checked", "c.*")


def _repeats(df: DataFrame, keys: list[str], label: str, rule: str) -> DataFrame:
    """Rows beyond the first per day and key. Days without any are added by `rules_daily`."""
    again = df.groupBy("date", *keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return again.groupBy("date").agg(F.expr("cast(null as bigint) as checked"), F.lit(rule).alias("check"),
                                     F.expr("sum(n - 1) as violations"), F.expr(f"min({label}) as example"))


def rules_transfers(tr: DataFrame, tx: DataFrame, bl: DataFrame) -> DataFrame:
    placed = tr.select("date", "transaction_hash", "block_number", "block_timestamp", F.expr("amount < 0").alias("negative"), month_key(F.col("date")).alias("month_of"))
    calls = tx.selectExpr("month_of", "hash as transaction_hash", "receipt_status", "block_number as x_block", "block_timestamp as x_time")
    blocks = bl.selectExpr("month_of", "number as block_number", "timestamp as b_time")
    rows = (spread_join(placed, calls, "transaction_hash", also=("month_of",)).withColumn("n", F.lit(1))
            .join(blocks, ["month_of", "block_number"], "left"))
    return _tally(rows, "transaction_hash", {
        "transfer in a failed transaction": "receipt_status = 0",
        "transfer and its transaction in different blocks": "x_block <> block_number or x_time <> block_timestamp",
        "transfer time differs from its block": "not (b_time <=> block_timestamp)",
        "negative amount": "negative",
        "transfer stored under the wrong day": "to_date(block_timestamp) <> date"})


def rules_transactions(tx: DataFrame, bl: DataFrame, entities: dict[str, str]) -> DataFrame:
    blocks = bl.selectExpr("month_of", "number as block_number", "timestamp as b_time", "base_fee_per_gas", "transaction_count")
    rows = (tx.withColumn("right_address", address_of(F.col("direct_token"), entities)).withColumn("n", F.lit(1))
            .join(blocks, ["month_of", "block_number"], "left"))
    return _tally(rows, "hash", {
        "fee below the block's base fee": "receipt_effective_gas_price < base_fee_per_gas",
        "transaction time differs from its block": "not (b_time <=> block_timestamp)",
        "transaction index beyond the block's size": "transaction_index >= transaction_count",
        "transaction stored under the wrong day": "to_date(block_timestamp) <> date",
        "direct call labelled with the wrong token": "direct_token is not null and lower(to_address) <> right_address"})


def rules_blocks(bl: DataFrame) -> DataFrame:
    """Each block against the one before it in its month.

    A month is too long for one sorted task, so blocks are ordered inside chunks of numbers and each chunk takes the
    last block of the chunk before it. Copies of a block are one row with a weight: the second copy follows the first,
    so it never breaks the chain but always fails to move time on.
    """
    order = ["number", "hash", "parent_hash", "timestamp", "date"]
    one = (bl.groupBy("month_of", *order, F.expr("gas_used > gas_limit").alias("over")).agg(F.count(F.lit(1)).alias("n"))
           .withColumn("chunk", F.floor(F.col("number") / NUMBERS_PER_CHUNK)))
    last = F.struct("number", "hash", "timestamp")
    inside = Window.partitionBy("month_of", "chunk").orderBy(*order)
    ends = one.groupBy("month_of", "chunk").agg(F.max_by(last, F.struct(*order)).alias("end"))
    before = ends.select("month_of", "chunk", F.lag("end").over(Window.partitionBy("month_of").orderBy("chunk")).alias("carried"))
    rows = (one.withColumn("prev", F.lag(last).over(inside)).join(before, ["month_of", "chunk"])
            .withColumn("prev", F.coalesce("prev", "carried")))
    broken, stuck = "prev.number = number - 1 and parent_hash <> prev.hash", "timestamp <= prev.timestamp"
    # Copies: only the first is compared with the block before; every further copy repeats its time.
    chained = rows.selectExpr("*", f"if({broken}, 1, 0) as broken", f"n - 1 + if({stuck}, 1, 0) as stuck")
    days = chained.groupBy("date").agg(F.expr("sum(n) as checked"), F.expr("""array(
        struct('parent hash does not match the previous block' as check, sum(broken) as violations,
               min(cast(number as string)) filter (where broken > 0) as example),
        struct('block time not after the previous block' as check, sum(stuck) as violations,
               min(cast(number as string)) filter (where stuck > 0) as example),
        struct('block over its gas limit' as check, coalesce(sum(n) filter (where over), 0) as violations,
               min(cast(number as string)) filter (where over) as example),
        struct('block stored under the wrong day' as check, coalesce(sum(n) filter (where to_date(timestamp) <> date), 0) as violations,
               min(cast(number as string)) filter (where to_date(timestamp) <> date) as example)) as c"""))
    return days.select("date", "checked", F.explode("c").alias("c")).select("date", "checked", "c.*")


def rules_daily(tr: DataFrame, tx: DataFrame, bl: DataFrame, entities: dict[str, str] | None = None) -> DataFrame:
    """One row per rule and day, clean days included, so a zero always says how many rows were checked."""
    # Blocks are read by three parts. Written, their size is known, so where they are few the rows of the others need no shuffle.
    tx, bl = (df.withColumn("month_of", month_key(F.col("date"))) for df in (tx, settle(bl)))
    found = settle(reduce(DataFrame.unionByName, [
        rules_transfers(tr, tx, bl), rules_transactions(tx, bl, entities or ENTITY_ADDRESSES), rules_blocks(bl),
        _repeats(tr, ["block_number", "log_index"], "concat(block_number, ':', log_index)", "repeated log index in a block"),
        _repeats(tx, ["block_number", "transaction_index"], "concat(block_number, ':', transaction_index)",
                 "repeated transaction index in a block")]))   # written: a few rows per day, read three times below
    # Rules and days: one small row each. Every day is paired with every rule by a single exploded list.
    rules = F.expr("array(" + ", ".join("struct('{}' as check, '{}' as table, '{}' as fault)".format(
        c.replace("'", "\\'"), t, f) for c, t, f in ROW_RULES) + ")")
    per_rule = found.groupBy("date", "check").agg(F.sum("violations").alias("violations"), F.min("example").alias("example"))
    tables = {c: t for c, t, _ in ROW_RULES}
    table_of = F.expr("case check " + " ".join("when '{}' then '{}'".format(c.replace("'", "\\'"), t) for c, t in tables.items()) + " end")
    checked = (found.where("checked is not null").withColumn("table", table_of).groupBy("date", "table")
               .agg(F.max("checked").alias("checked")))
    grid = checked.select("date").distinct().select("date", F.explode(rules).alias("r")).select("date", "r.*")
    return (grid.join(per_rule, ["date", "check"], "left").join(checked, ["date", "table"], "left").select(
        month_key(F.col("date")).alias("month"), "date", "check", "table", "fault",
        F.coalesce("checked", F.lit(0)).alias("checked"), F.coalesce("violations", F.lit(0)).alias("violations"),
        F.when(F.col("violations") > 0, F.col("example")).alias("example")))


def rules_summary(daily: DataFrame) -> DataFrame:
    """One row per rule with its place in the list of rules."""
    rank = F.expr("case check " + " ".join("when '{}' then {}".format(c.replace("'", "\\'"), i)
                                           for i, (c, _, _) in enumerate(ROW_RULES)) + " end")
    hit = "filter (where violations > 0)"
    return (daily.groupBy("check", F.col("table").alias("tbl"), "fault").agg(
        F.sum("checked").alias("rows_checked"), F.sum("violations").alias("violations"),
        F.expr("count_if(violations > 0) as days_affected"), F.expr(f"min(date) {hit} as first_day"),
        F.expr(f"max(date) {hit} as last_day"), F.expr(f"min(example) {hit} as example")).withColumn("position", (rank + 1).cast("long")).orderBy("position"))


def rules_totals(summary: DataFrame) -> DataFrame:
    """Rows checked over all tables, each table counted once, and rows that break a rule."""
    per_table = summary.groupBy("tbl").agg(F.max("rows_checked").alias("rows_checked"), F.sum("violations").alias("violations"),
                                           F.expr("count_if(violations > 0) as rules_broken"))
    return per_table.agg(F.sum("rows_checked").alias("rows_checked"), F.sum("violations").alias("violations"),
                         F.sum("rules_broken").alias("rules_broken"))
