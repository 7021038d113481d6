"""Daily marts and the load manifest."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.columns import amount_band, amount_band_order, count_if, month_key, ratio, route, seconds_between, single, sum_if
from tallywatch.functions.joins import spread_join
from tallywatch.functions.quantiles import exact_quantiles
from tallywatch.session import settle

CUBE = ["date", "token", "amount_band", "amount_band_order", "route"]


#: Distinct counts that the cube keeps as sketches, and the columns they count.
COUNTED = {"transactions": "transaction_hash", "senders": "from_address", "receivers": "to_address"}
#: 2 ** LOG_SIZE registers: the standard error of a merged estimate is 1.04 / sqrt(2 ** LOG_SIZE), 0.8 %.
LOG_SIZE = 14


def labelled_transfers(tr: DataFrame, tx: DataFrame) -> DataFrame:
    """Transfers with their band and route. One shuffle join on the hash; hashes that hold many rows are spread over many tasks."""
    direct = tx.select(F.col("hash").alias("transaction_hash"), "direct_token")
    return (spread_join(tr, direct, "transaction_hash")
            .withColumn("amount_band", amount_band(F.col("amount")))
            .withColumn("amount_band_order", amount_band_order(F.col("amount")))
            .withColumn("route", route(F.col("direct_token"), F.col("token"))))


def mart_payments(tr: DataFrame, tx: DataFrame, distinct: str | None = "approx") -> DataFrame:
    """The daily cube: one row per day, token, band and route.

    distinct "approx": HyperLogLog sketches, which merge map-side. "exact": for checking; see `exact_counts`.
    None: counts and value only. Only the columns a form needs meet the transactions, in one shuffle join.
    """
    needed = ["date", "token", "transaction_hash", "amount"] + ([] if distinct is None else ["from_address", "to_address"])
    labelled = labelled_transfers(tr.select(*needed), tx)
    if distinct == "exact":
        per_cell = exact_counts(settle(labelled.select(*CUBE, "amount", *COUNTED.values())), *CUBE)
    else:
        sketches = [F.approx_count_distinct(c).alias(m) for m, c in COUNTED.items()] if distinct == "approx" else []
        per_cell = labelled.groupBy(*CUBE).agg(F.count(F.lit(1)).alias("transfers"), F.sum("amount").alias("volume"), *sketches)
    return (per_cell.withColumn("month", month_key(F.col("date")))
            .withColumn("cube_key", F.concat_ws("|", "date", "token", "amount_band", "route"))
            .select("month", *CUBE, "cube_key", *[c for c in per_cell.columns if c not in CUBE]))


def exact_counts(labelled: DataFrame, *keys: str) -> DataFrame:
    """Transfers, value and exact distinct counts per group of any columns of labelled transfers. Null hashes and addresses are not counted.

    Several distinct counts in one aggregation would copy every row once per count and hold all copies in one task's table. Here each
    column is counted on its own, so `labelled` should be written."""
    first, *others = COUNTED.items()
    none = [F.lit(None).cast("long").alias("transfers"), F.lit(None).cast("double").alias("volume")]
    parts = labelled.groupBy(*keys).agg(F.count(F.lit(1)).alias("transfers"), F.sum("amount").alias("volume"), F.count_distinct(first[1]).alias(first[0]))
    for measure, column in others:
        parts = parts.unionByName(labelled.groupBy(*keys).agg(F.count_distinct(column).alias(measure)).select(*keys, *none, measure), allowMissingColumns=True)
    # One row per group and part: the sum takes the one that is there, and groups by null keys, too.
    return parts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in ("transfers", "volume", *COUNTED)])


def mart_sketches(tr: DataFrame, tx: DataFrame, log_size: int = LOG_SIZE, labelled: DataFrame | None = None) -> DataFrame:
    """The daily cube with mergeable sketches of its distinct hashes, senders and receivers (`<measure>_sketch`) beside counts and value.

    Transfers meet their transactions in one shuffle join that spreads hashes of many rows; `labelled` gives that join's rows where they are
    already there. Null hashes and addresses are not counted."""
    if labelled is None:
        labelled = labelled_transfers(tr.select("date", "token", "amount", *COUNTED.values()), tx)
    out = labelled.groupBy(*CUBE).agg(F.count(F.lit(1)).alias("transfers"), F.sum("amount").alias("volume"),
                                      *[F.hll_sketch_agg(c, log_size).alias(f"{m}_sketch") for m, c in COUNTED.items()])
    return out.withColumn("month", month_key(F.col("date"))).select("month", *CUBE, "transfers", "volume", *[f"{m}_sketch" for m in COUNTED])


def merged_counts(cube: DataFrame, *keys: str) -> DataFrame:
    """Transfers, value and estimated distinct counts by any columns of the cube, from its rows alone: months, bands or routes merge
    without the raw rows. Distinct counts can't be added, their sketches can be united."""
    return cube.groupBy(*keys).agg(F.sum("transfers").alias("transfers"), F.sum("volume").alias("volume"),
                                   *[F.hll_sketch_estimate(F.hll_union_agg(f"{m}_sketch")).alias(m) for m in COUNTED])


def within_error(estimate, exact, log_size: int = LOG_SIZE, errors: float = 3.0):
    """Whether an estimate lies within so many standard errors of the exact count (rounded to whole counts)."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), F.ceil(exact * F.lit(errors * 1.04 / (1 << log_size) ** 0.5)))


def mart_health(tx: DataFrame) -> DataFrame:
    """Direct calls, failures and fees per day and token. The median is exact and never held by one task."""
    direct = tx.where(F.col("direct_token").isNotNull()).withColumnRenamed("direct_token", "token")
    sums = direct.groupBy("date", "token").agg(
        F.count(F.lit(1)).alias("direct_calls"), count_if(~F.col("succeeded")).alias("failed_calls"),
        F.sum("fee_eth").alias("total_fee_eth"))
    medians = exact_quantiles(direct, ["date", "token"], F.col("fee_eth"), [0.5])
    return (sums.join(medians, ["date", "token"], "left").select(
        month_key(F.col("date")).alias("month"), "date", "token", F.concat_ws("|", "date", "token").alias("health_key"),
        "direct_calls", "failed_calls", ratio(F.col("failed_calls"), F.col("direct_calls")).alias("failure_rate"),
        F.get("q", F.lit(0)).alias("median_fee_eth"), "total_fee_eth"))


def mart_pipeline(bl: DataFrame, tr: DataFrame, load: DataFrame) -> DataFrame:
    """One row per day: is the data complete and on time? Blocks, transfers and loads are each reduced to days first."""
    blocks = bl.groupBy("date").agg(
        F.count(F.lit(1)).alias("blocks"), F.count_distinct("block_number").alias("numbers"),
        (F.max("block_number") - F.min("block_number") + 1).alias("range"),
        F.avg("base_fee_gwei").alias("avg_base_fee_gwei"))
    moved = tr.groupBy("date").agg(F.count(F.lit(1)).alias("stablecoin_transfers"))

    def rows_of(table: str):
        return sum_if(F.col("source_table") == table, F.col("source_rows"))

    loads = load.groupBy("date").agg(
        rows_of("token_transfers").alias("source_transfer_rows"), rows_of("transactions").alias("source_transaction_rows"),
        F.sum("files").alias("source_files"), F.max("max_lag_hours").alias("max_load_lag_hours"),
        F.max("last_written").alias("last_written"))
    return (blocks.join(moved, "date", "left").join(loads, "date", "left").select(
        month_key(F.col("date")).alias("month"), "date", "blocks", (F.col("range") - F.col("numbers")).alias("missing_blocks"),
        (F.col("blocks") - F.col("numbers")).alias("duplicate_blocks"), "avg_base_fee_gwei", "stablecoin_transfers",
        "source_transfer_rows", "source_transaction_rows", "source_files", "max_load_lag_hours", "last_written"))


def load_manifest(sources: dict[str, DataFrame]) -> DataFrame:
    """What arrived per table and day: rows, files, block range, write times, lag of the rows.

    The three sources share one aggregation, so its shuffles are not tripled.
    """
    rows = _stacked(sources)
    # Lags are whole seconds: per file and lag a day shrinks to at most as many rows as there are seconds between its
    # first and last write, so the weighted median is bounded by time and not by the number of rows.
    per_lag = rows.groupBy("source_table", "date", "file_name", "lag").agg(
        F.count(F.lit(1)).alias("n"), F.min("block").alias("b0"), F.max("block").alias("b1"),
        F.min("written").alias("w0"), F.max("written").alias("w1"))
    return per_lag.groupBy("source_table", "date").agg(
        F.sum("n").alias("rows"), F.size(F.collect_set("file_name")).cast("long").alias("files"),
        F.min("b0").alias("min_block"), F.max("b1").alias("max_block"), F.min("w0").alias("first_written"),
        F.max("w1").alias("last_written"), F.percentile("lag", F.lit(0.5), F.col("n")).alias("median_lag_s"),
        F.max("lag").alias("max_lag_s"))


def _stacked(sources: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in sources.items():
        block, time = ("number", "timestamp") if name == "blocks" else ("block_number", "block_timestamp")
        written = F.col("last_modified") if "last_modified" in df.columns else F.lit(None).cast("timestamp_ntz")
        part = df.select(F.lit(name).alias("source_table"), "date", "file_name", F.col(block).alias("block"),
                         written.alias("written"), seconds_between(F.col(time), written).alias("lag"))
        out = part if out is None else out.unionByName(part)
    return out


def load_summary(manifest: DataFrame) -> DataFrame:
    """Per source table. Its groups hold one row per day, so a plain percentile is bounded."""
    return manifest.groupBy("source_table").agg(
        F.sum("files").alias("files"), F.sum("rows").alias("rows"), F.percentile("median_lag_s", F.lit(0.5)).alias("median_lag_s"),
        F.max("max_lag_s").alias("max_lag_s"), F.max("last_written").alias("last_written"))


def entity_share(transfers: DataFrame, all_rows: DataFrame) -> DataFrame:
    """Transfers per token, and of all tokens together, as a share of every row of the source."""
    counts = transfers.rollup("token").agg(F.count(F.lit(1)).alias("transfers"))
    whole = single(all_rows.agg(F.count(F.lit(1)).alias("total")))
    return counts.withColumn("total", whole).select(
        F.coalesce("token", F.lit("All")).alias("token"), "transfers", ratio(F.col("transfers"), F.col("total")).alias("share"))


def failure_rate(tx: DataFrame) -> DataFrame:
    return (tx.where(F.col("direct_token").isNotNull()).groupBy(F.col("direct_token").alias("token"))
            .agg(F.count(F.lit(1)).alias("transactions"), count_if(F.col("receipt_status") == 0).alias("failed"))
            .withColumn("failure_rate", ratio(F.col("failed"), F.col("transactions"))))


def indirect_share(tx: DataFrame) -> DataFrame:
    return (tx.agg(count_if(F.col("direct_token").isNull()).alias("indirect"), F.count(F.lit(1)).alias("transactions"))
            .withColumn("share", ratio(F.col("indirect"), F.col("transactions"))))


def monthly_raw(tr: DataFrame) -> DataFrame:
    return tr.groupBy(F.trunc("date", "month").alias("month"), "token").agg(
        F.count(F.lit(1)).alias("transfers"), F.sum("amount").alias("volume"))
