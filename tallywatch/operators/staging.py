"""Extract from the source tables, and the four staging projections."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.fixed_values import ENTITY_ADDRESSES, UNIT_SCALE, WEI_PER_ETH, WEI_PER_GWEI
from tallywatch.functions.columns import entity_of


def _in_months(df: DataFrame, months: list[str] | None) -> DataFrame:
    """A range per month on the partition column; all months when none is named."""
    if not months:
        return df
    keep = F.lit(False)
    for m in months:
        first = F.lit(f"{m}-01").cast("date")
        keep = keep | ((F.col("date") >= first) & (F.col("date") < F.add_months(first, 1)))
    return df.where(keep)


def label_entity(df: DataFrame, address: str, label: str, entities: dict[str, str] | None = None) -> DataFrame:
    """Rows of the entities only, with the entity's name."""
    return df.withColumn(label, entity_of(F.col(address), entities or ENTITY_ADDRESSES)).where(F.col(label).isNotNull())


def extract_transfers(source: DataFrame, entities: dict[str, str] | None = None) -> DataFrame:
    """Entity transfers out of all token transfers: labelled, lower-cased, in whole units."""
    written = [F.col("last_modified")] if "last_modified" in source.columns else []
    return (label_entity(source, "token_address", "token", entities)
            .select("date", "block_timestamp", "block_number", "log_index", "transaction_hash", "token",
                    F.lower("from_address").alias("from_address"), F.lower("to_address").alias("to_address"),
                    (F.col("value") / UNIT_SCALE).cast("double").alias("amount"), *written))


def extract_transactions(source: DataFrame, transfers: DataFrame, entities: dict[str, str] | None = None) -> DataFrame:
    """Direct calls to an entity, plus every transaction behind a transfer.

    The OR is split: direct calls never enter the join, the rest is semi-joined once against distinct hashes.
    """
    labelled = source.withColumn("direct_token", entity_of(F.col("to_address"), entities or ENTITY_ADDRESSES))
    direct = labelled.where(F.col("direct_token").isNotNull())
    moved = transfers.select(F.col("transaction_hash").alias("hash")).distinct()
    behind = labelled.where(F.col("direct_token").isNull()).join(moved, "hash", "left_semi").select(*labelled.columns)
    written = ["last_modified"] if "last_modified" in source.columns else []
    return direct.unionByName(behind).select(
        "date", "block_timestamp", "block_number", "transaction_index", "hash",
        F.lower("from_address").alias("from_address"), F.lower("to_address").alias("to_address"), "direct_token",
        "receipt_status", "receipt_gas_used", "receipt_effective_gas_price", "transaction_type", *written)


def transfers(raw: DataFrame, months: list[str] | None = None) -> DataFrame:
    return _in_months(raw, months).select(
        "date", "block_timestamp", "block_number", "log_index", "transaction_hash", "token", "from_address",
        "to_address", "amount")


def transactions(raw: DataFrame, months: list[str] | None = None) -> DataFrame:
    fee = F.col("receipt_gas_used").cast("double") * F.col("receipt_effective_gas_price") / WEI_PER_ETH
    return _in_months(raw, months).select(
        "date", "block_timestamp", "block_number", "hash", "from_address", "to_address", "direct_token",
        (F.col("receipt_status") == 1).alias("succeeded"), fee.alias("fee_eth"), "transaction_type")


def blocks(raw: DataFrame, months: list[str] | None = None) -> DataFrame:
    return _in_months(raw, months).select(
        "date", F.col("number").alias("block_number"), F.col("timestamp").alias("block_timestamp"),
        "transaction_count", "gas_used", "gas_limit",
        (F.col("base_fee_per_gas") / WEI_PER_GWEI).alias("base_fee_gwei"))


def load(raw: DataFrame, months: list[str] | None = None) -> DataFrame:
    return _in_months(raw, months).select(
        "source_table", "date", F.col("rows").alias("source_rows"), "files", "min_block", "max_block", "last_written",
        (F.col("max_lag_s") / 3600.0).cast("double").alias("max_lag_hours"))
