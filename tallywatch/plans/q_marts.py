"""Staging, extract, marts, load manifest."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallywatch.operators import marts, staging
from tallywatch.plans.catalog import query
from tallywatch.session import settle, shared_dir
from tallywatch.sources.adapters import ENTITIES, Raw
from tallywatch.sources.tables import publish


@query("stg_transfers", "select * exclude (last_modified) from z_tr")
def _(raw: Raw):
    return staging.transfers(raw.transfers)


@query("stg_transactions", rounds="fee_eth:12", sql="""
    select date, block_timestamp, block_number, hash, from_address, to_address, direct_token, succeeded, fee_eth,
           transaction_type from z_stgtx""")
def _(raw: Raw):
    return staging.transactions(raw.transactions)


@query("stg_blocks", rounds="base_fee_gwei", sql="""
    select date, number as block_number, timestamp as block_timestamp, transaction_count, gas_used, gas_limit,
           base_fee_per_gas / 1e9 as base_fee_gwei from z_bl""")
def _(raw: Raw):
    return staging.blocks(raw.blocks)


@query("stg_load", rounds="max_lag_hours", sql="""
    select source_table, date, rows as source_rows, files, min_block, max_block, last_written,
           max_lag_s / 3600.0::double as max_lag_hours from z_load""")
def _(raw: Raw):
    return staging.load(raw.load)


@query("label_entity", """
    select hash, to_address, case lower(to_address) when '0xaaaa' then 'A' when '0xbbbb' then 'N' when '0xcccc' then 'R' end as entity
    from z_tx where lower(to_address) in ('0xaaaa', '0xbbbb', '0xcccc')""")
def _(raw: Raw):
    return staging.label_entity(raw.transactions.select("hash", "to_address"), "to_address", "entity", ENTITIES)


@query("extract_transfers", """
    select date, block_timestamp, block_number, log_index, transaction_hash, token, from_address, to_address,
           amount * 1e6 / 1e6 as amount, last_modified from z_tr""", rounds="amount:2")
def _(raw: Raw):
    source = (raw.transfers.withColumn("token_address", F.upper(F.element_at(
        F.create_map(*[F.lit(x) for kv in ENTITIES.items() for x in kv]), F.col("token"))))
        .withColumn("value", F.col("amount") * 1e6).drop("token", "amount"))
    return staging.extract_transfers(source, {t: a for t, a in ENTITIES.items()})


@query("extract_transactions", """
    select date, block_timestamp, block_number, transaction_index, hash, from_address, to_address,
           case lower(to_address) when '0xaaaa' then 'A' when '0xbbbb' then 'N' when '0xcccc' then 'R' end as direct_token,
           receipt_status, receipt_gas_used, receipt_effective_gas_price, transaction_type, last_modified
    from z_tx where lower(to_address) in ('0xaaaa', '0xbbbb', '0xcccc')
       or hash in (select transaction_hash from z_tr where amount < 100)""")
def _(raw: Raw):
    return staging.extract_transactions(raw.transactions, raw.transfers.where(F.col("amount") < 100), ENTITIES)


@query("mart_payments", "select * from z_pay", rounds="volume:2")
def _(raw: Raw):
    return marts.mart_payments(staging.transfers(raw.transfers), staging.transactions(raw.transactions), distinct="exact")


@query("mart_payments_approx", rounds="volume:2")
def _(raw: Raw):
    return marts.mart_payments(staging.transfers(raw.transfers), staging.transactions(raw.transactions))


def _published_cube(raw: Raw, labelled):
    """The cube with its sketches, published by month and read back."""
    path = f"{shared_dir(raw.spark)}/published/{uuid.uuid4().hex}"
    publish(marts.mart_sketches(staging.transfers(raw.transfers), staging.transactions(raw.transactions), labelled=labelled), path, "month")
    return raw.spark.read.parquet(path)


def _counted(raw: Raw, *keys: str):
    """Merged estimates beside exact counts of the same groups. Both read the labelled transfers, which are joined and written once."""
    needed = staging.transfers(raw.transfers).select("date", "token", "amount", *marts.COUNTED.values())
    labelled = settle(marts.labelled_transfers(needed, staging.transactions(raw.transactions)).select(*marts.CUBE, "amount", *marts.COUNTED.values()))
    merged = settle(marts.merged_counts(_published_cube(raw, labelled), *keys))
    exact = marts.exact_counts(labelled.withColumn("month", F.date_format("date", "yyyy-MM")), *keys).select(*keys, *[F.col(m).alias(f"exact_{m}") for m in marts.COUNTED])
    rows = merged.join(exact, list(keys))
    close = [marts.within_error(F.col(m), F.col(f"exact_{m}")) for m in marts.COUNTED]
    return rows.select(*keys, "transfers", "volume", *[F.col(f"exact_{m}").alias(m) for m in marts.COUNTED], (close[0] & close[1] & close[2]).alias("within_three_errors"))


def _counted_sql(keys: str) -> str:
    month = "strftime(date, '%Y-%m')"
    picked = ", ".join(f"{month} as month" if k == "month" else k for k in keys.split())
    return f"""select {picked}, count(*) as transfers, sum(amount) as volume, count(distinct transaction_hash) as transactions,
        count(distinct from_address) as senders, count(distinct to_address) as receivers, true as within_three_errors from z_labelled group by all"""


@query("payments_distinct_months", _counted_sql("month token"), rounds="volume:2")
def _(raw: Raw):
    return _counted(raw, "month", "token")


@query("payments_distinct_bands", _counted_sql("token amount_band route"), rounds="volume:2")
def _(raw: Raw):
    return _counted(raw, "token", "amount_band", "route")


@query("payments_distinct_tokens", _counted_sql("token"), rounds="volume:2")
def _(raw: Raw):
    return _counted(raw, "token")


@query("mart_health", "select * from z_health", rounds="failure_rate median_fee_eth:12 total_fee_eth:12")
def _(raw: Raw):
    return raw.health


@query("mart_blocks", "select * from z_pipe", rounds="avg_base_fee_gwei max_load_lag_hours")
def _(raw: Raw):
    return raw.pipeline


@query("load_manifest", "select * from z_load")
def _(raw: Raw):
    return raw.load


@query("load_summary", """
    select source_table, sum(files)::bigint as files, sum(rows)::bigint as rows, median(median_lag_s) as median_lag_s,
           max(max_lag_s) as max_lag_s, max(last_written) as last_written from z_load group by 1""")
def _(raw: Raw):
    return marts.load_summary(raw.load)


@query("entity_share", """
    with c as (select token, count(*) as transfers from z_tr where amount >= 1000 group by token),
    n as (select count(*) as total from z_tr)
    select token, transfers, transfers / total as share from c, n
    union all select 'All', sum(transfers)::bigint, sum(transfers) / any_value(total) from c, n""", rounds="share")
def _(raw: Raw):
    return marts.entity_share(raw.transfers.where(F.col("amount") >= 1000), raw.transfers)


@query("failure_rate", """
    select direct_token as token, count(*) as transactions, count(*) filter (where receipt_status = 0) as failed,
           count(*) filter (where receipt_status = 0) / count(*) as failure_rate
    from z_tx where direct_token is not null group by 1""", rounds="failure_rate")
def _(raw: Raw):
    return marts.failure_rate(raw.transactions)


@query("indirect_share", """
    select count(*) filter (where direct_token is null) as indirect, count(*) as transactions,
           count(*) filter (where direct_token is null) / count(*) as share from z_tx""", rounds="share")
def _(raw: Raw):
    return marts.indirect_share(raw.transactions)


@query("monthly_raw", """
    select date_trunc('month', date)::date as month, token, count(*) as transfers, sum(amount) as volume
    from z_tr group by all""", rounds="volume:2")
def _(raw: Raw):
    return marts.monthly_raw(raw.transfers)
