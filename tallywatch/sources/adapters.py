"""Views that give the benchmark tables the shape of the raw tables, with faults planted by rule.

The same definitions stand in `plans/oracle.py` as SQL. See FIXTURES.md.
"""
from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.operators import marts, staging
from tallywatch.sources.tables import listing

TOKENS = ["A", "N", "R"]
ENTITIES = {"A": "0xaaaa", "N": "0xbbbb", "R": "0xcccc"}
EPOCH = "1995-01-01"


# SQL text keeps each view to one call into the JVM.
DAY = f"datediff(date, date'{EPOCH}')"
MOMENT = f"""cast(date as timestamp_ntz) + make_dt_interval(0, cast(hour as int),
             case when hour = 23 and {DAY} % 29 <> 0 then 55 else 0 end)"""


def _written(key: str) -> str:
    """Most rows are written two hours later; some days partly, and others wholly, days later."""
    return (f"moment + make_dt_interval(0, case when {DAY} % 41 = 0 then 90 "
            f"when {DAY} % 13 = 0 and {key} % 2 = 0 then 60 else 2 end) as last_modified")


class Raw:
    """The raw tables and the daily marts built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def transfers(self) -> DataFrame:
        return (self.table("lineitem")
                .selectExpr("*", "to_date(l_shipdate) as date", "l_partkey % 24 as hour")
                .selectExpr("*", f"{MOMENT} as moment")
                .selectExpr(
                    "date",
                    "moment + make_dt_interval(0, case when l_suppkey % 97 = 0 then 24 else 0 end) as block_timestamp",
                    f"cast({DAY} as bigint) * 24 + hour as block_number",
                    "cast(l_linenumber as bigint) as log_index", "cast(l_orderkey as string) as transaction_hash",
                    "l_returnflag as token",
                    "concat('0x', lpad(if(l_suppkey % 25 = 0, '', cast(l_suppkey as string)), 64, '0')) as from_address",
                    "concat('0x', lpad(if(l_partkey % 40 = 7, '', cast(l_partkey as string)), 64, '0')) as to_address",
                    """cast(case l_linenumber when 7 then (l_partkey % 100) / 100 when 6 then l_quantity
                            else l_extendedprice end as double) as amount""",
                    _written("l_partkey")))

    @cached_property
    def transactions(self) -> DataFrame:
        tokens = ", ".join(f"'{t}'" for t in TOKENS)
        contract = " ".join(f"when '{t}' then '{a}'" for t, a in ENTITIES.items())
        return (self.table("orders")
                .selectExpr("*", "to_date(o_orderdate) as date", "o_custkey % 24 as hour",
                            f"case when o_custkey % 10 < 7 then get(array({tokens}), cast(o_orderkey % 3 as int)) end as direct_token")
                .selectExpr("*", f"{MOMENT} as moment")
                .selectExpr(
                    "date", "moment as block_timestamp", f"cast({DAY} as bigint) * 24 + hour as block_number",
                    "o_orderkey % 40 as transaction_index", "cast(o_orderkey as string) as hash",
                    "concat('0x', lpad(cast(o_custkey as string), 40, '0')) as from_address",
                    f"""case when direct_token is null or o_orderkey % 53 = 0
                             then concat('0x', lpad(cast(o_orderkey as string), 40, '0'))
                             else case direct_token {contract} end end as to_address""",
                    "direct_token", "cast(if(o_orderstatus = 'F', 0, 1) as bigint) as receipt_status",
                    "21000 + 1000 * (o_custkey % 4) as receipt_gas_used",
                    "cast(round(o_totalprice * 1000000) as bigint) as receipt_effective_gas_price",
                    "cast(2 as bigint) as transaction_type", _written("o_custkey")))

    @cached_property
    def blocks(self) -> DataFrame:
        """A block an hour on every day that has line items, with planted gaps, copies and broken links."""
        return (self.table("lineitem").selectExpr("to_date(l_shipdate) as date").distinct()
                .selectExpr("date", "explode(sequence(0, 23)) as hour")
                .selectExpr("date", f"cast({DAY} as bigint) * 24 + hour as number", f"{MOMENT} as moment")
                .where("number % 1009 <> 3")
                .selectExpr("*", "explode(sequence(1, if(number % 2003 = 5, 2, 1))) as copy")
                .selectExpr(
                    "date", "number", "md5(cast(number as string)) as hash",
                    "if(number % 1511 = 7, 'bad', md5(cast(number - 1 as string))) as parent_hash",
                    """moment + make_dt_interval(0, if(number % 3001 = 11, 24, 0) + if(number % 1709 = 9, -2, 0))
                       as timestamp""",
                    "cast(38 as bigint) as transaction_count", "15000000 + (number % 100) * 100000 as gas_used",
                    "cast(24850000 as bigint) as gas_limit",
                    "20000000000 + (number * 7919 % 1000) * 100000000 as base_fee_per_gas",
                    f"moment + make_dt_interval(0, if({DAY} % 41 = 0, 72, 1)) as last_modified"))

    @cached_property
    def calls(self) -> DataFrame:
        """The event stream as a day-partitioned call log."""
        tokens = ", ".join(f"'{t}'" for t in TOKENS)
        return self.table("events").selectExpr(
            "to_date(ts) as date", "ts as block_timestamp",
            f"get(array({tokens}), cast(user_id % 3 as int)) as token", "user_id as sender",
            "event_type = 'error' as failed", "cast(get_json_object(props, '$.k') as bigint) as gas", "value as amount",
            "event_id as number")

    @cached_property
    def sources(self) -> dict[str, DataFrame]:
        # The file a row came from is only known at the scan; here each source is one file.
        return {"token_transfers": self.transfers.withColumn("file_name", F.lit("lineitem.parquet")),
                "transactions": self.transactions.withColumn("file_name", F.lit("orders.parquet")),
                "blocks": self.blocks.withColumn("file_name", F.lit("lineitem.parquet"))}

    @cached_property
    def load(self) -> DataFrame:
        return marts.load_manifest(self.sources)

    @cached_property
    def listing(self) -> DataFrame:
        return listing(self.sources)

    # Daily marts

    @cached_property
    def payments(self) -> DataFrame:
        return marts.mart_payments(staging.transfers(self.transfers), staging.transactions(self.transactions), distinct=None)

    @cached_property
    def health(self) -> DataFrame:
        return marts.mart_health(staging.transactions(self.transactions))

    @cached_property
    def pipeline(self) -> DataFrame:
        return marts.mart_pipeline(staging.blocks(self.blocks), staging.transfers(self.transfers), staging.load(self.load))
