"""Publishing and scanning partitioned tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.plans.catalog import query
from tallywatch.session import settle, shared_dir
from tallywatch.sources.adapters import Raw
from tallywatch.sources.tables import keep_others, list_days, listing, publish, scan, with_month, write_json_lines, write_result


def published(raw: Raw, df) -> str:
    path = f"{shared_dir(raw.spark)}/published/{uuid.uuid4().hex}"
    publish(df, path, "date", ["number"])
    return path


DAILY = "select date, token, count(*) as calls, count(*) filter (where failed) as failed, sum(amount) as amount from {} group by date, token"


def daily(df):
    return df.groupBy("date", "token").agg(F.count(F.lit(1)).alias("calls"), F.expr("count_if(failed) as failed"), F.sum("amount").alias("amount"))


@query("scan_month", DAILY.format("z_calls") .replace(" group", " where date >= date '2024-01-01' and date < date '2024-02-01' group"), rounds="amount:2")
def _(raw: Raw):
    return daily(scan(raw.spark, published(raw, raw.calls), months=["2024-01"]))


@query("scan_days", DAILY.format("z_calls").replace(" group", " where date in (select max(date) - i from z_calls, (select unnest([0, 7, 14]) as i) group by i) group"),
       rounds="amount:2")
def _(raw: Raw):
    path = published(raw, raw.calls)
    wanted = raw.calls.agg(F.max("date").alias("m")).select(F.explode(F.expr("array(m, date_sub(m, 7), date_sub(m, 14))")).alias("date"))
    return daily(scan(raw.spark, path, days=wanted))


@query("publish_replace", """
    select date, count(*) as calls, count(distinct number) as numbers,
           sum(case when day(date) % 5 = 0 then amount * 2 else amount end) as amount from z_calls group by date""", rounds="amount:2")
def _(raw: Raw):
    """A second publish of some days replaces those days and leaves the others."""
    path = published(raw, raw.calls)
    again = raw.calls.where("day(date) % 5 = 0").withColumn("amount", F.col("amount") * 2)
    publish(again, path, "date", ["number"])
    return scan(raw.spark, path).groupBy("date").agg(
        F.count(F.lit(1)).alias("calls"), F.count_distinct("number").alias("numbers"), F.sum("amount").alias("amount"))


@query("keep_others", """
    select strftime(date, '%Y-%m') as month, date, case when strftime(date, '%Y-%m') < '1998-01' then 1 else 2 end as version, count(*) as transfers
    from z_tr group by all""")
def _(raw: Raw):
    days = with_month(raw.transfers.groupBy("date").agg(F.count(F.lit(1)).alias("transfers")))
    old = settle(days.withColumn("version", F.lit(1)))
    return keep_others(old, old.where("month >= '1998-01'").withColumn("version", F.lit(2)))


@query("source_listing", "select * from (select 'calls' as source_table, date from z_calls union select 'transfers', date from z_tr)")
def _(raw: Raw):
    return listing({"calls": raw.calls, "transfers": raw.transfers})


@query("scan_files", "select 'orders.parquet' as file_name, count(*) as rows from orders")
def _(raw: Raw):
    return scan(raw.spark, f"{raw.sf_dir}/orders.parquet", with_file=True).groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))


@query("folder_listing", "select distinct 'calls' as source_table, date from z_calls")
def _(raw: Raw):
    """Days from folder names: no file is opened."""
    return list_days(raw.spark, {"calls": published(raw, raw.calls), "absent": f"{shared_dir(raw.spark)}/none"})


@query("scan_drift", """
    select date, token, count(*) as calls, sum(case when day(date) % 3 = 0 then floor(amount) else amount end) as amount,
           count(case when day(date) % 3 <> 1 then number end) as numbered from z_calls group by date, token""", rounds="amount:2")
def _(raw: Raw):
    """Days whose files have amounts as whole numbers, days without a column, days with one more, and an absent table."""
    path = f"{shared_dir(raw.spark)}/drift/{uuid.uuid4().hex}"
    schema = T.StructType.fromDDL("date date, token string, number bigint, amount double")
    rows = raw.calls.select(*schema.names)
    changes = (lambda d: d.withColumn("amount", F.floor("amount").cast("bigint")), lambda d: d.drop("number"), lambda d: d.withColumn("extra", F.lit(1)))
    for kind, change in enumerate(changes):
        publish(change(rows.where(f"day(date) % 3 = {kind}")), path)
    table = scan(raw.spark, path, schema).unionByName(scan(raw.spark, f"{path}-absent", schema), allowMissingColumns=True)
    return table.groupBy("date", "token").agg(F.count(F.lit(1)).alias("calls"), F.sum("amount").alias("amount"), F.count("number").alias("numbered"))


@query("written_results", DAILY.format("z_calls"), rounds="amount:2")
def _(raw: Raw):
    """Results go to Parquet and to JSON lines, and both read back alike; the lines are returned."""
    path = f"{shared_dir(raw.spark)}/results/{uuid.uuid4().hex}"
    rows = daily(raw.calls)
    write_result(rows, f"{path}/table")
    table = raw.spark.read.parquet(f"{path}/table")
    write_json_lines(table, f"{path}/lines")
    return raw.spark.read.schema(table.schema).json(f"{path}/lines")
