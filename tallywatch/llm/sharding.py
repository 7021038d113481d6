"""Sharding by proportional stratified interleaving, in DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywatch.session import settle

#: Rows that one sort task should get, in the mean.
TASK_ROWS = 50_000


def _ranked(rows: DataFrame, group: list[str], bucket: str, order: list[Column], out: str, size: str | None = None) -> DataFrame:
    """0-based rank of each row within its group, and the group's size. Rows are sorted within (group, bucket) only; buckets follow
    the order, so the counts of the buckets before give the rest. A hot group is spread over its buckets."""
    keys = [*group, bucket]
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1) if group else W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    counts = (counts.withColumn(size, F.sum("_n").over(W.partitionBy(*group))) if size else counts).drop("_n")
    inside = F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1
    return rows.withColumn("_inside", inside).join(counts, keys).withColumn(out, F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def interleave(docs: DataFrame, shards: int, seed: str = "0", source: str = "source", task_rows: int = TASK_ROWS) -> DataFrame:
    """Adds `shard` and `slot`: counts of shards are at most one apart, and so are those of every source, within rounding.

    Method: rows of a source are shuffled by a seeded hash and ranked; (2 * rank + 1) / (2 * rows of the source) is a row's
    fractional rank; rows are ordered by it over all sources and cut into `shards` equal ranges. Both rankings sort only within
    buckets (of hash, of fractional rank) of about `task_rows` rows and add the counts of the buckets before, so neither a hot
    source nor the whole table meets in one task. Only the columns given (pass no texts) move through the shuffles.

    A null source is a source of its own. Ties of the hash go by doc_id, then by the other columns; wholly equal rows are
    interchangeable. Empty table: no rows.
    """
    n = docs.count()
    buckets = max(1, -(-n // task_rows))
    names = [c for c in docs.columns if c not in (source, "doc_id")]
    ties = [F.col("doc_id"), *[F.col(c) for c in names]]
    rows = docs.withColumn("_stratum", F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("")))
    # md5 gives the same shuffle in any SQL engine.
    rows = rows.withColumn("_u", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))
    part = F.floor(F.conv(F.substring("_u", 1, 8), 16, 10).cast("long") * F.lit(buckets) / F.lit(1 << 32)).cast("int")
    rows = _ranked(rows.withColumn("_bucket", part), ["_stratum"], "_bucket", [F.col("_u"), *ties], "_rank", "_size")
    rows = settle(rows)
    rows = rows.withColumn("_f", (2 * F.col("_rank") + 1) / (2 * F.col("_size")))
    rows = rows.withColumn("_bucket", F.least(F.floor(F.col("_f") * buckets), F.lit(buckets - 1)).cast("int"))
    rows = _ranked(rows, [], "_bucket", [F.col("_f"), F.col("_stratum"), F.col("_u"), *ties], "_place")
    # In whole numbers: a double may round across a cut. The first place of shard s is the smallest p with p * shards >= s * n.
    rows = rows.withColumn("shard", F.expr(f"cast((_place * {shards}) div {max(1, n)} as int)"))
    slot = F.expr(f"_place - (cast(shard as bigint) * {n} + {shards} - 1) div {shards}")
    return rows.withColumn("slot", slot).drop("_stratum", "_u", "_bucket", "_rank", "_size", "_f", "_place")


def shard_documents(docs: DataFrame, shards: int = 24, seed: str = "0") -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8), text_crc32, shard, slot for every document. Null text: size 8, crc of nothing."""
    text = F.coalesce(docs["text"], F.lit(""))
    slim = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["source"], (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    return interleave(slim, shards, seed)
