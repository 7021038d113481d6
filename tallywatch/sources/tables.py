"""Reading and publishing partitioned Parquet tables."""
from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.functions.columns import month_key
from tallywatch.session import settle

# The schemas of the raw tables. Absent tables and columns are read as these, empty or null.
SCHEMAS = {
    "transfers": (
        "date date, block_timestamp timestamp_ntz, block_number bigint, log_index bigint, transaction_hash string, "
        "token string, from_address string, to_address string, amount double, last_modified timestamp_ntz"),
    "transactions": (
        "date date, block_timestamp timestamp_ntz, block_number bigint, transaction_index bigint, hash string, "
        "from_address string, to_address string, direct_token string, receipt_status bigint, "
        "receipt_gas_used bigint, receipt_effective_gas_price bigint, transaction_type bigint, "
        "last_modified timestamp_ntz"),
    "blocks": (
        "date date, number bigint, hash string, parent_hash string, timestamp timestamp_ntz, "
        "transaction_count bigint, gas_used bigint, gas_limit bigint, base_fee_per_gas bigint, "
        "last_modified timestamp_ntz"),
    "load_manifest": (
        "source_table string, date date, rows bigint, files bigint, min_block bigint, max_block bigint, "
        "first_written timestamp_ntz, last_written timestamp_ntz, median_lag_s double, max_lag_s bigint"),
}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def schema_of(name: str) -> T.StructType:
    """The schema of a raw table (needs a running session)."""
    return T.StructType.fromDDL(SCHEMAS[name])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Known columns first, cast to their type; absent ones null; unknown ones kept at the end."""
    present = set(df.columns)
    known = [(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*known, *[c for c in df.columns if c not in set(schema.names)])


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out: a listing, no file is opened."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(target)
    return sorted(name for name in (f.getPath().getName() for f in found) if name[0] not in "_.")


def _alike(spark: SparkSession, path: str, parts: list[str]) -> list[DataFrame]:
    """The parts (folders or files under `path`) read in groups whose files' schemas can be merged.

    Usually that is one group. Where types differ, each part tells its schema by one footer, and equal ones are read together;
    a folder that mixes types is taken file by file.
    """
    def read(group: list[str]) -> DataFrame:
        return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f"{path}/{x}" for x in group])

    try:
        return [read(parts)]
    except Exception as refused:
        if "CANNOT_MERGE" not in str(refused):
            raise
    if len(parts) == 1:
        parts = [f"{parts[0]}/{name}" for name in _children(spark, f"{path}/{parts[0]}")]
    with ThreadPoolExecutor(8) as pool:
        kinds = list(pool.map(lambda x: spark.read.parquet(f"{path}/{x}").schema.simpleString(), parts))
    groups: dict[str, list[str]] = {}
    for kind, part in zip(kinds, parts):
        groups.setdefault(kind, []).append(part)
    if len(groups) == 1:  # the same first footers: some folder mixes types
        return [df for part in parts for df in _alike(spark, path, [part])]
    return [df for group in groups.values() for df in _alike(spark, path, group)]


def _on_days(parts: list[str], days: DataFrame) -> list[str]:
    """The folders of wanted days. The driver reads back at most as many names as it has listed."""
    listed = days.sparkSession.createDataFrame([(x,) for x in parts], "part string")
    days = days.select(F.concat(F.lit("date="), F.col("date").cast("string")).alias("part"))
    found = {row.part for row in listed.join(days, "part", "left_semi").collect()}
    return [x for x in parts if x in found]


def scan(spark: SparkSession, path: str, schema: T.StructType | None = None, months: list[str] | None = None,
         days: DataFrame | None = None, with_file: bool = False) -> DataFrame:
    """A day-partitioned table, tolerant of drift: columns merged by name, absent columns null, absent table empty.

    `months` ('YYYY-MM') chooses the folders, so files of other months are neither listed nor opened.
    `days` is a frame with a `date` column: folders of other days are not opened, not even for their schema, so columns that
    only other days have are absent. A semi-join with the written list keeps the days' rows of tables without folders.
    With a schema, files of unlike physical types are read in groups and cast before they meet.
    """
    if not _exists(spark, path):
        if schema is None:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    names = [x for x in _children(spark, path) if x.startswith("date=")] if not path.endswith(".parquet") else []
    parts = [x for x in names if not months or x[5:12] in months]
    if days is not None:
        days = settle(days.select("date").distinct())
        if parts:
            parts = _on_days(parts, days)
    if names and not parts:
        return spark.createDataFrame([], schema) if schema is not None else spark.read.parquet(path).limit(0)
    groups = _alike(spark, path, parts) if parts else [spark.read.parquet(path)]
    out = None
    for df in groups:
        if with_file:
            df = df.select("*", F.col("_metadata.file_name").alias("file_name"))
        if months and not parts:
            df = df.where(month_key(F.col("date")).isin(months))
        df = conform(df, schema) if schema is not None else df
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if days is not None:
        # The comparison makes the day list count as selective, which dynamic partition pruning asks for.
        wanted = days.where(F.col("date") > F.lit("1900-01-01").cast("date"))
        out = out.join(wanted, "date", "left_semi")
    return out


def list_days(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """source_table, date: which table has which day, from folder names alone (a name per table and day)."""
    found = [(name, x[5:]) for name, path in paths.items() if _exists(spark, path) for x in _children(spark, path) if x[:5] == "date=" and x[5:6].isdigit()]
    return spark.createDataFrame(found, "source_table string, day string").select("source_table", F.col("day").cast("date").alias("date"))


def publish(df: DataFrame, path: str, by: str = "date", order: list[str] | None = None,
            rows_per_file: int = 20_000_000, tasks_per_day: int = 8) -> None:
    """Write one folder per day (or month); folders present in `df` are replaced, the others stay.

    With `order`, rows are shuffled by day and leading sort key, so a day that holds most rows is written by many tasks, each
    a sorted range; the rows are written first, because range partitioning reads them twice. Without it, a day is dealt to
    `tasks_per_day` tasks by a hash of its rows. Files are also cut at `rows_per_file`.
    """
    if order:
        shuffled = settle(df).repartitionByRange(by, *order)
    else:
        shuffled = df.repartition(F.col(by), F.pmod(F.xxhash64(*[c for c in df.columns if c != by]), F.lit(tasks_per_day)))
    (shuffled.sortWithinPartitions(by, *(order or [])).write.mode("overwrite").partitionBy(by)
     .option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .option("maxRecordsPerFile", rows_per_file).parquet(path))


def keep_others(old: DataFrame, new: DataFrame, key: str = "month") -> DataFrame:
    """Months present in `new` replace those of `old`; the other months stay."""
    return (old.join(new.select(key).distinct(), key, "left_anti")
            .unionByName(new, allowMissingColumns=True))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_result(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Nested rows as JSON, one per line."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def profile_tables(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows per table, range of its sequence column, numbers missing from it and rows repeating one."""
    parts = []
    for name, (df, key) in tables.items():
        per_key = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(
            F.lit(name).alias("source_table"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.min("k").alias("min_key"), F.max("k").alias("max_key"), F.count("k").alias("distinct_keys"),
            (F.max("k") - F.min("k") + 1 - F.count("k")).alias("missing_keys"),
            (F.sum(F.when(F.col("k").isNotNull(), F.col("n"))) - F.count("k")).alias("duplicate_rows")))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def listing(tables: dict[str, DataFrame]) -> DataFrame:
    """Which table has which day: read from the partition column alone."""
    parts = [df.select(F.lit(name).alias("source_table"), "date").distinct() for name, df in tables.items()]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", month_key(F.col("date")))
