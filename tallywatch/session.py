"""Session helpers: the settings results depend on, and reliable lineage cuts."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def pin_utc(spark: SparkSession) -> SparkSession:
    """All dates and hours are UTC: day boundaries must not depend on where the job runs."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings this engine wants. On a cluster, master and partitions come from spark-submit."""
    builder = (SparkSession.builder.appName("tallywatch")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               # Recording a Python call site for every column multiplies the time to build large plans.
               .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates, as the cluster names it.

    Only a local session without the setting gets a folder of its own; a cluster without one is an error,
    because a machine-local folder would be lost with its executor.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def settle(df: DataFrame) -> DataFrame:
    """Compute once, write to the shared folder and read back.

    This cuts the lineage with something that outlives executors, and the written files tell the planner their real
    size, so later joins choose their strategy from it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/settled/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def settle_all(*builders: Callable[[], DataFrame]) -> list[DataFrame]:
    """Independent results written at the same time: their jobs share the cluster instead of waiting in turn."""
    with ThreadPoolExecutor(len(builders)) as pool:
        return list(pool.map(lambda build: settle(build()), builders))
