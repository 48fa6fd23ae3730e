"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app: str = "outledger", **conf: str) -> SparkSession:
    """A session for tests and bench runs on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a fresh local one only where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    set_before = spark.sparkContext.getCheckpointDir()
    if set_before:
        return set_before
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="outledger-"))
    return spark.sparkContext.getCheckpointDir()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the checkpoint folder and read it back.

    Later uses prune columns from the Parquet files instead of running the upstream plan again,
    a lost executor costs a file read, and the planner sees the true size.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Spark reads a bucketed table by size of files where no join or aggregate asks for its buckets.
AUTO_SCAN = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
#: With a few folders, a task keeps a file open for each instead of sorting all its rows by folder (which
#: spills where a bucket is large); with more folders the rest is sorted. Row groups are small, as several are open at once.
OPEN_FILES, MOST_OPEN, ROW_GROUP = "spark.sql.maxConcurrentOutputFileWriters", "8", 32 << 20


def bucketed(
    df: DataFrame, name: str, keys: list[str], partition_by: list[str] | None = None, buckets: int | None = None,
    placed: bool = False,
) -> DataFrame:
    """Write a frame once as a table bucketed by `keys`, in folders by `partition_by`, and read it back.

    Joins and aggregates by these keys (and more) need no shuffle afterwards, and filters on a folder
    column read that folder only. The files lie in the checkpoint folder; the session's catalog holds
    the name. `buckets` is the number of shuffle partitions by default: with fewer, Spark would shuffle
    the table again to meet another frame. A bucket is read by one task, so the keys together should
    be spread: a relation of an invoice is, a run or a country is not.
    `placed` says that the rows of `df` lie by `keys` already, in as many parts, so that they are written
    where they are; rows elsewhere would make more files, not other content.
    """
    spark = df.sparkSession
    number = buckets or shuffle_partitions(spark)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    # One task per bucket: each writes one file per folder.
    rows = df if placed else df.repartition(number, *keys)
    writer = rows.write.format("parquet").option("compression", "zstd").bucketBy(number, *keys)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("parquet.block.size", ROW_GROUP)
    before = {name: spark.conf.get(name) for name in (AUTO_SCAN, OPEN_FILES)}
    try:
        if placed:
            spark.conf.set(AUTO_SCAN, "false")
        spark.conf.set(OPEN_FILES, MOST_OPEN)
        writer.option("path", f"{checkpoint_dir(spark)}/{table}").saveAsTable(table)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.table(table)
