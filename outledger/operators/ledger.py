"""Versioned changes of stored, partitioned tables: each applied once, touching only its partitions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from outledger.operators.changes import Change

LEDGER, STAGED = "_ledger", "_staged"
LEDGER_SCHEMA = "name string, table string, checksum string, partitions long, applied_at timestamp"


@dataclass(frozen=True)
class StoredChange(Change):
    """A change of a stored table.

    `touches` is true for the rows that the change may alter or drop (none for an insert); `apply` gets
    these rows alone and gives what takes their place. `text` is the change's own text, such as its SQL:
    a change whose text differs from what was applied under its name is refused.
    """

    touches: Column | None = None
    text: str = ""

    @property
    def checksum(self) -> str:
        return hashlib.sha256(f"{self.table}\n{self.text}".encode()).hexdigest()


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, folder: str) -> bool:
    path, fs = _path(spark, folder)
    return fs.exists(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path, fs = _path(spark, folder)
    fs.delete(path, True)


def create_stored(df: DataFrame, root: str, table: str, partition_by: list[str]) -> None:
    """A new stored table in folders by the partition columns."""
    df.write.partitionBy(*partition_by).parquet(f"{root}/{table}")


def read_stored(spark: SparkSession, root: str, table: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/{table}")


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The changes applied so far, one row each."""
    if not _exists(spark, f"{root}/{LEDGER}"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/{LEDGER}")


def apply_stored(
    spark: SparkSession, root: str, schemas: dict[str, object], partition_by: dict[str, list[str]],
    changes: list[StoredChange], before_swap: Callable[[str], None] = lambda name: None,
) -> list[str]:
    """Apply what the ledger doesn't have yet, by version and name; returns the names applied.

    The new content of the touched partitions is staged first, then put in their place by a dynamic
    partition overwrite, then entered in the ledger. Other partitions keep their files. A run that broke
    off is taken up where it stopped: a change that is staged in full is swapped in again, which gives the
    same content, and never worked out a second time on rows that it has already altered.
    """
    names = [c.name for c in changes]
    if len(set(names)) < len(names):
        raise ValueError(f"change given twice: {sorted({n for n in names if names.count(n) > 1})}")
    # One row per change ever made.
    known = {r["name"]: r["checksum"] for r in ledger(spark, root).select("name", "checksum").collect()}
    for change in changes:
        if known.get(change.name, change.checksum) != change.checksum:
            raise ValueError(f"{change.name} was applied with another text")
    done = []
    for change in sorted(changes, key=lambda c: (c.version, c.name)):
        if change.name in known:
            continue
        folder = f"{root}/{STAGED}/{change.name}"
        keys = partition_by[change.table]
        if not _exists(spark, f"{folder}/partitions/_SUCCESS"):
            _delete(spark, folder)
            _stage(read_stored(spark, root, change.table, schemas[change.table]), change, keys, folder)
        before_swap(change.name)
        count = _swap(spark, f"{root}/{change.table}", folder, schemas[change.table], keys)
        entry = [(change.name, change.table, change.checksum, count)]
        spark.createDataFrame(entry, "name string, table string, checksum string, partitions long").withColumn(
            "applied_at", F.current_timestamp()
        ).coalesce(1).write.mode("append").parquet(f"{root}/{LEDGER}")
        _delete(spark, folder)
        done.append(change.name)
    return done


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join by partition columns; a NULL partition is one as well."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(renamed, on, how)


def _stage(df: DataFrame, change: StoredChange, keys: list[str], folder: str) -> None:
    """Write the changed rows, then the whole content of the partitions they leave or enter, then these partitions."""
    spark = df.sparkSession
    touched = F.lit(False) if change.touches is None else F.coalesce(change.touches, F.lit(False))
    change.apply(df.filter(touched)).select(*df.columns).write.parquet(f"{folder}/changed")
    changed = spark.read.schema(df.schema).parquet(f"{folder}/changed")
    left = df.filter(touched).select(*keys)
    partitions = left.union(changed.select(*keys)).distinct()
    rest = _same(df.filter(~touched), partitions, keys, "left_semi")
    rest.unionByName(changed).write.parquet(f"{folder}/rows")
    partitions.write.parquet(f"{folder}/partitions")


def _swap(spark: SparkSession, table: str, folder: str, schema, keys: list[str]) -> int:
    """Put staged rows in the place of their partitions; partitions left without rows go."""
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    partitions = spark.read.parquet(f"{folder}/partitions")
    rows.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(table)
    empty = _same(partitions, rows.select(*keys).distinct(), keys, "left_anti")
    paths = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in empty.select(*[F.col(k).cast("string") for k in keys]).collect():
        names = [paths.getPartitionPathString(k, row[k]) for k in keys]
        _delete(spark, "/".join([table, *names]))
    return partitions.count()
