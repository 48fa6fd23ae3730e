"""Reading tables, picking columns and storing intermediate frames."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from outledger.runtime import bucketed, materialize


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Python workers can import this package; once per application."""
    context = spark.sparkContext
    if getattr(context, "_outledger_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    name = os.path.join(tempfile.mkdtemp(prefix="package-"), "outledger")
    context.addPyFile(shutil.make_archive(name, "zip", root, "outledger"))
    context._outledger_shipped = True


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names: other columns can't clash with what is added."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read back: short lineage, lost executors reread."""
    return materialize(df, name)


def stored_by(df: DataFrame, name: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Stored in buckets by `key` and read back twice: as plain files, and as buckets, which don't move to meet another frame.

    Buckets are for joins of a row with a row; of the plain files Spark may split what is skewed.
    """
    placed = bucketed(df, name, [key])
    folders = {name.rpartition("/")[0] for name in placed.inputFiles()}
    return df.sparkSession.read.schema(placed.schema).parquet(*folders) if folders else placed, placed


def discard(*frames: DataFrame) -> None:
    """Delete the files of stored frames that nothing reads any more."""
    for df in frames:
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def n_words(text: str | Column) -> Column:
    """Runs of anything but ASCII white space; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def crc_fold(key: str | Column, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; NULL counts as fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds, F.lit(0))


def per_batch(function: Callable[[pd.DataFrame], pd.DataFrame]):
    """For mapInPandas: the function on each Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch)

    return run


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each run, and the position of every element inside its run."""
    starts = np.cumsum(lengths) - lengths
    return starts, np.arange(int(lengths.sum())) - np.repeat(starts, lengths)
