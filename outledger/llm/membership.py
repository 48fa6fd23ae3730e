"""Rows whose id is, or isn't, in a table of ids, without moving all rows to meet the ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from outledger.llm import frames

#: Most bits of a bitmap that every task gets (32 MB).
MOST_BITS = 1 << 28


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(bits)).astype(np.int64)


def maybe_in(ids: DataFrame, key: str, most_bits: int = MOST_BITS) -> Column:
    """A condition on the whole-number column `key`: true for every id in `ids` (one column), and for a few others.

    The ids set bits of a bitmap of bounded size, which all tasks get. With very many ids the bitmap
    fills up and the condition is true for more rows; it is never false for an id of the table. NULL is false.
    """
    numbers = ids.select(F.col(ids.columns[0]).cast("long").alias("id")).dropna().distinct()
    bits = min(most_bits, max(1 << 16, 1 << (16 * numbers.count()).bit_length()))

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = np.unique(_places(batch["id"].to_numpy(), bits))
            yield pd.DataFrame({"word": place >> 6, "mask": np.int64(1) << (place & 63)})

    words = numbers.mapInPandas(mark, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toPandas()
    bitmap = np.zeros(bits >> 6, np.int64)
    bitmap[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64)
    sent = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def marked(id_: pd.Series) -> pd.Series:
        place = _places(id_.fillna(0).to_numpy(), bits)
        return pd.Series((sent.value[place >> 6] >> (place & 63) & 1 == 1) & id_.notna().to_numpy())

    return marked(F.col(key).cast("long"))


def without(rows: DataFrame, ids: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows whose `key` isn't in `ids` (one column of that name); rows with a NULL key stay.

    Most rows are known to be none of the ids by the bitmap and stay where they are; only the others
    are moved to meet the ids. `rows` is read twice, so it should be a stored frame.
    """
    kept = frames.stored(ids.select(F.col(ids.columns[0]).cast("long").alias("_id")).dropna().distinct(), "ids")
    seen = rows.withColumn("_maybe", maybe_in(kept, key, most_bits))
    clear = seen.filter(~F.col("_maybe")).drop("_maybe")
    # The ids grow with the table: dealt by id at every size.
    met = seen.filter("_maybe").drop("_maybe").join(kept.hint("merge"), F.col(key).cast("long") == F.col("_id"), "left_anti")
    return clear.unionByName(met)
