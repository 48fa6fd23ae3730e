"""Left joins in which neither missing keys nor frequent ones gather in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Rows of a key from which it is dealt in parts, and the parts that rows without a key are spread over.
HOT_ROWS, SPREAD = 1_000_000, 1 << 20


def hot_keys(df: DataFrame, keys: list[str], at_least: int = HOT_ROWS) -> DataFrame:
    """Keys with `at_least` rows or more, and the `parts` they are dealt in.

    Only the key columns are read and rows are counted on the map side. There are at most
    rows / `at_least` such keys, so the result may be broadcast.
    """
    counted = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") >= at_least)
    return counted.select(*keys, F.ceil(F.col("n") / at_least).cast("int").alias("parts"))


def present(df: DataFrame) -> DataFrame | None:
    """The frame, or None where it has no rows."""
    return None if df.isEmpty() else df


def dealt_join(
    left: DataFrame,
    right: DataFrame,
    keys: dict[str, str],
    hot: DataFrame | None = None,
    spread_by: list[str] | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Left join of `left` with `right` where each left column equals its right one; both stay.

    A row of `left` with a NULL in a key, or for which `only` isn't true, matches nothing: such rows
    are spread over many numbers instead of meeting in the task of the NULL key. A key in `hot` (of
    `hot_keys`, named as in `left`) is dealt: its left rows get one of the key's part numbers, its right
    rows are repeated for every part, so a key with a third of all rows is joined by many tasks.
    `spread_by` names the left columns whose hash deals rows (all by default, or where none is there). Rows are neither lost
    nor repeated beyond what a plain left join gives.
    """
    names = list(keys)
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    usable = F.lit(True)
    for name in names:
        usable = usable & F.col(name).isNotNull()
    if only is not None:
        usable = usable & F.coalesce(only, F.lit(False))
    dealt = F.xxhash64(*([c for c in spread_by or [] if c in left.columns] or left.columns))
    # Spread rows get negative numbers, which no right row has.
    apart = -1 - F.pmod(dealt, F.lit(SPREAD))
    if hot is None:
        ours = left.withColumn("_part", F.when(usable, F.lit(0).cast("long")).otherwise(apart))
        theirs = right.withColumn("_other_part", F.lit(0).cast("long"))
    else:
        # Bounded by rows / HOT_ROWS.
        known = F.broadcast(hot.select(*[F.col(n).alias(f"_hot_{n}") for n in names], "parts"))
        of_left, of_right = F.lit(True), F.lit(True)
        for name, other in keys.items():
            of_left = of_left & (F.col(name) == F.col(f"_hot_{name}"))
            of_right = of_right & (F.col(other) == F.col(f"_hot_{name}"))
        part = F.pmod(dealt, F.coalesce("parts", F.lit(1)).cast("long"))
        ours = left.join(known, of_left, "left").select(
            *left.columns, F.when(usable, part).otherwise(apart).alias("_part")
        )
        numbers = F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)).cast("long") - 1)
        theirs = right.join(known, of_right, "left").select(*right.columns, F.explode(numbers).alias("_other_part"))
    on = F.col("_part") == F.col("_other_part")
    for name, other in keys.items():
        on = on & (F.col(name) == F.col(other))
    return ours.join(theirs, on, "left").drop("_part", "_other_part")
