"""Joins of one to many kept as factors: lines, and per key the count, sums and first of the members.

What a join of lines with all members of their key would give (row counts, sums, a chosen member) is
worked out from the factors; nothing has more rows than the lines. The pairs themselves are made on
request only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MONEY = "decimal(38,6)"


def member_groups(
    members: DataFrame, keys: list[str], order: str, facts: tuple[str, ...] = (), sums: tuple[str, ...] = ()
) -> DataFrame:
    """One row per key: `members`, the least `order`, that member's `facts`, and `total_<sum>`.

    `order` is a number that is unique within a key. Counts, sums and the least number are a hash
    aggregate that combines on the map side; the facts are then fetched for the one member chosen.
    """
    counted = members.groupBy(*keys).agg(
        F.count("*").alias("members"), F.min(order).alias("_first"),
        *[F.sum(s).cast(MONEY).alias(f"total_{s}") for s in sums],
    )
    if not facts:
        return counted.withColumnRenamed("_first", order)
    chosen = members.select(*[F.col(k).alias(f"_{k}") for k in keys], order, *facts)
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_{k}"))
    # Two comparisons, not an equality: the join then keeps the partitioning by the keys alone.
    on = on & (F.col(order) >= F.col("_first")) & (F.col(order) <= F.col("_first"))
    return counted.join(chosen, on).drop("_first", *[f"_{k}" for k in keys])


@dataclass(frozen=True)
class PairView:
    """The left join of `lines` and `members` by `keys`, as factors.

    `order` is a number column of `members` that is unique within a key. A line without members, or
    with a NULL key, counts as one pair without a member.
    """

    lines: DataFrame
    members: DataFrame
    keys: list[str]
    order: str

    def rows(self, facts: tuple[str, ...] = (), sums: tuple[str, ...] = ()) -> DataFrame:
        """Every line once, with `members`, `pairs`, the first member's number and `facts`, and the members' `sums`."""
        groups = member_groups(self.members, self.keys, self.order, facts, sums)
        joined = self.lines.join(groups, self.keys, "left")
        count = F.coalesce("members", F.lit(0).cast("long"))
        return joined.withColumn("members", count).withColumn("pairs", F.greatest(count, F.lit(1).cast("long")))

    def totals(self, by: list[str], line_sums: tuple[str, ...] = (), member_sums: tuple[str, ...] = ()) -> DataFrame:
        """Per `by` (columns of the lines): `pairs`, and sums over all pairs of line and member columns."""
        rows = self.rows(sums=member_sums)

        def whole(value: Column, name: str) -> Column:
            return F.sum(value).cast(MONEY).alias(name)

        return rows.groupBy(*by).agg(
            F.sum("pairs").alias("pairs"),
            *[whole(F.col(c) * F.col("pairs"), c) for c in line_sums],
            *[whole(F.col(f"total_{c}"), c) for c in member_sums],
        )

    def expanded(self) -> DataFrame:
        """The pairs themselves."""
        return self.lines.join(self.members, self.keys, "left")
