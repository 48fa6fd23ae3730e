"""Named tables of the billing database and of the second, contracts database."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from outledger import schemas
from outledger.sources.jdbc import read_split
from outledger.sources.splits import Split


@dataclass(frozen=True)
class Source:
    """Where tables live: a folder of Parquet tables, a Spark catalog, or a JDBC database.

    `options` go to the JDBC reader (url, user, password, driver) and are given at run time; none is
    stored here. `names` maps a table to its name at the source. `splits` says by which column a table of
    a database is read by many tasks; a table without one must be in `small`, and is read by one.
    """

    kind: str
    location: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    names: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[str, Split] = field(default_factory=dict)
    small: frozenset[str] = frozenset()

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        name = self.names.get(table, table)
        if self.kind == "parquet":
            return spark.read.parquet(f"{self.location}/{name}")
        if self.kind == "catalog":
            return spark.table(f"{self.location}.{name}" if self.location else name)
        if self.kind == "jdbc":
            return read_split(spark, self.options, name, self.splits.get(table), table in self.small)
        raise ValueError(f"unknown source kind {self.kind!r}")


def load_table(
    spark: SparkSession, catalog: Mapping[str, Source], table: str, source: str = "billing"
) -> DataFrame:
    """One table with its declared columns, empty text as NULL."""
    return schemas.conform(catalog[source].read(spark, table), table)


def load_tables(
    spark: SparkSession,
    catalog: Mapping[str, Source],
    tables: Iterable[str],
    placed: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Several tables; `placed` names the source of those outside the billing database."""
    placed = {"contracts": "contracts"} if placed is None else placed
    return {
        name: load_table(
            spark, catalog, name,
            placed[name] if placed.get(name) in catalog else "billing",
        )
        for name in tables
    }
