"""Small change operators: define, insert, update, delete, and versioned change sets."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def define_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty frame with the table's typed columns."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.createDataFrame([], T.StructType([T.StructField(f.name, _plain(f.dataType), f.nullable) for f in struct]))


def _plain(kind: T.DataType) -> T.DataType:
    """Text of limited length is plain text in frames; a table's columns hold the limit."""
    return T.StringType() if isinstance(kind, (T.VarcharType, T.CharType)) else kind


def not_null_checked(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast to the table's types; a NULL in a NOT NULL column fails the job."""
    cols = []
    for f in schema.fields:
        kind = _plain(f.dataType)
        value = F.col(f.name).cast(kind)
        if not f.nullable:
            error = F.raise_error(F.lit(f"column {f.name} must not be NULL")).cast(kind)
            value = F.coalesce(value, error)
        cols.append(value.alias(f.name))
    return df.select(*cols)


def create_table(df: DataFrame, name: str, schema: T.StructType | None = None) -> None:
    """Save a frame as a Parquet table.

    With a schema the table is created with its columns first: NOT NULL columns and the lengths of
    VARCHAR and CHAR columns are checked while rows are written, now and by later inserts into the
    table, and a row that breaks them fails the write.
    """
    if schema is None:
        df.write.format("parquet").saveAsTable(name)
        return
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema.fields
    )
    df.sparkSession.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
    insert_into(df, name, schema)


def insert_into(df: DataFrame, name: str, schema: T.StructType) -> None:
    """Append rows to a created table, by column name, with its checks."""
    not_null_checked(df, schema).write.insertInto(name)


def insert_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows that may lack columns; those become NULL. Unknown columns are an error."""
    unknown = set(rows.columns) - set(df.columns)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    types = {f.name: f.dataType for f in df.schema.fields}
    typed = rows.select(*[F.col(c).cast(types[c]).alias(c) for c in rows.columns])
    return df.unionByName(typed, allowMissingColumns=True)


def update_rows(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true; every value is computed on the old row."""
    types = {f.name: f.dataType for f in df.schema.fields}
    unknown = set(values) - set(types)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    return df.select(
        *[
            F.when(condition, values[c].cast(types[c])).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in df.columns
        ]
    )


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows where the condition is true; a NULL condition keeps its row."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


@dataclass(frozen=True)
class Change:
    """One change of one table, named `V<version>__<text>`."""

    name: str
    table: str
    apply: Callable[[DataFrame], DataFrame]

    @property
    def version(self) -> tuple[int, ...]:
        match = re.fullmatch(r"V(\d+(?:[._]\d+)*)__.+", self.name)
        if not match:
            raise ValueError(f"{self.name!r} is not named V<version>__<text>")
        return tuple(int(n) for n in re.split(r"[._]", match.group(1)))


def apply_changes(
    tables: Mapping[str, DataFrame], changes: list[Change], allow_repeats: bool = False
) -> dict[str, DataFrame]:
    """Apply changes in order of version and name.

    A version may be shared by changes with different names; the same name twice is an error
    unless allowed.
    """
    names = [c.name for c in changes]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated and not allow_repeats:
        raise ValueError(f"change given twice: {repeated}")
    result = dict(tables)
    for change in sorted(changes, key=lambda c: (c.version, c.name)):
        result[change.table] = change.apply(result[change.table])
    return result
