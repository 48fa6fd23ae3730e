"""Queries against a chosen environment's database.

Spark's JDBC reader runs the text; there is no connection handling here. URLs and credentials come
from the caller's environment table at run time. Errors surface, and a NULL cell does not end a
result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from outledger.functions.text import row_as_text
from outledger.sources.splits import Split, bounds_query, derived, quantile_query

Environments = Mapping[str, Mapping[str, str]]


def environment_options(environments: Environments, name: str) -> dict[str, str]:
    """Reader options of an environment; its name is compared without regard to case."""
    for known, options in environments.items():
        if known.lower() == name.lower():
            return dict(options)
    raise KeyError(f"unknown environment {name!r}; known: {sorted(environments)}")


def read_split(
    spark: SparkSession, options: Mapping[str, str], source: str, split: Split | None, unsplit: bool = False
) -> DataFrame:
    """A table or derived table, one task per predicate of its split.

    Without a split the whole result goes through one task and one connection: that must be asked for.
    """
    if split is None:
        if not unsplit:
            raise ValueError(f"no split for {source[:60]!r}: name a column, or say unsplit=True for a small result")
        return spark.read.format("jdbc").options(**options).option("dbtable", source).load()
    rest = {k: v for k, v in options.items() if k != "url"}
    return spark.read.jdbc(options["url"], source, predicates=split.predicates(), properties=rest)


def query(
    spark: SparkSession, environments: Environments, name: str, sql: str, split: Split | None = None,
    unsplit: bool = False,
) -> DataFrame:
    """The rows of a query text in the chosen environment, split by one of its columns."""
    return read_split(spark, environment_options(environments, name), derived(sql), split, unsplit)


def looked_up_split(
    spark: SparkSession, options: Mapping[str, str], source: str, column: str, parts: int, even: bool = False
) -> Split:
    """A split whose cuts the database gives: by its quantiles, or evenly between its bounds."""
    text = bounds_query(source, column) if even else quantile_query(source, column, parts)
    rows = read_split(spark, options, derived(text), None, unsplit=True).collect()
    if even:
        low, high = rows[0]
        return Split(column) if low is None else Split(column, bounds=(low, high), parts=parts)
    return Split(column, tuple(r[0] for r in rows if r[0] is not None))


def last_value(rows: DataFrame, order_by: list[str] | None = None) -> str:
    """First column of the last row as text, `""` for no rows.

    Rows have no order of their own in Spark, so `order_by` says which row is last. Without it the
    frame must have one row at most. Only that one row reaches the driver.
    """
    value = F.col(rows.columns[0]).cast("string").alias("value")
    if order_by:
        last = rows.orderBy(*[F.col(c).desc_nulls_first() for c in order_by]).limit(1)
        found = last.select(value).collect()
    else:
        found = rows.select(value).limit(2).collect()
        if len(found) > 1:
            raise ValueError("several rows: name the columns that order them")
    return (found[0]["value"] or "") if found else ""


def query_scalar(
    spark: SparkSession,
    environments: Environments,
    name: str,
    sql: str,
    order_by: list[str] | None = None,
) -> str:
    # One value is wanted; with `order_by` the database's rows come through one task.
    return last_value(query(spark, environments, name, sql, unsplit=True), order_by)


def rows_as_text(rows: DataFrame) -> DataFrame:
    """Each row as one text: its cells trimmed and joined by one space."""
    return rows.select(row_as_text(rows.columns).alias("value"))


def query_rows_as_text(
    spark: SparkSession, environments: Environments, name: str, sql: str, split: Split | None = None,
    unsplit: bool = False,
) -> DataFrame:
    return rows_as_text(query(spark, environments, name, sql, split, unsplit))
