"""Text, money and date expressions with the billing rules' NULL habits."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def joined(*parts: Column | str) -> Column:
    """Concatenation in which a NULL part counts as nothing; plain strings are literals."""
    return F.concat_ws("", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def packed_field(packed: Column, n: int) -> Column:
    """The n-th part (from 1) of a pipe-packed text; an empty or absent part is NULL."""
    return F.nullif(F.split_part(packed, F.lit("|"), F.lit(n)), F.lit(""))


def money_text(amount: Column) -> Column:
    """Two decimals, half away from zero, NULL as 0.00. Decimal casts keep the sign, `to_char` does not."""
    return F.coalesce(amount.cast("decimal(20,2)"), F.lit(0).cast("decimal(20,2)")).cast("string")


def rate_text(rate: Column) -> Column:
    """A rate fraction as a percentage with three decimals, NULL as 0.000."""
    percent = F.coalesce(rate, F.lit(0).cast("decimal(12,6)")) * 100
    return percent.cast("decimal(20,3)").cast("string")


def short_percent_text(rate: Column) -> Column:
    """Percentage with three decimals, printed in full however wide it is; NULL stays NULL."""
    return (rate * 100).cast("decimal(20,3)").cast("string")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")


def iso_day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMM")


def file_day_text(ts: Column) -> Column:
    return F.date_format(ts, "ddMMMyy")


def dashes_for_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("-"))


def without_commas(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(""))


def row_as_text(columns: list[str]) -> Column:
    """Cells trimmed and joined by one space; a NULL cell leaves an empty place."""
    return F.concat_ws(" ", *[F.trim(blank(F.col(c))) for c in columns])
