"""Employees with an anniversary in a given month."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F


def anniversaries(
    employees: DataFrame, departments: DataFrame, as_of: date | None = None
) -> DataFrame:
    """Employees hired in the calendar month of `as_of` (default today), with their department."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return (
        employees.filter(F.month("hire_date") == F.month(today))
        .join(departments, "department_id")
        .select("first_name", "department_name")
    )
