"""How a database table or query is read by many tasks: disjoint predicates over one of its columns."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal

Value = int | float | Decimal | str | date | datetime


def literal(value: Value) -> str:
    """A value as SQL text."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"{value!r} can't bound a range")
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, float) and not math.isfinite(value):
        raise ValueError(f"{value!r} can't bound a range")
    return str(value)


def predicates(column: str, cuts: Sequence[Value]) -> list[str]:
    """Conditions that hold for every row of the table exactly once.

    The ranges lie between the cuts, open at both ends, so rows beyond the bounds that were looked up are
    read too; rows without a value are a part of their own. Cuts may come in any order and repeat.
    """
    ordered = [literal(c) for c in sorted(set(cuts))]
    if not ordered:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    ranges = [f"{column} < {ordered[0]}"]
    ranges += [f"{column} >= {low} AND {column} < {high}" for low, high in zip(ordered, ordered[1:], strict=False)]
    return [*ranges, f"{column} >= {ordered[-1]}", f"{column} IS NULL"]


def even_cuts(low: Value, high: Value, parts: int) -> list[Value]:
    """Cuts that make `parts` ranges of equal width; numbers, days or times."""
    if parts < 1 or high < low:
        raise ValueError("parts must be 1 or more and bounds in order")
    if isinstance(low, datetime):
        step = (high - low) / parts
        return sorted({low + step * k for k in range(1, parts)})
    if isinstance(low, date):
        days = (high - low).days
        return sorted({low + timedelta(days=days * k // parts) for k in range(1, parts)})
    if isinstance(low, int) and isinstance(high, int):
        return sorted({low + (high - low) * k // parts for k in range(1, parts)})
    return sorted({low + (high - low) * k / parts for k in range(1, parts)})


def derived(sql: str, alias: str = "q") -> str:
    """A query's text in the place of a table name."""
    text = sql.strip().rstrip(";").rstrip()
    if not text:
        raise ValueError("empty query")
    # A comment in its last line must not swallow the bracket.
    return f"({text}\n) {alias}"


def bounds_query(source: str, column: str) -> str:
    """Text of a query for the least and greatest value of a column; two aggregates, no rows."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {source}"


def quantile_query(source: str, column: str, parts: int) -> str:
    """Text of a query for cuts between parts with about equally many rows, for skewed columns.

    The database ranks its own index; `parts` - 1 rows come back at most.
    """
    ranked = f"SELECT {column} AS v, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {source} WHERE {column} IS NOT NULL"
    return f"SELECT DISTINCT MIN(v) AS cut FROM ({ranked}) ranked WHERE part > 1 GROUP BY part"


@dataclass(frozen=True)
class Split:
    """The column a source is split by, and where: given cuts, or `parts` even ranges between two bounds."""

    column: str
    cuts: tuple[Value, ...] = ()
    bounds: tuple[Value, Value] | None = None
    parts: int = 1

    def predicates(self) -> list[str]:
        cuts = list(self.cuts)
        if self.bounds is not None:
            cuts += even_cuts(*self.bounds, self.parts)
        return predicates(self.column, cuts)
