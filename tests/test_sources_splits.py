"""Split reads: predicates that hold exactly once, on DuckDB as the database at hand."""

from datetime import date, datetime
from decimal import Decimal as D

import duckdb
import pytest

from outledger.sources import jdbc
from outledger.sources.splits import Split, bounds_query, derived, even_cuts, literal, predicates, quantile_query
from outledger.sources.tables import Source

COLUMNS = {
    "n": ("bigint", [None, -5, 0, 3, 3, 3, 9, 10**12], [0, 3, 9]),
    "d": ("decimal(12,2)", [None, D("-1.5"), D("0.01"), D("7")], [D("0.01"), D("7.00"), D("0.01")]),
    "t": ("varchar", [None, "", "a", "O'Neil", "z"], ["O'Neil", "b"]),
    "day": ("date", [None, date(2020, 1, 1), date(2020, 6, 1), date(2021, 1, 1)], [date(2020, 6, 1)]),
    "ts": ("timestamp", [None, datetime(2020, 1, 1), datetime(2020, 6, 1, 12, 30)], [datetime(2020, 6, 1, 12, 30)]),
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_every_row_meets_one_predicate(name):
    kind, values, cuts = COLUMNS[name]
    con = duckdb.connect()
    con.execute(f"create table x (v {kind})")
    con.executemany("insert into x values (?)", [[v] for v in values])
    found = predicates("v", cuts)
    assert len(found) == len(set(cuts)) + 2
    cases = " + ".join(f"(case when {p} then 1 else 0 end)" for p in found)
    assert con.execute(f"select distinct {cases} from x").fetchall() == [(1,)]
    assert con.execute(f"select count(*) from x where {found[-1]}").fetchone()[0] == 1


def test_cuts_and_texts():
    assert even_cuts(0, 100, 4) == [25, 50, 75]
    assert even_cuts(5, 5, 3) == [5] and even_cuts(0, 1, 1) == []
    assert even_cuts(date(2020, 1, 1), date(2020, 1, 11), 2) == [date(2020, 1, 6)]
    assert even_cuts(datetime(2020, 1, 1), datetime(2020, 1, 2), 2) == [datetime(2020, 1, 1, 12)]
    assert even_cuts(D(0), D(1), 4) == [D("0.25"), D("0.5"), D("0.75")]
    with pytest.raises(ValueError):
        even_cuts(3, 1, 2)
    for wrong in (None, True):
        with pytest.raises(TypeError):
            literal(wrong)
    with pytest.raises(ValueError):
        literal(float("nan"))
    assert predicates("c", []) == ["c IS NOT NULL", "c IS NULL"]
    assert derived("select 1; ") == "(select 1\n) q"
    with pytest.raises(ValueError):
        derived(" ; ")


def test_looked_up_texts_on_a_skewed_column():
    con = duckdb.connect()
    # A third of the rows on one value.
    con.execute("create table x as select case when i % 3 = 0 then 7 when i % 11 = 1 then null else i end as v from range(3000) r(i)")
    source = derived("select v from x where v is null or v >= 0 -- all of them", "s")
    assert con.execute(bounds_query(source, "v")).fetchone() == (2, 2999)
    cuts = [r[0] for r in con.execute(quantile_query(source, "v", 6)).fetchall()]
    parts = predicates("v", cuts)
    held = [con.execute(f"select count(*) from x where {p}").fetchone()[0] for p in parts]
    assert sum(held) == 3000 and max(held) <= 1500 and len(parts) >= 5


def test_an_unsplit_read_must_be_asked_for(spark, monkeypatch):
    options = {"url": "jdbc:none:", "user": "u"}
    with pytest.raises(ValueError, match="no split for 'je_line'"):
        jdbc.read_split(spark, options, "je_line", None)
    with pytest.raises(ValueError, match="no split"):
        jdbc.query(spark, {"T": options}, "t", "select 1")
    with pytest.raises(ValueError, match="no split"):
        Source("jdbc", options=options).read(spark, "je_line")
    asked = []
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **more: asked.append((url, table, more)))
    Source("jdbc", options=options, names={"je_line": "B.JE"}, splits={"je_line": Split("run", bounds=(0, 9), parts=3)}).read(spark, "je_line")
    jdbc.query(spark, {"T": options}, "t", "select a from b;", Split("a", ("k",)))
    assert asked == [
        ("jdbc:none:", "B.JE", {"predicates": ["run < 3", "run >= 3 AND run < 6", "run >= 6", "run IS NULL"], "properties": {"user": "u"}}),
        ("jdbc:none:", "(select a from b\n) q", {"predicates": ["a < 'k'", "a >= 'k'", "a IS NULL"], "properties": {"user": "u"}}),
    ]
