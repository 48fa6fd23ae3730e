"""Journal, drivers, numbering, changes and sources on small frames."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F, types as T

from billing import DAY, RUN, world
from outledger import schemas
from outledger.functions import text
from outledger.operators import changes, drivers, journal, numbering, people
from outledger.operators.counterparty import counterparties, primary_contact
from outledger.sources import jdbc
from outledger.sources.tables import Source, load_tables


@pytest.fixture(scope="module")
def small(rows):
    return world(rows, [("RU", 1, 601, "0.1", "10", "1"), ("RU", 1, 602, "0.1", "10", "1")])


def test_texts(spark):
    df = spark.sql("""select cast(-1234.565 as decimal(20,6)) a, cast(null as decimal(20,6)) n,
        cast(0.1236 as decimal(12,6)) r, cast(10.5 as decimal(12,6)) big, 'a||c,|' p,
        timestamp '2020-05-04 10:00:00' t""")
    c = F.col
    got = df.select(
        text.money_text(c("a")), text.money_text(c("n")), text.rate_text(c("r")),
        text.rate_text(c("n")), text.short_percent_text(c("r")), text.short_percent_text(c("big")),
        text.packed_field(c("p"), 1), text.packed_field(c("p"), 2), text.packed_field(c("p"), 9),
        text.joined("x", F.lit(None), "y"), text.file_day_text(c("t")), text.month_text(c("t")),
        text.without_commas(c("p")), text.dashes_for_commas(c("p")),
    ).first()
    assert tuple(got) == (
        "-1234.57", "0.00", "12.360", "0.000", "12.360", "1050.000", "a", None, None, "xy",
        "04May20", "202005", "a||c|", "a||c-|",
    )


def test_empty_text_is_null_except_codes(rows):
    r = rows("je_line", dict(project="", je_type="", brin_cost_center="x")).first()
    assert (r.project, r.je_type, r.brin_cost_center) == (None, "", "x")


def test_run_window_and_view_fan_out(rows, small):
    lines = small["je_line"]
    late = lines.filter("je_type = 'REC'").withColumn("je_line_seq_id", F.col("je_line_seq_id") + 100)
    edge = late.withColumn("created_on", F.lit(DAY + timedelta(days=1)))
    over = late.withColumn("je_line_seq_id", F.col("je_line_seq_id") + 100).withColumn(
        "created_on", F.lit(DAY + timedelta(days=1, seconds=1))
    )
    vat = lines.filter("je_type = 'VAT'").withColumn("je_line_seq_id", F.col("je_line_seq_id") + 50)
    hidden = late.withColumn("shadow_ind", F.lit("Y"))
    tp = late.withColumn("je_type", F.lit("TP"))
    t = small | {"je_line": lines.union(edge).union(over).union(vat).union(hidden).union(tp)}
    seen = [r.je_line_seq_id for r in journal.outbound_lines(t).filter("je_type = 'REC'").collect()]
    assert sorted(seen) == [1, 11, 101, 111]
    view = journal.outbound_journal(t, counterparties(t), "pop", "other", expanded=True).collect()
    rec = [r for r in view if r.je_type == "REC"]
    assert len(rec) == 8 and {r.orig_gl_account for r in rec} == {"ORIG"}
    others = [r for r in view if r.je_type != "REC"]
    assert {r.orig_gl_account for r in others} == {None}
    assert {(r.je_type, r.product_line, r.product_line_tp) for r in view} == {
        ("REC", "PL1", None), ("AR", "PL1", None), ("TP", "PL1", "PL1"),
    }
    one = journal.enrich(
        journal.outbound_lines(t), t, counterparties(t), "pop", "other", one_vat_line=True
    )
    assert one.filter("je_type = 'REC'").count() == 4
    assert {r.vat_line_seq_id for r in one.collect()} == {4, 14}


def test_contact_and_interface_flag(rows):
    contacts = rows(
        "pl_contact",
        *[
            dict(pl_seq_id=1, user_seq_id=u, contact_type=k, contact_order=o, is_active=a)
            for u, k, o, a in [
                (1, "GBS Contact", 1, "Y"), (2, "GBS Contact", 1, "Y"), (3, "GBS Contact", 2, "Y"),
                (4, "GBS Contact", 1, "N"), (5, "Else", 1, "Y"),
            ]
        ],
    )
    users = rows("app_user", dict(user_seq_id=2, first_name="Ann", last_name=None, work_id="W"))
    assert tuple(primary_contact(contacts, users).first()) == (1, 2, "Ann  (W)")
    for flag, settlement, expected in [("Y", "IBS", 1), ("O", "OTH", 1), ("O", "IBS", 0), ("N", "OTH", 0)]:
        t = world(
            rows, [("US", 1, 101, "0.1", "1", "1")], seller={"ccl_ar_interface_required": flag}
        )
        t["billing_rel"] = t["billing_rel"].withColumn("settlement_type", F.lit(settlement))
        assert counterparties(t).count() == expected


def test_missing_contract_report_is_whole(rows):
    charges = [("RU", n, 601, "0.1", "1", "1") for n in range(1, 91)]
    t = world(rows, charges)
    t["contracts"] = t["contracts"].limit(0)
    report = drivers.missing_contracts(t, RUN)
    assert report.count() == 90
    assert drivers.missing_contracts(t, RUN + 1).count() == 0
    none = t | {"je_line": t["je_line"].withColumn("created_on", F.lit(DAY + timedelta(days=1)))}
    assert drivers.missing_contracts(none, RUN).count() == 0
    other = world(rows, [("US", 1, 101, "0.1", "1", "1")])
    other["contracts"] = other["contracts"].limit(0)
    assert drivers.missing_contracts(other).count() == 0


def test_offsets_against_brute_force(spark):
    rng = random.Random(3)
    ids = [rng.choice([n, n * 70_000, n * 5_000_000_000, n * 300_000_000_000_000]) for n in range(1, 300)]
    data = [(k, i, rng.randint(0, 3)) for k in (1, 2) for i in sorted(set(ids))[: 300 if k == 1 else 3]]
    df = spark.createDataFrame(data, "k long, id long, n long")
    expected = sorted(
        (k, i, sum(m for kk, j, m in data if kk == k and j < i)) for k, i, _ in data
    )
    got = numbering.offsets(df, ["k"], "id", "n")
    assert sorted(map(tuple, got.collect())) == expected


def test_change_sets(spark):
    schema = T.StructType.fromDDL("id int not null, name string not null, age int")
    empty = changes.define_table(spark, schema)
    rows_ = spark.createDataFrame([(4, "a"), (None, "b")], "id int, name string")
    full = changes.insert_rows(empty, rows_)
    assert sorted(map(str, full.collect())) == sorted(
        ["Row(id=4, name='a', age=None)", "Row(id=None, name='b', age=None)"]
    )
    with pytest.raises(ValueError, match="unknown columns"):
        changes.insert_rows(empty, rows_.withColumnRenamed("name", "nom"))
    moved = changes.update_rows(full, F.col("id") == 4, {"id": F.lit(5), "age": F.col("id")})
    assert moved.filter("id = 5").first().age == 4
    assert [r.id for r in changes.delete_rows(moved, F.col("id") == 5).collect()] == [None]
    with pytest.raises(Exception, match="must not be NULL"):
        changes.not_null_checked(full, schema).collect()
    add = lambda c: lambda d: d.withColumn("name", F.concat("name", F.lit(c)))
    steps = [changes.Change(n, "t", add(n[-1])) for n in ("V10__z", "V3__y", "V3__x", "V2.1__w", "V2__v")]
    got = changes.apply_changes({"t": full.filter("id = 4")}, steps)["t"].first().name
    assert got == "avwxyz"
    with pytest.raises(ValueError, match="given twice"):
        changes.apply_changes({"t": full}, steps + steps[:1])
    with pytest.raises(ValueError, match="is not named"):
        changes.apply_changes({"t": full}, [changes.Change("x__y", "t", add("q"))])


def test_saved_table(spark):
    schema = T.StructType.fromDDL(schemas.TABLES["customers"])
    kind = "id int, name string, age int"
    df = spark.createDataFrame([(1, "n" * 20, 2)], kind)
    spark.sql("drop table if exists outledger_customers")
    changes.create_table(df, "outledger_customers", schema)
    changes.insert_into(df.select("age", "name", "id"), "outledger_customers", schema)
    assert [tuple(r) for r in spark.table("outledger_customers").collect()] == [(1, "n" * 20, 2)] * 2
    for wrong in ((2, "n" * 21, 3), (2, None, 3), (None, "n", 3)):
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds|must not be NULL"):
            changes.insert_into(spark.createDataFrame([wrong], kind), "outledger_customers", schema)
    assert spark.table("outledger_customers").count() == 2
    spark.sql("drop table outledger_customers")
    assert changes.define_table(spark, schemas.TABLES["customers"]).columns == ["id", "name", "age"]


def test_environments_and_scalars(spark):
    envs = {"QA": {"url": "jdbc:x", "user": "u"}, "Stage": {"url": "jdbc:y"}}
    assert jdbc.environment_options(envs, "stage") == {"url": "jdbc:y"}
    with pytest.raises(KeyError):
        jdbc.environment_options(envs, "none")
    df = spark.createDataFrame([(1, " a ", None), (3, "c", "d"), (2, "b", " ")], "n int, x string, y string")
    assert jdbc.last_value(df, ["n"]) == "3"
    assert jdbc.last_value(df.filter("n = 2")) == "2"
    assert jdbc.last_value(df.limit(0)) == ""
    with pytest.raises(ValueError, match="several rows"):
        jdbc.last_value(df)
    assert sorted(r.value for r in jdbc.rows_as_text(df).collect()) == ["1 a ", "2 b ", "3 c d"]


def test_loading_tables(spark, tmp_path):
    spark.createDataFrame([(1, "", "x")], "buc_id int, buc string, more string").withColumn(
        "mars_le", F.lit("M")
    ).write.parquet(str(tmp_path / "a" / "T_BUC"))
    spark.createDataFrame([("R", "C")], "reference_id string, contract_number string").write.parquet(
        str(tmp_path / "b" / "contracts")
    )
    catalog = {
        "billing": Source("parquet", str(tmp_path / "a"), names={"buc": "T_BUC"}),
        "contracts": Source("parquet", str(tmp_path / "b")),
    }
    got = load_tables(spark, catalog, ["buc", "contracts"])
    assert tuple(got["buc"].first()) == (1, None, "M")
    assert got["contracts"].count() == 1
    with pytest.raises(ValueError):
        Source("nothing").read(spark, "buc")


def test_anniversaries(rows):
    staff = rows(
        "employees",
        dict(first_name="a", department_id=1, hire_date=datetime(2001, 3, 31)),
        dict(first_name="b", department_id=1, hire_date=datetime(2001, 4, 1)),
        dict(first_name="c", department_id=2, hire_date=datetime(2001, 3, 1)),
    )
    departments = rows("departments", dict(department_id=1, department_name="D"))
    got = people.anniversaries(staff, departments, date(2020, 3, 2)).collect()
    assert [tuple(r) for r in got] == [("a", "D")]


def test_two_contract_numbers_of_a_reference_fail(spark):
    invoices = spark.createDataFrame(
        [(1, "RU", "R1"), (2, "RU", None)], "invoice_prefix_seq_id long, file_country string, brin_reference_id string"
    )
    contracts = spark.createDataFrame(
        [("R1", "C"), ("R1", None), ("R1", "C")], "reference_id string, contract_number string"
    )
    got = drivers.contract_number(invoices, contracts).orderBy("invoice_prefix_seq_id").collect()
    assert [(r.contract_number, r.contract_missing) for r in got] == [("C", False), (None, True)]
    more = contracts.unionByName(spark.createDataFrame([("R1", "D")], contracts.schema))
    with pytest.raises(Exception, match="more than one contract number for R1"):
        drivers.contract_number(invoices, more).collect()
