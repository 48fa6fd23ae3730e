"""Country rules on hand-made charges."""

from decimal import Decimal as D

import pytest

from outledger.operators import branches, picks
from outledger.operators.rollup import account_list, account_texts, rate_rollup
from outledger.plans.outbound import add_lookup, lookup_value

SCHEMA = """id int, country_code string, seller_vat_regime string, rate_percentage decimal(12,6),
    item decimal(20,6), vat decimal(20,6), max_unit_price decimal(20,6), invoice_amount decimal(20,6),
    account string, account_vat string, line_start long"""


def d(value):
    return None if value is None else D(value)


@pytest.fixture(scope="module")
def charges(spark):
    def build(*records):
        data = []
        for n, r in enumerate(records):
            r = dict(regime="Y", rate="0.1", item="10", vat="1", cap="0", account_vat="VATACC") | r
            data.append((
                n, r["country"], r["regime"], d(r["rate"]), d(r["item"]), d(r["vat"]), d(r["cap"]),
                d(r.get("total", r["item"])), "ACC", r["account_vat"], 0,
            ))
        return spark.createDataFrame(data, SCHEMA)

    return build


def made(df):
    """Rows per charge id; the counted rows must agree with the rows made."""
    found = {}
    for r in branches.revtax(df).orderBy("id", "seq").collect():
        found.setdefault(r.id, []).append(r)
    for r in branches.with_row_count(df).collect():
        assert r.made == len(found.get(r.id, []))
    return found


INDIA = {
    "0": [("0.000", "VATACC", "0")],
    None: [("0.000", "VATACC", "0")],
    "0.09": [("9.000", "VATACC", "9.01"), ("9.000", "VATACC", "9.01")],
    "0.1236": [("12.360", "2076001311", "12.37"), ("0.000", "2076001322", "0")],
    "0.14": [("14.000", "2076001311", "14.01"), ("0.000", "2076001322", "0")],
    "0.145": [("14.000", "2076001311", "14.01"), ("0.500", "2076001322", "0.50")],
    "0.15": [
        ("14.000", "2076001311", "14.01"), ("0.500", "2076001322", "0.50"),
        ("0.500", "2270403000", "0.51"),
    ],
    "0.18": [("18.000", "VATACC", "18.02")],
}


def test_india(charges):
    cases = [(rate, sign) for rate in INDIA for sign in (1, -1)]
    df = charges(*[
        dict(country="IN", rate=rate, item=str(D("100.10") * sign)) for rate, sign in cases
    ])
    found = made(df)
    for n, (rate, sign) in enumerate(cases):
        rev, *tax = found[n]
        assert (rev.kind, rev.amount, rev.quantity) == ("REV", D("100.10") * sign, sign)
        assert [(r.rate_text, r.row_account, r.amount * sign) for r in tax] == [
            (printed, account, D(amount)) for printed, account, amount in INDIA[rate]
        ]
    assert branches.india_unsupported(df).count() == 0


def test_india_without_rule(charges):
    df = charges(
        dict(country="IN", rate="0.07"), dict(country="IN", rate="0.18", regime="N"),
        dict(country="IN", rate="0.18", account_vat=None), dict(country="US", rate="0.07"),
    )
    assert [r.id for r in branches.india_unsupported(df).collect()] == [0, 1]
    found = made(df)
    assert sorted(found) == [2, 3] and found[2][1].row_account == "2076001302"


CHINA = [
    (dict(item="80", vat="8", cap="100"), [("REV", 1, 1, "80", "80"), ("TAX", 1, None, None, "8")]),
    (dict(item="100", vat="8", cap="100"), [("REV", 1, 1, "100", "100"), ("TAX", 1, None, None, "8")]),
    (dict(item="300", vat="9", cap="100"), [("REV", 1, 3, "100", "300"), ("TAX", 1, None, None, "9")]),
    (
        dict(item="250", vat="10", cap="100"),
        [
            ("REV", 1, 2, "100", "200"), ("REV", 2, 1, "50", "50"),
            ("TAX", 1, None, None, "8"), ("TAX", 2, None, None, "2"),
        ],
    ),
    (
        dict(item="-250.01", vat="-10", cap="100"),
        [
            ("REV", 1, -2, "100", "-200"), ("REV", 2, -1, "50.01", "-50.01"),
            ("TAX", 1, None, None, "-8"), ("TAX", 2, None, None, "-2"),
        ],
    ),
    (dict(item="-250", vat="-1", cap="0"), [("REV", 1, -1, "250", "-250"), ("TAX", 1, None, None, "-1")]),
    (dict(item=None, vat="1", cap="0", total="1"), [("REV", 1, 1, None, None), ("TAX", 1, None, None, "1")]),
    (dict(item=None, vat="1", cap="100"), []),
    # 1/3 of the tax is 0.005 and rounds away from zero; a quotient cut to six digits would not.
    (
        dict(item="3", vat="0.015", cap="2", regime="N"),
        [
            ("REV", 1, 1, "2", "2"), ("REV", 2, 1, "1", "1"),
            ("TAX", 1, None, None, "0.01"), ("TAX", 2, None, None, "0.01"),
        ],
    ),
]


def test_china(charges):
    df = charges(*[dict(country="CN") | case for case, _ in CHINA])
    found = made(df)
    for n, (_, expected) in enumerate(CHINA):
        got = [(r.kind, r.line_no, r.quantity, r.unit_price, r.amount) for r in found.get(n, [])]
        assert got == [(k, no, q, d(u), d(a)) for k, no, q, u, a in expected], n
    steps = [r.steps for r in branches.with_line_steps(df).orderBy("id").collect()]
    assert steps == [1, 1, 1, 2, 2, 1, 1, 0, 2]
    # The revenue rate is printed under any regime, the tax rate is not.
    assert [r.rate_text for r in found[8]] == ["10.000", "10.000", None, None]


def test_colombia_and_defaults(charges):
    found = made(charges(
        dict(country="CO", item="1000", vat="190.005", regime="N", account_vat=None),
        dict(country="US", item="-10", vat="-0.005"),
        dict(country="US", regime="N"),
        dict(country="MX"),
        dict(country="RU", account_vat=None),
        dict(country=None),
    ))
    rows = {n: [(r.kind, r.row_account, r.amount, r.rate_text) for r in rs] for n, rs in found.items()}
    assert rows[0] == [
        ("REV", "ACC", D(1000), None), ("TAX", "2076001001", D("190.01"), None),
        ("TAX", "2270506000", D(-8), None), ("TAX", "1100401000", D(8), None),
    ]
    assert rows[1] == [
        ("REV", "ACC", D(-10), "10.000"), ("TAX", "VATACC", D("-0.01"), "10.000"),
    ]
    assert [r.quantity for r in found[1]] == [-1, None]
    assert [k for k, *_ in rows[2]] == ["REV"]
    assert rows[3][1][1] == "2076001008" and rows[4][1][1] == "2076001001"
    assert 5 not in rows


def test_accounts_and_partners(spark):
    schema = """id int, country_code string, rate_percentage decimal(12,6), je_line_type_interco string,
        expense_account string, exception_account string, tp_required string, outbound_id string,
        s_bal_seg string, b_bal_seg string"""
    zero, some = D(0), D("0.1")
    cases = [
        (("MX", zero, "OOB", "A", None, None, "Buyer", "SEL1", "B"), ("4020601650", "SEL1")),
        (("MX", None, "WOB", "A", None, None, "Buyer", "SEL1", "B"), ("4020613650", "0000")),
        (("MX", zero, "GEC", "A", None, None, "Buyer", "SEL1", "B"), ("4020201650", "0000")),
        (("MX", zero, "EXT", "A", None, None, "Buyer", "SEL1", "B"), ("4020101650", "0000")),
        (("MX", zero, "XXX", "a1", None, None, "Buyer", "SEL1", "B"), ("a1", "SEL1")),
        (("MX", some, "OOB", "A1", None, None, "SELLER", "SEL1", "LONGSEG"), ("A1", "C1")),
        (("US", zero, "OOB", "A1", "X", None, "seller", "SEL1", "BUY1"), ("A1", "BUY1")),
        (("CN", zero, "OOB", "A1", "N1", None, "Buyer", "SEL1", "B"), ("N1", "0000")),
        (("CN", zero, "OOB", "N1", "A1", None, "Buyer", " ", "B"), ("A1", "0000")),
        (("CN", zero, "OOB", "A1", None, "N", "Buyer", "SEL1", "B"), ("A1", "SEL1")),
        (("IN", zero, "OOB", "A1", None, "N", "Buyer", "SEL1", "B"), ("A1", "0000")),
        (("CO", zero, "OOB", "Z", None, "t", "Buyer", "LONGSEG", "B"), ("Z", "C1")),
        (("US", zero, "OOB", "A1", None, "Y", None, "SEL1", "B"), ("A1", "0000")),
        (("US", zero, "OOB", None, None, "Y", "Buyer", "SEL1", "B"), (None, "0000")),
    ]
    df = spark.createDataFrame([(n, *c) for n, (c, _) in enumerate(cases)], schema)
    codes = spark.createDataFrame([("LONGSEG", "C1")], "balancing_segment string, company_code string")
    accounts = spark.createDataFrame([("A1",), ("4020601650",)], "acct_number string")
    got = branches.with_account(branches.with_company(df, codes), accounts).orderBy("id").collect()
    assert [(r.account, r.trading_partner) for r in got] == [e for _, e in cases]


def test_several_values_for_one_key_fail(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "k string, v string")
    assert sorted(map(tuple, picks.unique_per_key(df, ["k"], "v", "value").collect())) == [
        ("a", "1"), ("b", "2"),
    ]
    worse = df.union(spark.createDataFrame([("b", "3")], "k string, v string"))
    with pytest.raises(Exception, match="more than one value for b"):
        picks.unique_per_key(worse, ["k"], "v", "value").collect()


def test_lookup_must_be_single(rows):
    table = rows(
        "look_up",
        dict(type="T", look_code="C", look_name="N", value="v"),
        dict(type="T", look_code="C", look_name="TWICE", value="v"),
        dict(type="T", look_code="C", look_name="TWICE", value="w"),
    )
    assert lookup_value(table, "T", "C", "N").first().value == "v"
    assert add_lookup(table, table, ("T", "C", "N"), "word").count() == 3
    for name in ("TWICE", "NONE"):
        with pytest.raises(Exception, match="exactly one row"):
            lookup_value(table, "T", "C", name).collect()


def test_account_list_has_no_limit(spark):
    df = spark.range(3000).selectExpr("concat('A', id % 1500) as acct_number")
    assert account_list(df).count() == 1500
    assert account_list(df.limit(0)).count() == 0


def test_account_texts_are_the_whole_list_in_order(spark):
    names = [f"4{k:09d}" for k in range(700)] + ["", "é", "4", "40000000000001", "zz", "Z", "4000000"] + [f"same-start-{k}" for k in range(40)]
    df = spark.createDataFrame([(n,) for n in names * 2 + [None]], "acct_number string")
    parts = {r.part: r.accounts for r in account_texts(df, 50).collect()}
    assert sorted(parts) == list(range(-(-len(names) // 50)))
    whole = [x for p in sorted(parts) for x in parts[p].split(",")]
    assert whole == sorted(names, key=lambda n: n.encode())
    assert account_texts(df.limit(0)).count() == 0


def test_rollup_types_and_descriptions(rows):
    base = dict(invoice_prefix_seq_id=1, brid_billing_rel_id=2, rate_percentage=D("0.1"))

    def line(kind, tax, net, desc=None, translated=None, **more):
        return base | dict(
            inv_line_type=kind, tax_comp_amt=d(tax), ntax_comp_amt=d(net), service_desc=desc,
            service_name_translated=translated,
        ) | more

    table = rows(
        "invoice_line",
        line("ITEM", "1", "10", "b", "a"), line("ITEM", "0", "5", "z"), line("VAT", "2", "0", "m"),
        line("FEE", "0", "99"), line("HEADER", "0", "1000", "zz"),
        line("FEE", "0", "7", rate_percentage=None), line("", "0", "7", rate_percentage=D(3)),
    )
    got = sorted(rate_rollup(table).collect(), key=lambda r: r.rate_percentage is None)
    assert [tuple(r) for r in got] == [
        (1, 2, D("0.1"), D(16), D(2), "m"), (1, 2, None, D(0), D(0), None),
    ]
    assert rate_rollup(table).schema["item"].dataType.simpleString() == "decimal(20,6)"
