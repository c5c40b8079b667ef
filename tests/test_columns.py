from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


@pytest.mark.parametrize("text, expected", [
    ("12", 12), (" 12 ", 12), ("-3", -3), ("abc", None), ("1.5", None), ("", None), (None, None),
    ("99999999999999999999", None),
])
def test_safe_id(spark, rows, text, expected):
    assert values(rows("v string", (text,)), C.safe_id(F.col("v"))) == [expected]


def test_safe_id_of_a_number(spark, rows):
    assert values(rows("v bigint", (7,), (None,)), C.safe_id(F.col("v"))) == [7, None]


def test_safe_timestamp(spark, rows):
    df = rows("v string", ("2022-05-",), ("2022-05-01T10:00:00Z",), (None,))
    assert values(df, C.safe_timestamp(F.col("v"))) == [None, datetime(2022, 5, 1, 10), None]


@pytest.mark.parametrize("amount, exponent, expected", [
    ("12559", "2", "125.59"), ("100", None, "100.00"), ("1005", "3", "1.01"), ("1.5e3", "1", "150.00"),
    ("ABC", "2", None), ("NaN", "0", None), ("Infinity", "0", None), ("1e40", "0", None), (None, "2", None),
    ("99999999999999999", "0", None), ("-4", "0", "-4.00"), ("5", "x", None),
])
def test_minor_units(spark, rows, amount, exponent, expected):
    df = rows("a string, e string", (amount, exponent))
    assert values(df, C.minor_units(F.col("a"), F.col("e"))) == [expected and Decimal(expected)]


def test_optional_fields(spark, rows):
    df = rows("id int, contact struct<name: string>", (1, ("Ada",)))
    got = df.select(C.optional_col(df, "contact.name"), C.optional_col(df, "contact.phone"), C.optional_col(df, "nope", "bigint"))
    assert got.columns == ["name", "phone", "nope"]
    assert [tuple(r) for r in got.collect()] == [("Ada", None, None)]
    assert got.schema["nope"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("ddl, value, expected", [
    ("agent_ids array<bigint>", [1, 2], [1, 2]),
    ("agent_ids array<string>", ["1", "x"], [1, None]),
    ("users array<struct<id: bigint>>", [(3,)], [3]),
    ("users struct<id: array<bigint>>", ([4, 5],), [4, 5]),
    ("members struct<id: bigint>", (6,), [6]),
    ("other int", 1, []),
    ("agent_ids array<bigint>", None, []),
])
def test_member_sources(spark, rows, ddl, value, expected):
    df = rows(ddl, (value,))
    assert values(df, C.member_ids(df)) == [expected]


def test_member_source_order(spark, rows):
    df = rows("users array<struct<id: bigint>>, agent_ids array<bigint>", ([(9,)], [1]))
    assert values(df, C.member_ids(df)) == [[1]]


def test_names_and_fallbacks(spark, rows):
    df = rows("a string, b string", ("x", "y"), (None, "y"), (None, None))
    assert values(df, C.composite_name(F.col("a"), F.col("b"))) == ["x y", "y", ""]
    assert values(df, C.first_non_null(F.col("a"), F.col("b"), default="z")) == ["x", "y", "z"]
    assert values(df, C.required_text(F.col("a"))) == [True, False, False]


def test_csv_and_days(spark, rows):
    assert values(rows("v string", ("1,x,3",), (None,)), C.csv_to_array(F.col("v"))) == [[1, None, 3], None]
    df = rows("v string", ("2026-01-05T23:59:59.000-08:00",), ("soon",), (None,))
    assert values(df, C.day_of(F.col("v"))) == [date(2026, 1, 5), None, None]


def test_money_is_divided_exactly_and_rounded_once(spark, rows):
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    from tidemark.operators.fx import convert_currency, exact_quotient

    cases = [
        ("125.59", "0.79"), ("0.01", "2"), ("0.03", "2"), ("90071992547409.93", "1.000000000000000001"), ("9999999999999999.99", "1"),
        ("9999999999999999.99", "0.5"), ("1.00", "3"), ("-0.03", "2"), ("1.00", "0"), ("1.00", "-2"), ("0.00", "7"),
        # The tenth digit behind the half decides; a quotient cut to fewer digits would be rounded up twice.
        ("1.00", "0.995024875621890548"), ("5000000000000.00", "1.000000000000000100"), ("1.00", "0.000000000000000001"),
    ]
    df = rows("k int, a string, u string", *[(k, a, u) for k, (a, u) in enumerate(cases)]).selectExpr(
        "k", "cast(a as decimal(18,2)) as a", "cast(u as decimal(28,18)) as u"
    )
    got = {r.k: r.v for r in df.select("k", exact_quotient(df.a, df.u).alias("v")).collect()}
    with localcontext() as context:
        context.prec = 80
        for k, (a, u) in enumerate(cases):
            if Decimal(u) <= 0:
                assert got[k] is None
                continue
            want = (Decimal(a) / Decimal(u)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert got[k] == (want if abs(want) < Decimal(10) ** 16 else None), (a, u)
    txns = rows("transaction_date string, currency_code string, a string", ("d", "GBP", "125.59"), ("d", "USD", "3.10"), ("d", "EUR", "1.00"))
    rates = rows("currency string, rate_date string, rate double, u string", ("GBP", "d", 1 / 0.79, "0.79"))
    done = convert_currency(
        txns.selectExpr("transaction_date", "currency_code", "cast(a as decimal(18,2)) as original_amount"),
        rates.selectExpr("currency", "rate_date", "rate", "cast(u as decimal(28,18)) as units"),
    )
    assert {(r.currency_code, r.exchange_rate, str(r.amount_usd)) for r in done.collect()} == {
        ("GBP", 1 / 0.79, "158.97"), ("USD", 1.0, "3.10"), ("EUR", None, "None")
    }


def test_minor_units_of_many_places(spark, rows):
    from tidemark.functions.columns import minor_units

    cases = {("100000000000000000", "15"): "100.00", ("5", "13"): "0.00", ("149999999999999999", "19"): "0.01", ("150000000000000000", "19"): "0.02",
             ("-150000000000000000", "19"): "-0.02", ("999999999999999999", "40"): "0.00", ("12559", "2"): "125.59", ("12", "-2"): "1200.00", ("5", "x"): "None"}
    df = rows("a string, e string", *cases)
    assert {(r.a, r.e): str(r.v) for r in df.select("a", "e", minor_units(df.a, df.e).alias("v")).collect()} == cases
