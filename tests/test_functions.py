"""Literal inputs with results worked out by hand."""

from datetime import date
from decimal import Decimal

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from partflow.functions import codes, dates, hashing, numbers
from partflow.functions.names import normalize_name, normalized_names, unique_names


def values(spark, rows, expression, schema="x string"):
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expression).collect()]


def test_erp_number(spark):
    got = values(spark, ["1.234,500", "12,000-", "5", None, "x"], numbers.erp_number(F.col("x")))
    assert got == [Decimal("1234.500"), Decimal("-12.000"), Decimal("5.000"), None, None]


@pytest.mark.parametrize("text, value", [
    ("1.234,56", "1234.56"), ("1,234.56", "1234.56"), ("1.234", "1234.00"), ("0.500", "500.00"),
    ("1,234", "1.23"), ("12.345.678", "12345678.00"), ("1234.567", "1234.57"), (" R$ 12,30 ", "12.30"),
    ("1.23E+2", "123.00"), ("-1.234,5", "-1234.50"), ("", None), ("abc", None), ("12,30-", None),
])
def test_locale_decimal(spark, text, value):
    rounded = numbers.round_half_up(numbers.locale_decimal(F.col("x")))
    assert values(spark, [text], rounded) == [None if value is None else Decimal(value)]


def test_invalid_number(spark):
    got = values(spark, ["", None, "abc", "12,30-", "99999999999999999,00", "1,5"],
                 numbers.invalid_number(F.col("x")))
    assert got == [False, False, True, True, True, False]


def test_rounding(spark):
    row = spark.sql("SELECT CAST(2.345 AS DECIMAL(10,3)) AS x").select(
        numbers.round_half_up(F.col("x")), numbers.round_half_even(F.col("x"))).first()
    assert tuple(row) == (Decimal("2.35"), Decimal("2.34"))
    assert values(spark, [-2.9, 2.9], numbers.trunc_int(F.col("x")), "x double") == [-2, 2]


def test_blank_horizon(spark):
    assert values(spark, ["", "  ", "7", None], numbers.blank_to_zero(F.col("x"))) == ["0", "0", "7", None]


def test_repair_date(spark):
    got = values(spark, ["05.03.2020", "00.00.0000", None, "12/31/24", "3/5/98", "garbage"],
                 dates.repair_date(F.col("x")))
    assert got == ["05.03.2020", "00.00.0000", None, "31.12.2024", "05.03.1998", None]


def test_erp_date(spark):
    assert values(spark, ["31.12.2024", "2024-12-31", "99.99.2024"], dates.erp_date(F.col("x"))) == [
        date(2024, 12, 31), None, None]


def test_calendar_scalars(spark):
    days = ["2026-03-31", "2026-04-01", "2024-12-30"]
    day = F.col("x").cast("date")
    assert values(spark, days, dates.fiscal_label(day)) == ["102ki", "103ki", "101ki"]
    assert values(spark, days, dates.iso_weekday(day)) == [2, 3, 1]
    assert values(spark, days, F.weekofyear(day))[2] == 1


def test_easter(spark):
    known = {1961: "04-02", 1981: "04-19", 2000: "04-23", 2008: "03-23", 2011: "04-24", 2024: "03-31",
             2025: "04-20", 2026: "04-05", 2038: "04-25", 2049: "04-18", 2076: "04-19"}
    got = values(spark, list(known), dates.easter(F.col("x")), "x int")
    assert [f"{d:%m-%d}" for d in got] == list(known.values())


def test_main_item(spark):
    rows = [(None,), ("",), ("  ",), ("sim",), (" SIM ",), ("0",), ("0.0",), ("X",)]
    own = F.lit("M")
    assert values(spark, rows, codes.main_item(F.col("x"), own)) == ["M"] * 5 + ["0", "0.0", "X"]
    assert values(spark, rows, codes.main_item(F.col("x"), own, zeros=True)) == ["M"] * 7 + ["X"]
    assert values(spark, rows, codes.main_item_plain(F.col("x"), own)) == [
        "M", "", "  ", "M", " SIM ", "0", "0.0", "X"]


def test_clean_chain(spark):
    rows = [("0200", "A C", "042"), ("0200", "A C", "040"), ("0200", "A C", None), ("0200", "A G", "042"),
            ("0500", "A G", "040"), ("0500", "A  C", None), ("0900", "A C", "042")]
    got = values(spark, rows, codes.clean_chain(F.col("c"), F.col("o"), F.col("b")), "o string, c string, b string")
    assert got == ["A", "A C", "A", "A G", "A", "A", "A C"]


def test_clean_variant(spark):
    rows = [("0200", "A N", "040"), ("0200", "A NP", None), ("0200", "A C", "040"), ("0200", "A G", "042"),
            ("0200", "A G", "040"), ("0200", "A G", None), ("0500", "A G", "040"), ("0500", "AN", "040")]
    got = values(spark, rows, codes.clean_variant(F.col("c"), F.col("o"), F.col("b")), "o string, c string, b string")
    assert got == ["A", "A", "A", "A", "A G", "A G", "A", "AN"]


def test_codes(spark):
    assert values(spark, ["000120", "0000", "A0"], codes.strip_zeros(F.col("x"))) == ["120", "", "A0"]
    assert values(spark, ["0203", "0505"], codes.company_of(F.col("x"))) == ["0200", "0500"]
    rows = [("0200", None), ("0500", " "), ("0900", None), ("0200", "0232")]
    assert values(spark, rows, codes.default_center(F.col("o"), F.col("c")), "o string, c string") == [
        "0203", "0503", None, "0232"]
    rows = [("TO", "0203"), ("TO", "0503"), ("AP", "0209"), ("SP", "0203"), (None, "0203")]
    assert values(spark, rows, codes.adjusted_center(F.col("s"), F.col("c")), "s string, c string") == [
        "0209", "0505", "0232", "0203", "0203"]


def test_forecast_texts(spark):
    assert values(spark, ["Export - Parts", "Domestic- A", "Parts"], codes.strip_market(F.col("x"))) == [
        "Parts", "A", "Parts"]
    assert values(spark, ["Supply - Parts - X", "Supply", None, "A - "], codes.class_tag(F.col("x"))) == [
        "Parts - X", None, None, ""]


def test_hash_forms(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    joined = [r[0] for r in df.select(hashing.row_hash(["x", "y"])).collect()]
    plain = [r[0] for r in df.select(hashing.row_hash(["x", "y"], "json")).collect()]
    assert joined[0] == joined[1] and plain[0] != plain[1]


def test_names():
    assert normalize_name("Cód. Cliente (SAP)") == "cod_cliente_sap"
    assert normalize_name("") == normalize_name(None) == "col_unknown"
    assert unique_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    assert normalized_names(["PS", "Rg"], {"ps": "pais"}) == ["pais", "rg"]


@given(st.text())
def test_normalized_names_are_plain(text):
    assert set(normalize_name(text)) <= set("abcdefghijklmnopqrstuvwxyz0123456789_")


@given(st.dates(date(1900, 1, 1), date(2100, 1, 1)), st.integers(-600, 600))
def test_month_shift_round_trip(day, n):
    assert dates.shift_month(dates.shift_month(day, n), -n) == day.replace(day=1)


def test_windows():
    anchor = date(2026, 10, 15)
    assert dates.last_months(anchor, 60)[0] == date(2021, 11, 1)
    assert dates.last_months(anchor, 12)[0] == date(2025, 11, 1)
    assert [dates.label_of(m) for m in dates.last_months(anchor, 6)][::5] == ["2026/05", "2026/10"]
