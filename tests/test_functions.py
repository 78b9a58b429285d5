import datetime as dt
from decimal import Decimal as M

import pytest
from pyspark.sql import functions as F

from estrato.functions.dates import (
    age_years, micros_of_day, month_starts, next_month, seconds_of_day,
)
from estrato.functions.money import convert, monthly_rate, percent
from estrato.functions.text import (
    blank_to_null, contains_any, mask_document, mask_name, matches, relabel,
)
from estrato.model import SEGMENT_LABELS
from estrato.plans.gold import provision_amount, provision_rate, regulatory_class
from estrato.plans.silver import arrears_bucket


def values(spark, ddl, data, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {ddl}")
    return [r.y for r in frame.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_names_and_documents_are_masked(spark):
    assert values(spark, "string", [" Rosa", "", None], mask_name) == ["R***", "***", "***"]
    documents = ["12345678", "12345", "1234", "1", "123  ", "", None]
    assert values(spark, "string", documents, mask_document) == [
        "****5678", "*2345", "****", "****", "****", "****", ""]


def test_blank_text(spark):
    assert values(spark, "string", [" a ", "  ", None], blank_to_null) == ["a", None, None]


def test_segment_labels_keep_unknown_codes(spark):
    codes = ["básico", "ESTANDAR ", "Premium", "ÉLITE", "ORO", "", None]
    assert values(spark, "string", codes, lambda c: relabel(c, SEGMENT_LABELS)) == [
        "Básico", "Estándar", "Premium", "Élite", "ORO", "", "NO_INFORMADO"]


def test_membership_ignores_case_and_trailing_blanks(spark):
    hit = lambda c: matches(c, "ATM")
    assert values(spark, "string", ["atm", "Atm ", " ATM", "WEB", None], hit) == [
        True, True, False, False, False]
    found = lambda c: contains_any(c, "CRÉDITO")
    assert values(spark, "string", ["un crédito", "credito", None], found) == [True, False, False]


@pytest.mark.parametrize(
    "born, as_of, years",
    [
        (dt.date(2000, 3, 10), dt.date(2026, 3, 10), 26),
        (dt.date(2000, 3, 11), dt.date(2026, 3, 10), 25),
        (dt.date(2004, 2, 29), dt.date(2025, 2, 28), 21),
        (dt.date(2004, 2, 29), dt.date(2025, 2, 27), 20),
        (dt.date(2004, 2, 29), dt.date(2024, 2, 28), 19),
        (dt.date(2026, 3, 10), dt.date(2026, 3, 10), 0),
    ],
)
def test_age(spark, born, as_of, years):
    assert values(spark, "date", [born], lambda c: age_years(c, as_of)) == [years]


def test_clock(spark):
    assert values(spark, "string", ["00:00:00", "04:59:59", "23:59:59.900"], seconds_of_day) == [
        0, 17999, 86399]


def test_months():
    assert month_starts(dt.date(2026, 2, 28), 3) == [
        dt.date(2025, 12, 1), dt.date(2026, 1, 1), dt.date(2026, 2, 1)]
    assert len(month_starts(dt.date(2026, 12, 31))) == 12
    assert next_month(dt.date(2025, 12, 1)) == dt.date(2026, 1, 1)
    assert next_month(dt.date(2025, 11, 1)) == dt.date(2025, 12, 1)


# Days overdue on both sides of every band.
DAYS = [-1, 0, 1, 30, 31, 60, 61, 90, 91]


def test_bands(spark):
    assert values(spark, "int", DAYS, arrears_bucket) == [
        "DETERIORADO", "AL DIA", "RANGO 1", "RANGO 1", "RANGO 2", "RANGO 2", "RANGO 3", "RANGO 3",
        "DETERIORADO"]
    assert "".join(values(spark, "int", DAYS, regulatory_class)) == "BABBCCDDE"
    assert values(spark, "int", DAYS, provision_rate) == [
        M(x) for x in "0.05 0.01 0.05 0.05 0.20 0.20 0.50 0.50 1.00".split()]


def test_provision_rounds_half_up(spark):
    row = spark.sql("SELECT cast('100.50' as decimal(18,2)) AS b, 0 AS d")
    assert row.select(provision_amount(F.col("b"), F.col("d"))).first()[0] == M("1.01")


def test_rates_and_currency(spark):
    assert values(spark, "decimal(10,4)", [M("12.6825"), M("0")], monthly_rate) == [
        M("1.0000"), M("0.0000")]
    assert values(spark, "decimal(18,2)", [M("20.00"), M("60.00"), M("-20.00")],
                  lambda c: convert(c, M("4000"))) == [M("0.01"), M("0.02"), M("-0.01")]


def test_percentages_of_nothing(spark):
    row = spark.sql("SELECT cast(0 as decimal(18,2)) AS z, cast(1 as decimal(18,2)) AS one, "
                    "cast(3 as decimal(18,2)) AS three")
    z, one, three = F.col("z"), F.col("one"), F.col("three")
    got = row.select(percent(one, three), percent(one, z, 0), percent(one, z)).first()
    assert list(got) == [M("33.33"), M("0.00"), None]


def test_odd_clocks(spark):
    clocks = ["7:05:00", "", "25:00:00", "noon", "07:05", None]
    assert values(spark, "string", clocks, seconds_of_day) == [25500] + [None] * 5


def test_totals_over_a_table_pass_the_width_of_an_amount(spark):
    from estrato.plans.validate import regulatory_summary

    row = (1, M("9999999999999999.99"), 1)
    ddl = "total_transacciones bigint, volumen_transaccional decimal(18,2), cuentas_activas bigint"
    got = regulatory_summary(spark.createDataFrame([row, row], ddl)).first()
    assert got.volumen_total == M("19999999999999999.98")


def test_micros_of_day(spark):
    texts = {"00:00:00": 0, " 1:2:3.5 ": 3723500000, "23:59:59.9999999": 86399999999,
             "12:00:00.000001": 43200000001, "12:00:00.": 43200000000, "12:00:00.x": 43200000000,
             "24:00:00.1": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.m for r in df.select("t", micros_of_day(F.col("t")).alias("m")).collect()} == texts
