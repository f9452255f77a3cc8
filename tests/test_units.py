from fractions import Fraction

import pytest

from adloom.operators.units import parse, period_of, to_common_unit

UNITS = [("period", "hour", 2000), ("period", "day", 240), ("period", "week", 50), ("period", "month", 12), ("period", "year", 1), ("currency", "JPY", 1), ("currency", "USD", 150), ("currency", "EUR", 165)]
SOURCES = [("indeed", "year", 1), ("manpoint", "month", 10000)]


@pytest.mark.parametrize(
    "text,ends,currency,period",
    [
        ("月給18万 ~ 20万円", (180000, 200000), "JPY", "month"),
        ("18~20万円", (180000, 200000), "JPY", None),
        ("三百五十万円／年", (3500000,), "JPY", "year"),
        ("5.18百万円", (5180000,), "JPY", None),
        ("３万５千円", (35000,), "JPY", None),
        ("USD 12 per hour", (12,), "USD", "hour"),
        ("¥383,000 /mo", (383000,), "JPY", "month"),
        ("2110.0", (2110,), None, None),
        ("£30 per hour", (30,), "GBP", "hour"),
        ("GBP 30/h", (30,), "GBP", "hour"),
        ("CNY 5000 per month", (5000,), "CNY", "month"),
        ("₪ 90 per hour", (90,), "₪", "hour"),
        ("月給20万円(賞与年2回)", (200000,), "JPY", "month"),
        ("月給20万円〜25万円(賞与年2〜3回)", (200000, 250000), "JPY", "month"),
        ("3万5000円", (35000,), "JPY", None),
        ("1.234,50 €", ("1234.5",), "EUR", None),
        ("12,50 € / h", ("12.5",), "EUR", "hour"),
        ("1,234.50", ("1234.5",), None, None),
        ("1.234.567", (1234567,), None, None),
        ("1,200,000", (1200000,), None, None),
    ],
)
def test_parse(text, ends, currency, period):
    q = parse(text)
    assert (q.ends, q.currency, q.period) == (tuple(map(Fraction, ends)), currency, period)


def test_no_figure():
    assert parse("ASK") is None and parse(None) is None and parse("") is None


def test_period_of():
    assert period_of("フルタイム, 月給制") == "month" and period_of("full time") is None and period_of("Part-time / day rate") == "day" and period_of(None) is None


def run(spark, rows):
    ads = spark.createDataFrame(rows, "id long, min_amount string, max_amount string, job_type string, source string, text string")
    units = spark.createDataFrame(UNITS, "kind string, code string, factor long")
    sources = spark.createDataFrame(SOURCES, "source string, period string, scale long")
    got = to_common_unit(ads, "id", "min_amount", "max_amount", "job_type", "source", units, sources)
    return sorted(map(tuple, got.collect()))


def test_table(spark):
    rows = [
        (1, "2930000", "3390000", None, None, "x"),  # plain already
        (2, "25.4", None, None, "manpoint", None),
        (3, "月給18万 ~ 20万円", "月給18万 ~ 20万円", None, "indeed", None),
        (4, None, "", "月給", "indeed", None),
        (5, "20万円", " 300 ", "月給制", "other", None),
        (6, "100", None, None, "other", None),  # no period known
        (6, "$1.005 an hour", None, None, None, None),
        (7, "£30 per hour", "₪ 90 per hour", "月給", "indeed", None),  # currencies without a factor
    ]
    assert run(spark, rows) == [(2, "min_amount", 3048000), (3, "max_amount", 2400000), (3, "min_amount", 2160000), (5, "max_amount", 3600), (5, "min_amount", 2400000), (6, "min_amount", 301500)]
    assert run(spark, []) == []
