"""Column functions on the dirty values the extracts are known to hold."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tallymill.functions import clean, compat, contact, money
from tallymill.plans import vocab as v


def one(spark, column, **values):
    """The value of an expression over a single row."""
    schema = ", ".join(f"{k} {'string' if x is None or isinstance(x, str) else 'double'}" for k, x in values.items())
    row = tuple(float(x) if isinstance(x, int) else x for x in values.values())
    return spark.createDataFrame([row], schema).select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, day",
    [("2023-13-45", date(2023, 12, 25)), ("2024-02-29", date(2024, 2, 29)), ("2023-02-30", None), ("", None), (None, None)],
)
def test_fix_date(spark, text, day):
    assert one(spark, clean.fix_date(F.col("x"), v.CHRISTMAS_2023), x=text) == day


@pytest.mark.parametrize(
    "text, out", [("PROD-0001-DUP", "PROD-0001"), ("PROD-0001", "PROD-0001"), ("A-DUP-DUP", "A"), (None, None)]
)
def test_strip_dup(spark, text, out):
    assert one(spark, clean.strip_dup(F.col("x")), x=text) == out


def test_casts(spark):
    assert one(spark, clean.as_int(F.col("x")), x="12") == 12
    assert one(spark, clean.as_int(F.col("x")), x="12.5") is None
    assert one(spark, clean.as_float(F.col("x")), x="none") is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, clean.strict(F.col("x"), "int"), x="none")


@pytest.mark.parametrize("rate, label", [(0, 0), (0.01, 1), (0.05, 2), (0.1, 3), (0.2, None), (0.9, None)])
def test_bands_take_the_first_match(spark, rate, label):
    tiers = v.DISCOUNT_TIERS
    expected = tiers.otherwise if label is None else tiers.steps[label][1]
    assert one(spark, clean.band(F.col("x"), tiers), x=float(rate)) == expected


def test_band_gaps_fall_through(spark):
    assert one(spark, clean.band(F.col("x"), v.STOCK_LEVELS), x=50.5) == "Unknown"
    assert one(spark, clean.band(F.col("x"), v.MARGIN_BANDS), x=None) is None


def test_first_failing_keeps_rule_order_and_ignores_null(spark):
    rules = [("a", F.col("x") > 5), ("b", F.col("x") > 1)]
    assert one(spark, clean.first_failing(rules), x=9) == "a"
    assert one(spark, clean.first_failing(rules), x=2) == "b"
    assert one(spark, clean.first_failing(rules), x=None) == "Valid"


def test_packed_and_commas(spark):
    assert one(spark, clean.packed(F.col("x"), 2, 3), x='5,6,"a,b"') == '"a,b"'
    assert one(spark, clean.packed(F.col("x"), 1), x="5") is None
    assert one(spark, clean.comma_count(F.col("x")), x="a,b,") == 2


def test_text(spark):
    assert one(spark, compat.capitalise(F.col("x")), x="mary JANE") == "Mary jane"
    assert one(spark, compat.text_len(F.col("x")), x="ab  ") == 2
    assert one(spark, compat.glue(F.col("x"), F.lit("b")), x=None) == "b"
    assert one(spark, compat.text_before(F.col("x"), "-"), x="4000-Sales-a") == "4000"
    assert one(spark, compat.text_after(F.col("x"), "-"), x="4000-Sales-a") == "Sales-a"
    assert one(spark, compat.text_before(F.col("x"), "-"), x="4000") is None
    assert one(spark, compat.no_decimals(F.col("x")), x=1234567) == "1,234,567"


@pytest.mark.parametrize("day, week", [("2023-01-01", 1), ("2023-01-08", 2), ("2000-12-31", 54), ("2024-12-31", 53)])
def test_week_of_year(spark, day, week):
    assert one(spark, compat.week_of_year(F.col("x").cast("date")), x=day) == week


def test_boundary_counts(spark):
    a, b = F.lit("2023-12-31").cast("date"), F.col("x").cast("date")
    assert one(spark, compat.years_between_starts(a, b), x="2024-01-01") == 1
    assert one(spark, compat.months_between_starts(a, b), x="2024-01-01") == 1
    assert one(spark, compat.days_between(a, b), x="2024-01-01") == 1


def test_fiscal_year_starts_in_july(spark):
    day = F.col("x").cast("date")
    assert one(spark, compat.fiscal_year(day), x="2023-06-30") == "2022/2023"
    assert one(spark, compat.fiscal_year(day), x="2023-07-01") == "2023/2024"
    assert one(spark, compat.fiscal_quarter(day), x="2023-07-01") == 1


@pytest.mark.parametrize("stamp, clock", [("2024-05-01T08:15:30", "08:15:30"), ("2024-05-01", None), ("2024-05-01T25:00:00", None)])
def test_clock_text(spark, stamp, clock):
    assert one(spark, compat.clock_text(F.col("x")), x=stamp) == clock


@pytest.mark.parametrize(
    "raw, compat_form, plain",
    [
        ("+254 712-345678", "0712345678", "0712345678"),
        ("712345678", "07712345678", "0712345678"),
        ("0712345678", "0712345678", "0712345678"),
        ("12", "12", "12"),
    ],
)
def test_phone(spark, raw, compat_form, plain):
    digits = contact.digits(F.col("x"))
    assert one(spark, contact.local_phone(digits), x=raw) == compat_form
    assert one(spark, contact.local_phone(digits, compat=False), x=raw) == plain


@pytest.mark.parametrize("email, ok", [("a@bc.de", True), ("@bc.de", False), ("a@b.de", False), ("a@bcde", False), (None, False)])
def test_email(spark, email, ok):
    assert one(spark, contact.email_valid(F.col("x")), x=email) is ok


def test_money_rounds_half_up_exactly(spark):
    q, p, d = F.lit(1), F.col("x"), F.lit(0.05)
    assert one(spark, money.line_total(q, p, d), x=0.1) == 0.1  # 0.095
    assert one(spark, money.unit_price(F.col("x"), F.lit(0)), x=5.0) is None
    assert one(spark, money.exact_mean(F.col("x").cast("decimal(18,2)"), F.lit(30).cast("bigint")), x=142805014.35) == 4760167.15


def test_imputed_date_is_repeatable_and_in_range(spark):
    df = spark.range(2000).select("id", clean.imputed_date(F.col("id"), v.IMPUTE_FROM, v.IMPUTE_TO).alias("d"))
    first, again = df.collect(), df.repartition(7).orderBy("id").collect()
    assert first == again
    assert min(r["d"] for r in first) >= date(1978, 1, 1) and max(r["d"] for r in first) <= date(2010, 12, 31)
    assert len({r["d"] for r in first}) > 1500
