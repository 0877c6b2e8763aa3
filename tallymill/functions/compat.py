"""Date, text and number functions whose SQL Server meaning differs from Spark's."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


# --- text ------------------------------------------------------------------
def text_len(c: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(c))


def glue(*parts: Column) -> Column:
    """Concatenation that reads NULL as empty text."""
    return F.concat_ws("", *parts)


def capitalise(c: Column) -> Column:
    """Upper first letter, lower rest; later words stay lower, unlike ``initcap``."""
    return F.trim(F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2)))))


def position_of(needle: str, c: Column, start: int = 1) -> Column:
    """1-based position of ``needle`` in ``c`` at or after ``start``, 0 if absent."""
    return F.locate(needle, c, start)


def text_before(c: Column, mark: str) -> Column:
    """Text left of the first ``mark``; NULL when it is absent."""
    return F.when(c.contains(mark), F.substring_index(c, mark, 1))


def text_after(c: Column, mark: str) -> Column:
    """Text right of the first ``mark``; all of it when it is absent."""
    return F.when(c.contains(mark), F.substr(c, F.locate(mark, c) + len(mark))).otherwise(c)


def no_decimals(c: Column) -> Column:
    """Number with thousands separators and no decimals."""
    return F.format_number(c, 0)


# --- dates -----------------------------------------------------------------
def is_date(c: Column) -> Column:
    return c.try_cast("date").isNotNull()


def clock_text(stamp: Column) -> Column:
    """``HH:mm:ss`` out of ``yyyy-MM-dd?HH:mm:ss``; NULL if it is no time of day."""
    text = F.substring(stamp, 12, 8)
    return F.when(text.rlike(r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"), text)


def clock_hour(clock: Column) -> Column:
    return F.left(clock, F.lit(2)).try_cast("int")


def week_of_year(d: Column) -> Column:
    """Week number with week 1 starting on 1 January and weeks starting on Sunday."""
    first_weekday = F.dayofweek(F.trunc(d, "year"))
    return (F.floor((F.dayofyear(d) + first_weekday - 2) / 7) + 1).cast("int")


def month_text(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def day_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def days_between(a: Column, b: Column) -> Column:
    return F.date_diff(b, a)


def months_between_starts(a: Column, b: Column) -> Column:
    """Month boundaries crossed from ``a`` to ``b``; days do not matter."""
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def years_between_starts(a: Column, b: Column) -> Column:
    return F.year(b) - F.year(a)


def quarter_label(d: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit(" "), F.year(d).cast("string"))


def fiscal_year(d: Column) -> Column:
    """``start/end`` of the year beginning in July."""
    return F.concat_ws(
        "/", F.year(F.add_months(d, -6)).cast("string"), F.year(F.add_months(d, 6)).cast("string")
    )


def fiscal_quarter(d: Column) -> Column:
    return F.quarter(F.add_months(d, -6))


def month_parts(d: Column, prefix: str) -> dict[str, Column]:
    """The year, month, quarter and year-month columns most silver tables carry."""
    return {
        f"{prefix}_year": F.year(d),
        f"{prefix}_month": F.month(d),
        f"{prefix}_quarter": F.quarter(d),
        f"{prefix}_year_month": month_text(d),
    }


def month_start(year_month: Column) -> Column:
    """First day of a ``yyyy?MM`` text."""
    return F.concat_ws(
        "-", F.left(year_month, F.lit(4)), F.right(year_month, F.lit(2)), F.lit("01")
    ).try_cast("date")


def today(as_of: date) -> Column:
    """The run date; a parameter, so that a rerun gives the same rows."""
    return F.lit(as_of)
