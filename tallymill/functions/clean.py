"""Repair, banding and flag expressions shared by the silver tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
BAD_DATE = "2023-13-45"
DUP_MARK = "-DUP"
VALID = "Valid"
UNREADABLE = "Unreadable value"


# --- casts -----------------------------------------------------------------
def as_int(c: Column) -> Column:
    return c.try_cast("int")


def as_long(c: Column) -> Column:
    return c.try_cast("bigint")


def as_float(c: Column) -> Column:
    return c.try_cast("double")


def as_date(c: Column) -> Column:
    return c.try_cast("date")


def strict(c: Column, to: str) -> Column:
    """ANSI cast: text that does not fit ``to`` stops the job."""
    return c.cast(to)


def fix_date(c: Column, replacement: str, sentinel: str = BAD_DATE) -> Column:
    """Swap the impossible date ``sentinel`` for ``replacement``, then parse safely."""
    return F.when(c == sentinel, F.lit(replacement)).otherwise(c).try_cast("date")


def open_end(c: Column, as_of: date) -> Column:
    """A missing end date means the interval is open until ``as_of``."""
    return F.coalesce(c, F.lit(as_of))


# --- identifiers -----------------------------------------------------------
def strip_dup(c: Column) -> Column:
    """Text before the duplicate marker; plain ids pass through."""
    return F.substring_index(c, DUP_MARK, 1)


def not_dup(c: Column) -> Column:
    return ~c.endswith("DUP")


def no_blanks(c: Column) -> Column:
    return F.replace(c, F.lit(" "), F.lit(""))


def present(c: Column) -> Column:
    """Neither NULL nor the empty string."""
    return c.isNotNull() & (c != "")


def not_null_text(c: Column) -> Column:
    """Neither NULL nor the word NULL."""
    return c.isNotNull() & (c != "NULL")


def join_key(*parts: Column) -> Column:
    """Composite text key; a NULL part leaves an empty slot."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


# --- recoding --------------------------------------------------------------
def allow(c: Column, allowed: Sequence[str], otherwise: str) -> Column:
    return F.when(c.isin(*allowed), c).otherwise(F.lit(otherwise))


def recode(c: Column, synonyms: Mapping[str, Sequence[str]], otherwise: Column | str | None) -> Column:
    """Map every listed synonym to its label."""
    out = None
    for label, words in synonyms.items():
        out = (F if out is None else out).when(c.isin(*words), F.lit(label))
    if otherwise is None:
        return out
    return out.otherwise(otherwise if isinstance(otherwise, Column) else F.lit(otherwise))


@dataclass(frozen=True)
class Bands:
    """Ordered value bands; the first step that matches gives the label.

    ``test`` compares the value with the step's edge: ``<``, ``<=``, ``>=``,
    ``>``, ``=`` or ``between`` (the edge is then a pair, both ends included).
    A step may name its own test as a third item.
    """

    test: str
    steps: tuple[tuple, ...]
    otherwise: str | None

    def items(self):
        for step in self.steps:
            yield (step[2] if len(step) > 2 else self.test), step[0], step[1]


_TESTS = {
    "<": lambda c, e: c < e,
    "<=": lambda c, e: c <= e,
    ">=": lambda c, e: c >= e,
    ">": lambda c, e: c > e,
    "=": lambda c, e: c == e,
    "between": lambda c, e: c.between(e[0], e[1]),
}


def band(c: Column, bands: Bands) -> Column:
    out = None
    for test, edge, label in bands.items():
        out = (F if out is None else out).when(_TESTS[test](c, edge), F.lit(label))
    return out if bands.otherwise is None else out.otherwise(F.lit(bands.otherwise))


def first_failing(rules: Sequence[tuple[str, Column]], ok: str = VALID) -> Column:
    """Name of the first rule a row breaks, ``ok`` if it breaks none.

    A rule that evaluates to NULL does not fire.
    """
    out = None
    for label, broken in rules:
        out = (F if out is None else out).when(broken, F.lit(label))
    return out.otherwise(F.lit(ok))


def unreadable(*pairs: tuple[Column, Column]) -> Column:
    """Is any text there that its type cannot hold? Pairs of raw text and typed value; NaN holds nothing."""
    out = F.lit(False)
    for raw, typed in pairs:
        lost = typed.isNull() | (typed.cast("string") == "NaN")
        out = out | (F.coalesce(raw != "", F.lit(False)) & lost)
    return out


def yes_no(cond: Column) -> Column:
    return F.when(cond, F.lit("yes")).otherwise(F.lit("no"))


# --- packed and shifted fields --------------------------------------------
def packed(c: Column, k: int, limit: int = -1) -> Column:
    """The k-th comma-separated piece (from 0), NULL when there is none."""
    return F.get(F.split(c, ",", limit), F.lit(k))


def comma_count(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(","), F.lit("")))


def imputed_date(key: Column, start: str, end: str) -> Column:
    """A repeatable date in [start, end], spread by the first 48 bits of ``key``'s digest."""
    span = F.date_diff(F.lit(end).cast("date"), F.lit(start).cast("date")) + 1
    number = F.conv(F.left(F.md5(key.cast("string")), F.lit(12)), 16, 10).cast("bigint")
    return F.date_add(F.lit(start).cast("date"), (number % span).cast("int"))


def parity_choice(odd: str, even: str, *names: Column) -> Column:
    """Pick by the parity of the summed name lengths; NULL names give ``even``."""
    total = sum((F.length(F.rtrim(n)) for n in names[1:]), F.length(F.rtrim(names[0])))
    return F.when(total % 2 == 1, F.lit(odd)).otherwise(F.lit(even))
