"""Type-2 dimensions: version intervals and point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.operators.windows import row_numbers
from tallymill.session import materialise

# Fixed values
FIRST_VALID = date(2016, 1, 1)
FOREVER = date(9999, 12, 30)


def versions_from_changes(df: DataFrame, key: str, valid_from: str, valid_to: str = "valid_to") -> DataFrame:
    """Close each version the day before the next one starts; the last stays open (NULL)."""
    w = Window.partitionBy(key).orderBy(valid_from)
    return df.withColumn(valid_to, F.date_sub(F.lead(valid_from).over(w), 1))


def open_first_version(
    df: DataFrame, key: str, order_by: Sequence[Column], chunk: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """Move the start dates of each key's first version back to ``FIRST_VALID``."""
    numbered = row_numbers(df, [key], order_by, chunk, "_version")
    start = F.lit(FIRST_VALID)
    return numbered.withColumns(
        {c: F.when(F.col("_version") == 1, start).otherwise(F.col(c)) for c in columns}
    ).drop("_version")


def disjoint_periods(
    versions: DataFrame,
    key: str,
    order_by: str,
    payload: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Cut overlapping inclusive intervals into periods with one version each.

    On a day that several versions cover, the one that starts last wins, and
    among those the one with the smallest ``order_by``. A join against these
    periods gives at most one match, so the facts need no fan-out guard and thus
    no second shuffle.

    A version runs from its start, or from the end of stronger ones that start on the same
    day, until it ends or a later one begins. That is all, unless a version outlasts the
    next beginning and so comes back in a gap, where the next ones have ended and none has
    begun. Only keys with such versions and gaps go through ``_returns``. The work is
    linear in the versions, and no task needs more than those of one key and year.
    """
    pick = F.struct(order_by, *[c for c in payload if c != order_by])
    rows = (
        versions.where(F.col(valid_from) <= F.col(valid_to))
        .groupBy(key, F.col(valid_from).alias("_lo"), F.col(valid_to).alias("_hi"))
        .agg(F.min(pick).alias("_pick"))
        .withColumn("_year", F.year("_lo"))
        .repartition(key, "_year")  # one shuffle for all that follows
    )
    equal = Window.partitionBy(key, "_year", "_lo")
    stronger = equal.orderBy(F.col(f"_pick.{order_by}").asc_nulls_first(), "_hi").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(key, "_year").orderBy(F.unix_date("_lo")).rangeBetween(1, Window.unboundedFollowing)
    # the first start of each year tells the year before when its last versions are over
    years = rows.groupBy(key, "_year").agg(F.min("_lo").alias("_begin"))
    years = years.withColumn("_begin", F.lead("_begin").over(Window.partitionBy(key).orderBy("_year")))
    rows = rows.withColumns(
        {
            "_from": F.greatest("_lo", F.date_add(F.max("_hi").over(stronger), 1)),
            "_top": F.max("_hi").over(equal),
            "_next": F.min("_lo").over(later),
        }
    ).join(years, [key, "_year"])
    rows = materialise(rows.withColumn("_next", F.coalesce("_next", "_begin")).drop("_begin", "_year"), "versions")
    until = F.least(F.col("_hi"), F.coalesce(F.date_sub("_next", 1), F.col("_hi")))
    columns = [key, "_lo", "_hi", "_pick"]
    runs = rows.select(key, F.col("_from").alias("_lo"), until.alias("_hi"), "_pick").where("_lo <= _hi")

    # one day beyond the next start is not enough: a gap begins a day after that at least
    lasting = rows.where(F.col("_hi") > F.col("_next")).select(*columns)
    gaps = rows.select(
        key, F.date_add("_top", 1).alias("_lo"), F.coalesce(F.date_sub("_next", 1), F.lit(FOREVER)).alias("_hi")
    ).where("_lo <= _hi")
    latest = lasting.groupBy(key).agg(F.max("_hi").alias("_latest"))
    earliest = gaps.groupBy(key).agg(F.min("_lo").alias("_earliest"))
    back = latest.join(earliest, key).where("_earliest <= _latest").select(key)
    if not back.isEmpty():
        lasting, gaps = (df.join(back, key, "left_semi") for df in (lasting, gaps.distinct()))
        runs = runs.unionByName(_returns(lasting, gaps, key, order_by).select(*columns))
    return runs.select(
        key,
        F.col("_lo").alias(valid_from),
        F.col("_hi").alias(valid_to),
        *[F.col(f"_pick.{c}").alias(c) for c in payload],
    )


def _with_neighbours(
    df: DataFrame, key: str, order_by: Sequence[Column], before: dict[str, str], after: dict[str, str]
) -> DataFrame:
    """Values of the rows before and after, along ``order_by``, within a key.

    Windows hold one key and ``_year``; what lies beyond the year's ends comes from the
    neighbouring years, of which a key has as many as the calendar.
    """
    inside = Window.partitionBy(key, "_year").orderBy(*order_by)
    along = Window.partitionBy(key).orderBy("_year")
    held = sorted({*before.values(), *after.values()})
    placed = df.withColumns(
        {"_n": F.row_number().over(inside), "_of": F.count(F.lit(1)).over(Window.partitionBy(key, "_year"))}
    )
    ends = placed.groupBy(key, "_year").agg(
        F.max(F.when(F.col("_n") == 1, F.struct(*held))).alias("_first"),
        F.max(F.when(F.col("_n") == F.col("_of"), F.struct(*held))).alias("_last"),
    )
    ends = ends.select(
        key, "_year", F.lag("_last").over(along).alias("_earlier"), F.lead("_first").over(along).alias("_later")
    )
    seen = {out: F.lag(c).over(inside) for out, c in before.items()} | {out: F.lead(c).over(inside) for out, c in after.items()}
    joined = placed.withColumns(seen).join(ends, [key, "_year"])
    edges = {out: F.when(F.col("_n") == 1, F.col(f"_earlier.{c}")).otherwise(F.col(out)) for out, c in before.items()}
    edges |= {out: F.when(F.col("_n") == F.col("_of"), F.col(f"_later.{c}")).otherwise(F.col(out)) for out, c in after.items()}
    return joined.withColumns(edges).select(*df.columns, *before, *after)


#: Days 2**k, from one day to more than any calendar has.
_LEVELS = 23


def _stabbed(points: DataFrame, intervals: DataFrame, key: str) -> DataFrame:
    """The points (key, _day and more) with the least ``_value`` of the intervals (key, _lo, _hi) on their day, or NULL.

    An interval is a few dozen blocks at most, of 2**k days beginning at multiples of 2**k. The
    least value of a block holds for all of it, and that of a day is the least of the blocks
    around the day.
    """
    shift = lambda c, k: F.call_function("shiftright", c, k)
    one = F.lit(1).cast("int")
    lo, hi = F.unix_date("_lo"), F.unix_date("_hi") + 1  # the end excluded
    levels = F.sequence(F.lit(0), F.lit(_LEVELS - 1))

    def blocks(k: Column) -> Column:
        left = shift(lo + F.call_function("shiftleft", one, k) - 1, k)
        right = shift(hi, k)
        odd = lambda c: (left < right) & (c.bitwiseAND(one) == 1)
        return F.array(
            F.when(odd(left), F.struct(k.alias("level"), left.alias("block"))),
            F.when(odd(right), F.struct(k.alias("level"), (right - 1).alias("block"))),
        )

    covered = F.filter(F.flatten(F.transform(levels, blocks)), lambda b: b.isNotNull())
    best = intervals.select(key, "_value", F.inline(covered)).groupBy(key, "level", "block").agg(F.min("_value").alias("_value"))
    asked = points.select(key, "_day").distinct().select(key, "_day", F.explode(levels).alias("level"))
    asked = asked.withColumn("block", shift(F.unix_date("_day"), F.col("level")))
    found = asked.join(best, [key, "level", "block"]).groupBy(key, "_day").agg(F.min("_value").alias("_value"))
    return points.join(found, [key, "_day"], "left")


def _returns(lasting: DataFrame, gaps: DataFrame, key: str, order_by: str) -> DataFrame:
    """The periods in which versions come back: the strongest of ``lasting`` on each day of the ``gaps``.

    Within a gap the winner changes only where one has ended.
    """
    as_value = F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))
    ended = lasting.select(key, F.date_add("_hi", 1).alias("_day")).distinct()
    ended = _stabbed(ended, gaps.withColumn("_value", as_value), key).where(F.col("_value").isNotNull())
    begun = gaps.select(key, F.col("_lo").alias("_day"), as_value.alias("_value"))
    points = begun.unionByName(ended.select(*begun.columns)).distinct().withColumnRenamed("_value", "_gap")
    strength = F.struct(
        (-F.unix_date("_lo")).alias("start"), F.col(f"_pick.{order_by}").alias("tie"), F.col("_hi").alias("hi"), F.col("_pick").alias("pick")
    )
    won = _stabbed(points, lasting.withColumn("_value", strength), key).withColumn("_year", F.year("_day"))
    seen = _with_neighbours(won, key, [F.col("_day")], {"_old": "_value", "_old_gap": "_gap"}, {})
    same = F.col("_value").eqNullSafe(F.col("_old")) & F.col("_gap").eqNullSafe(F.col("_old_gap"))
    changes = seen.where(~same).drop("_old", "_old_gap")
    until = _with_neighbours(changes, key, [F.col("_day")], {}, {"_next": "_day"})
    last = F.least(F.coalesce(F.date_sub("_next", 1), F.col("_gap.hi")), F.col("_gap.hi"))
    return until.where(F.col("_value").isNotNull()).select(
        key, F.col("_day").alias("_lo"), last.alias("_hi"), F.col("_value.pick").alias("_pick")
    )


#: Months of a cell, from the finest to the coarsest.
_WIDTHS = (1, 2, 3, 6, 12, 24, 60, 120, 600, 1 << 20)
#: Rows that cells may make of a period, on average.
_MOST_CELLS = 1.5
#: Rows up to which periods may be broadcast; their files are far smaller than they are in memory.
_BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class MonthlyPeriods:
    """Disjoint periods as they are met by cells of ``width`` months: ``rows`` have a row for each period and cell.

    Months run from that of the first start (``first``) to that of the last (``last``), counted from
    year 0; whatever lies before or after belongs to these two, as no other version begins there.
    ``n_rows`` is the number of ``rows``.
    """

    rows: DataFrame
    key: str
    first: int
    last: int
    width: int = 1
    n_rows: int = 0

    def month(self, day: Column) -> Column:
        """The cell of a day."""
        return _cell(_clamped(_month(day), self.first, self.last), self.width)


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _clamped(month: Column, first: int, last: int) -> Column:
    # greatest and least skip nulls; a day that is not known has no month
    return F.when(month.isNotNull(), F.least(F.greatest(month, F.lit(first)), F.lit(last)))


def _cell(month: Column, width: int) -> Column:
    return F.floor(month / width).cast("int")


def by_month(periods: DataFrame, key: str, valid_from: str = "valid_from", valid_to: str = "valid_to") -> MonthlyPeriods:
    """Split disjoint periods at the ends of months, and write them: joins then know their true size.

    Where periods last long, several months make a cell: the finest width is taken with which the
    periods become no more than ``_MOST_CELLS`` times as many, so what is written grows with the
    periods, not with their days.
    """
    ends = periods.agg(F.min(_month(F.col(valid_from))), F.max(_month(F.col(valid_from)))).first()
    first, last = (x if x is not None else 0 for x in ends)
    cell = lambda c, width: _cell(_clamped(_month(F.col(c)), first, last), width)
    cells = [F.sum(cell(valid_to, w) - cell(valid_from, w) + 1).alias(f"w{w}") for w in _WIDTHS]
    sizes = periods.agg(F.count(F.lit(1)).alias("n"), *cells).first()
    width = next((w for w in _WIDTHS if (sizes[f"w{w}"] or 0) <= _MOST_CELLS * sizes["n"]), _WIDTHS[-1])
    payload = [c for c in periods.columns if c not in (key, valid_from, valid_to)]
    rows = periods.select(
        F.col(key).alias("_pk"),
        F.col(valid_from).alias("_from"),
        F.col(valid_to).alias("_to"),
        F.explode(F.sequence(cell(valid_from, width), cell(valid_to, width))).alias("_pm"),
        *payload,
    )
    return MonthlyPeriods(materialise(rows, "periods"), key, first, last, width, sizes[f"w{width}"] or 0)


def point_in_time_join(
    facts: DataFrame, periods: MonthlyPeriods, on_date: str, columns: Sequence[str], key: str | None = None
) -> DataFrame:
    """Left join each fact to the version valid on its date, both ends included.

    The periods are disjoint per key (``disjoint_periods``), so facts keep their row count, and
    met by key and cell of months: a fact is compared with the one or two versions of its cell,
    however many its key has, and a hot key spreads over its cells. No broadcast is
    forced: Spark broadcasts periods below its size limit and ``_BROADCAST_ROWS``, and
    otherwise splits what is still hot of the sort-merge join.
    """
    key = key or periods.key
    p = periods.rows.select("_pk", "_pm", "_from", "_to", *columns)
    if periods.n_rows > _BROADCAST_ROWS:
        p = p.hint("merge")
    same = (F.col(key) == F.col("_pk")) & (periods.month(F.col(on_date)) == F.col("_pm"))
    return facts.join(p, same & F.col(on_date).between(F.col("_from"), F.col("_to")), "left").drop("_pk", "_pm", "_from", "_to")


def point_in_time_guarded(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    on_date: str,
    line_key: Sequence[str],
    order_by: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """The same result from overlapping versions, by ranking the matches per line.

    For versions too many to rewrite; costs a shuffle of the joined facts.
    """
    v = versions.withColumnRenamed(key, "_pk")
    joined = facts.join(
        v, (F.col(key) == F.col("_pk")) & F.col(on_date).between(F.col(valid_from), F.col(valid_to)), "left"
    )
    w = Window.partitionBy(*line_key).orderBy(F.col(valid_from).desc(), F.col(order_by))
    return (
        joined.withColumn("_n", F.row_number().over(w))
        .where("_n = 1")
        .drop("_n", "_pk", valid_from, valid_to)
    )
