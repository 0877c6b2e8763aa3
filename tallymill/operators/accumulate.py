"""Tables that later batches go on with, without reading or writing all of the past."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.windows import Level, running_windows

#: Partition of the lines whose month is not known.
NO_MONTH = "unknown"


def by_month(lines: DataFrame, day: str) -> DataFrame:
    return lines.withColumn("month", F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(NO_MONTH)))


def accumulate(
    lines: DataFrame,
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    measures: Mapping[str, Column],
    batch: DataFrame | None = None,
) -> list[str] | None:
    """An accumulating snapshot: every line with ``measures`` of its events so far, by ``month`` folders.

    ``batch``, the events that have come last, decides which months are written anew: those that have a
    line it touches; without it all are. A month is made from ``events``, all that are kept, so a batch that
    comes again changes nothing. Returns the months written (None for all), a calendar's at most.
    """
    part, months = lines, None
    if batch is not None:
        touched = lines.join(batch.select(*keys).distinct(), list(keys), "left_semi").select("month").distinct()
        months = sorted(r["month"] for r in touched.collect())
        part = lines.where(F.col("month").isin(months))
        events = events.join(part.select(*keys).distinct(), list(keys), "left_semi")
    # events are added up before they meet the lines
    summed = events.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    rows = part.join(summed, list(keys), "left").hint("rebalance", "month")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
    return months


def running_sums_from(
    batch: DataFrame, level: Level, order_by: Sequence[Column], chunk: Sequence[Column], state: DataFrame | None
) -> DataFrame:
    """Running sums of a batch that goes on where ``state`` (keys, sums) ends; the past is not read."""
    rows = running_windows(batch, [level], order_by, chunk)
    if state is None:
        return rows
    before = state.withColumnsRenamed({out: f"_{out}" for out in level.sums})
    met = rows.join(before, list(level.keys), "left")
    # sums skip nulls; a key with nothing but nulls has no sum
    added = {out: F.when(F.col(out).isNull(), F.col(f"_{out}")).otherwise(F.col(out) + F.coalesce(f"_{out}", F.lit(0))) for out in level.sums}
    return met.withColumns(added).select(*rows.columns)


def next_state(batch: DataFrame, level: Level, state: DataFrame | None) -> DataFrame:
    """The last sums by key after a batch: one row per key, combined in the map tasks."""
    keys = list(level.keys)
    sums = batch.groupBy(*keys).agg(*[F.sum(c).alias(out) for out, c in level.sums.items()])
    if state is None:
        return sums
    both = sums.unionByName(state.select(*sums.columns))
    return both.groupBy(*keys).agg(*[F.sum(out).cast(sums.schema[out].dataType).alias(out) for out in level.sums])
