"""Text that its column's type cannot hold: found, kept and set apart, in any table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.functions.clean import BAD_DATE

# Words that stand for a missing value.
NO_VALUE = ("", "n/a", "NULL")


def _lost(c: str, kind: str) -> Column:
    raw = F.col(c)
    typed = raw.try_cast(kind)
    # the costly reading of the text comes first and once: NaN is above all numbers, and most texts parse
    gone = ~F.coalesce(typed <= F.lit(float("inf")), F.lit(False)) if kind == "double" else typed.isNull()
    if kind == "date":
        gone = gone & (raw != BAD_DATE)
    return gone & F.coalesce(~raw.isin(*NO_VALUE), F.lit(False))


def unread(types: Mapping[str, str]) -> Column:
    """Map of column → text for every field that is there but does not parse.

    ``types``: column → int, bigint, double, date or timestamp_ntz. NaN is no number, and the impossible date
    that stands for a known one is not lost.
    """

    entries = [F.when(_lost(c, kind), F.struct(F.lit(c).alias("key"), F.col(c).alias("value"))) for c, kind in types.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def _any_lost(types: Mapping[str, str]) -> Column:
    """Whether a field does not parse: the map, which no generated code makes, is left to the few rows that need it."""
    return reduce(lambda a, b: a | b, [_lost(c, kind) for c, kind in types.items()])


def readable(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The rows of which every field parses."""
    return raw.where(~_any_lost(types))


def blanked(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """All rows, with NULL for every number that does not parse; dates are left to the table's own rules."""
    numbers = {c: kind for c, kind in types.items() if kind in ("int", "bigint", "double")}
    return raw.withColumns({c: F.when(~_lost(c, kind), F.col(c)) for c, kind in numbers.items()})


def rescued(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The other rows, as they came, with the map of what does not parse as ``unread``."""
    return raw.where(_any_lost(types)).withColumn("unread", unread(types))


def strict(raw: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """All rows; one that does not parse stops the job and names its texts."""
    first = raw.columns[0]
    found = unread(types)
    stop = F.raise_error(F.concat(F.lit("unreadable: "), F.to_json(found)))
    return raw.withColumn(first, F.when(F.size(found) == 0, F.col(first)).otherwise(stop.cast("string")))


def unread_texts(raw: DataFrame, types: Mapping[str, str], table: str) -> DataFrame:
    """How often each text was met that its column cannot hold."""
    texts = rescued(raw, types).select(F.explode("unread").alias("column_name", "text"))
    counted = texts.groupBy("column_name", "text").agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.withColumn("table_name", F.lit(table))
