"""Gates, metric tables, reconciliation and constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gate(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Split into kept and rejected rows; an undecided test rejects."""
    sure = F.coalesce(keep, F.lit(False))
    return df.where(sure), df.where(~sure)


def count_where(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def long_form(one_row: DataFrame, name: str = "metric", value: str = "value") -> DataFrame:
    """Turn a row of counts into one row per column."""
    pairs = [
        F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("long").alias(value))
        for c in one_row.columns
    ]
    return one_row.select(F.inline(F.array(*pairs)))


def metrics(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """One row per metric, computed in a single pass."""
    return long_form(df.agg(*[m.alias(n) for n, m in measures.items()]))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source rows, target rows and the difference, each as a share of the source."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    n = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("s"), F.coalesce(F.sum("t"), F.lit(0)).alias("t")
    )

    def line(label: str, rows: Column) -> Column:
        share = F.round(F.try_divide(rows.cast("decimal(20,0)") * 100, F.col("s")), 2)
        text = F.concat(share.cast("decimal(20,2)").cast("string"), F.lit("%"))
        return F.struct(
            F.lit(label).alias("source"), rows.cast("long").alias("row_count"), text.alias("percentage")
        )

    return n.select(
        F.inline(
            F.array(
                line("Source Bronze", F.col("s")),
                line("Target Silver", F.col("t")),
                line("Missing Rows", F.col("s") - F.col("t")),
            )
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once: empty where the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def violations(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """How many rows break each check; like a CHECK constraint, NULL passes."""
    broken = {name: F.count_if(F.coalesce(~ok, F.lit(False))) for name, ok in checks.items()}
    return long_form(df.agg(*[m.alias(n) for n, m in broken.items()]), "check_name", "n_violations")


def unmatched_keys(facts: DataFrame, dim: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Fact rows whose non-null key the dimension lacks, counted per key.

    Facts are counted per key first, so a hot key is one row at the join.
    """
    counted = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = dim.select(F.col(dim_key).alias("_known")).distinct()
    return counted.join(known, F.col(key) == F.col("_known"), "left_anti")
