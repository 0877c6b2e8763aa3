"""Window operators that stay exact and even when one key holds most rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.operators.keys import dense_key

_CHUNK, _ORDER, _LEVEL, _TAIL = "_chunk", "_order", "_level", "_tail"


@dataclass(frozen=True)
class Level:
    """Columns to compute along one partitioning.

    ``sums``: output → summed column (all rows up to the current one);
    ``moving``: output → (summed column, rows in the frame, current one included);
    ``lags``: output → column whose previous row's value is wanted.
    """

    keys: tuple[str, ...]
    sums: dict[str, str] = field(default_factory=dict)
    moving: dict[str, tuple[str, int]] = field(default_factory=dict)
    lags: dict[str, str] = field(default_factory=dict)

    @property
    def reach(self) -> int:
        """How many earlier rows a row has to see."""
        return max([n - 1 for _, n in self.moving.values()] + [1] * bool(self.lags) + [0])

    @property
    def looked_at(self) -> list[str]:
        return sorted({c for c, _ in self.moving.values()} | set(self.lags.values()))


def running_windows(
    df: DataFrame, levels: Sequence[Level], order_by: Sequence[Column], chunk: Sequence[Column]
) -> DataFrame:
    """Running sums, moving sums and lags, split along the order into chunks.

    A plain window sends a whole key to one task. ``chunk`` holds expressions that
    never decrease along ``order_by`` (day, month, id prefix …); rows are shuffled
    on key and chunk instead, and every chunk starts with *seed rows* that carry
    what came before it: the sum so far, and the last few values. Those come from
    one pre-aggregated row per key and chunk, and from a per-chunk top-n that Spark
    limits before its shuffle. Seeds are dropped at the end, so rows are kept as
    they were.

    Each level's keys must contain those of the first level: all windows then run
    on the first one's shuffle.
    """
    first = levels[0]
    if any(not set(first.keys) <= set(lv.keys) for lv in levels):
        raise ValueError("every level must contain the keys of the first level")
    base, order = df.withColumn(_CHUNK, F.struct(*chunk)), list(order_by)
    if any(level.reach for level in levels):  # seeds with a place in the order carry it; sums have none
        base, order = base.withColumn(_ORDER, F.struct(*order_by)), [F.col(_ORDER)]
    rows = base
    outputs: dict[str, Column] = {}
    for i, level in enumerate(levels):
        for out, col in level.sums.items():
            rows = rows.withColumn(f"_s{i}_{out}", F.col(col))
        for col in level.looked_at:
            rows = rows.withColumn(f"_t{i}_{col}", F.col(col))
    rows = rows.withColumn(_LEVEL, F.lit(None).cast("int")).withColumn(_TAIL, F.lit(False))
    for i, level in enumerate(levels):
        for seed in _seeds(base, level, i):
            rows = rows.unionByName(seed, allowMissingColumns=True)
        mine = F.col(_LEVEL) == i
        rank = F.when(F.col(_LEVEL).isNull(), 2).when(mine & F.col(_TAIL), 1).otherwise(0)
        w = Window.partitionBy(*level.keys, _CHUNK).orderBy(rank, *order)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        for out in level.sums:
            outputs[out] = F.sum(f"_s{i}_{out}").over(so_far)
        for out, (col, n) in level.moving.items():
            outputs[out] = F.sum(f"_t{i}_{col}").over(w.rowsBetween(1 - n, 0))
        for out, col in level.lags.items():
            outputs[out] = F.lag(f"_t{i}_{col}").over(w)
    return (
        rows.withColumns(outputs)
        .where(F.col(_LEVEL).isNull())
        .select(*df.columns, *outputs)
    )


def _seeds(base: DataFrame, level: Level, i: int) -> list[DataFrame]:
    keys = [*level.keys, _CHUNK]
    along = Window.partitionBy(*level.keys).orderBy(_CHUNK)
    mark = [F.lit(i).alias(_LEVEL)]
    seeds = []
    if level.sums:
        before = along.rowsBetween(Window.unboundedPreceding, -1)
        totals = base.groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in level.sums.items()])
        seeds.append(
            totals.select(
                *keys,
                *[F.sum(o).over(before).alias(f"_s{i}_{o}") for o in level.sums],
                F.lit(False).alias(_TAIL),
                *mark,
            )
        )
    if level.reach:
        last = Window.partitionBy(*keys).orderBy(F.col(_ORDER).desc())
        tails = (
            base.select(*keys, _ORDER, *level.looked_at)
            .withColumn("_n", F.row_number().over(last))
            .where(F.col("_n") <= level.reach)
            .groupBy(*keys)
            .agg(F.sort_array(F.collect_list(F.struct(_ORDER, *level.looked_at))).alias("_rows"))
        )
        nothing = F.array().cast(tails.schema["_rows"].dataType)
        if level.keys:
            earlier = [F.coalesce(F.lag("_rows", k).over(along), nothing) for k in range(level.reach, 0, -1)]
        else:
            tails, earlier = _numbered_tails(tails, level.reach, nothing)
        joined = F.concat(*earlier)
        wanted = F.slice(joined, F.greatest(F.size(joined) - level.reach + 1, F.lit(1)), level.reach)
        seeds.append(
            tails.select(*keys, wanted.alias("_prior"))
            .select(*keys, F.explode("_prior").alias("_p"))
            .select(
                *keys,
                F.col(f"_p.{_ORDER}").alias(_ORDER),
                *[F.col(f"_p.{c}").alias(f"_t{i}_{c}") for c in level.looked_at],
                F.lit(True).alias(_TAIL),
                *mark,
            )
        )
    return seeds


def _numbered_tails(tails: DataFrame, reach: int, nothing: Column) -> tuple[DataFrame, list[Column]]:
    """Each chunk's tail with those of the ``reach`` chunks before it, farthest first.

    Without keys a window along the chunks would hold all of them in one task. Here the chunks are
    numbered from one range-sorted write, and neighbours meet by their numbers.
    """
    numbered = dense_key(tails, [F.col(_CHUNK)], "_i")
    out = numbered
    for k in range(1, reach + 1):
        prior = numbered.select((F.col("_i") + k).alias("_i"), F.col("_rows").alias(f"_rows_{k}"))
        out = out.join(prior, "_i", "left")
    return out, [F.coalesce(f"_rows_{k}", nothing) for k in range(reach, 0, -1)]


def row_numbers(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], chunk: Sequence[Column], name: str
) -> DataFrame:
    """Position of each row within its key, as a running count."""
    level = Level(tuple(keys), sums={name: "_one"})
    counted = running_windows(df.withColumn("_one", F.lit(1).cast("long")), [level], order_by, chunk)
    return counted.drop("_one")


def lag_fill(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column],
    chunk: Sequence[Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Fill NULLs of ``column`` with the previous row's value, one step back."""
    level = Level(tuple(keys), lags={"_before": column})
    seen = running_windows(df, [level], order_by, chunk)
    return seen.withColumn(column, F.coalesce(column, "_before")).drop("_before")


def best_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row per key along ``order_by``.

    Spark keeps one row per key and input task before the shuffle
    (WindowGroupLimit), so hot keys stay small.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def latest_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """All rows that carry their key's greatest ``column``, ties included."""
    top = df.groupBy(*keys).agg(F.max(column).alias("_top"))
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}") == F.col(f"t.{k}") for k in keys])
    return (
        df.alias("r")
        .join(top.alias("t"), same & (F.col(f"r.{column}") == F.col("t._top")), "inner")
        .select("r.*")
    )
