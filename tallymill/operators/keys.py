"""Surrogate keys."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.session import materialise

_PLACE, _FILE, _AT = "_place", "_file", "_at"
#: Task number, and number of the file within the task, in the names of written files.
_PART = re.compile(r"part-(\d+)-.*?(?:-c(\d+))?(?:\.|$)")


def dense_key(df: DataFrame, order_by: Sequence[Column], name: str, steady: bool = False) -> DataFrame:
    """Number the rows 1..n along ``order_by`` without gathering them in one task.

    The rows are range partitioned, sorted and written once. Their numbers come from the files: the
    place in its file, which every later read finds again, and the rows in the files before. The
    driver counts these, one number per file; ids are the same on every read and every retry.

    Ties are broken by a place in the input, so that even a third of all rows being copies of each
    other spreads over many partitions. A retried task must find the same places. A plain scan, or
    what filters and projections make of one, does (``steady``); any other input is first sorted
    within its tasks, by the order and a digest of the whole row. Neighbours then are alike, and
    what is shuffled compresses well.
    """
    if not steady:
        df = df.sortWithinPartitions(*order_by, F.xxhash64(*df.columns), *df.columns)
    order = [*order_by, F.col(_PLACE)]
    placed = (
        df.withColumn(_PLACE, F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(_PLACE)
    )
    rows = materialise(placed, "keys").select(
        *df.columns, F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_AT)
    )
    counts = {r[_FILE]: r["count"] for r in rows.groupBy(_FILE).count().collect()}
    offsets, before = [], 0
    for file in sorted(counts, key=_written_order):
        offsets.append((file, before))
        before += counts[file]
    # one row per written file: safe to send to every task
    starts = df.sparkSession.createDataFrame(offsets, f"{_FILE} string, _before bigint")
    return rows.join(F.broadcast(starts), _FILE).select(
        (F.col("_before") + F.col(_AT) + 1).alias(name), *[F.col(c) for c in df.columns]
    )


def _written_order(file: str) -> tuple[int, int]:
    found = _PART.match(file)
    return int(found[1]), int(found[2] or 0)
