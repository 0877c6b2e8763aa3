"""Small helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_batch(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """Apply ``fn`` to each Arrow batch: no shuffle, memory of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def per_task(
    df: DataFrame, begin: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema, end: Callable[[], None] | None = None
) -> DataFrame:
    """As ``per_batch``, by a function that ``begin`` makes anew for each task.

    What the function remembers from batch to batch goes with the task: workers live on, and the
    next stage needs their memory. ``end`` drops what it has left elsewhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = begin()
        try:
            for batch in batches:
                if batch.num_rows:
                    yield fn(batch)
        finally:
            del fn
            if end is not None:
                end()
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


#: Rows of a batch that are Python texts at one time.
ROWS_AT_ONCE = 512


def text_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[list[str]]:
    """The texts of a batch, some at a time; null is an empty text."""
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield texts(batch.slice(at, ROWS_AT_ONCE), name)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is an empty text."""
    return [x or "" for x in batch.column(name).to_pylist()]


def hash_share(key: Column, share: float) -> Column:
    """True for about ``share`` of the keys, the same ones on every run."""
    return F.pmod(F.xxhash64(key), F.lit(1_000_000)) < F.lit(int(1_000_000 * min(1.0, share)))
