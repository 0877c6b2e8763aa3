"""Embeddings as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and v (bytes of doubles), one row for each id: the smallest of its vectors.

    Null ids and vectors that are null, empty, zero or hold null or non-finite components are left out.
    """
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).mapInArrow(_packed, "vec_id long, v binary")


def _packed(batches):
    for batch in batches:
        v = [np.asarray(x, np.float64).tobytes() for x in batch.column("v").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(v, pa.binary())], names=["vec_id", "v"])


def matrix(column) -> np.ndarray:
    """Rows of a binary column whose values have one length."""
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.float64).reshape(len(parts), -1)


def by_length(column) -> list[np.ndarray]:
    """Row numbers of a binary column, grouped by the length of the value."""
    sizes = np.array([len(x) for x in column.to_pylist()])
    return [np.flatnonzero(sizes == n) for n in np.unique(sizes)]
