"""Table writes, audit columns and the load log."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = (
    "table_name string, rows_inserted bigint, rows_updated bigint, rows_deleted bigint, "
    "load_date timestamp_ntz, batch_id string, status string, error_message string"
)


def _clock(at: datetime) -> Column:
    """A wall-clock time that no session time zone moves."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def with_audit(df: DataFrame, source: str, as_of: date) -> DataFrame:
    return df.withColumns({"etl_load_date": F.lit(as_of), "etl_source": F.lit(source)})


def with_batch(df: DataFrame, source: str, loaded_at: datetime, batch_id: str) -> DataFrame:
    """Creation, modification and load dates, source system and batch."""
    at = _clock(loaded_at)
    return df.withColumns(
        {
            "created_date": at,
            "modified_date": at,
            "data_load_date": at.cast("date"),
            "source_system": F.lit(source),
            "etl_batch_id": F.lit(batch_id),
        }
    )


# --- full refresh ----------------------------------------------------------
_VERSION = re.compile(r"v(\d{8})")


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the versions of a table that were published, and of all begun."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return [], []
    found = [m for m in (_VERSION.fullmatch(f.getPath().getName()) for f in fs.listStatus(root)) if m]
    done = [m for m in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/{m[0]}/_SUCCESS"))]
    return sorted(int(m[1]) for m in done), sorted(int(m[1]) for m in found)


def current(spark: SparkSession, path: str) -> str:
    """Where the newest published version of a table is."""
    published, _ = _versions(spark, path)
    if not published:
        raise FileNotFoundError(f"no published version of {path}")
    return f"{path}/v{published[-1]:08d}"


def _publish(writer: DataFrameWriter, spark: SparkSession, path: str) -> None:
    """Write a new version of a table beside the old ones.

    The mark that Spark leaves when all tasks have been committed publishes it: until then, and
    if the job dies, readers find the version before. That one stays for readers that have
    begun; what is older goes.
    """
    published, begun = _versions(spark, path)
    number = max(begun, default=0) + 1
    writer.parquet(f"{path}/v{number:08d}")
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for old in begun:
        if old not in published[-1:]:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{path}/v{old:08d}"), True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(current(spark, path))


#: Bytes of input for one file of a sorted table.
SORTED_FILE = 256 << 20


def clustered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows in order, within each written file and from file to file.

    Ranges of the order go to tasks, as many as the input's estimated bytes ask for, and are sorted there.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(1, min(-(-size // SORTED_FILE), 100_000))
    return df.repartitionByRange(files, *order).sortWithinPartitions(*order)


def replace_table(df: DataFrame, path: str, sort: Sequence[str] = ()) -> int:
    """Full refresh, in the order ``sort`` if one is given; returns the rows written, counted on the way."""
    seen = Observation()
    out = clustered(df, sort) if sort else df
    _publish(out.observe(seen, F.count(F.lit(1)).alias("rows")).write, df.sparkSession, path)
    return seen.get["rows"]


def replace_monthly(df: DataFrame, day: str, path: str) -> int:
    """Full refresh in one folder per month.

    The rebalance hint gathers a month's rows into few files and lets Spark split
    months that are too large for one task.
    """
    seen = Observation()
    monthly = df.withColumn("month", F.date_format(day, "yyyy-MM")).hint("rebalance", "month")
    counted = monthly.observe(seen, F.count(F.lit(1)).alias("rows"))
    _publish(counted.write.partitionBy("month"), df.sparkSession, path)
    return seen.get["rows"]


@contextmanager
def _open_files(spark: SparkSession, n: int) -> Iterator[None]:
    """Let a task keep ``n`` partitions' files open at once.

    Otherwise Spark sorts all rows of a task by partition before it writes them, and holds them for that.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(n, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


# --- batches ---------------------------------------------------------------
def append_batch(df: DataFrame, path: str, source: str, loaded_at: datetime, batch_id: str) -> int:
    """Append a batch, stamped, as a partition of its own; loading it again replaces it and nothing else."""
    seen = Observation()
    counted = with_batch(df, source, loaded_at, batch_id).observe(seen, F.count(F.lit(1)).alias("rows"))
    with _open_files(df.sparkSession, 1):
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("etl_batch_id").parquet(path)
    return seen.get["rows"]


def append_table(df: DataFrame, path: str, columns: list[str]) -> int:
    """Append under a fixed column list."""
    seen = Observation()
    chosen = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows"))
    chosen.write.mode("append").parquet(path)
    return seen.get["rows"]


def write_gated(df: DataFrame, keep: Column, path: str) -> dict[str, int]:
    """Write kept and rejected rows in one pass, as two partitions of one folder."""
    seen = Observation()
    kept = F.coalesce(keep, F.lit(False))
    counted = df.withColumn("accepted", kept).observe(seen, F.count_if("accepted").alias("kept"), F.count(F.lit(1)).alias("rows"))
    with _open_files(df.sparkSession, 2):
        _publish(counted.write.partitionBy("accepted"), df.sparkSession, path)
    return {"kept": seen.get["kept"], "rejected": seen.get["rows"] - seen.get["kept"]}


def read_gated(df_schema: T.StructType, spark: SparkSession, path: str, accepted: bool = True) -> DataFrame:
    """The kept (or the rejected) partition of a gated table."""
    schema = T.StructType([*df_schema.fields, T.StructField("accepted", T.BooleanType())])
    both = spark.read.schema(schema).parquet(current(spark, path))
    return both.where(F.col("accepted") == accepted).drop("accepted")


def log_load(
    spark, path: str, table: str, rows: int | None, batch_id: str, at: datetime, error: str | None = None
) -> None:
    """Append one line to the load log."""
    line = [(table, rows or 0, None, None, at, batch_id, "FAILED" if error else "SUCCESS", error)]
    spark.createDataFrame(line, LOG_SCHEMA).write.mode("append").parquet(path)
