"""Bronze layer: raw text files into all-text tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymill.sources.schemas import PATHS, SCHEMAS

STATUS_SCHEMA = "table_name string, path string, rows_loaded bigint, status string, error string"
_NEVER = "\u0001"


def read_overflow_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Unquoted comma-separated text whose surplus fields stay in the last column.

    Spark's own CSV reader drops the surplus. Here it only cuts lines and skips
    the first line of each file (large files are still split); the fields come
    from a split with a limit. Missing and empty fields are NULL.
    """
    lines = (
        spark.read.schema("line string")
        .options(header=True, sep=_NEVER, quote="", escape="", comment="", mode="PERMISSIVE")
        .csv(path)
    )
    n = len(schema.fields)
    parts = F.split(F.rtrim(F.col("line"), F.lit("\r")), ",", n)
    return lines.select(
        *[
            F.nullif(F.get(parts, F.lit(i)), F.lit("")).alias(f.name, metadata=f.metadata)
            for i, f in enumerate(schema.fields)
        ]
    )


def load_bronze(
    spark: SparkSession,
    root: str,
    target: str,
    *,
    truncate_first: bool = True,
    continue_on_error: bool = False,
    tables: Iterable[str] | None = None,
) -> DataFrame:
    """Load every table of the manifest from ``root`` into parquet under ``target``.

    One status row per table: LOADED, FAILED, or SKIPPED once a failure has
    stopped the load. Rows are counted while they are written. A final row named
    ``*`` tells whether the load as a whole succeeded.
    """
    status: list[tuple] = []
    failed = False
    for name in tables or SCHEMAS:
        path = f"{root.rstrip('/')}/{PATHS[name]}"
        if failed and not continue_on_error:
            status.append((name, path, None, "SKIPPED", None))
            continue
        seen = Observation()
        try:
            raw = read_overflow_csv(spark, path, SCHEMAS[name])
            counted = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("overwrite" if truncate_first else "append").parquet(f"{target}/{name}")
            status.append((name, path, seen.get["rows"], "LOADED", None))
        except Exception as err:  # noqa: BLE001 - any failure is reported per table
            failed = True
            status.append((name, path, None, "FAILED", str(err).splitlines()[0]))
    outcome = "completed with errors" if failed else "completed successfully"
    status.append(("*", root, sum(s[2] or 0 for s in status), outcome, None))
    return spark.createDataFrame(status, STATUS_SCHEMA)


def read_bronze(spark: SparkSession, target: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{target.rstrip('/')}/{name}")
