"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the JVM compiles no method beyond 8,000 bytes of code; Spark then does better without one
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings the plans count on; sizes are left to the cluster."""
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return builder


def work_dir(spark: SparkSession) -> str:
    """Folder for written intermediates: the one named in ``spark.checkpoint.dir``, or else the
    one set for checkpoints, or else a folder of the warehouse, which all executors can reach.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, in the shared folder."""
    return f"{work_dir(spark)}/tallymill/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Used where a result must be fixed before it is read twice (range bounds are
    sampled anew on every run) and between medallion layers. Unlike a cached
    or locally checkpointed frame, it outlives lost executors.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
