"""Values that are worked out once, whatever is then asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_HERE = "_here"


def settled(df: DataFrame) -> DataFrame:
    """The same rows, whose columns are made before a later filter looks at them.

    Spark moves a filter below the columns it asks for, and writes out their expressions in place
    of their names, again for each mention. A gate over typed and repaired fields thereby becomes
    more code than the JVM compiles (8,000 bytes a method), or even takes (65,535), and is then
    interpreted, row by row. It does not move a filter below a column that tells the task; one is
    made here, tested and dropped again.
    """
    return df.withColumn(_HERE, F.spark_partition_id()).where(F.col(_HERE) >= 0).drop(_HERE)
