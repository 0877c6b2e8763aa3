from __future__ import annotations

import tempfile

import duckdb
import pytest
from pyspark.sql import SparkSession

from tallymill.session import configure

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("tests")
    settings = {
        "spark.sql.shuffle.partitions": "4",
        
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tallymill-tests-"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


def rows(df) -> list[tuple]:
    """Rows as sorted tuples, columns by name."""
    columns = sorted(df.columns)
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)
