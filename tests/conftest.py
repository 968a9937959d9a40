from __future__ import annotations

import duckdb
import pytest

from orderloom.context import build_session

SF_DIR = "/root/testdata/sf0.001"
TABLES = """region nation customer supplier part orders lineitem events documents embeddings
    pages benchmark labels conversations"""


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "orderloom-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection
