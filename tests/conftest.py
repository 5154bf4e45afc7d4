import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from waybill.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "waybill-tests", "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "checkpoint"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    """A DuckDB connection per scale, with the test tables as views."""
    open_connections = {}

    def connect(scale: str):
        if scale not in open_connections:
            connection = duckdb.connect()
            for path in glob.glob(f"{TESTDATA}/sf{scale}/*.parquet"):
                name = os.path.basename(path).removesuffix(".parquet")
                connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
            open_connections[scale] = connection
        return open_connections[scale]

    yield connect
    for connection in open_connections.values():
        connection.close()
