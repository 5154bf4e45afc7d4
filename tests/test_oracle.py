"""Every registered query against DuckDB on the same tables."""

import pytest

from __spark_entry__ import entry
from oracles import ORACLES
from tests.conftest import TESTDATA
from waybill.queries import QUERIES

SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def in_order(rows):
    return sorted(rows, key=lambda row: [(value is None, str(value)) for value in row])


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name, scale):
    result = QUERIES[name](spark, f"{TESTDATA}/sf{scale}")
    oracle = duck(scale).sql(ORACLES[name])
    names = sorted(result.columns)
    assert names == sorted(oracle.columns)
    types = dict(zip(oracle.columns, [str(kind) for kind in oracle.types]))
    assert {field.name: SPARK_TO_DUCK[field.dataType.simpleString()] for field in result.schema} == types
    got = in_order(tuple(row[column] for column in names) for row in result.collect())
    quoted = ", ".join(f'"{column}"' for column in names)
    want = in_order(duck(scale).sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall())
    assert len(got) > 0
    assert got == want


def test_entry_is_the_mart(spark):
    assert entry(spark).count() == 68
