"""The queries that SQL can express, against DuckDB on the same tables."""

import pytest

import corpus_pipeline
from tests.conftest import TESTDATA
from waybill.llm.oracles import ORACLES
from waybill.llm.queries import QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
    names = sorted(result.columns)
    quoted = ", ".join(f'"{column}"' for column in names)
    want = duck("0.001").sql(f"SELECT {quoted} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(row[column] for column in names) for row in result.collect()]
    assert got and sorted(got, key=str) == sorted(want, key=str)


def test_every_dealt_operator_has_one_query():
    numbers = [name.split("_")[0] for name in QUERIES]
    assert sorted(numbers) == sorted(f"op{n}" for n in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "pii", "source_mixing", "bpe"]
