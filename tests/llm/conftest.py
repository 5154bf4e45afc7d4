import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (id, text) pairs or (id, text, lang, source)."""
    def make(rows, schema=SCHEMA):
        full = [(*row, "en", "src0")[:4] if len(row) == 2 else row for row in rows]
        return spark.createDataFrame([(*row, len(row[1] or "")) for row in full], schema)
    return make


@pytest.fixture(scope="session")
def clashing():
    """Adds columns whose names the operators use themselves."""
    def add(docs, *names):
        from pyspark.sql import functions as F
        return docs.withColumns({name: F.lit(f"own {name}") for name in names})
    return add
