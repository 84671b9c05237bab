import pytest

from martloom.llm.shipping import ship


@pytest.fixture(autouse=True, scope="module")
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def docs(spark):
    def make(rows, schema="doc_id long, text string, lang string, source string"):
        names = [part.split()[0] for part in schema.split(", ")]
        return spark.createDataFrame([tuple(r) + (None,) * (len(names) - len(r)) for r in rows], schema)
    return make
