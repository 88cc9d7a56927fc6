import pytest
from pyspark.sql import DataFrame

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) or (doc_id, text, lang)."""

    def build(rows) -> DataFrame:
        data = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(data, DOCUMENTS)

    return build
