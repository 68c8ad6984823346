import pytest


@pytest.fixture
def docs(spark):
    """Builds documents with an extra column whose name an operator might use itself."""

    def build(rows):
        full = [(i, t, "en", "src", len(t or ""), "x") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, _key string")

    return build
