import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, __id string, score string, bucket string"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from texts; nulls everywhere are allowed, and extra columns clash with inner names."""

    def make(rows):
        full = [(i, t, "en", "s", len(t) if t is not None else None, "x", "y", "z") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make
