import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples, with two extra columns whose names clash."""
    def make(rows):
        full = [(r[0], r[1], (r + (None, None))[2], (r + (None, None, None))[3],
                 None if r[1] is None else len(r[1]), "x", 7) for r in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, size string, shard int")
    return make
