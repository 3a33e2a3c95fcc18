import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASHES = ["_key", "key", "size", "word", "row", "kept", "spans", "items", "term", "n_words", "copies", "_k1", "simhash"]


@pytest.fixture
def docs(spark):
    """A frame of documents from (doc_id, text) or (doc_id, text, source)."""
    def make(rows, clash=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, COLUMNS)
        if clash:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit("other") for c in CLASHES})
        return df
    return make
