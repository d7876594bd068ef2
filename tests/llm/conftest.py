import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def frame(spark):
    """A documents frame of (doc_id, text) or (doc_id, text, lang) rows, with clashing extra columns."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        for name in ("component", "score", "id", "h", "key", "u", "row"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make
