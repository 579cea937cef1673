import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names clash with inner ones."""
    def make(rows, extra=False):
        df = spark.createDataFrame([(d, t, "en", "src0", len(t or "")) for d, t in rows], DOCS)
        if extra:
            for c in ("v", "a", "b", "key", "ref", "tag", "spans", "n", "label", "score", "kept", "salt", "rank", "quality"):
                df = df.selectExpr("*", f"cast(doc_id as string) as {c}")
        return df
    return make
