import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and blank texts, repeated rows, a long text, clashing extra columns."""
    long = "alpha beta gamma delta epsilon zeta eta theta " * 4000
    rows = [
        (1, "the cat sat on the mat and looked at the moon", "en", "a", 45),
        (1, "the cat sat on the mat and looked at the moon", "en", "a", 45),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \n\t ", "de", None, 4),
        (5, long, "en", "b", len(long)),
        (6, long, "en", "b", len(long)),
        (7, "der hund und die katze sind im haus und schlafen", "de", "b", 47),
        (8, "12345 !!", None, "c", 8),
        (None, "no identifier here at all, only words", "en", "c", 37),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F

    extra = {c: F.lit("x") for c in ("size", "score", "lang_pred", "kept", "row_id", "label", "hash", "target", "words", "host")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)
