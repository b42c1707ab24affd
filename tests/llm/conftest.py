import pytest

# Edge cases that every operator on documents has to bear.
LONG = "word other. " * 30_000


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in any column, empty and blank texts, a very long one, repeated rows, clashing columns."""
    rows = [
        (1, "One two three four five six seven eight nine ten.", "en", "a", 49, "x"),
        (1, "One two three four five six seven eight nine ten.", "en", "a", 49, "x"),
        (2, None, None, None, None, None),
        (3, "", "de", "b", 0, "y"),
        (4, " \n\t ", "de", "b", 4, "y"),
        (None, "One two three four five six seven eight nine ten.", "en", None, 49, "z"),
        (5, "é 中文 \U0001f600 <|endoftext|> token = 'aB3dE5fG7'", "fr", "c", 30, "z"),
        (6, LONG, "en", "a", len(LONG), "w"),
        (7, "One two three four five six seven eight nine ten.", "en", "a", 49, "x"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.limit(0)


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet").cache()
