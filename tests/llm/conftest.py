import pytest
from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet consetetur " * 4000

#: Nulls in every column, empty and white texts, repeated rows, a very long text.
ROWS = [(1, "Hello world, this is a test.", "en", "a"), (1, "Hello world, this is a test.", "en", "a"), (2, None, "en", None),
        (3, "", None, "b"), (None, "No id here but some words.", "de", "b"), (4, " \n\t ", "fr", "a"), (5, LONG, "en", None),
        (6, "x" * 30_000, None, None), (None, None, None, None), (7, "Größe ﬁ ½ 日本語 \U0001F600 é", "de", "a")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names operators also use."""
    df = spark.createDataFrame(ROWS, SCHEMA)
    names = ("ids", "fp", "score", "length", "n_words", "kept", "removed", "spans", "language", "labels", "rank", "key", "a", "b")
    return df.withColumns({n: F.lit("keep") for n in names})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def write(spark, tmp_path_factory):
    """Write rows as the tables of a small data folder."""
    def put(**tables):
        path = tmp_path_factory.mktemp("sf")
        for name, df in tables.items():
            df.write.parquet(f"{path}/{name}.parquet")
        return str(path)
    return put
