import pytest
from pyspark.sql import functions as F

#: Rows that every operator has to bear: nulls, empty and blank texts, ties, repeated rows, a long text.
ODD = [
    (1, None, "en", "s", 0),
    (2, "", None, "s", 0),
    (3, " \t\n\r ", "en", None, 5),
    (None, "no id at all here", "en", "s", None),
    (5, "one", "en", "s", 3),
    (6, "the same words in two rows of one id", "en", "s", 1),
    (6, "the same words in two rows of one id", "en", "s", 1),
    (7, "É日本語 😀 <|endoftext|> ▁x <s> \x00 end", "fr", "s", 1),
    (8, "word " * 30_000 + "x" * 5_000, "en", "s", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def odd(spark):
    """Odd rows with extra columns whose names operators use themselves."""
    rows = spark.createDataFrame(ODD, SCHEMA)
    return rows.withColumns({c: F.lit("x") for c in ("score", "ids", "row", "hash", "copies", "n", "class")})


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
