import pytest

#: Documents with every odd case: nulls in any column, empty and blank texts,
#: repeated rows, ties, one long text, and columns whose names clash with those
#: the operators work with.
LONG = "long " + "wörd tälk " * 30_000 + "end"
ODD = [
    (1, "Hello there, this is a plain text of some words.", "en", "a", 10),
    (2, "Hello  there,\tthis is a plain text\nof some words.", "en", "b", None),
    (2, "Hello  there,\tthis is a plain text\nof some words.", "en", "b", None),
    (None, "Hello there, this is a plain text of some words.", None, None, 3),
    (None, None, None, None, None),
    (5, None, "de", "a", 0),
    (6, "", "de", None, 0),
    (7, " \t\n ", None, "a", 4),
    (8, "123 456 !!", "en", "a", 10),
    (9, LONG, "de", "a", len(LONG)),
    (10, LONG, "de", "a", len(LONG)),
    (11, "<|endoftext|> don't İ 日本   x\u0085y 😀", "en", "a", 5),
    (12, "x", "en", "a", 1),
    (12, "y", "en", "a", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASH = ("rid", "fp", "digest", "id", "bucket", "block", "_rid", "_h", "HELD_OUT", "train", "n")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def some(spark):
    """(documents, rows) of the small tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return docs, docs.collect()
