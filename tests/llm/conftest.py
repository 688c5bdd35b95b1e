import pytest
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.001"

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use for columns of their own.
    T.StructField("ids", T.StringType()), T.StructField("key", T.StringType()), T.StructField("node", T.StringType()),
    T.StructField("hit", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("score", T.StringType()),
    *[T.StructField(name, T.StringType()) for name in ("toxic", "part", "labelled", "spans", "raw", "matches", "doc", "runs")],
])

PROSE = " ".join(f"word{i * 7919 % 1009}" for i in range(120))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls everywhere, empty and long texts, ties and repeated rows, extra columns with clashing names."""
    long_text = " ".join(f"w{i * 31 % 5003}" for i in range(40_000))
    texts = [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE + " more"), (4, ""), (5, None), (6, long_text), (7, " \n\t "),
        (None, "a text without an id"), (8, "short"), (9, "a@b.co +1 (017) 555-7713 \u00e9t\u00e9"), (None, None),
    ]
    rows = [(i, t, None if i == 1 else "en", None, None, "x", "y", "z", "h", "n", "s", *"abcdefgh") for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def few_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 1, 1), (8, 0, 1), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small_benchmark(spark):
    rows = [(1, " ".join(PROSE.split()[30:45])), (2, None), (3, ""), (4, "short"), (4, "short"), (None, "two words")]
    return spark.createDataFrame(rows, "item_id long, text string")
