import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

SMALL = "/root/testdata/sf0.01"
#: Names that the operators might use themselves.
CLASHING = ("id", "row", "node", "a", "b", "n", "col", "kind", "start", "end", "key", "norm", "sha",
            "found", "edge", "keep", "component", "score", "features", "rule", "line_no", "host")
LONG_TEXT = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
LONG_WORD = "x1-" * 40_000


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeats and ties."""
    texts = [None, "", " \t\n\r\f\v ", "123 456 !!", LONG_TEXT, LONG_WORD, LONG_TEXT + " end",
             "one two three", "One  TWO\tthree", "A tie of five words here.", "A tie of five words here.",
             "é à ü \U0001f600  x", "+1 (017) 555-7713 a@b.co 1.2.3.4", "line\nline\n\nline"]
    rows = [(i, t, [None, "en", "fr"][i % 3], None if i % 4 else "s", None)
            for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (None, "no id but some words in here", "en", "s", 1),
             (None, None, None, None, None)]
    base = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType())]
    extra = [T.StructField(c, T.StringType()) for c in CLASHING]
    schema = T.StructType(base + extra)
    return spark.createDataFrame([(*r, *[c if k % 2 else None for k, c in enumerate(CLASHING)])
                                  for r in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark, awkward):
    return spark.createDataFrame([], awkward.schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)


@pytest.fixture(scope="session")
def corpus(documents) -> list[Row]:
    return documents.collect()


def counts(df, *cols):
    from collections import Counter

    return Counter(tuple(r) for r in df.select(*cols).collect())
