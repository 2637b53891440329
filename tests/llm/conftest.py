import pytest
from pyspark.sql import functions as F

BASE = "the quick brown fox jumps over a lazy dog near the old river bank while seven small birds sing softly in the tall green trees"
PASSAGE = ("Every morning the keeper of the lighthouse climbed one hundred and twelve steps to trim the wick and polish the great lens before "
           "the fishing boats came home. He counted the sails, wrote the weather in a blue book, and lit the lamp again at dusk without fail.")

#: doc_id, text: nulls, empty and blank texts, ties, repeated rows and ids, short and long texts, shared passages.
EDGE = [
    (1, None), (2, ""), (3, "   \t\n "), (4, "one"), (5, "one"), (6, "Two words"), (7, "two  words"), (8, "1 2 3"), (9, "... !!"),
    (10, BASE), (11, BASE), (11, BASE), (12, BASE + " today"), (13, BASE.replace("lazy", "sleepy")), (14, BASE[::-1]),
    (15, PASSAGE), (16, "Before. " + PASSAGE + " After."), (17, "x" * 700), (18, " ".join(["again and again"] * 300)),
    (19, ("word%d " * 4000) % tuple(range(4000))), (None, BASE), (None, None), (None, "no id at all"), (20, "Über größe – naïve café 東京"),
    (21, "Released under the MIT License."), (22, "under the MIT license under the mit license"), (23, "a b 　 c"), (24, PASSAGE.upper()),
    (25, "line one\nLicensed under the Apache License, Version 2.0.\nCC BY-NC 4.0"), (26, "tab\there\r\nand\x0bthere\x0c"), (6, "another text with the same id"),
]

#: Names that the operators use inside.
CLASHES = ["n", "name", "mark", "word", "label", "labels", "batch", "owner", "grade", "kept", "rejected", "size", "node", "component", "sig", "uid", "words",
           "bucket", "digest", "doc", "pos", "term", "window", "ids", "part", "severity", "score", "toxic", "text_key", "letters", "block", "start"]


def documents(spark, rows, extra=True):
    df = spark.createDataFrame([(d, t, "en" if i % 2 else None, "s", 1) for i, (d, t) in enumerate(rows)],
                               "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if extra else df


@pytest.fixture(scope="session")
def edge(spark):
    return documents(spark, EDGE)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, EDGE).limit(0)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest test table and its rows."""
    from tests.conftest import SF_SMALL

    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return df, [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
