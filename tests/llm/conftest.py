import os

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the smallest table."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(os.path.join(SMALL, "documents.parquet")).select("doc_id", "text").collect()]


#: NULLs, empty and blank texts, repeated rows, ids that repeat with other texts, a long text; and columns with the operators' own names.
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (4, "one two"), (5, "One  TWO"), (6, "É à ü 漢字 <|endoftext|> a  b\n\n c"),
    (None, "no id here at all"), (None, "no id here at all"), (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (7, "another text under the same id"), (8, "0123456789 " * 3000), (9, "!!! 123 ..."), (10, "\n\n\n"),
]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i, t, "en", 5, "x", 0) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_words int, kept string, shard int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
