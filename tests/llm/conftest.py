import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum " * 30_000

#: Rows with nulls, empty and very long texts, repeated rows, and columns named like those that operators add.
EDGE_ROWS = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t", None, "a"), (4, "one", "en", "b"), (5, LONG, "fr", "b"),
    (6, "same words here again and again until ten words stand", "en", "a"), (6, "same words here again and again until ten words stand", "en", "a"),
    (7, "Same words HERE again and again until ten words stand", None, "c"), (None, "nobody knows my number", "fr", "c"), (None, None, None, None),
]
EXTRA = ("score", "lang_pred", "n_words", "item_ids", "key", "size", "_mix", "u", "h")


@pytest.fixture(scope="session")
def edge(spark):
    fields = [T.StructField("doc_id", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("text", "lang", "source")]]
    fields += [T.StructField("n_chars", T.LongType()), *[T.StructField(c, T.StringType()) for c in EXTRA]]
    return spark.createDataFrame([(*r, 0, *EXTRA) for r in EDGE_ROWS], T.StructType(fields))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
