import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make(spark):
    """A documents table of (doc_id, text, lang, source) rows, with extra columns whose names clash with internal ones."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           *[T.StructField(c, T.IntegerType()) for c in ("key", "h", "norm", "size", "tie", "fp", "k", "cell")]])

    def build(rows):
        full = [(*r, *((None, None, None, None)[len(r):]), *range(8)) for r in rows]
        return spark.createDataFrame(full, schema)

    return build


#: Null and empty texts, null ids and metadata, repeated rows, an id with two texts, a very long text.
HARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", None, "b"), (4, "the cat sat on the mat", "en", "a"),
    (5, "the  cat\tsat on the mat", "en", "b"), (5, "the  cat\tsat on the mat", "en", "b"), (6, "1234 --- 5678", "de", "a"),
    (None, "no id at all here", "en", None), (None, "no id at all here", "en", None), (7, "same id, first text", "en", "a"),
    (7, "same id, second text", "en", "a"), (8, "wörter über straßen", "de", "b"),
    (9, "long " * 60_000, "en", "b"), (10, "the cat sat on the mat", "en", None), (11, "😀 emoji ’quoted’ text", "en", "a"),
]
