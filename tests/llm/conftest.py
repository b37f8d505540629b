import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("__row", T.StringType()),
    T.StructField("content", T.StringType()), T.StructField("key", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark, tmp_path_factory):
    """A stored table of documents with extra columns whose names operators use themselves."""
    from tallyloom.llm.registry import prepare

    prepare(spark)

    def make(rows, schema=DOCS):
        full = [
            (i, t, lang, source, len(t) if t is not None else None, "own", "own", 7)
            for i, t, lang, source in rows
        ]
        path = str(tmp_path_factory.mktemp("docs") / "docs.parquet")
        spark.createDataFrame(full, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties and repeated rows."""
    words = " ".join(f"w{i}" for i in range(3000))
    return [
        (1, "one two three four five six", "en", "a"), (2, "one  two\tthree four five six", "en", "a"),
        (3, "One two three four five six", None, None), (4, None, "en", "a"), (5, "", "de", "b"),
        (6, " \n\t ", "de", "b"), (7, words, "en", "a"), (8, words + " tail", "en", None),
        (9, words, "fr", "b"), (9, words, "fr", "b"), (None, "no id here at all", "en", "a"),
        (None, "no id here at all", "en", "a"), (None, None, None, None), (10, "Été K 你好", "fr", "\U0001F600"),
        (11, "!!! ??? 123", "en", "a"), (12, "one two three four five six", "en", "z"),
    ]
