import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text[, lang[, source]]) rows, with
    further columns whose names clash with results and inner names."""
    from pyspark.sql import functions as F

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for c in ("score", "row", "node", "comp", "kept", "size", "start", "length", "label", "words", "held_out", "digest", "block", "a", "b"):
            df = df.withColumn(c, F.lit("clash"))
        return df
    return make


@pytest.fixture(scope="session")
def real(spark):
    """Tables of the smallest given scale."""
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")


#: Nulls, empty and blank texts, repeated rows, no letters, one very long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven eight nine ten eleven twelve."),
       (4, "one two three four five six seven eight nine ten eleven twelve."), (None, "a row without an id, of several words"),
       (5, "123 456"), (6, "wort " * 60_000), (7, "one two three four five six seven eight nine ten eleven twelve."),
       (8, "Ünïcode 漢字 текст emoji 😀 ends"), (9, "x")]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def empty(docs_of, spark):
    return docs_of([(1, "x")]).where("doc_id < 0")
