import pytest

DDL = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use for columns of their own.
CLASHES = ("key", "row", "node", "component", "slot", "shard", "n", "place", "gone", "hit_words", "row_key", "row_count",
           "chunk", "bucket", "size", "left", "first", "mix_pass", "found", "score", "id")


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, source) rows; `clash` adds columns named like the operators' own."""
    def made(rows, clash=False):
        rows = [(i, t, "en", s[0] if s else "src", None if t is None else len(t)) for i, t, *s in rows]
        docs = spark.createDataFrame(rows, DDL)
        if clash:
            from pyspark.sql import functions as F
            docs = docs.select("*", *[F.lit("other").alias(c) for c in CLASHES])
        return docs
    return made
