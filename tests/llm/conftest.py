import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators use inside
    *(T.StructField(n, T.StringType()) for n in ("id", "t", "n", "rep", "key", "kept", "score", "quality", "bucket", "length", "comp", "_gone")),
])


def docs_of(spark, rows):
    """A documents table with extra, clashing columns from (doc_id, text[, lang]) rows."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, *["x"] * 12) for r in rows]
    return spark.createDataFrame(full, DOCS)


@pytest.fixture
def make_docs(spark):
    return lambda rows: docs_of(spark, rows)


def prose(seed, n, alphabet="an er on th re in ed nd ha at en es of or nt ea ti to it st".split()):
    import random

    r = random.Random(seed)
    words = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 4))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words)).capitalize()
