import pytest
from pyspark.sql import types as T

#: Columns whose names an operator might use inside.
CLASHES = ["ids", "size", "n_words", "k1", "k2", "node", "score", "spans", "toxic", "row", "key", "component"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text, source) rows, with further columns of clashing names."""

    def make(rows):
        fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType())]
        fields += [("n_chars", T.LongType())] + [(c, T.StringType()) for c in CLASHES]
        schema = T.StructType([T.StructField(n, t) for n, t in fields])
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), *["x"] * len(CLASHES))
            for r in rows
        ]
        return spark.createDataFrame(full, schema)

    return make
