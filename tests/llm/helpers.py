"""Small tables with every awkward case, for all operators on documents."""

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("fp", T.StringType()), T.StructField("words", T.StringType())])


def docs(spark, rows):
    """Rows of (doc_id, text[, lang, source]); columns with clashing names come along."""
    full = []
    for r in rows:
        r = tuple(r) + (None,) * (4 - len(r))
        full.append((r[0], r[1], r[2], r[3], len(r[1] or ""), "x", None))
    return spark.createDataFrame(full, DOCS)


def prose(seed, n, vocabulary=400):
    import random

    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
