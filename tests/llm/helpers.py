"""Small fixtures shared by the tests of the training-data operators."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qi ro su ta ve wi xo zu".split()


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n)]


def text(n, seed):
    return " ".join(words(n, seed))


def docs(spark, rows):
    """Rows (doc_id, text[, lang[, source]]) as a ``documents`` table."""
    full = [(i, t, *(rest + [None, None])[:2], None if t is None else len(t)) for i, t, *rest in rows]
    return spark.createDataFrame(full, DOCS)


def clashing(df):
    """The same rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    return df.select("*", *[F.lit(1).alias(c) for c in ("id", "chunk", "size", "target", "copies", "keep", "row", "class_id", "slot", "score", "n", "x", "u", "w", "src")])


def odd_rows():
    """Null id, null and empty text, blanks, repeated rows, one long text."""
    long = text(30_000, 1)
    return [(None, text(40, 2), "en", "a"), (1, None, "en", None), (2, "", None, "b"), (3, " \t\n", "de", "b"), (4, text(40, 3), "en", "a"), (4, text(40, 3), "en", "a"),
            (5, long, "fr", "a"), (6, "one", None, None), (7, "....", "en", "b")]
