"""Fixtures shared by the operator tests."""

import datetime
import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

# Names that the operators use inside, as extra columns of other types.
CLASHES = ["uid", "id", "n", "sha", "z", "h1", "t", "_t", "_fid", "_fh", "_fs", "_fsha", "_fn", "m", "key", "node", "label",
           "kept", "size", "copies", "_copies", "_copy", "word", "held", "rn", "src", "_k__fid", "_pick", "lines", "bucket"]


def words(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}x" for _ in range(n))


def docs(spark, rows):
    """Documents from (doc_id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCS)


def awkward(seed=0):
    """Nulls, empty, white space only, repeated rows, ties, long and odd texts."""
    rng = random.Random(seed)
    long = words(rng, 6000)
    return [(1, None), (2, ""), (3, " \t\r\n\x0b\x0c"), (None, "no id at all here"), (None, None), (4, "same row"), (4, "same row"),
            (5, "samerow"), (6, long), (7, long + " tail"), (8, "▁ mark \U0001F600 emoji   nbsp"), (9, "a"), (10, "x" * 5000),
            (11, "1.2.3.4 +1 (555) 123-4567 a@b.co 4111 1111 1111 1111"), (12, words(rng, 40)), (13, words(rng, 40)), (13, words(rng, 40))]


def with_clashes(df):
    from pyspark.sql import functions as F
    return df.select("*", *[F.array(F.lit(i)).alias(c) for i, c in enumerate(CLASHES) if c not in df.columns],
                     F.lit(datetime.date(2020, 1, 1)).alias("word_"))
