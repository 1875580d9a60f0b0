"""Small tables with everything that may be odd about documents."""

from pyspark.sql import types as T

WORDS = "the quick brown fox jumps over the lazy dog near a quiet river bank today".split()
LONG = " ".join(f"word{i % 700} and then some more." for i in range(4000))
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
EXTRA = ["TEXT", "score", "key", "print", "_row", "kept", "copy", "found"]
ROWS = [
    (1, "A first line of the text here.\nA second line, with seven more words.\n", "en", "a", 70),
    (2, "a FIRST line of the text here. And another one that only this has.", "en", "a", 60),
    (3, None, "en", "a", None),
    (4, "", None, "b", 0),
    (5, " \n\t \x0b\f\r ", "fr", None, 8),
    (6, LONG, "en", "b", len(LONG)),
    (7, LONG, "en", "b", len(LONG)),
    (8, LONG + " end", "en", "b", None),
    (None, "a row without an id but with a sentence in it.", "en", "b", 46),
    (None, "a row without an id but with a sentence in it.", "en", "b", 46),
    (9, "naïve Ünïcode 日本語 😀 text with odd blanks", "de", "c", 40),
    (9, "naïve Ünïcode 日本語 😀 text with odd blanks", "de", "c", 40),
    (9, "the same id with another text altogether, which is longer", "de", "c", 58),
    (10, " ".join(WORDS * 3), "en", "a", 1),
    (11, " ".join(WORDS * 3).upper(), "en", "a", 1),
    (12, "x", "en", "a", 1),
    (13, "1234567890 " * 30, "en", "a", 1),
    (14, "\x01 control \x02 signs ▁ and a marker", "es", "a", 1),
]
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def odd(spark, rows=ROWS, extra=()):
    """The rows as a table, with further columns named like what operators use."""
    schema = T.StructType([*SCHEMA, *(T.StructField(n, T.StringType()) for n in extra)])
    return spark.createDataFrame([(*r, *(["other"] * len(extra))) for r in rows], schema)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
