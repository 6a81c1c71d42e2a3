"""A small documents table with every awkward case, and helpers of the tests."""

from pyspark.sql import types as T

#: Extra columns named like the operators' own intermediate ones.
CLASHING = ["score", "_score", "fp", "_fp", "label", "_label", "_id", "_key", "_mark", "_draw", "key", "size", "draw", "at", "x", "pos", "range", "next", "edited", "word"]
LONG = ("der lange text mit vielen worten. " * 6000)[:200_000]

ROWS = [
    (1, "The cat sat on the mat, and the dog looked on.", "a"),
    (2, "The cat sat on the mat, and the dog looked on.", "a"),  # an exact copy
    (3, None, "a"),
    (4, "", "b"),
    (5, "word", "b"),
    (6, LONG, None),
    (6, LONG, None),  # a repeated row
    (7, "   \n\t ", "b"),
    (None, "A text without an id, written by someone in a hurry.", "c"),
    (None, "A text without an id, written by someone in a hurry.", "c"),
    (8, "Ünïcödé 中文 🙂 text mit é und mehr Worten darin <|endoftext|> Ende.", None),
    (9, "mail bob@example.org or call +1 (212) 555-0199 from 10.0.0.1, card 4111 1111 1111 1111", "c"),
    (10, "idiot idiot moron " * 3, "c"),
]


def odd_documents(spark, rows=ROWS):
    fields = [("doc_id", T.LongType()), ("text", T.StringType()), ("source", T.StringType())]
    fields += [(c, T.StringType()) for c in CLASHING]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    return spark.createDataFrame([(*r, *("extra" for _ in CLASHING)) for r in rows], schema)


def odd_labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (3, 0, 0), (5, 0, None), (8, 1, 0), (9, None, 0), (10, 0, 1), (None, 1, 1), (6, 1, 0), (6, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
