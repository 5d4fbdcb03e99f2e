"""Rows that every text operator must take: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("_row", T.StringType()), T.StructField("sequence_id", T.StringType()), T.StructField("SPANS", T.StringType())])

LONG = " ".join(f"word{i % 977} tail{i % 13}" for i in range(60_000))

TEXTS = [
    (1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (4, "Hello World", "en"), (5, "hello world", "xx-odd"),
    (5, "hello world", "xx-odd"), (6, LONG, "en"), (7, LONG.upper(), "en"), (None, "hello WORLD", None), (None, None, None),
    (8, "ÉCOLE école", "fr"), (9, "école École", "fr"), (10, "mail a.b@c.example.com now, ip 10.0.0.1", "en"),
    (4, "another text for the same id", "en"), (11, "日本語 テスト 😀", "ja"), (12, "<|endoftext|> it's x_y 3.5%", "en"),
]


def rows():
    return [(i, t, g, None if t is None else len(t), "x", "y", "z", "s", "p") for i, t, g in TEXTS]


def frame(spark, of=None):
    return spark.createDataFrame(rows() if of is None else of, SCHEMA)


def plain(spark, texts):
    """``doc_id, text`` with ids from 0."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
