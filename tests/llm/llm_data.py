"""Odd and real rows for the tests."""

import zlib

import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import types as T

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       # names the operators use inside
                       T.StructField("row", T.StringType()), T.StructField("key", T.LongType()),
                       T.StructField("n", T.LongType()), T.StructField("size", T.StringType())])

LONG = "lorem ipsum dolor sit amet " * 4000

#: nulls everywhere, empty and long texts, equal texts, repeated rows and ids
ODD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \t\n", "en", "a"), (4, "one", "en", None), (5, LONG, "en", "a"),
    (6, LONG, "en", "b"), (6, LONG, "en", "b"), (None, "one", "en", "a"), (None, None, None, "b"), (7, "one  two\nthree", "de", "b"),
    (8, "one two three", "de", "b"), (9, "İstanbul, café \U0001f642 <|endoftext|> x", "fr", "c"), (9, "other words of the same id", "fr", "c"),
    (10, "12 34 !!", None, "c"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, None, "y") for r in rows], SCHEMA).repartition(3)


def real(n=None, name="sf0.001"):
    rows = pq.read_table(f"/root/testdata/{name}/documents.parquet").to_pylist()
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in rows[:n]]


def crc(doc_id, k):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % k
