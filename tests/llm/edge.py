"""Rows every operator must take: nulls, empty and long texts, repeated rows, clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: names the operators use themselves
CLASH = ("score", "shard", "slot", "fp", "kept", "_text", "size", "taken", "n_tokens", "ids", "_id", "lang_pred", "_row")


def prose(rnd, n, letters="abcdeéß"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 8))) for _ in range(n))


def rows(seed=1, n=40):
    rnd = random.Random(seed)
    base = [(i, prose(rnd, rnd.randint(1, 120)), rnd.choice(["en", "de", None]), rnd.choice(["a", "b", None]), 5) for i in range(n)]
    long = prose(rnd, 6000)
    return base + [(100, None, "en", "a", None), (101, "", "en", "b", 0), (102, " \n\t ", None, None, 4), (103, "...!? 123", "en", "a", 9),
                   (104, long, "en", "a", len(long)), (105, long, "de", "c", len(long)), (None, "no id here", "en", "a", 10),
                   base[0], base[0], base[1], (106, base[2][1], "en", "b", 5), (107, "x" * 3000, "en", "b", 3000)]


def docs(spark, data=None, clash=False):
    df = spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)
    if clash:
        from pyspark.sql import functions as F

        df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASH})
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
