"""Cases that every text operator meets: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import random

WORDS = "the of and in to a is that it was for on are as with his they be at one have this from or had by".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x%d" % rng.randrange(400), ",", "."]) for _ in range(n))


LONG = prose(1, 30_000)
TEXTS = [None, "", " \n\t", "one", "Two words", prose(2, 12), prose(2, 12), prose(3, 300), prose(3, 300), prose(3, 299) + " end", LONG,
         "Ünï ✓ 漢字 👍 café\nline\nline\n\n", "a" * 70_000, "# $ | *", "mail a.b@c.org now, +1 (555) 555-0199 or 10.0.0.1"]


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def clashing(df, *names):
    """``df`` with columns of an operator's own names."""
    from pyspark.sql import functions as F

    return df.select("*", *[F.lit("mine").alias(n) for n in names])


def read(sf="sf0.001", table="documents"):
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '/root/testdata/{sf}/{table}.parquet' ORDER BY doc_id").fetchall()
