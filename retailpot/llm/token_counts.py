"""Token counts over a digest cache: content met before is looked up, only distinct new content is encoded and appended.

The cache is a Parquet table (content_sha256, tokenizer_sha256, n_tokens). Content is normalised only in ways that cannot change a
count: where the tokenizer drops white space, runs of ASCII white space become one space and the ends are trimmed. The tokenizer's
digest covers the whole file, so another version never meets stale counts. Copies of one text meet in a grouping with map-side
combine (one row per task and digest), so a text that makes up a third of all rows is encoded once and moved a few times.
A cache with a count twice (two writers at once) is read as one.
"""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailpot.llm.tokens import splits_at_blanks, word_ids

CACHE = "content_sha256 string, tokenizer_sha256 string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def content_digest(text: Column, blanks_dropped: bool) -> Column:
    text = F.coalesce(text, F.lit(""))
    if blanks_dropped:
        text = F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " "))
    return F.sha2(text.cast("binary"), 256)


def _has_files(df_path: str, spark) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(df_path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def count_tokens(docs: DataFrame, cache_path: str, tokenizer_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """``docs`` with ``out`` (tokens without added special ones, whole texts, null as empty); misses are appended to ``cache_path``.

    Empty tables give an empty result and an empty cache. Repeated rows all get their count. A column that is named ``out`` already is replaced.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        blanks_dropped = splits_at_blanks(json.load(f))
    version = tokenizer_digest(tokenizer_path)
    if out == text:
        raise ValueError("the counts need a column of their own")
    docs = docs.drop(out)
    key = "_digest"
    while key in docs.columns:
        key += "_"
    digest = content_digest(F.col(text), blanks_dropped)
    new = docs.groupBy(digest.alias("content_sha256")).agg(F.first(F.coalesce(F.col(text), F.lit(""))).alias("content"))
    if _has_files(cache_path, spark):
        known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer_sha256") == version)
        new = new.join(known, "content_sha256", "left_anti")

    def encode(batches):
        counter = word_ids(tokenizer_path)
        for b in batches:
            yield pd.DataFrame({"content_sha256": b["content_sha256"], "tokenizer_sha256": version, "n_tokens": counter.counts(b["content"].tolist())})

    new.mapInPandas(encode, CACHE).write.mode("append").parquet(cache_path)
    known = spark.read.schema(CACHE).parquet(cache_path).where(F.col("tokenizer_sha256") == version)
    known = known.groupBy(F.col("content_sha256").alias(key)).agg(F.max("n_tokens").alias(out))
    return docs.withColumn(key, digest).join(known, key).drop(key)
