"""Corpus pipeline: quality classifier, quality rules, near duplicates, personal data, packing, each over all its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; stages hand over documents' columns by Parquet, the last one gives pieces.
Models are fitted on labelled rows of the tables in ``sf_dir``; a stage's decisions depend on its own input only besides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpot.llm import ngram_join, packing, pii, quality_model, quality_rules
from retailpot.llm.common import released, stored, table
from retailpot.llm.queries import PREDICTED_FROM
from retailpot.llm.tokens import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NEAR = {"width": 5, "t": ngram_join.Threshold(80, 100)}


def _sample(spark: SparkSession, sf_dir: str):
    return quality_model.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = quality_model.score(docs, quality_model.fit(*_sample(spark, sf_dir)), "_score")
    return scored.where(F.col("_score") >= PREDICTED_FROM).select(*COLUMNS)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.judge(docs.select(*COLUMNS), quality_rules.fit(*_sample(spark, sf_dir))).where("kept").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (of several texts under that id, one). Texts without words stay.

    Every row is judged by its own text, whatever other texts share its id; of rows that repeat an id and text one stays.
    """
    found = ngram_join.grouped(docs, **NEAR)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("f"))
    stays = found.where("group is not null").join(first, "group").where(F.col("doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("text_hash") == F.col("f.text_hash")))
    keep = stored(stays.unionByName(found.where("group is null"), allowMissingColumns=True).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct(), "keep")
    rows = docs.select(*COLUMNS).withColumn("_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "_hash"])
    return rows.join(keep.withColumnRenamed("_hash", "_same"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_same")), "left_semi").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars`` follows the new text."""
    found = pii.find(docs.select(*COLUMNS), pii.fit(docs))
    text = pii.redacted(F.col("text"), F.col("spans"))
    return found.withColumn("text", text).withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed token sequences."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality classifier", classify), ("quality rules", apply_rules), ("near duplicates", drop_near_duplicates), ("personal data", redact), ("packing", pack)]
ORACLE_SQL = None  # fitted models, components and packing have no SQL form; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        released(before)
    return STAGES[-1][1](spark, docs, sf_dir)
