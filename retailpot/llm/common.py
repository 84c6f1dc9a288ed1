"""Shared folder, reliable cuts and column hygiene of the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from retailpot.session import shared_root


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder (below ``spark.checkpoint.dir``)."""
    return f"{shared_root(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends at files that all executors see."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch`` has named, once its last reader has been written out."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def released(*tables: DataFrame) -> None:
    """Delete ``stored`` tables after their last reader; others are left alone. Shuffle files go with the plans that are no longer held."""
    for t in tables:
        if path := t.__dict__.pop("stored_at", None):
            removed(t.sparkSession, path)
    if tables:
        tables[0].sparkSession._jvm.System.gc()  # Spark drops shuffle files only when the driver collects its garbage
