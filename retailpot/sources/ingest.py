"""Reading raw files, conforming columns and writing layer tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from retailpot.config import COLUMN_ALIASES

log = logging.getLogger(__name__)
RAW_FILES = (
    "distributor_seasonality_details", "holiday_list", "outlet_coordinates", "outlet_master", "transactions_history_final",
)
ROW_ID = "ingest_id"
# Texts that stand for a missing cell.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def row_id() -> Column:
    """A stable unique id of a row read from Parquet files: (hash of the file path, row number in it)."""
    return F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def read_parquet_with_id(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df if ROW_ID in df.columns else df.select("*", row_id().alias(ROW_ID))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool = False) -> DataFrame:
    """Rows of a CSV with a header and an ``ingest_id`` that numbers them in file order (file, offset of the split, row within it).

    Quotes inside quoted fields are doubled. The texts of ``MISSING`` are nulls. With a schema the file is read once; a value that does not fit its type is
    null. Without one types are inferred, in a pass of its own. ``multiline`` reads quoted line breaks; such a file cannot be split over tasks.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if schema is None:
        text = reader.csv(path)
        plain = text.select(*[F.when(~F.trim(F.col(f"`{c}`")).isin(*MISSING), F.col(f"`{c}`")).alias(c) for c in text.columns])
        schema = plain.select(*[_kind(c).alias(c) for c in text.columns]).first()
        schema = StructType([StructField(c, {0: LongType(), 1: DoubleType(), 2: StringType()}[schema[i] if schema[i] is not None else 2]) for i, c in enumerate(text.columns)])
    df = reader.schema(schema).csv(path)
    file = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    number = F.struct(file[0].alias("file"), file[1].alias("split"), F.monotonically_increasing_id().alias("row"))
    strings = {f.name for f in schema.fields if isinstance(f.dataType, StringType)}
    cells = [F.when(~F.trim(F.col(f"`{c}`")).isin(*MISSING), F.col(f"`{c}`")).alias(c) if c in strings else F.col(f"`{c}`") for c in df.columns]
    return df.select(*cells, number.alias(ROW_ID))


def _kind(c: str) -> Column:
    """0 where all filled cells of a text column are whole numbers, 1 where they are numbers, 2 otherwise."""
    cell = F.trim(F.col(f"`{c}`"))
    whole, number = cell.try_cast("long").isNotNull() & ~cell.contains("."), cell.try_cast("double").isNotNull()
    return F.max(F.when(cell.isNull(), None).when(whole, 0).when(number, 1).otherwise(2))


def ingest_csv(spark: SparkSession, raw_dir: str, bronze_dir: str, names: Sequence[str] = RAW_FILES,
               schemas: Mapping[str, StructType] | None = None, multiline: Sequence[str] = ()) -> dict[str, str]:
    """Snapshot each CSV to Parquet with every column and ``ingest_id`` (``read_csv``); returns the outcome per file.

    A missing file is skipped with a warning and a bad file does not stop the others.
    """
    outcome = {}
    for name in names:
        src = f"{raw_dir}/{name}.csv"
        if not path_exists(spark, src):
            log.warning("File not found: %s", src)
            outcome[name] = "missing"
            continue
        try:
            read_csv(spark, src, (schemas or {}).get(name), name in multiline).write.mode("overwrite").parquet(f"{bronze_dir}/{name}")
            outcome[name] = "written"
        except Exception as exc:  # one bad file must not stop the rest
            log.error("Failed to process %s: %s", src, exc)
            outcome[name] = "failed"
    return outcome


def canonical_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = COLUMN_ALIASES) -> DataFrame:
    """Rename columns by alias, ignoring case and outer blanks; the first alias found wins."""
    present = {c.lower().strip(): c for c in df.columns}
    renames = {}
    for target, names in aliases.items():
        match = next((present[a.lower()] for a in names if a.lower() in present), None)
        if match is None:
            raise ValueError(f"no column of {df.columns} stands for {target}: expected one of {list(names)}")
        renames[match] = target
    return df.withColumnsRenamed(renames)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select and cast to a fixed schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def optional_input(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where it does not exist; one that exists but cannot be read is an error."""
    if not path_exists(spark, path):
        log.info("Optional input absent: %s", path)
        return None
    return spark.read.parquet(path)


def parquet_sink(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("compression", "snappy").parquet(path)


def csv_sink(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def report_append(report: DataFrame, path: str, run: str) -> None:
    """Keep one set of rows per (dataset, run): a re-run replaces its own partition only."""
    (report.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run", "dataset").parquet(path))


def run_registry(entries: DataFrame, path: str) -> None:
    """Append one row of settings and scores per model run."""
    entries.write.mode("append").parquet(path)
