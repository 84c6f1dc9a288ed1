"""Session settings and the shared folder used for checkpoints and layer tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(master: str | None = None, app: str = "retailpot", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``, or in the checkpoint directory the user has set. Only on a
    local master without either (tests on one machine) is a folder of our own made; elsewhere that is an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        context = spark.sparkContext
        base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if not base:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            base = tempfile.mkdtemp(prefix="retailpot-")
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(base)
        _ROOTS[app] = f"{base.rstrip('/')}/retailpot-{app}-{uuid.uuid4().hex[:8]}"
    return _ROOTS[app]


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and cut its lineage."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder as columns and read from there: for a few columns of a dear plan that several passes read."""
    path = f"{shared_root(df.sparkSession)}/kept-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
