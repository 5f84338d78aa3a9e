"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def builder(app: str = "stormledger") -> SparkSession.Builder:
    """Settings every job wants; sizing is left to the cluster and to AQE."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the one the cluster names.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"{CHECKPOINT_DIR} must name a folder shared by the cluster")
    return "file://" + tempfile.mkdtemp(prefix="stormledger-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/stormledger/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a table in the shared folder and read it back.

    For small results that several jobs start from; unlike a cache it survives
    the loss of an executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table that may not be there yet: without rows then."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
