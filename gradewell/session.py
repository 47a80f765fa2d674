"""Session settings the jobs expect, and the shared folder they pin tables in."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# HotSpot never compiles a method above 8,000 bytes, so one that Spark generates for many columns
# would be interpreted row by row. Above this limit Spark runs the operators one by one instead.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Compared with the size AQE measured for a finished stage, not with an estimate.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    METHOD_LIMIT[0]: METHOD_LIMIT[1],
}


def session(app: str = "gradewell", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir``.

    Where it is unset, as in tests, a folder in the warehouse, which is shared
    by definition.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_pinned").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    Used where several branches must see the same rows (segment numbers of a
    range partitioning) or where a deep plan would otherwise run again. The
    shuffle files of the finished write are given back at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "pinned")
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
