"""Session settings and durable intermediate results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPES: list[list[str]] = []


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("schoolatlas")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The application's folder where driver and executors all see the same files."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def durable(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder as Parquet and read them from there.

    The copy survives lost executors, is computed once and has statistics.  It
    goes with the ``temporary_copies`` it was made in, or with ``clear_durable``.
    """
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary_copies(spark: SparkSession) -> Iterator[None]:
    """The stored copies that a job makes go at its end, also if it fails; those made before it stay."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def clear_durable(spark: SparkSession) -> None:
    """Delete all that ``durable`` has written for this application."""
    _delete(spark, shared_folder(spark))
