"""Intermediate results that several later steps read, kept as Parquet in the shared folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names in ``spark.checkpoint.dir``; all executors must share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/wordmill-{spark.sparkContext.applicationId}"


def kept_path(spark: SparkSession, name: str) -> str:
    """A path of its own for something this session keeps."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffle_files_removed(spark: SparkSession):
    # What is written needs its shuffles no more; left alone they stay until the driver's
    # garbage collector comes by.
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str = "kept") -> DataFrame:
    """Compute ``df`` once into the shared folder, where the loss of executors cannot reach it.

    The files stay until ``release`` or until somebody clears the folder.
    """
    spark = df.sparkSession
    path = kept_path(spark, name)
    with _shuffle_files_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Remove all this session has kept; results that still read it must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
