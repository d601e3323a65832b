"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Sizes joins and reduce tasks by what was really shuffled, and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Kept results are many small files that become much work; don't merge them into few tasks.
    "spark.sql.files.openCostInBytes": "262144",
    # A small shuffle may become a lot of pairs, so small partitions are not merged down to one
    # per core.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
}


def session(name: str = "wordmill", **extra: str) -> SparkSession:
    """A session with those settings; ``extra`` takes dots in names as double underscores."""
    named = {key.replace("__", "."): value for key, value in extra.items()}
    return SparkSession.builder.appName(name).config(map=SETTINGS | named).getOrCreate()
