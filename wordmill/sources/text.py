"""Corpora: text files and text columns of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordmill.operators.lines import split_lines


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line of text files as ``value``; LF, CR and CRLF end a line."""
    return spark.read.text(path)


def read_texts(spark: SparkSession, path: str, column: str, keep: list[str] | None = None) -> DataFrame:
    """A text column of a Parquet table (and the ``keep`` columns), nothing else of it."""
    return spark.read.parquet(path).select(*(keep or []), column)


def read_table_lines(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row per line of a text column of a Parquet table as ``value``."""
    return split_lines(read_texts(spark, path, column), column)
