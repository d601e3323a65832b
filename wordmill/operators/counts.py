"""Counts of words and lines.

Each is one grouped aggregate: Spark adds up inside the map task first, so a word that makes
up a third of the corpus still sends only one row per task through the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import text as T


def explode_words(lines: DataFrame) -> DataFrame:
    return lines.select(F.explode(T.words(F.col("value"))).alias("word"))


def word_count(lines: DataFrame) -> DataFrame:
    """Occurrences of every word: ``word, n``.

    Line ends are token delimiters too, so whole texts may be passed instead of lines.
    """
    return explode_words(lines).groupBy("word").agg(F.count("*").alias("n"))


def line_total(lines: DataFrame) -> DataFrame:
    """Number of lines, empty ones included: ``n_lines``."""
    return lines.agg(F.count("*").alias("n_lines"))


def line_frequency(lines: DataFrame, max_tokens: int | None = T.MAX_TOKENS) -> DataFrame:
    """Number of lines each word occurs in: ``word, n``.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines.
    """
    words = T.distinct_words(F.col("value"), max_tokens)
    return lines.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
