"""Text output: one row per line, key and value separated by a tab."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.scores import render_vector


def _key_value(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(F.concat_ws("\t", key, value).alias("value"))


def _pair(left: str, right: str) -> Column:
    return F.concat(F.lit("("), F.col(left), F.lit(", "), F.col(right), F.lit(")"))


def render_counts(counts: DataFrame) -> DataFrame:
    """``word, n`` as text."""
    return _key_value(counts, F.col("word"), F.col("n").cast("string"))


def render_pmi_pairs(pairs: DataFrame) -> DataFrame:
    """PMI rows as ``(x, y)`` and the eight numbers."""
    return _key_value(pairs, _pair("x", "y"), render_vector())


def render_bigram_counts(counts: DataFrame) -> DataFrame:
    """``w1, w2, n`` as ``(w1, w2)`` and the count."""
    return _key_value(counts, _pair("w1", "w2"), F.col("n").cast("string"))


def render_bigram_pairs(pairs: DataFrame) -> DataFrame:
    """``w1, w2, rf`` as ``(w1, w2)`` and the share."""
    return _key_value(pairs, _pair("w1", "w2"), F.col("rf").cast("string"))


def render_stripes(stripes: DataFrame, word: str) -> DataFrame:
    """A word and its map as a JSON object; one line per part of a very long map."""
    return _key_value(stripes, F.col(word), F.to_json("stripe"))


def write_text(
    rendered: DataFrame, path: str, num_partitions: int | None = None, sort: bool = False
) -> None:
    """Write rendered rows over whatever is at ``path``.

    ``num_partitions`` is the number of part files at most; without it Spark decides by size.
    With ``sort`` rows are in order within and across part files. Sorting splits by range of
    whole rows, so the rows of one frequent word may fill several files but never one task.
    """
    if sort and num_partitions:
        rendered = rendered.repartitionByRange(num_partitions, "value").sortWithinPartitions("value")
    elif sort:
        rendered = rendered.orderBy("value")
    elif num_partitions:
        rendered = rendered.repartition(num_partitions)
    rendered.write.mode("overwrite").text(path)
