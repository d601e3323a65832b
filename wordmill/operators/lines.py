"""Lines of a text column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import text as T


def split_lines(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """One row per line of ``column`` as ``value``.

    With ``keep``, those columns and the line's number in its text (from 0) come along.
    """
    kept = keep or []
    # Cut in a step of its own: a generator works out a repeated expression repeatedly.
    parts = df.select(*kept, T.line_parts(F.col(column)).alias("parts"))
    lines = T.without_open_end(F.col("parts"))
    if keep is None:
        return parts.select(F.explode(lines).alias("value"))
    return parts.select(*kept, F.posexplode(lines).alias("line_no", "value"))
