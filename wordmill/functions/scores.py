"""Probability and PMI columns in single precision, and their text rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The eight published numbers of a pair, in output order, and their format.
VECTOR = ["n_x", "p_x", "n_y", "p_y", "n_xy", "p_xy", "pmi", "log10_pmi"]
NUMBER_FORMAT = "%.5f"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Single-precision quotient.

    Spark divides floats as doubles; narrowing that quotient gives the correctly rounded
    single-precision result because a double has more than twice the digits of a float.
    """
    return (numerator.cast("float") / denominator.cast("float")).cast("float")


def pmi(p_xy: Column, p_x: Column, p_y: Column) -> Column:
    return ratio(p_xy, p_x * p_y)


def log10(value: Column) -> Column:
    return F.log10(value.cast("double")).cast("float")


def render_vector() -> Column:
    """The eight numbers of a PMI row as text."""
    fields = [F.col(name).cast("float") for name in VECTOR]
    return F.format_string(", ".join([NUMBER_FORMAT] * len(fields)), *fields)
