"""Pointwise mutual information of words that share lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions import scores as S
from wordmill.functions.text import MAX_TOKENS, MIN_SUPPORT
from wordmill.operators.cooccurrence import Counts, count_cooccurrence
from wordmill.operators.stripes import collect_stripes, part_of


def _both_ways(half: DataFrame, swapped: dict[str, str]) -> DataFrame:
    """Every pair and its mirror image; the columns in ``swapped`` trade places, others stay.

    The pair is doubled in place, so it is counted and joined only once.
    """
    trade = swapped | {right: left for left, right in swapped.items()}
    # A flag per row costs less than a row per way in an array.
    ways = half.withColumn("mirrored", F.explode(F.array(F.lit(False), F.lit(True))))

    def other(name: str) -> Column:
        return F.when(F.col("mirrored"), F.col(trade[name])).otherwise(F.col(name)).alias(name)

    return ways.select(*[other(name) if name in trade else F.col(name) for name in half.columns])


def _scored(counts: Counts) -> DataFrame:
    """One row per unordered pair with all eight numbers; PMI is symmetric."""
    n_lines = counts.total().scalar()
    probabilities = counts.pairs.select(
        "*",
        S.ratio(F.col("n_x"), n_lines).alias("p_x"),
        S.ratio(F.col("n_y"), n_lines).alias("p_y"),
        S.ratio(F.col("n_xy"), n_lines).alias("p_xy"),
    )
    return probabilities.withColumn(
        "pmi", S.pmi(F.col("p_xy"), F.col("p_x"), F.col("p_y"))
    ).withColumn("log10_pmi", S.log10(F.col("pmi")))


def pairs_from_counts(counts: Counts) -> DataFrame:
    swapped = {"x": "y", "n_x": "n_y", "p_x": "p_y"}
    return _both_ways(_scored(counts), swapped).select("x", "y", *S.VECTOR)


def _entries(counts: Counts) -> DataFrame:
    half = _scored(counts).select("x", "y", "log10_pmi")
    return _both_ways(half, {"x": "y"}).select(
        F.col("x").alias("word"), F.col("y").alias("partner"), "log10_pmi"
    )


def stripes_from_counts(counts: Counts, buckets: int = 1) -> DataFrame:
    entries = _entries(counts).select("word", part_of(F.col("partner"), buckets).alias("part"), "partner", "log10_pmi")
    # Words that had company keep part 0, empty if no partner with enough support is in it.
    bare = counts.words.where(F.col("word").isNotNull() & F.col("paired")).select(
        "word",
        F.lit(0).alias("part"),
        F.lit(None).cast("string").alias("partner"),
        F.lit(None).cast("float").alias("log10_pmi"),
    )
    return collect_stripes(entries.unionByName(bare), "word", "partner", "log10_pmi")


def pair_counts(
    lines: DataFrame, min_support: int = MIN_SUPPORT, max_tokens: int | None = MAX_TOKENS
) -> DataFrame:
    """Number of lines that hold both words, for pairs with enough support: ``x, y, n``.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines.
    """
    return _pair_counts(count_cooccurrence(lines, min_support, max_tokens))


def _pair_counts(counts: Counts) -> DataFrame:
    half = counts.pairs.select("x", "y", F.col("n_xy").alias("n"))
    return _both_ways(half, {"x": "y"}).select("x", "y", "n")


def pair_count_stripes(
    lines: DataFrame, min_support: int = MIN_SUPPORT, max_tokens: int | None = MAX_TOKENS, buckets: int = 1
) -> DataFrame:
    """Pair counts as maps from partner to lines per word: ``word, part, stripe``.

    Parts are those of ``pmi_stripes``. With ``min_support=1`` they add up over corpora.
    """
    return pair_stripes_from_counts(count_cooccurrence(lines, min_support, max_tokens), buckets)


def pair_stripes_from_counts(counts: Counts, buckets: int = 1) -> DataFrame:
    entries = _pair_counts(counts).select(F.col("x").alias("word"), part_of(F.col("y"), buckets).alias("part"), "y", "n")
    return collect_stripes(entries, "word", "y", "n")


def pmi_pairs(
    lines: DataFrame, min_support: int = MIN_SUPPORT, max_tokens: int | None = MAX_TOKENS
) -> DataFrame:
    """Both words, then ``n_x, p_x, n_y, p_y, n_xy, p_xy, pmi, log10_pmi``.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines.
    """
    return pairs_from_counts(count_cooccurrence(lines, min_support, max_tokens))


def pmi_stripes(
    lines: DataFrame,
    min_support: int = MIN_SUPPORT,
    max_tokens: int | None = MAX_TOKENS,
    buckets: int = 1,
) -> DataFrame:
    """Maps from partner to log10 PMI per word: ``word, part, stripe``.

    Every word that shares a line with another has a part 0, empty or not. A hash of the partner
    says which of the ``buckets`` parts it is in, for every word and at every size. With one
    bucket each word is one row, and all its partners have to fit into one task.
    """
    counts = count_cooccurrence(lines, min_support, max_tokens)
    return stripes_from_counts(counts, buckets)


def pmi_ranked(pairs: DataFrame) -> DataFrame:
    """PMI rows from the strongest association to the weakest, ties in word order."""
    return pairs.orderBy(F.desc("log10_pmi"), "x", "y")


def pmi_top(pairs: DataFrame, k: int) -> DataFrame:
    """The ``k`` strongest associations; each task sends at most ``k`` rows."""
    return pmi_ranked(pairs).limit(k)
