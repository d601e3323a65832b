"""Bigram counts and relative frequencies.

A bigram is two words next to each other on one line after cleaning; words dropped by the
cleaning do not separate their neighbours, and there is no cap on the length of a line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import text as T
from wordmill.functions.scores import ratio
from wordmill.operators.stripes import collect_stripes, part_of

SALTS = 16
FREQUENT_FIRSTS = 1000


def bigrams(lines: DataFrame) -> DataFrame:
    """One row per bigram occurrence: ``w1, w2``."""
    words = lines.select(T.words(F.col("value")).alias("words"))
    firsts = words.select("words", F.posexplode(T.all_but_last(F.col("words"))).alias("i", "w1"))
    return firsts.select("w1", F.get("words", F.col("i") + 1).alias("w2"))


def bigram_counts(lines: DataFrame) -> DataFrame:
    """Occurrences of every bigram: ``w1, w2, n``."""
    return bigrams(lines).groupBy("w1", "w2").agg(F.count("*").alias("n"))


def _marginals(counts: DataFrame) -> DataFrame:
    # Grouping the counted bigrams instead of the raw ones adds up a frequent first word
    # inside every task, so its row reaches the second shuffle once per task.
    return counts.groupBy("w1").agg(F.sum("n").alias("total"))


def bigram_marginals(lines: DataFrame) -> DataFrame:
    """Number of bigrams that start with each word: ``w1, n``."""
    return bigrams(lines).groupBy("w1").agg(F.count("*").alias("n"))


def bigram_grouping_sets(lines: DataFrame) -> DataFrame:
    """Bigram counts and their totals per first word (null ``w2``) together: ``w1, w2, n``."""
    counts = bigram_counts(lines)
    sets = [[F.col("w1"), F.col("w2")], [F.col("w1")]]
    return counts.groupingSets(sets, "w1", "w2").agg(F.sum("n").alias("n"))


def _with_marginals(lines: DataFrame, salts: int) -> DataFrame:
    # A join, not a window over w1. A word that starts very many bigrams is in as many parts as
    # there are salts, so that it is no single task's work; its total is repeated for each part.
    # Any other first word has a small share of the bigrams and is in one part. The totals are
    # short rows, which a task holds, so that the bigrams need no sorting.
    # First words are never null; said here, it is said to all who read the counts, which are shuffled once.
    counts = bigram_counts(lines).where(F.col("w1").isNotNull())
    totals = _marginals(counts)
    frequent = totals.orderBy(F.desc("total"), "w1").limit(FREQUENT_FIRSTS)
    frequent = F.broadcast(frequent.select("w1", F.lit(salts).alias("parts")))
    last = F.coalesce("parts", F.lit(1)) - 1
    parts = totals.join(frequent, "w1", "left").select("w1", "total", F.explode(F.sequence(F.lit(0), last)).alias("part"))
    part = F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("w2"), F.lit(salts)).cast("int"))
    dealt = counts.join(frequent, "w1", "left").select("w1", "w2", "n", part.alias("part"))
    return dealt.join(parts.hint("shuffle_hash"), ["w1", "part"])


def bigram_relfreq_pairs(lines: DataFrame, salts: int = SALTS) -> DataFrame:
    """Share of each bigram among those with the same first word: ``w1, w2, rf``.

    ``salts`` is how many tasks share the bigrams of a frequent first word; the result is the same.
    """
    return _with_marginals(lines, salts).select("w1", "w2", ratio(F.col("n"), F.col("total")).alias("rf"))


def bigram_relfreq_stripes(lines: DataFrame, buckets: int = 1) -> DataFrame:
    """The same as maps from second word to share per first word: ``w1, part, stripe``.

    A word's map comes in up to ``buckets`` parts; a hash of the second word says which part it
    is in, for every word and at every size. With one bucket each word is one row, and all its
    followers have to fit into one task.
    """
    part = part_of(F.col("w2"), buckets).alias("part")
    entries = _with_marginals(lines, SALTS).select("w1", part, "w2", ratio(F.col("n"), F.col("total")).alias("rf"))
    return collect_stripes(entries, "w1", "w2", "rf")


def bigram_count_stripes(lines: DataFrame, buckets: int = 1) -> DataFrame:
    """Counts as maps from second word to occurrences, in parts as above: ``w1, part, stripe``.

    Unlike shares, they add up over corpora.
    """
    counts = bigram_counts(lines).withColumn("part", part_of(F.col("w2"), buckets))
    return collect_stripes(counts, "w1", "w2", "n")
