"""Co-occurrence counts kept on disk between the counting and the scoring job.

One table holds everything, in a folder per kind of row: ``corpus`` is one row with the number of
lines and the parameters of the count, ``word`` a row per word, ``pair`` a row per pair. It is
written by one job, so it is there whole or not at all, and a reader of one kind opens only the
files of that kind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators.cooccurrence import Counts

LAYOUT = (
    "x string, y string, n bigint, n_x bigint, n_y bigint, paired boolean, "
    "min_support int, max_tokens int, kind string"
)


def write_counts(counts: Counts, path: str) -> None:
    """Write counts, with the parameters they were made with, over whatever is at ``path``."""
    is_corpus = F.col("word").isNull()
    words = counts.words.select(
        F.col("word").alias("x"),
        "n",
        "paired",
        F.when(is_corpus, F.lit(counts.min_support)).alias("min_support"),
        F.when(is_corpus, F.lit(counts.max_tokens)).cast("int").alias("max_tokens"),
        F.when(is_corpus, F.lit("corpus")).otherwise(F.lit("word")).alias("kind"),
    )
    pairs = counts.pairs.select("x", "y", F.col("n_xy").alias("n"), "n_x", "n_y", F.lit("pair").alias("kind"))
    rows = words.unionByName(pairs, allowMissingColumns=True)
    rows.write.mode("overwrite").partitionBy("kind").parquet(path)


def read_kind(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    """The rows of some kinds; the files of others are not opened."""
    return spark.read.schema(LAYOUT).parquet(path).where(F.col("kind").isin(*kinds))


def read_counts(spark: SparkSession, path: str, **expected: int | None) -> Counts:
    """Counts written before, with the parameters that were written with them.

    ``min_support`` and ``max_tokens`` may be given as what the caller relies on; if the counts
    were made with others, or the table has no single row about its corpus, an error is raised.
    """
    corpus = read_kind(spark, path, "corpus").select("min_support", "max_tokens").take(2)
    if len(corpus) != 1:
        raise ValueError(f"{path} does not hold the counts of one corpus")
    made = corpus[0].asDict()
    for name, value in expected.items():
        if name not in made:
            raise TypeError(f"counts have no parameter {name}")
        if made[name] != value:
            raise ValueError(f"{path} was counted with {name}={made[name]}, not {value}")
    words = read_kind(spark, path, "corpus", "word").select(F.col("x").alias("word"), "n", "paired")
    pairs = read_kind(spark, path, "pair").select("x", "y", F.col("n").alias("n_xy"), "n_x", "n_y")
    return Counts(words, pairs, **made)
