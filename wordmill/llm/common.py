"""Expressions and steps several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word, and the characters between words.
WORD = r"[^\x20\x09-\x0D]+"
GAPS = " \t\n\x0b\f\r"

ROWS_PER_BUCKET = 50_000


def words(text: Column) -> Column:
    """The words of a text, unchanged and in order; null has none.

    Splitting at one plain character is several times as fast as splitting by a pattern.
    """
    blanks = F.coalesce(text, F.lit(""))
    for character in GAPS[1:]:
        blanks = F.replace(blanks, F.lit(character), F.lit(" "))
    return F.array_remove(F.split(blanks, " "), "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def aside(docs: DataFrame, *read: str) -> DataFrame:
    """Rows packed whole as ``row``, beside the columns an operator reads.

    Columns that an operator adds on its way cannot clash with the caller's, whatever their
    names; ``select("row.*")`` brings those back as they were.
    """
    return docs.select(F.struct("*").alias("row"), *read)


def numbered(df: DataFrame, keys: list[str], order: list[Column], spread: Column, rows: int, name: str) -> DataFrame:
    """Number the rows of each key from 0 without a gap, as the new long column ``name``.

    ``spread`` deals the rows of a key into buckets of some 50,000 and the numbers run through
    one bucket after the other, in ``order`` within a bucket. A key with most of the rows is so
    numbered by many tasks; only one row per bucket and key is ever put in sequence. ``rows`` is
    the number of rows, which sets the number of buckets. ``spread`` must not depend on where
    Spark happens to run a row.
    """
    buckets = max(1, -(-rows // ROWS_PER_BUCKET))
    dealt = df.withColumn("__bucket", F.pmod(F.xxhash64(spread), F.lit(buckets)))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    local = dealt.withColumn("__inside", F.row_number().over(inside) - 1)
    sizes = dealt.groupBy(*keys, "__bucket").agg(F.count("*").alias("__n"))
    # Without keys a constant stands in for one.
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__bucket")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return (
        local.join(offsets, [*keys, "__bucket"])
        .withColumn(name, (F.col("__before") + F.col("__inside")).cast("long"))
        .drop("__bucket", "__inside", "__before")
    )
