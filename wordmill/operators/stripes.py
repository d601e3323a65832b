"""Maps per word ("stripes") in a fixed number of parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.functions.scores import ratio
from wordmill.sources.checkpoints import materialise


def part_of(partner: Column, buckets: int) -> Column:
    """The part of its word's map that a partner goes to; it depends on nothing else."""
    if buckets == 1:
        return F.lit(0)
    part = F.conv(F.left(F.md5(partner), F.lit(8)), 16, 10).cast("long") % buckets
    # Never null, so that a join on it adds no filter and equal exchanges stay equal.
    return F.coalesce(part.cast("int"), F.lit(0))


def collect_stripes(entries: DataFrame, word: str, partner: str, value: str) -> DataFrame:
    """``word, part, stripe`` from one row per entry; a null partner only makes the row exist.

    The explicit repartitioning spreads the parts of a frequent word over tasks even where the
    input already lies partitioned by the word alone.
    """
    entry = F.when(F.col(partner).isNotNull(), F.struct(F.col(partner), F.col(value)))
    return (
        entries.select(F.col(word), F.col("part"), entry.alias("entry"))
        .repartition(word, "part")
        .groupBy(word, "part")
        .agg(F.map_from_entries(F.sort_array(F.collect_list("entry"))).alias("stripe"))
    )


def merge_stripes(left: DataFrame, right: DataFrame, word: str) -> DataFrame:
    """Maps of numbers of two corpora added up partner by partner: ``word, part, stripe``.

    Both have to come in the same number of parts: a partner is then in the same part on either
    side, so two ready maps meet per part, and no entry is taken out of its map.
    """
    kind = left.schema["stripe"].dataType
    none, zero = F.create_map().cast(kind), F.lit(0).cast(kind.valueType)
    both = left.withColumnRenamed("stripe", "mine").join(right.withColumnRenamed("stripe", "other"), [word, "part"], "full_outer")
    added = F.map_zip_with(
        F.coalesce("mine", none),
        F.coalesce("other", none),
        lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero),
    )
    return both.select(word, "part", added.alias("stripe"))


def supported_stripes(stripes: DataFrame, min_support: int) -> DataFrame:
    """Maps without the entries below a support; a map may become empty."""
    return stripes.withColumn("stripe", F.map_filter("stripe", lambda _, n: n >= min_support))


def normalised_stripes(stripes: DataFrame, word: str) -> DataFrame:
    """Maps of counts as maps of shares of the word's total over all of its parts.

    One number per part is shuffled for the totals. The maps are kept, as they are needed twice.
    """
    stripes = materialise(stripes, "stripes")
    part_sum = F.aggregate(F.map_values("stripe"), F.lit(0).cast("long"), lambda total, n: total + n)
    totals = stripes.select(word, part_sum.alias("total")).groupBy(word).agg(F.sum("total").alias("total"))
    shares = F.transform_values("stripe", lambda _, n: ratio(n, F.col("total")))
    return stripes.join(totals, word).select(word, "part", shares.alias("stripe"))
