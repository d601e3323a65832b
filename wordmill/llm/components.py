"""Connected components of links given as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import materialise


def _to_least(pairs: DataFrame, wanted: Column) -> DataFrame:
    """Link each node's ``wanted`` neighbours to the least of the node and its neighbours."""
    # Kept on its own so that the join below has a plain exchange on both sides: a node with a
    # great many neighbours is then split over tasks.
    least = materialise(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("least")), "least")
    linked = pairs.where(wanted).join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return linked.where("u <> v").distinct()


def _size(pairs: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(pairs.agg(F.count("*"), F.sum(mixed)).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node with a link; the root is the least node it can reach.

    ``links`` has two long columns ``u, v``, in either order, repeats allowed. Links are moved
    towards smaller nodes, first from larger neighbours, then among smaller ones, until nothing
    changes and every node hangs on its root. Their number never grows; each round is a join of
    the links with one row per node, and its result is kept.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = materialise(ordered.distinct(), "links")
    before = None
    while (size := _size(pairs)) != before:
        before = size
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialise(_to_least(both, F.col("v") > F.col("u")), "links")
        # Among smaller neighbours the node itself is linked to the least one too.
        down = large.unionByName(large.select("u", F.col("u").alias("v")))
        pairs = materialise(_to_least(down, F.lit(True)), "links")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
