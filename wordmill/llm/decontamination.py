"""Benchmark decontamination: n-grams of test items seed alignments in documents.

Items are cut into overlapping runs of three words. Documents that hold such runs are joined to
the items, however many documents hold a run: a single frequent run tells nothing, but two
different ones on nearly the same diagonal do. They open a region of the document some four
times as long as the item, and Smith-Waterman aligns the two word by word.
The score is the share of the best possible one: 1 for a copy, less for every word that was
replaced, left out or put in. A document is reported from a score of ``MIN_SCORE``, or from an
alignment worth ``EXCERPT_WORDS`` equal words, as an excerpt of a long item is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import aside
from wordmill.sources.checkpoints import materialise

SEED_WORDS = 3
MIN_SEEDS = 2
MIN_ITEM_WORDS = 5  # shorter items stand in any text by chance and are not searched for
MIN_SCORE = 0.4
EXCERPT_WORDS = 50  # an alignment worth as many equal words is reported however long its item is
BROADCAST_SEEDS = 1 << 20  # up to so many runs of items, of 8 bytes each, go to every executor

MATCH, MISMATCH, GAP = 2, -1, -1

_WORD = r"[\p{L}\p{N}]+"


def normal_words(text: Column) -> Column:
    """Lower-case runs of letters and digits; punctuation and white space don't count."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(_WORD), F.lit(0))


def _runs(w: Column) -> Column:
    """Hashes of all runs of ``SEED_WORDS`` words."""
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (SEED_WORDS - 1), F.lit(0)))
    return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, SEED_WORDS)]))


def _keyed(docs: DataFrame) -> DataFrame:
    """Whole rows as ``row``, their text and a key of doc_id and text.

    Rows that agree in the key are alike to this operator.
    """
    return aside(docs, "doc_id", "text").withColumns({"__id": F.coalesce("doc_id", F.lit(0)), "__none": F.col("doc_id").isNull(), "__hash": F.xxhash64("text")})


_KEY = ["__id", "__none", "__hash"]


def _items(items: DataFrame) -> DataFrame:
    """``item_id, w, n`` of the items long enough to search for, kept."""
    cut = items.select("item_id", normal_words(F.col("text")).alias("w")).withColumn("n", F.size("w"))
    return materialise(cut.where(F.col("n") >= MIN_ITEM_WORDS).dropDuplicates(["item_id", "w"]), "items")


def _hits(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Where documents hold a run of an item: key, ``run, at``, kept."""
    seeds = runs.select("run").distinct()
    if seeds.count() <= BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    cut = _keyed(docs.select("doc_id", "text")).select(*_KEY, normal_words(F.col("text")).alias("w"))
    found = cut.select(*_KEY, F.posexplode(_runs(F.col("w"))).alias("at", "run")).join(seeds, "run")
    return materialise(found, "hits")


def _regions(hits: DataFrame, seeds: DataFrame) -> DataFrame:
    """Stretches of documents to align: key, ``regions`` of ``item_id, from, words``.

    Seeds are put together by diagonal, in windows of two item lengths that overlap by one. An
    item that is one run again and again needs only that one.
    """
    needed = F.least(F.count("*").over(Window.partitionBy("item_id")), F.lit(MIN_SEEDS))
    seeds = seeds.withColumn("needed", needed).withColumnRenamed("at", "item_at")
    band = F.floor((F.col("at") - F.col("item_at")) / F.col("n"))
    diagonals = hits.join(seeds, "run").select(
        *_KEY, "item_id", "n", "needed", "run", (F.col("at") - F.col("item_at")).alias("d"), F.explode(F.array(band, band - 1)).alias("band")
    )
    bands = diagonals.groupBy(*_KEY, "item_id", "n", "needed", "band").agg(
        F.count_distinct("run").alias("runs"), F.min("d").alias("low"), F.max("d").alias("high")
    )
    start = F.greatest(F.col("low") - F.ceil(F.col("n") / 2), F.lit(0))
    end = F.col("high") + F.col("n") + F.ceil(F.col("n") / 2)
    wanted = bands.where("runs >= needed").select(*_KEY, "item_id", start.cast("int").alias("from"), (end - start).cast("int").alias("words")).distinct()
    return materialise(wanted.groupBy(*_KEY).agg(F.collect_list(F.struct("item_id", "from", "words")).alias("regions")), "regions")


def best_alignment(item: list[str], words: list[str]) -> tuple[float, int]:
    """Smith-Waterman score of two word lists, as a share of a full match, and where it ends."""
    numbers = {word: k for k, word in enumerate(dict.fromkeys(item))}
    row = np.array([numbers.get(word, -1) for word in words], dtype=np.int64)
    if not row.size:
        return 0.0, 0
    steps = np.arange(1, row.size + 1) * -GAP
    before, best, end = np.zeros(row.size + 1, np.int64), 0, 0
    for word in item:
        pair = before[:-1] + np.where(row == numbers[word], MATCH, MISMATCH)
        cell = np.maximum(np.maximum(pair, before[1:] + GAP), 0)
        # A gap in the item: the best cell to the left, less its distance.
        cell = np.maximum.accumulate(cell + steps) - steps
        before[1:] = cell
        if cell.max() > best:
            best, end = int(cell.max()), int(cell.argmax()) + 1
    return best / (MATCH * len(item)), end


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        scored = [best_alignment(list(item), list(region)) for item, region in zip(rows["w"], rows["region"])]
        out = rows[[*_KEY, "item_id"]].copy()
        out["score"] = [score for score, _ in scored]
        out["ends_at"] = [start + end for start, (_, end) in zip(rows["from"], scored)]
        words = out["score"] * rows["w"].map(len)
        yield out[(out["score"] >= MIN_SCORE) | (words >= EXCERPT_WORDS - 1e-9)]


def _matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Key, ``item_id, score, ends_at``; one row per aligned region that reaches the score or the words."""
    known = _items(items)
    each = known.select("item_id", "n", F.posexplode(_runs(F.col("w"))).alias("at", "run"))
    # A run that an item repeats counts where it comes first.
    runs = materialise(each.groupBy("item_id", "run").agg(F.min("at").alias("at"), F.max("n").alias("n")), "runs")
    hits = _hits(docs, runs)
    regions = _regions(hits, runs)
    cut = _keyed(docs.select("doc_id", "text")).join(regions, _KEY).dropDuplicates(_KEY)
    cut = cut.select(*_KEY, "regions", normal_words(F.col("text")).alias("all"))
    sliced = F.transform(
        "regions", lambda r: F.struct(r["item_id"].alias("item_id"), r["from"].alias("from"), F.slice(F.col("all"), r["from"] + 1, r["words"]).alias("region"))
    )
    each = cut.select(*_KEY, F.explode(sliced).alias("r")).select(*_KEY, "r.*")
    kinds = {name: kind for name, kind in each.dtypes}
    schema = ", ".join(f"{name} {kinds[name]}" for name in [*_KEY, "item_id"]) + ", score double, ends_at long"
    return each.join(known.select("item_id", "w"), "item_id").mapInPandas(_align, schema)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold a test item: ``doc_id, item_id, score, ends_at``.

    One row per document and item, with the best score and the word its passage ends at. Null
    and empty texts hold nothing, null and short items are held by nothing. Rows that agree in
    doc_id come out as one. Other columns of both tables are not read.
    """
    best = _matches(docs, items).groupBy("__id", "__none", "item_id").agg(F.max(F.struct("score", F.col("ends_at"))).alias("best"))
    doc_id = F.when(~F.col("__none"), F.col("__id")).alias("doc_id")
    return best.select(doc_id, "item_id", F.round("best.score", 6).alias("score"), "best.ends_at")


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns as they were, whatever their names."""
    leaked = materialise(_matches(docs, items).select(*_KEY).distinct(), "leaked")
    return _keyed(docs).join(leaked, _KEY, "left_anti").select("row.*")
