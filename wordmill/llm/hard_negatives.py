"""Hard negatives by Fagin's threshold algorithm over blocks of vectors.

The inner product with an anchor is a monotone sum over dimensions once each dimension is taken
in the order of the anchor's sign there. A block of candidates therefore holds one sorted list
per dimension; an anchor reads all lists in parallel, from the top where its component is
positive and from the bottom where it is negative, and every row met for the first time is
scored in full. The components last read bound the score of every row not met yet: this
threshold ends the search as soon as it lies strictly below the worst score kept.

The search runs twice. The first gives each anchor its positives, the best rows of its label.
The second reads rows of other labels, for all windows that the positives open at once, and ends
when the threshold lies below the k-th score of every window, or below its lower edge.

Anchors are a stated query set. Rows are dealt into blocks and anchors into slices, both of
bounded size, and every pair of a block and a slice is a group of its own; only the best few of
a group leave it. Nothing is gathered per label, so a label with most of the rows is no hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.sources.checkpoints import materialise

BLOCK_ROWS = 8192  # rows whose sorted lists one group holds, on average
SLICE_ANCHORS = 1024
FIRST_DEPTH = 32  # rows read from each list before the first look at the threshold; doubled then

_POSITIVES = "anchor long, anchor_id long, near long, near_id long, score long"
_NEGATIVES = "anchor long, edge long, near long, near_id long, score long"

Settled = Callable[[np.ndarray, float], bool]


def taking_part(rows: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """``uid, vec_id, label, is_anchor, v`` of the rows that can be compared, kept.

    Components become whole numbers, ``floor(scale * x)``. Rows without a label, without a
    vector, or with a component that is null or not finite are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    usable = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    chosen = usable.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
        whole.alias("v"),
    )
    return materialise(chosen, "vectors")


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows; short ones end in zeros."""
    if len(vectors) and vectors.map(len).min() == width:
        return np.stack(vectors.to_numpy()).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def _exact(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the fastest type that holds every partial sum of their products exactly."""
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (rows, anchors)]
    bound = rows.shape[1] * largest[0] * largest[1]
    if bound >= 1 << 63:
        raise OverflowError("the inner product of these vectors may not fit into 64 bits")
    return (rows.astype(np.float64), anchors.astype(np.float64)) if bound < 1 << 53 else (rows, anchors)


class Lists:
    """Rows with one list of row numbers per dimension, from the least component to the largest."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.order = np.ascontiguousarray(np.argsort(rows, axis=0, kind="stable").T)

    def search(self, anchor: np.ndarray, settled: Settled) -> tuple[np.ndarray, np.ndarray]:
        """Which rows were met, and the scores of those, when ``settled`` ends the search.

        ``settled`` gets the numbers of the rows met so far with their scores, and what no
        other row's score can exceed.
        """
        n = len(self.rows)
        met, scores = np.zeros(n, bool), np.zeros(n, self.rows.dtype)
        up, down = np.flatnonzero(anchor < 0), np.flatnonzero(anchor > 0)
        depth = FIRST_DEPTH if len(up) or len(down) else n  # nothing orders rows for a zero anchor
        before = 0
        while n:
            depth = min(depth, n)
            fresh = np.zeros(n, bool)
            if depth == n:
                fresh[:] = True
            else:
                fresh[self.order[up, before:depth]] = True
                fresh[self.order[down, n - depth : n - before]] = True
            fresh = np.flatnonzero(fresh & ~met)
            met[fresh] = True
            scores[fresh] = self.rows[fresh] @ anchor
            last = self.rows[self.order[up, depth - 1], up] @ anchor[up] + self.rows[self.order[down, n - depth], down] @ anchor[down]
            seen = np.flatnonzero(met)
            if len(seen) == n or settled(seen, scores[seen], last):
                break
            before, depth = depth, depth * 2
        seen = np.flatnonzero(met)
        return seen, scores[seen]


def _best(numbers: np.ndarray, scores: np.ndarray, k: int) -> list[int]:
    """The k highest scores' places; rows are numbered in the order that breaks ties."""
    return np.lexsort((numbers, -scores))[:k].tolist()


def _kth(scores: np.ndarray, k: int) -> float | None:
    return np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else None


def _group(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Rows in the order that breaks ties, by ``vec_id`` with null last, and both as matrices."""
    rows = rows.sort_values(["vec_id", "uid"], na_position="last", ignore_index=True)
    width = max(rows["v"].map(len).max(), anchors["v"].map(len).max())
    return rows, *_exact(_matrix(rows["v"], width), _matrix(anchors["v"], width))


def _positives(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(found(rows, anchors), columns=["anchor", "anchor_id", "near", "near_id", "score"]).astype("Int64")

    def found(rows: pd.DataFrame, anchors: pd.DataFrame) -> Iterator[tuple]:
        if rows.empty or anchors.empty:
            return
        rows, matrix, queries = _group(rows, anchors)
        uids, ids, labels = rows["uid"].to_numpy(), rows["vec_id"].astype("Int64"), rows["label"].to_numpy()
        for label, some in anchors.groupby("label").indices.items():
            own = np.flatnonzero(labels == label)
            lists = Lists(matrix[own])
            for at in some:
                uid = anchors["uid"].iat[at]

                def settled(seen: np.ndarray, scores: np.ndarray, threshold: float) -> bool:
                    least = _kth(scores[uids[own[seen]] != uid], k)
                    return least is not None and threshold < least

                seen, scores = lists.search(queries[at], settled)
                other = uids[own[seen]] != uid
                seen, scores = seen[other], scores[other]
                for j in _best(seen, scores, k):
                    row = own[seen[j]]
                    yield uid, anchors["vec_id"].iat[at], uids[row], ids.iat[row], int(scores[j])

    return run


def _negatives(k: int, low: int, high: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(found(rows, anchors), columns=["anchor", "edge", "near", "near_id", "score"]).astype("Int64")

    def found(rows: pd.DataFrame, anchors: pd.DataFrame) -> Iterator[tuple]:
        if rows.empty or anchors.empty:
            return
        rows, matrix, queries = _group(rows, anchors)
        uids, ids, labels = rows["uid"].to_numpy(), rows["vec_id"].astype("Int64"), rows["label"].to_numpy()
        for label, some in anchors.groupby("label").indices.items():
            other = np.flatnonzero(labels != label)
            lists = Lists(matrix[other])
            for at in some:
                # Whole scores n with low * p <= 100 * n <= high * p.
                windows = [(int(p), -(-low * int(p) // 100), high * int(p) // 100) for p in anchors["edges"].iat[at]]
                windows = [(p, least, most) for p, least, most in windows if least <= most]
                if not windows:
                    continue
                floor = min(least for _, least, _ in windows)

                def settled(seen: np.ndarray, scores: np.ndarray, threshold: float) -> bool:
                    if threshold < floor:
                        return True
                    ranked = np.sort(scores[scores >= floor])
                    for _, least, most in windows:
                        kth = np.searchsorted(ranked, most, side="right") - k
                        if threshold >= least and not (kth >= 0 and ranked[kth] >= least and threshold < ranked[kth]):
                            return False
                    return True

                seen, scores = lists.search(queries[at], settled)
                for p, least, most in windows:
                    inside = np.flatnonzero((scores >= least) & (scores <= most))
                    for j in _best(seen[inside], scores[inside], k):
                        row = other[seen[inside[j]]]
                        yield anchors["uid"].iat[at], p, uids[row], ids.iat[row], int(scores[inside[j]])

    return run


def _leading(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first k rows per key as ``place``; Spark cuts each task's rows to k before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("near_id"), "near")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: int = 256,
    block_rows: int = BLOCK_ROWS,
    slice_anchors: int = SLICE_ANCHORS,
) -> DataFrame:
    """The best-scored rows of other labels within a window below each positive of each anchor.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; other columns are ignored. A score is
    the inner product of ``floor(scale * x)``. The positives of an anchor are its best other rows
    of the same label; for each, negatives n satisfy ``low * p <= 100 * n <= high * p``, where p
    is the positive's score. Fewer are returned where there are fewer; none for an anchor without
    a positive. Ties go to the smaller ``vec_id``, rows without one come last.

    Columns: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows with a null label, a null vector, or a component that is null, NaN or infinite take no
    part; a null ``vec_id`` does. Vectors of different lengths are filled up with zeros, so an
    empty vector scores 0. A row is a row of its own even if it repeats another: its twin may be
    its positive, and a repeated anchor returns its rows once for each. No rows give no rows.
    Vectors so large that a score might leave 64 bits raise an error.
    """
    kept = taking_part(rows, is_anchor, scale)
    count = kept.agg(F.count("*").alias("n"), F.count_if("is_anchor").alias("a")).first()
    blocks, slices = max(1, -(-count["n"] // block_rows)), max(1, -(-count["a"] // slice_anchors))
    place = F.xxhash64("uid")
    block, part = F.pmod(place, F.lit(blocks)).cast("int"), F.pmod(F.xxhash64(place), F.lit(slices)).cast("int")
    candidates = kept.select(
        block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), "uid", "vec_id", "label", "v"
    ).groupBy("block", "slice")

    def dealt(anchors: DataFrame) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
        pairs = anchors.withColumn("slice", part).withColumn("block", every)
        return pairs.toDF(*pairs.columns).groupBy("block", "slice")  # columns of their own beside the candidates'

    anchors = kept.where("is_anchor").select("uid", "vec_id", "label", "v")
    near = candidates.cogroup(dealt(anchors)).applyInPandas(_positives(positives), _POSITIVES)
    best = materialise(_leading(near, ["anchor"], positives), "positives")

    edges = best.groupBy(F.col("anchor").alias("uid")).agg(F.collect_set("score").alias("edges"))
    windows = dealt(anchors.join(edges, "uid"))
    found = candidates.cogroup(windows).applyInPandas(_negatives(negatives, low, high), _NEGATIVES)
    chosen = _leading(found, ["anchor", "edge"], negatives)
    return (
        best.select("anchor", "anchor_id", F.col("near_id").alias("positive_id"), F.col("score").alias("edge"))
        .join(chosen, ["anchor", "edge"])
        .select(
            "anchor_id",
            "positive_id",
            F.col("place").cast("int").alias("rank"),
            F.col("near_id").alias("negative_id"),
            F.col("edge").alias("positive_score"),
            F.col("score").alias("negative_score"),
        )
    )


SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v,
         row_number() OVER (ORDER BY vec_id) AS uid
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.uid, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 100 = 0 AND a.uid <> b.uid
), positives AS (
  SELECT uid, anchor_id, vec_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id) AS place
  FROM scores WHERE same
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.uid, p.place ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scores n ON p.uid = n.uid AND NOT n.same
   AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 5"""
