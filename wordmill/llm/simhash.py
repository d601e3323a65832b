"""SimHash near-duplicates: fingerprints, covering-code anchors, components.

Two fingerprints link at ``THRESHOLD`` = 3 or fewer differing bits. One of the two 32-bit halves
then differs in at most one bit. Each half is looked up among the words of a covering code: the
perfect Hamming code on 31 bits and one bit that stands for itself. Every half is within one bit
of an anchor (the covering radius), so two halves that differ in one bit share an anchor within
two bits of both (radius plus threshold). A fingerprint goes to all such anchors, at most 17 per
half, and meets there everything it may link to; the whole fingerprints are compared there.

Equal fingerprints are one node. What meets at one anchor leaves it as a star, each node with
the least node it hangs together with, so a dense anchor makes no quadratic number of links. An
anchor with very many fingerprints is cut into pieces, and every pair of pieces is a task of its
own, so no comparison is left out and none needs more than two pieces in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from wordmill.llm.common import aside
from wordmill.llm.components import components
from wordmill.sources.checkpoints import materialise

# Fixed values of the fingerprint.
BITS = 64
SHINGLE_WORDS = 3
SEED = 42
THRESHOLD = 3

HALF_BITS = 32
CODE_BITS = 31  # bits of a half under the Hamming code; the last one stands for itself
HALF_THRESHOLD = THRESHOLD // 2
PIECE = 2048  # fingerprints of one anchor that one comparison takes from each side

_SLICE = 1 << 16


def fingerprint_of(text: bytes) -> int:
    """The fingerprint of one text, as a signed 64-bit number."""
    words = text.lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined, ends, end = b" ".join(words), [], -1
    for word in words:
        end += len(word) + 1
        ends.append(end)
    starts = [0, *(e + 1 for e in ends[:-1])]
    width = min(SHINGLE_WORDS, len(words)) - 1
    digest, ones, total = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64), len(words) - width
    for k in range(0, total, _SLICE):
        spans = zip(starts[k : k + _SLICE], ends[k + width : k + width + _SLICE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > total, bitorder="little")
    return int(bits.view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint_of)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column as a long; that of null and of wordless texts is 0."""
    return _fingerprint(F.coalesce(text, F.lit("")).cast("binary"))


def _flips() -> list[list[int]]:
    """For each syndrome of a half, what to flip to reach the anchors within two bits."""
    single, own = lambda j: 1 << (j - 1), 1 << CODE_BITS
    flips = [[0, own]]
    for s in range(1, CODE_BITS + 1):
        pairs = [single(i) | single(i ^ s) for i in range(1, CODE_BITS + 1) if i < i ^ s]
        flips.append([single(s), single(s) | own, *pairs])
    return flips


def anchors(half: Column) -> Column:
    """All code words within two bits of a half, as an array of longs."""
    syndrome = F.lit(0)
    for bit in range(5):
        checked = sum(1 << (j - 1) for j in range(1, CODE_BITS + 1) if j >> bit & 1)
        parity = F.bit_count(half.bitwiseAND(F.lit(checked).cast("long"))).bitwiseAND(F.lit(1))
        syndrome = syndrome + parity * (1 << bit)
    flips = F.array(*[F.array(*[F.lit(x).cast("long") for x in row]) for row in _flips()])
    return F.transform(F.element_at(flips, syndrome + 1), lambda flip: half.bitwiseXOR(flip))


def at_anchors(nodes: DataFrame) -> DataFrame:
    """``anchor, fp``: each fingerprint once per anchor; the number of the half leads the anchor."""
    low = F.col("fp").bitwiseAND(F.lit((1 << HALF_BITS) - 1))
    halves = F.array(low, F.shiftrightunsigned("fp", HALF_BITS))
    sides = nodes.select("fp", F.posexplode(halves).alias("side", "half"))
    marked = sides.select("fp", "side", F.explode(anchors(F.col("half"))).alias("word"))
    return marked.select((F.shiftleft(F.col("side").cast("long"), HALF_BITS) + F.col("word")).alias("anchor"), "fp")


def _least_linked(run: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """For each position the least position it hangs together with in its run of equal keys."""
    n = len(fps)
    least, at, gap, found = np.arange(n), np.arange(n), 0, []

    def join(us, vs):
        nonlocal least
        while True:
            low = np.minimum(least[us], least[vs])
            new = least.copy()
            for side in (us, vs):
                np.minimum.at(new, side, low)
                np.minimum.at(new, least[side], low)
            new = new[new]
            if np.array_equal(new, least):
                return
            least = new

    def flush():
        if found:
            join(np.concatenate([u for u, _ in found]), np.concatenate([v for _, v in found]))
            found.clear()

    while True:
        gap += 1
        at = at[at + gap < n]
        at = at[run[at] == run[at + gap]]
        if not at.size:
            break
        close = at[np.bitwise_count(fps[at] ^ fps[at + gap]) <= THRESHOLD]
        if close.size:
            found.append((close, close + gap))
            if sum(len(u) for u, _ in found) > 1 << 20:
                flush()
    flush()
    return least


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links within each run of equal keys of sorted rows, as stars; a run may span batches."""
    keys = ["anchor", "lo", "hi"]

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().astype(np.uint64)
        new_run = (rows[keys].to_numpy()[1:] != rows[keys].to_numpy()[:-1]).any(axis=1)
        run = np.concatenate([[0], np.cumsum(new_run)])
        least = _least_linked(run, fps)
        linked = np.flatnonzero(least != np.arange(len(fps)))
        return pd.DataFrame({"u": fps[linked].astype(np.int64), "v": fps[least[linked]].astype(np.int64)})

    open_run = None
    for rows in batches:
        if open_run is not None:
            rows = pd.concat([open_run, rows], ignore_index=True)
        last = (rows[keys].to_numpy() != rows[keys].to_numpy()[-1]).any(axis=1)
        done = int(last.nonzero()[0][-1]) + 1 if last.any() else 0
        open_run = rows.iloc[done:].reset_index(drop=True)
        if done:
            yield links(rows.iloc[:done])
    if open_run is not None and len(open_run):
        yield links(open_run)


def links(nodes: DataFrame, piece: int = PIECE) -> DataFrame:
    """Links ``u, v`` that connect all distinct fingerprints ``fp`` which may be reached in steps."""
    spread = at_anchors(nodes)
    sizes = spread.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > piece)
    large = materialise(sizes.select("anchor", F.ceil(F.col("n") / piece).cast("int").alias("pieces")), "anchors")
    own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    others = F.when(F.col("pieces").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("pieces") - 1))
    paired = spread.join(large, "anchor", "left").select("anchor", "fp", F.coalesce(own, F.lit(0)).alias("own"), F.explode(others).alias("other"))
    keyed = paired.select("anchor", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    dealt = keyed.repartition("anchor", "lo", "hi").sortWithinPartitions("anchor", "lo", "hi")
    return dealt.mapInPandas(_compare, "u long, v long")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row, kept."""
    return materialise(docs.select("doc_id", F.xxhash64("text").alias("text_hash"), fingerprint(F.col("text")).alias("fp")), "fingerprints")


def _groups(prints: DataFrame, first: Column) -> DataFrame:
    """``fp, first``: for each fingerprint the least ``first`` among all rows it links to."""
    nodes = materialise(prints.groupBy("fp").agg(F.min(first).alias("own")), "nodes")
    roots = components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "own", F.coalesce("root", "fp").alias("root"))
    least = materialise(rooted.groupBy("root").agg(F.min("own").alias("first")), "roots")
    return materialise(rooted.join(least, "root").select("fp", "first"), "groups")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    The component is the least doc_id that can be reached over links, its own included. Null
    texts count as empty; all wordless texts share fingerprint zero and hang together. Rows with
    null as doc_id are linked too, but name a component only if all of it has none. Repeated
    rows come out repeatedly. Other columns are not read.
    """
    prints = fingerprints(docs.select("doc_id", "text"))
    named = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    groups = _groups(prints, F.col("doc_id"))
    return prints.join(groups, "fp").select("doc_id", named, F.col("first").alias("component_id"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, that with the least doc_id, with all its columns as they were.

    Of rows that agree in doc_id and text one stays. Columns may have any names.
    """
    prints = fingerprints(docs.select("doc_id", "text"))
    # Rows without doc_id come after all others.
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = _groups(prints, who).select(F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")).distinct()
    rows = prints.groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows"))
    same = rows["doc_id"].eqNullSafe(F.col("first_id")) & (rows["text_hash"] == F.col("first_hash"))
    chosen = materialise(groups.join(rows, same).select("first_id", "first_hash", "rows"), "chosen")
    marked = aside(docs, "doc_id", "text").select("row", "doc_id", F.xxhash64("text").alias("hash"))
    found = marked.join(chosen, marked["doc_id"].eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash")))
    once = found.where("rows = 1").select("row.*")
    if chosen.where("rows > 1").isEmpty():
        return once
    order = Window.partitionBy("first_id", "first_hash").orderBy(F.to_json("row"))
    repeated = found.where("rows > 1").withColumn("no", F.row_number().over(order))
    return once.unionByName(repeated.where("no = 1").select("row.*"))
