"""Sharding by balanced label propagation.

Documents that share a link key should share a shard. Linked documents start spread evenly and
then move, round by round, to the shard most of their neighbours are in. How many may move from
one shard to another is a quota: as many as move the other way round, and what room the target
has left. So no shard ever holds more linked documents than its capacity. Documents without a
link cut nothing wherever they are; they fill every shard up to exactly its capacity. A group
larger than a shard fills one shard after the other.

The driver only sees numbers per shard and per pair of shards. Neighbours are counted per group
and shard, and rows meet those counts in joins that split a large group over tasks.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import numbered
from wordmill.sources.checkpoints import materialise

SHARDS = 8
ROUNDS_PER_SHARD = 12  # a mere safeguard; a large group takes some two rounds for each shard it fills
LAW = "rows"


def _capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def _counts(df: DataFrame, *keys: str, weight: str | None = None) -> dict:
    """Rows, or sums of a weight, per key; the keys are shards, so there are few."""
    value = F.count("*") if weight is None else F.sum(weight)
    return {tuple(row[key] for key in keys): row["n"] for row in df.groupBy(*keys).agg(value.alias("n")).collect()}


def _quotas(wanted: dict, room: list[int]) -> dict:
    """How many of the wanted moves (from, to) are let through without overfilling a shard."""
    left = list(room)
    quotas = {(i, j): min(n, wanted.get((j, i), 0)) for (i, j), n in wanted.items()}
    for (i, j), n in sorted(wanted.items(), key=lambda move: (-move[1], move[0])):
        more = min(n - quotas[i, j], left[j])
        quotas[i, j] += more
        left[j] -= more
    return quotas


def _by_shards(values: dict, default: int):
    """A column that looks up a few constants by the columns ``shard`` and ``target``."""
    out = F.lit(default).cast("long")
    for (i, j), value in values.items():
        out = F.when((F.col("shard") == i) & (F.col("target") == j), F.lit(value).cast("long")).otherwise(out)
    return out


def propagate(state: DataFrame, capacities: list[int], rounds: int | None = None) -> DataFrame:
    """Move linked rows ``uid, group, shard`` to their neighbours: the same columns.

    Rounds go on until nothing changes. They come to an end, as every move puts more rows of a
    group together; ``rounds`` bounds them, ``ROUNDS_PER_SHARD`` for each shard unless given,
    and a warning says so if they were cut short.
    """
    rounds = ROUNDS_PER_SHARD * len(capacities) if rounds is None else rounds
    full: set[int] = set()
    still = 0
    for number in range(rounds):
        votes = materialise(state.groupBy("group", "shard").agg(F.count("*").alias("n")), "votes")
        held = _counts(votes, "shard", weight="n")
        room = [capacity - held.get((shard,), 0) for shard, capacity in enumerate(capacities)]
        # Ties go by a hash of the round, so that no shard draws all small groups and those that
        # were not let through one way try the other, and they go away from full shards.
        closed = F.col("shard").isin(list(full)) if full else F.lit(False)
        rank = F.struct("n", F.when(~closed, F.xxhash64("group", "shard", F.lit(number))).alias("tie"), "shard")
        open_shards = votes.where(~closed)
        best = open_shards.groupBy("group").agg(F.max(rank).alias("best"))
        moves = materialise(
            votes.join(best, "group")
            .where((F.col("shard") != F.col("best.shard")) & (rank < F.col("best")))
            .select("group", "shard", F.col("best.shard").alias("target"), "n"),
            "moves",
        )
        wanted = _counts(moves, "shard", "target", weight="n")
        quotas = _quotas(wanted, room)
        if any(quotas.values()):
            aimed = state.join(moves.drop("n"), ["group", "shard"], "left")
            if quotas != wanted:
                rows = sum(wanted.values())
                aimed = materialise(aimed, "aimed")
                staying, going = aimed.where("target IS NULL"), aimed.where("target IS NOT NULL")
                going = numbered(going, ["shard", "target"], [F.col("uid")], F.col("uid"), rows, "no")
                let = F.when(F.col("no") < _by_shards(quotas, 0), F.col("target"))
                aimed = going.withColumn("target", let).drop("no").unionByName(staying)
            state = materialise(aimed.select("uid", "group", F.coalesce("target", "shard").alias("shard")), "state")
        drawn = {j for (_, j), n in quotas.items() if n}
        newly_full = {j for (_, j) in wanted if room[j] <= 0 and j not in drawn} - full
        full |= newly_full
        still = 0 if newly_full or any(quotas.values()) else still + 1
        if not wanted or still == 2:
            break
    else:
        warnings.warn(f"sharding stopped after {rounds} rounds; some groups may be cut that need not be", stacklevel=2)
    return state


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int | None = None) -> DataFrame:
    """All documents in shards of equal row counts, equal texts together.

    One row per row of ``docs``: ``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and
    ``linked``, whether another row has the same text. Counts differ by one at most; the slot
    numbers a shard's rows from 0 without a gap. Null counts as the empty text and takes one
    byte, like every text takes one more than its own. Repeated rows are rows of their own.
    Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = materialise(
        docs.select(
            "doc_id",
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.xxhash64(text).alias("group"),
            F.monotonically_increasing_id().alias("uid"),
        ),
        "rows",
    )
    total = rows.count()
    capacities = _capacities(total, shards)
    groups = materialise(rows.groupBy("group").agg(F.count("*").alias("n")).where("n > 1").select("group"), "groups")
    marked = materialise(
        rows.select("uid", "group").join(groups.withColumn("linked", F.lit(True)), "group", "left"), "marked"
    )
    linked = numbered(marked.where("linked").select("uid", "group"), [], [F.col("uid")], F.col("uid"), total, "no")
    start = linked.select("uid", "group", (F.col("no") % shards).cast("int").alias("shard"))
    placed = propagate(materialise(start, "state"), capacities, rounds)

    held, filled, end = _counts(placed, "shard"), F.lit(None).cast("int"), 0
    for number, capacity in enumerate(capacities):
        end += capacity - held.get((number,), 0)
        filled = F.coalesce(filled, F.when(F.col("no") < end, F.lit(number)))
    single = marked.where("linked IS NULL").select("uid")
    filler = numbered(single, [], [F.col("uid")], F.col("uid"), total, "no").select("uid", filled.alias("shard"))
    everywhere = placed.select("uid", "shard", F.lit(True).alias("linked")).unionByName(
        filler.withColumn("linked", F.lit(False))
    )
    joined = rows.join(everywhere, "uid").drop("group")
    slotted = numbered(materialise(joined, "shards"), ["shard"], [F.col("uid")], F.col("uid"), total, "slot")
    return slotted.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "linked",
    )
