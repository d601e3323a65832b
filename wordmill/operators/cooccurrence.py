"""Words that share lines: dictionary, word sets, pairs and their counts.

Pairs are what costs: a corpus has many more of them than it has words. They are kept cheap by

* counting copies of a word set once, weighted;
* dropping words without the support a pair needs before pairs are made, and writing words as
  numbers, by a broadcast dictionary if it is small and by a shuffled join if it is not;
* making each pair once, under the rarer of its two words, and shuffling one row per word and
  line with all its partners instead of one row per pair;
* writing a partner in two bytes, unless it is not among the 65,536 most frequent words;
* sorting all partners of a word as one array of numbers, out of which only pairs come that have
  support, instead of adding up pair by pair;
* counting pairs of two of the most frequent words inside the map tasks instead, where they
  repeat. Any other word is the rarer one of its pairs on a small share of the lines at most;
* counting the rest in as many tasks as there are pairs for, and dealing the lines of a word on
  very many of them into several arrays, so that what a task holds stays in memory at every size.

What is known of a corpus before pairs are made, its word sets and line frequencies, adds up over
corpora, as nothing has been dropped from it yet.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ShortType

from wordmill.functions import text as T
from wordmill.sources.checkpoints import materialise

# Tables of words are broadcast only while they are estimated to stay below this size; the
# estimate takes the bytes of each word plus a fixed overhead per entry.
BROADCAST_BYTES = 64 << 20
ENTRY_BYTES = 64

# A word is very frequent if it is in more lines than one task gathers easily.
FREQUENT_LINES = 200_000

# Of the words in more lines than this, so many of the most frequent ones have the pairs among them
# counted in the map tasks: two million pairs at most, so that each is met there again and again.
REPEATED_LINES = 2_000
REPEATED_WORDS = 2_000

# Word numbers from here on fit into two bytes, up to that of the most frequent word.
SHORT_MIN, SHORT_MAX = -(1 << 15), (1 << 15) - 1

# Pairs that one task counts, most of them more than once.
PAIRS_PER_TASK = 8_000_000

# Equal partners in a row that tell a pair which may have support; fewer if support is less.
LONGEST_RUN = 16

# Lines whose partners of one word are gathered in one array.
LONG_LINES = 100_000


@dataclass(frozen=True)
class WordSets:
    """What the lines of one corpus hold, kept: ``bags`` and ``words``, both whole.

    ``bags``: ``bag, copies`` as ``word_sets`` makes them. ``words`` as in ``Counts``.
    """

    bags: DataFrame
    words: DataFrame
    max_tokens: int | None = T.MAX_TOKENS


@dataclass(frozen=True)
class Counts:
    """Line frequencies and pair counts of one corpus.

    ``words``: ``word, n, paired`` - lines holding the word, and whether it ever had company;
    the row whose word is null counts the lines themselves.
    ``pairs``: ``x, y, n_xy, n_x, n_y`` - every pair with enough support, one way round.
    """

    words: DataFrame
    pairs: DataFrame
    min_support: int = T.MIN_SUPPORT
    max_tokens: int | None = T.MAX_TOKENS

    def total(self) -> DataFrame:
        return self.words.where(F.col("word").isNull()).select(F.col("n").alias("n_lines"))


PAIR_COLUMNS = ["x", "y", "n_xy", "n_x", "n_y"]


def is_supported(min_support: int) -> Column:
    return F.col("word").isNotNull() & (F.col("n") >= min_support)


def supported_words(words: DataFrame, min_support: int) -> DataFrame:
    return words.where(is_supported(min_support)).select("word", "n")


def word_sets(lines: DataFrame, max_tokens: int | None) -> DataFrame:
    """The distinct word sets of the lines and how many lines have each: ``bag, copies``.

    A bag is the sorted set joined by blanks. Copies of a line are counted in the map task, so
    a line that is repeated all over the corpus is kept once and makes its pairs once. The
    shuffle also evens out tasks, and makes the bag a key that needs no generated line numbers.
    """
    words = F.sort_array(T.distinct_words(F.col("value"), max_tokens))
    bags = lines.select(F.array_join(words, " ").alias("bag"))
    return bags.groupBy("bag").agg(F.count("*").alias("copies"))


def dictionary(bags: DataFrame) -> DataFrame:
    """Line frequency of every word, and of the null word that stands for the line itself."""
    words = F.when(F.col("bag") != "", F.split("bag", " ")).otherwise(F.array().cast("array<string>"))
    marked = F.array_append(words, F.lit(None).cast("string"))
    return (
        bags.select("copies", F.contains("bag", F.lit(" ")).alias("paired"), F.explode(marked).alias("word"))
        .groupBy("word")
        .agg(F.sum("copies").alias("n"), F.bool_or("paired").alias("paired"))
    )


def numbered(words: DataFrame) -> DataFrame:
    """``word, n, id`` with larger numbers for more frequent words, from 0 without gaps, kept.

    The words are sorted by many tasks; numbers grow within a task's rows and from task to task.
    The driver sees how many words each task has.
    """
    task, row = F.shiftright("at", 33).cast("int"), F.col("at").bitwiseAND((1 << 33) - 1)
    ordered = words.select("word", "n").orderBy("n", "word").withColumn("at", F.monotonically_increasing_id())
    ordered = materialise(ordered.select("word", "n", task.alias("task"), row.alias("row")), "ordered")
    sizes = {row["task"]: row["count"] for row in ordered.groupBy("task").count().collect()}
    starts, start = [], 0
    for number in range(max(sizes, default=-1) + 1):
        starts.append(start)
        start += sizes.get(number, 0)
    first = F.get(F.array(*map(F.lit, starts)).cast("array<bigint>"), F.col("task"))
    # Half as many bytes as a long; more words than an int can number raise an error.
    return ordered.select("word", "n", (first + F.col("row")).cast("int").alias("id"))


def _tokens(bags: DataFrame) -> DataFrame:
    """``bag_id, copies, word`` of kept bags. Reading them again gives the same numbers."""
    return bags.withColumn("bag_id", F.monotonically_increasing_id()).select(
        "bag_id", "copies", F.explode(F.split("bag", " ")).alias("word")
    )


def numbered_sets(bags: DataFrame, numbers: DataFrame, limit: int) -> DataFrame:
    """Word sets as sorted numbers, without the words that have none: ``copies, words, rarer, far``.

    ``rarer`` is how many of the words, at the front, have numbers below ``limit``, ``far`` how
    many have numbers that need more than two bytes. A set is put back together from the numbers
    of its words.
    """
    return (
        _tokens(bags)
        .join(numbers, "word")
        .groupBy("bag_id", "copies")
        .agg(
            F.sort_array(F.collect_list("id")).alias("words"),
            F.count_if(F.col("id") < limit).alias("rarer"),
            F.count_if(F.col("id") < SHORT_MIN).cast("int").alias("far"),
        )
        .select("copies", "words", "rarer", "far")
    )


def _partners(sets: DataFrame) -> DataFrame:
    """Each word of a sorted set with those after it in two bytes: ``x, copies, rare, partners``."""
    words, far = F.col("words"), F.col("far")
    # Kept arrays may hold nulls by their type; without that, they are sorted as plain numbers.
    near = F.slice(F.array_compact(words), far + 1, F.size(words)).cast(ArrayType(ShortType(), False))
    cut = sets.select("copies", "rarer", "words", "far", near.alias("near"))
    firsts = cut.select("copies", "rarer", "far", "near", F.posexplode(T.all_but_last(words)).alias("i", "x"))
    skipped = F.greatest(F.col("i") + 1 - F.col("far"), F.lit(0))
    return firsts.select(
        "x",
        "copies",
        (F.col("i") < F.col("rarer")).alias("rare"),
        F.slice("near", skipped + 1, F.size("near")).alias("partners"),
    )


def _far_partners(sets: DataFrame) -> DataFrame:
    """Each word of a sorted set with those after it that need more than two bytes: ``x, copies, partners``."""
    # Without nulls by type, as in ``_partners``.
    words = F.slice(F.array_compact("words"), F.lit(1), F.col("far"))
    cut = sets.where(F.col("far") > 1).select("copies", words.alias("words"))
    firsts = cut.select("copies", "words", F.posexplode(T.all_but_last(F.col("words"))).alias("i", "x"))
    return firsts.select("x", "copies", F.slice("words", F.col("i") + 2, F.size("words")).alias("partners"))


def count_under_rarer_word(
    partners: DataFrame, tasks: int, min_support: int, long_from: int | None = None, shares: int = 1
) -> DataFrame:
    """Pair counts from one shuffled row per word and line: ``x, y, n_xy``; most pairs below support are left out.

    All partners of a word are sorted as one array of numbers, where a pair is a stretch of equal
    ones. Only the first and the last place of a stretch leave the array, and none if it is too
    short for support, so the aggregate meets a pair twice, however many lines it is on. Words
    from ``long_from`` on have their lines dealt into ``shares`` arrays, out of which every pair
    comes. Partitioned by x the counts need no further shuffle.
    """
    run = max(1, min(min_support, LONGEST_RUN))
    # A line counts as many times as it has copies, up to ``run``; what it has beyond that comes
    # after the stretches with its number, and is only had by pairs whose stretch is long enough.
    times = F.least("copies", F.lit(run)).cast("int")
    beyond = F.when(F.col("copies") > run, F.col("copies") - run)
    is_long = F.lit(False) if long_from is None else F.col("x") >= long_from
    share = F.when(is_long, F.monotonically_increasing_id() % shares).otherwise(0).cast("int")
    lists = partners.repartition(tasks, "x").sortWithinPartitions("x").select(
        "x",
        share.alias("share"),
        F.when(times == 1, F.col("partners")).otherwise(F.flatten(F.array_repeat("partners", times))).alias("list"),
        F.when(beyond.isNotNull(), F.col("partners")).alias("more"),
        F.when(beyond.isNotNull(), F.array_repeat(beyond, F.size("partners"))).alias("more_n"),
    )
    merged = lists.groupBy("x", "share").agg(
        F.sort_array(F.flatten(F.collect_list("list"))).alias("list"),
        F.flatten(F.collect_list("more")).alias("more"),
        F.flatten(F.collect_list("more_n")).alias("more_n"),
    )
    i, end = F.col("i"), F.size("list")
    places = end + F.size("more")
    places = F.when(places > 0, F.sequence(F.lit(0), places - 1)).alias("partners")
    each = merged.select("*", places).select("x", "list", "more", "more_n", F.explode("partners").alias("i"))

    def same(step: int) -> Column:
        return F.get("list", i + step).eqNullSafe(F.get("list", i))

    after, first, last = i >= end, ~same(-1), ~same(1)
    pairs = each.where(after | (first & (is_long | same(run - 1))) | (last & (is_long | same(1 - run)))).select(
        "x",
        F.when(after, F.get("more", i - end)).otherwise(F.get("list", i)).cast("int").alias("y"),
        F.when(after, F.get("more_n", i - end))
        .otherwise(F.when(last, i + 1).otherwise(0) - F.when(first, i).otherwise(0))
        .alias("n"),
    )
    return pairs.groupBy("x", "y").agg(F.sum("n").alias("n_xy"))


def count_in_map_tasks(partners: DataFrame) -> DataFrame:
    """Pair counts added up before the shuffle, for pairs that may be on any share of the lines."""
    # The pairs of a line are never held: the generator feeds the aggregate one by one.
    pairs = partners.select("x", F.explode("partners").alias("y"), "copies")
    counts = pairs.groupBy("x", "y").agg(F.sum("copies").alias("n_xy"))
    return counts.withColumn("y", F.col("y").cast("int"))


def with_words(counts: DataFrame, numbers: DataFrame, small: bool) -> DataFrame:
    """Numbers back to words, and how many lines have each.

    Only pairs with support get here. Where the dictionary is joined by a shuffle, a word with
    very many partners is split over tasks: as the second word of a pair, and as the first one
    if it is among the most frequent. Any other first word has a small share of the pairs.
    """
    x = numbers.select(F.col("id").alias("x_id"), F.col("word").alias("x"), F.col("n").alias("n_x"))
    y = numbers.select(F.col("id").alias("y_id"), F.col("word").alias("y"), F.col("n").alias("n_y"))
    if small:
        x, y = F.broadcast(x), F.broadcast(y)
    named = counts.withColumnsRenamed({"x": "x_id", "y": "y_id"})
    return named.join(x, "x_id").join(y, "y_id").select(*PAIR_COLUMNS)


def _is_small(supported: DataFrame, broadcast_bytes: int) -> bool:
    """Whether the dictionary is small enough to broadcast."""
    entry = F.octet_length("word") + ENTRY_BYTES
    return (supported.agg(F.sum(entry).alias("bytes")).first()["bytes"] or 0) <= broadcast_bytes


def _first_repeated(numbers: DataFrame, frequent_lines: int) -> tuple[int, bool]:
    """The number from which on words have the pairs among them counted in map tasks, and if any has."""
    frequent = F.count_if(F.col("n") > min(frequent_lines, REPEATED_LINES))
    found = numbers.agg(F.count("*").alias("words"), frequent.alias("frequent")).first()
    repeated = min(found["frequent"], REPEATED_WORDS)
    return found["words"] - repeated, repeated > 0


def _tasks(bags: DataFrame) -> int:
    """How many tasks the pairs of all words need."""
    size = (F.length("bag") - F.length(F.replace("bag", F.lit(" "), F.lit("")))).cast("long") + 1
    pairs = bags.agg(F.sum(size * (size - 1) / 2).alias("pairs")).first()["pairs"] or 0
    return max(1, math.ceil(pairs / PAIRS_PER_TASK))


def count_word_sets(lines: DataFrame, max_tokens: int | None = T.MAX_TOKENS) -> WordSets:
    """Word sets and line frequencies of a corpus, kept in the shared folder.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines. The
    corpus is read and tokenised once.
    """
    bags = materialise(word_sets(lines, max_tokens), "bags")
    return WordSets(bags, materialise(dictionary(bags), "words"), max_tokens)


def merge_word_sets(several: list[WordSets]) -> WordSets:
    """Word sets of corpora together, kept, from those made apart with the same cap.

    They are the size of the corpora, and pairs without support in the sum are never made.
    """
    if len({part.max_tokens for part in several}) != 1:
        raise ValueError("word sets with different caps on tokens do not add up")
    bags = reduce(DataFrame.unionByName, [part.bags for part in several])
    bags = materialise(bags.groupBy("bag").agg(F.sum("copies").alias("copies")), "bags")
    return WordSets(bags, _merged_words([part.words for part in several]), several[0].max_tokens)


def _merged_words(several: list[DataFrame]) -> DataFrame:
    words = reduce(DataFrame.unionByName, several)
    words = words.groupBy("word").agg(F.sum("n").alias("n"), F.bool_or("paired").alias("paired"))
    return materialise(words, "words")


def count_pairs(
    found: WordSets,
    min_support: int = T.MIN_SUPPORT,
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent_lines: int = FREQUENT_LINES,
) -> Counts:
    """Counts of the pairs in word sets; leaves the pairs lazy.

    Of the words in more than ``frequent_lines`` lines, or ``REPEATED_LINES`` if that is less, the
    most frequent ones have the pairs among them counted in the map tasks.
    """
    supported = supported_words(found.words, min_support)
    small = _is_small(supported, broadcast_bytes)
    numbers = numbered(supported)
    limit, any_repeated = _first_repeated(numbers, frequent_lines)
    # The most frequent word gets the largest number of two bytes, whatever the size of the dictionary.
    longer = F.count_if(F.col("n") > LONG_LINES)
    longest = F.max(F.when(F.col("id") < limit, F.col("n")))
    sizes = numbers.agg(F.count("*").alias("words"), longer.alias("longer"), longest.alias("longest")).first()
    shift = sizes["words"] - 1 - SHORT_MAX
    long_from = sizes["words"] - sizes["longer"] - shift
    shares = math.ceil((sizes["longest"] or 1) / LONG_LINES)
    any_far = shift + SHORT_MIN > 0
    numbers = numbers.withColumn("id", F.col("id") - shift)
    sets = numbered_sets(found.bags, F.broadcast(numbers) if small else numbers, limit - shift)
    if any_repeated or any_far:
        # Needed more than once, so they are put together once and kept.
        sets = materialise(sets, "sets")
    partners, tasks = _partners(sets), _tasks(found.bags)
    rare = partners.where("rare") if any_repeated else partners
    kinds = [rare, _far_partners(sets)] if any_far else [rare]
    under_rarer = [count_under_rarer_word(kind, tasks, min_support, long_from, shares) for kind in kinds]

    def named(counts: DataFrame) -> DataFrame:
        return with_words(counts.where(F.col("n_xy") >= min_support), numbers, small)

    pairs = named(reduce(DataFrame.unionByName, under_rarer))
    if any_repeated:
        pairs = pairs.unionByName(named(count_in_map_tasks(partners.where(~F.col("rare")))))
    return Counts(found.words, pairs, min_support, found.max_tokens)


def count_cooccurrence(
    lines: DataFrame,
    min_support: int = T.MIN_SUPPORT,
    max_tokens: int | None = T.MAX_TOKENS,
    broadcast_bytes: int = BROADCAST_BYTES,
    frequent_lines: int = FREQUENT_LINES,
) -> Counts:
    """Count words and pairs of a corpus; computes the dictionary, leaves the pairs lazy.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines. The
    corpus is read and tokenised once; its word sets and the dictionary are kept in the shared
    folder.
    """
    return count_pairs(count_word_sets(lines, max_tokens), min_support, broadcast_bytes, frequent_lines)


def merge_counts(
    several: list[Counts], min_support: int = T.MIN_SUPPORT, broadcast_bytes: int = BROADCAST_BYTES
) -> Counts:
    """Counts of corpora together, from counts made apart.

    Counts of lines add up as long as nothing was dropped, so every part has to be counted with
    ``min_support=1`` and the same cap; support is applied to the sums. Parts may be kept by
    ``write_counts``, and a new one be added to them without counting the old corpora again.
    Pairs without support are many more than others: corpora of more than some 10 MB are better
    merged by ``merge_word_sets``.
    """
    if any(part.min_support > 1 for part in several):
        raise ValueError("counts that dropped rare pairs do not add up; count with min_support=1")
    if len({part.max_tokens for part in several}) != 1:
        raise ValueError("counts with different caps on tokens do not add up")
    words = _merged_words([part.words for part in several])

    # Parts may have a pair either way round.
    way = (F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "n_xy")
    pairs = reduce(DataFrame.unionByName, [part.pairs.select(*way) for part in several])
    pairs = pairs.groupBy("x", "y").agg(F.sum("n_xy").alias("n_xy")).where(F.col("n_xy") >= min_support)
    supported = supported_words(words, min_support)
    small = _is_small(supported, broadcast_bytes)
    named = with_words(pairs, supported.withColumn("id", F.col("word")), small)
    return Counts(words, named, min_support, several[0].max_tokens)
