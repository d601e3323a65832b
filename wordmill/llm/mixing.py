"""Mixing sources by temperature.

The token share p of a source becomes the weight p**e / sum(p**e). The exponent e is searched
between 0 (all sources alike) and 1 (as they are): the least one whose mixture is within the
limit, on how often a source is repeated or on the entropy of the weights. The budget is the
smallest that shows every document at least once; each source gets its weight of it.

Within a source documents come in passes. A pass is a permutation by a hash of the document and
the pass, cut into blocks. All passes the budget holds are whole; of the next one the blocks
from the front that fit are taken whole and one block up to the token the budget ends at. Only
that one block per source is put in sequence, everything else is decided row by row from a
table with one row per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.common import aside, words
from wordmill.sources.checkpoints import materialise

MAX_REPEATS = 2.0
SEED = "mix"
ROWS_PER_BLOCK = 20_000

_SECTIONS = 32  # the bracket of the exponent shrinks by this factor with each look at the sources
_LOOKS = 8
_DECIMALS = 6

_OWN = "__mix_"


def _keyed(df: DataFrame, source: str) -> DataFrame:
    """With the source as a plain join key; rows without a source are one of their own."""
    return df.withColumn(_OWN + "source", F.coalesce(source, F.lit(""))).withColumn(_OWN + "none", F.col(source).isNull())


_KEY = [_OWN + "source", _OWN + "none"]


def source_tokens(counted: DataFrame) -> DataFrame:
    """Tokens of each source from ``source, n_tokens``, kept; one row per source."""
    sums = _keyed(counted, "source").groupBy(*_KEY).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    return materialise(sums, "sources")


def _within(share: Column, exponent: float, max_repeats: float | None, max_entropy: float | None) -> Column:
    """Whether the mixture at an exponent keeps the limit, as an aggregate over sources."""
    if max_repeats is not None:
        seen = F.pow(share, F.lit(exponent - 1))
        return F.max(seen) <= F.min(seen) * max_repeats
    power = F.pow(share, F.lit(exponent))
    entropy = F.log(F.sum(power)) - F.lit(exponent) * F.sum(power * F.log(share)) / F.sum(power)
    return entropy <= max_entropy


def find_exponent(sources: DataFrame, max_repeats: float | None = MAX_REPEATS, max_entropy: float | None = None) -> float:
    """The least exponent within the limit, rounded up to six decimals.

    Give one limit: how often the most repeated source may be seen for each time the least
    repeated one is, or the entropy the weights may have at most. Both fall as the exponent
    grows. Each look evaluates a whole grid in one aggregate over the sources.
    """
    with_tokens = sources.where("tokens > 0")
    total = with_tokens.agg(F.sum("tokens")).first()[0]
    if not total:
        return 1.0
    limit = (None, max_entropy) if max_entropy is not None else (max_repeats, None)
    share, low, high = F.col("tokens") / F.lit(total), 0.0, 1.0
    for look in range(_LOOKS):
        step = (high - low) / _SECTIONS
        grid = [low + step * k for k in range(_SECTIONS)] + [high]
        row = with_tokens.agg(*[_within(share, e, *limit).alias(f"g{k}") for k, e in enumerate(grid)]).first()
        first = next((k for k, ok in enumerate(row) if ok), _SECTIONS)
        if first == 0:  # on the first look the flattest mixture is within the limit
            high = grid[0]
            break
        low, high = grid[first - 1], grid[first]
    return min(1.0, math.ceil(high * 10**_DECIMALS - 1e-3) / 10**_DECIMALS)


def mixing_plan(sources: DataFrame, exponent: float) -> DataFrame:
    """One row per source: ``tokens, weight, budget, passes, rest``, kept.

    ``passes`` whole passes and ``rest`` tokens of one more make up the budget. A source without
    tokens costs nothing; its documents come once.
    """
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(exponent))).otherwise(F.lit(0.0))
    powered = sources.withColumn("power", power)
    total = powered.select(F.sum("power")).scalar()
    per_power = powered.select(F.max(F.col("tokens") / F.nullif("power", F.lit(0.0)))).scalar()
    budgeted = powered.select(
        *_KEY,
        "tokens",
        "rows",
        F.coalesce(F.col("power") / F.nullif(total, F.lit(0.0)), F.lit(0.0)).alias("weight"),
        F.coalesce(F.round(F.col("power") * per_power).cast("long"), F.lit(0)).alias("budget"),
    )
    passes = F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.nullif("tokens", F.lit(0)))).otherwise(1).cast("int")
    passed = budgeted.withColumn("passes", passes)
    return materialise(passed.withColumn("rest", F.greatest(F.col("budget") - F.col("passes") * F.col("tokens"), F.lit(0))), "plan")


def _place(doc_id: Column, number: Column) -> Column:
    """Where a document stands in a pass: a hash that every engine has."""
    return F.md5(F.concat_ws(":", F.lit(SEED), number.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _block(place: Column, blocks: int) -> Column:
    return F.floor(F.conv(F.substring(place, 1, 8), 16, 10).cast("long") * blocks / F.lit(1 << 32)).cast("int")


def _realised(docs: DataFrame, counted: DataFrame, plan: DataFrame, tokens: Column, blocks: int) -> DataFrame:
    """``docs`` once per time it is shown, with the number of the pass as ``__mix_epoch``.

    ``counted`` has ``doc_id, source, n_tokens`` of the same rows.
    """
    place, passes = _OWN + "place", _OWN + "passes"
    small = plan.select(*_KEY, F.col("passes").alias(passes), F.col("rest").alias(_OWN + "rest"))

    # Tokens per source and block of the pass that is not whole, and the block it ends in.
    last = _keyed(counted, "source").join(small, _KEY)
    last = last.withColumn(_OWN + "block", _block(_place(F.col("doc_id"), F.col(passes)), blocks))
    sums = last.groupBy(*_KEY, _OWN + "block", _OWN + "rest").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(*_KEY).orderBy(_OWN + "block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fits = sums.select(*_KEY, _OWN + "block", _OWN + "rest", before.alias("before"), "n").where(F.col("before") + F.col("n") > F.col(_OWN + "rest"))
    ends = fits.groupBy(*_KEY).agg(F.min(_OWN + "block").alias(_OWN + "end"), F.min_by("before", _OWN + "block").alias(_OWN + "before"))
    table = materialise(
        small.join(ends, _KEY, "left").select(*small.columns, F.coalesce(_OWN + "end", F.lit(blocks)).alias(_OWN + "end"), F.coalesce(_OWN + "before", F.lit(0)).alias(_OWN + "before")),
        "ends",
    )

    shown = _keyed(docs, "source").join(table, _KEY)
    shown = shown.withColumn(place, _place(F.col("doc_id"), F.col(passes)))
    shown = shown.withColumn(_OWN + "block", _block(F.col(place), blocks))
    more = (F.col(_OWN + "block") < F.col(_OWN + "end")).cast("int")
    times = F.col(passes) + F.when(F.col(_OWN + "rest") > 0, more).otherwise(0)
    whole = shown.withColumn(_OWN + "epoch", F.explode(F.sequence(F.lit(0), times - 1)))

    edge = shown.where((F.col(_OWN + "block") == F.col(_OWN + "end")) & (F.col(_OWN + "rest") > 0))
    # Rows that agree in their place, which are repeats of a document, fit together or not at all.
    so_far = F.sum(tokens).over(Window.partitionBy(*_KEY).orderBy(place))
    edge = edge.withColumn(_OWN + "sum", so_far).where(F.col(_OWN + "before") + F.col(_OWN + "sum") <= F.col(_OWN + "rest"))
    cut = edge.withColumn(_OWN + "epoch", F.col(passes)).drop(_OWN + "sum")
    return whole.unionByName(cut)


def _tokens(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("n_tokens"))


def mixture(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, max_entropy: float | None = None) -> DataFrame:
    """One row for each time a document is shown: ``doc_id, source, n_tokens, epoch, order_key``.

    ``epoch`` is the pass from 0, ``order_key`` sorts a pass. Every document is shown at least
    once. Null texts have no tokens; rows without a source are a source of their own; rows that
    agree in doc_id are shown equally often. An empty table gives an empty result. Other columns
    are not read.
    """
    counted = materialise(_tokens(docs), "tokens")
    sources = source_tokens(counted)
    plan = mixing_plan(sources, find_exponent(sources, max_repeats, max_entropy))
    blocks = max(1, -(-counted.count() // ROWS_PER_BLOCK))
    out = _realised(counted, counted, plan, F.col("n_tokens"), blocks)
    epoch = F.col(_OWN + "epoch")
    return out.select("doc_id", "source", "n_tokens", epoch.alias("epoch"), _place(F.col("doc_id"), epoch).alias("order_key"))


def mix(docs: DataFrame, max_repeats: float | None = MAX_REPEATS, max_entropy: float | None = None) -> DataFrame:
    """The rows of ``docs``, each as often as it is shown, with all their columns as they were, whatever their names."""
    counted = materialise(_tokens(docs), "tokens")
    sources = source_tokens(counted)
    plan = mixing_plan(sources, find_exponent(sources, max_repeats, max_entropy))
    blocks = max(1, -(-counted.count() // ROWS_PER_BLOCK))
    tokens = F.size(words(F.col("text"))).cast("long")
    return _realised(aside(docs, "doc_id", "source", "text"), counted, plan, tokens, blocks).select("row.*")


SQL = f"""
  WITH counted AS (
    SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS BIGINT) AS n_tokens
    FROM documents
  ), sources AS (
    SELECT source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM counted GROUP BY source
  ), exponent AS (
    SELECT CASE WHEN max(tokens) <= min(tokens) * {MAX_REPEATS} THEN 0
                ELSE ceil((1 - ln({MAX_REPEATS}) / ln(CAST(max(tokens) AS DOUBLE) / min(tokens))) * 1e{_DECIMALS} - 1e-3) / 1e{_DECIMALS} END AS e
    FROM sources WHERE tokens > 0
  ), powered AS (
    SELECT source, tokens, CASE WHEN tokens > 0 THEN pow(CAST(tokens AS DOUBLE), e) ELSE 0 END AS power
    FROM sources, exponent
  ), budgeted AS (
    SELECT source, tokens, CAST(coalesce(round(power * (SELECT max(tokens / power) FROM powered WHERE power > 0)), 0) AS BIGINT) AS budget
    FROM powered
  ), plan AS (
    SELECT source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 1 END AS passes,
           CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest
    FROM budgeted
  ), placed AS (
    SELECT c.*, passes, rest, sum(n_tokens) OVER (
             PARTITION BY c.source ORDER BY md5('{SEED}:' || passes || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))) AS so_far
    FROM counted c JOIN plan p ON c.source IS NOT DISTINCT FROM p.source
  ), shown AS (
    SELECT doc_id, source, n_tokens,
           unnest(range(passes + CASE WHEN rest > 0 AND so_far <= rest THEN 1 ELSE 0 END)) AS epoch
    FROM placed
  )
  SELECT doc_id, source, n_tokens, CAST(epoch AS INTEGER) AS epoch,
         md5('{SEED}:' || epoch || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS order_key
  FROM shown"""
