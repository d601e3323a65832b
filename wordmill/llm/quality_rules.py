"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Every rule compares two whole numbers measured on the text, so the verdict is exact and the
same everywhere. Nothing is shuffled and nothing but the text is looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordmill.llm.common import aside, WORD, words

# Symbols, shortest text in words, largest share of repeated words in percent.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

# Frequent words of four languages; they count where they stand alone and in lower case.
STOP_WORDS = (
    "the of and to in a is that it for on with as was by this are from or an be at "
    "der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es für "
    "le la les de et un une du que qui dans pour par sur au pas est ce il en "
    "el los las y se por con su para al lo como"
).split()


@dataclass(frozen=True)
class Rule:
    """Reject a text if ``times * measure`` is beyond ``bound * per`` on the side ``op`` names."""

    name: str
    measure: str
    op: str
    bound: int
    per: str | None = None
    times: int = 1

    def broken(self, prefix: str = "") -> Column:
        left = F.col(prefix + self.measure) * self.times
        right = F.lit(self.bound) if self.per is None else F.col(prefix + self.per) * self.bound
        return left < right if self.op == "<" else left > right


BASE_RULES = (
    Rule("too_short", "n_words", "<", MIN_WORDS),
    Rule("repeats", "n_repeat_words", ">", MAX_REPEATED_PERCENT, "n_words", 100),
)
RULES = (
    Rule("words_too_short", "word_chars", "<", 2, "n_words"),
    Rule("words_too_long", "word_chars", ">", 20, "n_words"),
    Rule("symbols", "n_symbols", ">", 20, "n_words", 100),
    Rule("no_stop_words", "n_stop_words", "<", 5, "n_words", 100),
    Rule("same_lines", "n_dup_lines", ">", 50, "n_lines", 100),
)
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_POSITION_BITS = 30
_POSITION_MASK = (1 << _POSITION_BITS) - 1


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, wherever the optimizer moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _like_neighbour(items: Column, same) -> Column:
    """Those elements of a sorted array that are the same as one beside them."""
    return F.filter(items, lambda item, k: same(item, F.get(items, k - 1)) | same(item, F.get(items, k + 1)))


def _same_hash(a: Column, b: Column) -> Column:
    return F.shiftrightunsigned(a.bitwiseXOR(b), _POSITION_BITS) == 0


def _repeated_words(w: Column) -> Column:
    """How many words of an array are in windows of three words that occur twice or more.

    Windows are first sorted by a short hash beside their position; only windows that share one
    are compared as words, so the count is exact and the work per text is that of sorting
    numbers.
    """

    def hashed(w):
        starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))
        h = lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))
        return F.transform(starts, lambda x, i: F.shiftleft(h(x, i), _POSITION_BITS).bitwiseOR(i.cast("long")))

    def alike(hashes):
        return F.transform(_like_neighbour(hashes, _same_hash), lambda v: v.bitwiseAND(F.lit(_POSITION_MASK)).cast("int"))

    def compared(w, at):
        words = lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return F.transform(at, lambda i: F.struct(words(i).alias("g"), i.alias("i")))

    def positions(windows):
        return F.transform(_like_neighbour(windows, lambda a, b: a["g"] == b["g"]), lambda s: s["i"])

    def covered(at):
        steps = F.transform(at, lambda i, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - i, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    return _bind(
        w,
        lambda w: _bind(
            F.sort_array(hashed(w)),
            lambda hashes: _bind(
                alike(hashes),
                lambda at: _bind(
                    F.sort_array(compared(w, at)),
                    lambda windows: _bind(F.sort_array(positions(windows)), covered),
                ),
            ),
        ),
    )


def measured(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` with its measures as further long columns, their names after ``prefix``.

    Null is the empty text. Lines without a word don't count as lines.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    w, lines = F.col("__quality_w"), F.col("__quality_lines")
    out = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]", "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": _repeated_words(w),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(w, lambda x: x.isin(STOP_WORDS))),
    }
    with_words = F.filter(F.split(t, "\n"), lambda line: line.rlike(WORD))
    step = docs.select("*", words(F.col(text)).alias("__quality_w"), with_words.alias("__quality_lines"))
    return step.select(*docs.columns, *[value.cast("long").alias(prefix + name) for name, value in out.items()])


def quality(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the measures, ``base_failed``, ``kept``, ``broken``.

    ``broken`` lists the rules a text breaks. Null and empty texts have no words, fail the base
    rules and are not kept. Repeated rows are judged each for itself; other columns than
    ``doc_id`` and ``text`` are not read.
    """
    m = measured(docs.select("doc_id", "text"))
    names = F.array(*[F.when(rule.broken(), F.lit(rule.name)) for rule in BASE_RULES + RULES])
    base = F.lit(False)
    for rule in BASE_RULES:
        base = base | rule.broken()
    judged = m.select("*", F.array_compact(names).alias("broken"), base.alias("base_failed"))
    return judged.select(
        "doc_id", *MEASURES, "base_failed", (F.size("broken") == 0).alias("kept"), "n_lines", "n_stop_words", "broken"
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` no rule rejects, with all their columns as they were, whatever their names."""
    own = "__quality_"
    broken = F.lit(False)
    for rule in BASE_RULES + RULES:
        broken = broken | rule.broken(own)
    # The row number keeps the filter above the measures. Pushed below them it would work out
    # every measure again for every rule, and a text's words again for every word.
    m = measured(aside(docs, "text"), prefix=own).select("*", F.monotonically_increasing_id().alias(own + "row"))
    return m.where(~broken & (F.col(own + "row") >= 0)).select("row.*")


# The measures and rules of ``quality`` by their definitions, ``broken`` joined by commas.
SQL = r"""
WITH texts AS MATERIALIZED (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)),
                       lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
    FROM documents),
numbered AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM texts),
windows AS (
    SELECT r, i, word || ' ' || lead(word) OVER later || ' ' || lead(word, 2) OVER later AS g
    FROM numbered WINDOW later AS (PARTITION BY r ORDER BY i)),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS found FROM windows WHERE g IS NOT NULL),
repeated AS (
    SELECT r, count(DISTINCT i + o) AS n_repeat_words
    FROM counted, (VALUES (0), (1), (2)) AS offsets(o) WHERE found > 1 GROUP BY r),
stop_words AS (
    SELECT r, count(*) AS n_stop_words FROM numbered WHERE word IN (%s) GROUP BY r),
measures AS (
    SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
           length(regexp_replace(t, '[^#*$%%&|<>]', '', 'g')) AS n_symbols,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words,
           len(lines) AS n_lines, coalesce(n_stop_words, 0) AS n_stop_words
    FROM texts LEFT JOIN repeated USING (r) LEFT JOIN stop_words USING (r)),
judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           concat_ws(',',
               CASE WHEN n_words < 50 THEN 'too_short' END,
               CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 'repeats' END,
               CASE WHEN word_chars < 2 * n_words THEN 'words_too_short' END,
               CASE WHEN word_chars > 20 * n_words THEN 'words_too_long' END,
               CASE WHEN 100 * n_symbols > 20 * n_words THEN 'symbols' END,
               CASE WHEN 100 * n_stop_words < 5 * n_words THEN 'no_stop_words' END,
               CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 'same_lines' END) AS broken
    FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       broken = '' AS kept, n_lines, n_stop_words, broken
FROM judged
""" % ", ".join(f"'{word}'" for word in sorted(set(STOP_WORDS)))
