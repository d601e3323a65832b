"""Personal data: patterns propose spans, checksums confirm them, nearby words move the score.

All of it is built-in functions. Where a pattern matches is found by cutting the text at the
matches: the lengths of the pieces and of the matches add up to the offsets, in code points.
Patterns only start where a run of their characters starts and never give back what they took,
so they are linear in the length of the text; they match what the plain pattern would.

Kinds with a contract of their own (``BASE``) are kept whenever they are valid. Others have to
reach ``MIN_SCORE``: a checksum gives them most of it, words of the context around them the rest.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 60
CONTEXT_CHARS = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))
    weighed = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(weighed, F.lit(0), lambda total, d: total + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether a string of digits and capital letters passes the mod-97 checksum of IBANs."""
    turned = F.concat(F.substring(code, 5, 1 << 10), F.substring(code, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.conv(c, 36, 10).cast("int"))
    rest = F.aggregate(values, F.lit(0), lambda r, v: (r * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return rest == 1


def _between(value: Column, low: int, high: int) -> Column:
    return (value >= low) & (value <= high)


def _valid_ip(match: Column) -> Column:
    def small(part):
        number = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(number) <= 3) & (F.left(number, F.lit(3)).cast("int") <= 255)

    return F.forall(F.split(match, r"\."), small)


def _valid_card(match: Column) -> Column:
    digits = _digits(match)
    return F.when(_between(F.length(digits), 13, 19), luhn(digits)).otherwise(F.lit(False))


def _valid_iban(match: Column) -> Column:
    code = F.replace(match, F.lit(" "), F.lit(""))
    return F.when(_between(F.length(code), 15, 34), mod97(code)).otherwise(F.lit(False))


def _valid_ssn(match: Column) -> Column:
    return ~match.rlike("^(?:000|666|9)") & ~F.substring(match, 5, 2).isin("00") & ~F.substring(match, 8, 4).isin("0000")


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    ``needs``: a character without which the pattern cannot match. ``score``: what a valid span
    has by itself; ``context`` is a pattern of words that add ``bonus`` when they stand within
    ``CONTEXT_CHARS`` before it, or as near after it and before the next match of its kind.
    ``least`` is how long a match is at least.
    """

    name: str
    pattern: str
    valid: Callable[[Column], Column] | None = None
    needs: str | None = None
    score: int = 100
    context: str | None = None
    bonus: int = 0
    least: int = 1


_LOCAL = "[A-Za-z0-9._%+-]"

# Kinds in their order, what they look like and how long they are.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, "@"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _valid_ip, "."),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", _valid_card),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: _between(F.length(_digits(m)), 9, 15), "+"),
)
ADDED = (
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9]{4}+){2,7}+(?:\x20?+[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
        _valid_iban, score=70, context=r"(?i)\b(?:iban|account|konto|compte|cuenta)\b", bonus=30, least=12,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        _valid_ssn, "-", score=40, context=r"(?i)\b(?:ssn|social|security)\b", bonus=40, least=11,
    ),
)
KINDS = BASE + ADDED


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and how deep ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sums(numbers: Column) -> Column:
    """Inclusive running sums of an array, by doubling: after k steps each is the sum of 2 ** k.

    An array that grows by one number at a time would be copied for every number.
    """
    def add(sums: Column, k: Column) -> Column:
        shift = F.least(F.pow(F.lit(2), k).cast("int"), F.size(sums))
        behind = F.concat(F.array_repeat(F.lit(0), shift), F.slice(sums, F.lit(1), F.size(sums) - shift))
        return F.zip_with(sums, behind, lambda a, b: a + b)

    steps = F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(2)))).cast("int")
    return F.aggregate(F.sequence(F.lit(0), steps - 1), numbers, add)


def _placed(text: Column, kind: Kind) -> Column:
    """All matches of a kind with their offsets and whether its context is near, in order."""
    cut = F.struct(
        F.split(text, kind.pattern).alias("pieces"), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found")
    )

    def near(cut: Column, i: Column) -> Column:
        if kind.context is None:
            return F.lit(False)
        # So many matches of the least length fill the characters that are looked at.
        back = range(-(-CONTEXT_CHARS // kind.least), 0, -1)
        earlier = [F.coalesce(F.get(cut[name], i - k), F.lit("")) for k in back for name in ("pieces", "found")]
        before = F.right(F.concat(*earlier, F.get(cut["pieces"], i)), F.lit(CONTEXT_CHARS))
        after = F.left(F.get(cut["pieces"], i + 1), F.lit(CONTEXT_CHARS))
        return before.rlike(kind.context) | after.rlike(kind.context)

    def place(cut: Column, ends: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            end = F.get(ends, i)
            return F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("m"), near(cut, i).alias("near"))

        return F.transform(cut["found"], one)

    def lengths(cut: Column) -> Column:
        return F.transform(cut["found"], lambda m, i: F.length(F.get(cut["pieces"], i)) + F.length(m))

    return _let(cut, lambda cut: _let(_running_sums(lengths(cut)), lambda ends: place(cut, ends)))


def _spans(text: Column, kind: Kind) -> Column:
    """Valid matches of a kind: an array of structs ``start, end, score``, in order."""
    empty = F.array().cast("array<struct<start:int,end:int,score:int>>")
    placed = _placed(text, kind)
    valid = placed if kind.valid is None else F.filter(placed, lambda s: kind.valid(s["m"]))

    bonus = lambda s: F.when(s["near"], kind.bonus).otherwise(0)
    scored = F.transform(valid, lambda s: F.struct(s["start"], s["end"], (F.lit(kind.score) + bonus(s)).alias("score")))
    kept = F.filter(scored, lambda s: s["score"] >= MIN_SCORE)
    cheap = text.rlike(kind.pattern) if kind.needs is None else F.contains(text, F.lit(kind.needs))
    return F.when(cheap, kept).otherwise(empty)


def _listed(kinds: tuple[Kind, ...]) -> Column:
    """All spans as ``kind:start:end``, by kind, then by start."""
    def named(kind):
        return F.transform(kind.name, lambda s: F.concat(F.lit(f"{kind.name}:"), s["start"], F.lit(":"), s["end"]))

    return F.array_join(F.concat(*[named(kind) for kind in kinds]), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, counts and digest of the base kinds, all spans.

    ``spans`` lists ``kind:start:end`` in code points, the end exclusive; ``scores`` the score of
    each. Null is the empty text; a text without any has an empty list and the digest of the
    empty string. Repeated rows come out repeatedly, other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", text.alias("text")).select(
        "doc_id", *[_spans(F.col("text"), kind).alias(kind.name) for kind in KINDS]
    )
    counts = [F.size(kind.name).cast("long").alias(f"n_{kind.name}") for kind in BASE]
    scores = F.concat(*[F.transform(kind.name, lambda s: s["score"]) for kind in KINDS])
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(BASE), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
        scores.alias("scores"),
    )
