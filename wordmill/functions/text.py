"""Column expressions from a line of text to its words.

All of them are built-in regular-expression and array functions, so they stay inside
whole-stage code generation, and every pattern is linear in the length of the line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token delimiters, token cap per line, minimum support.
DELIMITERS = r" \t\n\r\f"
MAX_TOKENS = 100
MIN_SUPPORT = 10

# What is left of a token once everything before its first and after its last letter is cut
# off: one match per token that has a letter at all, none for the others.
_WORD = rf"[a-z](?:[^{DELIMITERS}]*[a-z])?"


def words(line: Column) -> Column:
    """The cleaned, non-empty words of a line in order, repeats included."""
    return F.regexp_extract_all(F.lower(line), F.lit(_WORD), F.lit(0))


def capped(line: Column, max_tokens: int | None = MAX_TOKENS) -> Column:
    """The lower-cased start of a line that counts towards co-occurrence; all of it with ``None``.

    It holds the first ``max_tokens - 1`` raw tokens, then any tokens without a letter, then
    one more token. Possessive quantifiers keep the matcher from backtracking or recursing.
    """
    if max_tokens is None:
        return F.lower(line)
    gap, raw, junk = f"[{DELIMITERS}]", f"[^{DELIMITERS}]", f"[^a-z{DELIMITERS}]"
    start = rf"^{gap}*+(?:{raw}++{gap}++){{0,{max_tokens - 1}}}+(?:{junk}++{gap}++)*+{raw}*+"
    return F.regexp_extract(F.lower(line), start, 0)


def distinct_words(line: Column, max_tokens: int | None = MAX_TOKENS) -> Column:
    """The set of words a line contributes to line frequencies and co-occurrence.

    Only the first ``max_tokens`` tokens of a line count; ``None`` counts whole lines.
    """
    return F.array_distinct(F.regexp_extract_all(capped(line, max_tokens), F.lit(_WORD), F.lit(0)))


def all_but_last(array: Column) -> Column:
    return F.slice(array, F.lit(1), F.greatest(F.size(array) - 1, F.lit(0)))


def line_parts(text: Column) -> Column:
    """A text cut at its line ends, which are CR, LF and CRLF."""
    unified = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    return F.split(unified, "\n")


def without_open_end(parts: Column) -> Column:
    """The lines among the parts: the piece after a final line end is not one."""
    open_end = (F.element_at(parts, -1) == "").cast("int")
    return F.slice(parts, F.lit(1), F.size(parts) - open_end)


def lines_of(text: Column) -> Column:
    """The lines of a text; the empty text has none."""
    return without_open_end(line_parts(text))
