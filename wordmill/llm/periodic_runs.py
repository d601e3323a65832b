"""Periodic runs of words, found by recursive frequency splitting and a scan over lags.

A run has the length of at least three of its periods, so each of its words occurs three times in
it. A word that occurs less often within a segment is in no run of that segment and splits it;
what is left on either side is a segment of its own, in which more words may now be too rare.
Once nothing splits any more, only the surviving segments are scanned. A word next to a run that
continued it would occur as often, so no run is cut short at the edge of a segment.

Splitting keeps the counts of a segment's largest piece and recounts the others, so a word is
counted again only where its segment at least halved. The scan compares aligned blocks of each
lag's length: a run of three periods holds two equal ones next to each other. Blocks are compared
by names of their first and last power-of-two parts, which are equal only if the words are, so
all lags together take about n log n steps and no hash can mislead them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of a run.
REPEATS = 3  # least length in periods
MIN_WORDS = 24  # least length in words

SHORT_LAG = 16  # up to here a lag is compared at every position

_SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)

Run = tuple[int, int, int]  # start, length, period


def _coded(words: list[bytes]) -> np.ndarray:
    """A number for each word, the same for equal ones."""
    numbers = dict(zip(dict.fromkeys(words), count()))
    return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))


def _pieces(lo: int, hi: int, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of what is left of ``lo:hi`` without the places in ``cuts``."""
    return np.append(lo, cuts + 1), np.append(cuts, hi)


def segments(codes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of the stretches in which every word is frequent enough for a run."""
    todo = [(0, codes)]
    while todo:
        base, part = todo.pop()
        if len(part) < MIN_WORDS:
            continue
        _, part, counts = np.unique(part, return_inverse=True, return_counts=True)
        cuts = np.flatnonzero(counts[part] < REPEATS)
        by_word, first = np.argsort(part, kind="stable"), np.append(0, np.cumsum(counts))
        lo, hi = 0, len(part)
        while len(cuts):
            starts, ends = _pieces(lo, hi, cuts)
            largest = np.argmax(ends - starts)
            for k in np.flatnonzero(ends - starts >= MIN_WORDS):
                if k != largest:
                    todo.append((base + int(starts[k]), part[starts[k] : ends[k]]))
            left, right = int(starts[largest]), int(ends[largest])
            gone, times = np.unique(np.concatenate((part[lo:left], part[right:hi])), return_counts=True)
            counts[gone] -= times
            lo, hi = left, right
            rare = gone[(counts[gone] > 0) & (counts[gone] < REPEATS)]
            places = [by_word[first[w] : first[w + 1]] for w in rare]
            inside = [p[np.searchsorted(p, lo) : np.searchsorted(p, hi)] for p in places]
            cuts = np.sort(np.concatenate(inside)) if inside else np.empty(0, np.int64)
        if hi - lo >= MIN_WORDS:
            yield base + lo, base + hi


def _stretches(equal: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], equal, [False])).astype(np.int8)))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def _same_before(x: np.ndarray, at: int, lag: int) -> int:
    """How many places before ``at`` equal those ``lag`` later, ``lag`` at most."""
    low = max(0, at - lag)
    different = np.flatnonzero(x[low:at] != x[low + lag : at + lag])
    return at - low - 1 - int(different[-1]) if len(different) else at - low


def _same_from(x: np.ndarray, at: int, lag: int) -> int:
    """How many places from ``at`` on equal those ``lag`` later, ``lag`` at most."""
    high = min(len(x) - lag, at + lag)
    different = np.flatnonzero(x[at:high] != x[at + lag : high + lag])
    return int(different[0]) if len(different) else high - at


def lag_scan(x: np.ndarray) -> Iterator[Run]:
    """The runs of one segment. Lags grow, so the first to find a stretch is its period."""
    n, found, ends = len(x), [], set()
    longest = np.full(n, -1)  # the number of the longest run over each place
    lengths = np.zeros(n, np.int64)

    def run(start: int, end: int, lag: int) -> Iterator[Run]:
        if end - start >= max(MIN_WORDS, REPEATS * lag) and (start, end) not in ends:
            ends.add((start, end))
            over = start + np.flatnonzero(lengths[start:end] < end - start)
            longest[over], lengths[over] = len(found), end - start
            found.append((start, end - start, lag))
            yield found[-1]

    for lag in range(1, min(SHORT_LAG, n // REPEATS) + 1):
        for start, end in _stretches(x[:-lag] == x[lag:]):
            yield from run(start, end + lag, lag)

    names, width = x, 1  # names of the stretches of ``width`` words from each place on
    for lag in range(SHORT_LAG + 1, n // REPEATS + 1):
        while 2 * width <= lag:
            # Both names are below n, so the pair is one number.
            _, names = np.unique(names[:-width] * (n + 1) + names[width:], return_inverse=True)
            width *= 2
        fronts, backs = names[::lag], names[lag - width :: lag]
        m = n // lag
        equal = (fronts[: m - 1] == fronts[1:m]) & (backs[: m - 1] == backs[1:m])
        if not equal.any():
            continue
        for a, b in _stretches(equal):
            start, end = a * lag, (b + 1) * lag
            # Within one run and at a multiple of its period, only that run can be found again.
            known = longest[start]
            if known >= 0 and known == longest[end - 1] and lag % found[known][2] == 0:
                continue
            start, end = start - _same_before(x, start, lag), end + _same_from(x, end - lag, lag)
            yield from run(start, end, lag)


def runs(words: list[bytes]) -> list[Run]:
    """Every run of a text, by start and period."""
    # Most texts have no stretch of frequent words at all, and counting says so fastest.
    times = Counter(words)
    if sum(n for n in times.values() if n >= REPEATS) < MIN_WORDS:
        return []
    codes = _coded(words)
    found = [(lo + s, n, q) for lo, hi in segments(codes) for s, n, q in lag_scan(np.unique(codes[lo:hi], return_inverse=True)[1])]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without those any run has after its first period."""
    if not found:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in found:
        kept[start + period : start + length] = False
    return [words[k] for k in np.flatnonzero(kept)]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words with the repetition that a document's number puts into one document in ten.

    A null number puts in none.
    """
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + period]
    return words[:a] + (unit * (1 + (n - a) // period))[: n - a]


def _most_repeated(found: list[Run]) -> Run | None:
    best = None
    for run in found:  # by start and period already, so only a greater exponent replaces
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _described(doc_id: int | None, text: bytes | None, plant: bool) -> tuple:
    words = (text or b"").split()  # of bytes: ASCII white space only
    if plant:
        words = planted(words, doc_id)
    found = runs(words)
    best = _most_repeated(found)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (
        doc_id,
        len(found),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(collapsed(words, found))).hexdigest(),
    )


def _by_row(plant: bool):
    names = [column.split()[0] for column in _SCHEMA.split(", ")]

    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [None if pd.isna(i) else int(i) for i in batch["doc_id"]]
            found = [_described(i, t, plant) for i, t in zip(ids, batch["text"])]
            out = pd.DataFrame(found, columns=names)
            yield out.astype({name: "Int64" for name in names[:6]})

    return describe


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """The runs of every document's words, summed up in a row per document.

    A run is a stretch of words with smallest period q, at least ``max(24, 3 * q)`` words long,
    that no neighbouring word continues. ``n_runs`` counts them; ``start, length, period,
    exponent_milli`` describe the one with the greatest length in periods (ties: the first, then
    the shortest period), null where there is none. ``runs_sha256`` is over all of them,
    ``collapsed_sha256`` over the words that are left if each run keeps its first period only.

    ``plant`` puts a repetition into one document in ten first, as its ``doc_id`` says.

    A null text is an empty one. An empty text has no run, and both digests are of nothing.
    Repeated rows and rows with a null ``doc_id`` (never planted) come out once each; other
    columns are ignored; no rows give no rows. A text of any length is worked through whole, in
    time about n log n of its words. Nothing is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(_by_row(plant), _SCHEMA)


def without_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with every run of the text collapsed to its first period.

    The words of such a text are joined by one blank; a text without a run stays as it is, a null
    one null.
    """

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(text=[None if t is None else _collapsed_text(t) for t in batch["text"]])

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = rows.mapInPandas(collapse, rows.schema)
    return out.withColumn("text", F.col("text").cast("string"))


def _collapsed_text(text: bytes) -> bytes:
    words = text.split()
    found = runs(words)
    return b" ".join(collapsed(words, found)) if found else text
