"""The definitions spelled out one row at a time, to compare small results with."""

import re
from collections import Counter, defaultdict

import numpy as np

DELIMITERS = " \t\n\r\f"


def raw_tokens(line):
    return [t for t in re.split(f"[{DELIMITERS}]+", line) if t]


def clean(token):
    """From the first letter to the last one, lower case."""
    letters = re.search("[a-z](?:.*[a-z])?", token.lower(), re.S)
    return letters[0] if letters else ""


def words(line):
    return [w for w in map(clean, raw_tokens(line)) if w]


def line_set(line, cap=100):
    """The words among the first ``cap - 1`` tokens, and the first word from there on."""
    cleaned = [clean(token) for token in raw_tokens(line)]
    if cap is None:
        return set(filter(None, cleaned))
    return set(filter(None, cleaned[: cap - 1])) | set(list(filter(None, cleaned[cap - 1 :]))[:1])


def pmi_rows(lines, support=10, cap=100):
    sets = [line_set(line, cap) for line in lines]
    single = Counter(w for s in sets for w in s)
    double = Counter((a, b) for s in sets for a in s for b in s if a != b)
    f = np.float32
    total, rows = f(len(lines)), {}
    for (x, y), n in double.items():
        if n >= support:
            px, py, pxy = f(single[x]) / total, f(single[y]) / total, f(n) / total
            pmi = pxy / (px * py)
            rows[x, y] = (single[x], px, single[y], py, n, pxy, pmi, f(np.log10(np.float64(pmi))))
    company = {w for s in sets if len(s) > 1 for w in s}
    return rows, company


def bigram_rows(lines):
    pairs = Counter(p for line in lines for p in zip(words(line), words(line)[1:]))
    totals = Counter()
    for (first, _), n in pairs.items():
        totals[first] += n
    shares = {p: np.float32(n) / np.float32(totals[p[0]]) for p, n in pairs.items()}
    return pairs, totals, shares


def articles(lines):
    """For each end tag the plain lines after the last start tag before it."""
    starts = [k for k, line in enumerate(lines) if re.search(r"<doc[^>]*>", line)]
    ends = [k for k, line in enumerate(lines) if "</doc>" in line and k not in starts]
    tags = {*starts, *ends}
    opened = [max((s for s in starts if s < end), default=-1) for end in ends]
    return ["".join(lines[k] + " " for k in range(s + 1, e) if k not in tags) for s, e in zip(opened, ends)]


def stripes(rows, company):
    maps = defaultdict(dict, {word: {} for word in company})
    for (x, y), vector in rows.items():
        maps[x][y] = vector[-1]
    return dict(maps)
