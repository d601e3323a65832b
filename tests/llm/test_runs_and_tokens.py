"""Periodic runs, byte-level BPE and hard negatives, by brute force and an exact round trip."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from llm import cases
from wordmill.llm import byte_bpe, hard_negatives, periodic_runs, registry


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# Periodic runs


def slow_runs(words):
    """Every lag at every position; the first lag that gives a stretch is its period."""
    n, found = len(words), {}
    for lag in range(1, n // 3 + 1):
        at = 0
        while at + lag < n:
            end = at
            while end + lag < n and words[end] == words[end + lag]:
                end += 1
            if end > at and end + lag - at >= max(24, 3 * lag):
                found.setdefault((at, end + lag), lag)
            at = max(end, at + 1)
    return sorted((start, end - start, lag) for (start, end), lag in found.items())


def slow_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), 1 if doc_id is None else zlib.crc32(b"%d" % doc_id)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = slow_runs(words)
    dropped = {k for s, length, q in found for k in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    shown = (*best, math.floor(1000 * best[1] / best[2])) if best else (None,) * 4
    kept = [w for k, w in enumerate(words) if k not in dropped]
    return (doc_id, len(found), *shown, sha("".join("%d,%d,%d\n" % r for r in found)), sha(b" ".join(kept)))


def repeating(rng, letters):
    words = [b"%d" % rng.randrange(letters) for _ in range(rng.choice([5, 30, 90, 250]))]
    for _ in range(rng.randint(0, 3)):
        unit = [b"%d" % rng.randrange(letters + 3) for _ in range(rng.randint(1, 40))]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * 9)[: rng.randint(1, 6 * len(unit) + 30)]
    return words


@pytest.mark.parametrize("letters", [1, 2, 3, 6, 60])
def test_runs_equal_every_lag_at_every_position(letters):
    rng = random.Random(letters)
    for _ in range(60):
        words = repeating(rng, letters)
        assert periodic_runs.runs(words) == slow_runs(words)


def test_splitting_loses_no_run_and_recurses():
    # c is too rare at first; then b is, in the last piece.
    words = b"a b a c".split() * 2 + b"a".split() * 30 + [b"b"]
    codes = periodic_runs._coded(words)
    assert list(periodic_runs.segments(codes)) == [(8, 38)]
    assert periodic_runs.runs(words) == [(8, 30, 1)] == slow_runs(words)


@pytest.mark.parametrize(
    ("words", "expected"),
    [
        ([b"a"] * 24, [(0, 24, 1)]),
        ([b"a"] * 23, []),
        ([b"a", b"b"] * 12, [(0, 24, 2)]),
        ([b"%d" % k for k in range(20)] * 3, [(0, 60, 20)]),
        (([b"%d" % k for k in range(20)] * 3)[:-1], []),
        ([], []),
    ],
)
def test_run_limits(words, expected):
    assert periodic_runs.runs(words) == expected


def test_long_repetitive_texts_take_little_time():
    rng = random.Random(3)
    texts = [[b"a"] * 60_000, [b"%d" % rng.randrange(2) for _ in range(60_000)], b"a b c d e f g".split() * 9_000]
    texts.append([b"%d" % rng.randrange(40) for _ in range(60_000)])
    before = time.process_time()
    counts = [len(periodic_runs.runs(words)) for words in texts]
    assert time.process_time() - before < 20
    assert counts[0] == counts[2] == 1


def test_every_row_of_periodic_runs(spark):
    rng = random.Random(8)
    found = cases.rows() + [(1000 + k, b" ".join(repeating(rng, 4)).decode()) for k in range(60)]
    found = [(i, t if t is None or len(t) < 9000 else t[:1400]) for i, t in found]
    rows = periodic_runs.periodic_runs(cases.documents(spark, found), plant=True).collect()
    assert Counter(map(tuple, rows)) == Counter(slow_row(i, t) for i, t in found)
    assert sum(r.n_runs > 0 for r in rows) > 20
    assert periodic_runs.periodic_runs(cases.empty(spark), plant=True).isEmpty()


def test_collapsed_texts(spark):
    found = [(1, "x " + "a b " * 20 + "y"), (2, "no  run\nhere"), (3, None), (4, "")]
    rows = periodic_runs.without_runs(cases.documents(spark, found)).collect()
    assert Counter(map(tuple, rows)) == Counter([(1, "x a b y"), (2, "no  run\nhere"), (3, None), (4, "")])


# Byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def model(ranks):
    return byte_bpe.serialise(ranks)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(coder, texts):
    out = [[] for _ in texts]
    for k, ids in coder.encode(texts):
        out[k] += ids
    return out


def odd_texts():
    rng = random.Random(6)
    pools = ["abc xyz'st 12", " \t\n\r\x0b\x0c\x85\xa0 　", "éüßñ中文字日本語", "😀👍🏽‍﻿", "\x00\x1c\x1f▁Ġ", "!?.,;:--==", "<|endoftext|>"]
    made = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    return made + ["", "a" * 50_000, " " * 20_000, "\n" * 999 + "a", "<unk>" * 3, "x" * 70 + " y"]


@pytest.mark.parametrize("table", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_equal_the_reference_encoder(table):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(table))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder, texts = byte_bpe.Codec(byte_bpe.serialise(ranks), public_tokenizers.PATTERN), odd_texts()
    texts += [f"a{chr(c)}1{chr(c)}!{chr(c)} {chr(c)}b" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    ids = ids_of(coder, texts)
    assert ids == reference.encode_ordinary_batch(texts)
    assert [coder.decode(row) for row in ids] == [text.encode() for text in texts]


def test_small_memory_and_long_texts_give_the_same(model, reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 50)
    monkeypatch.setattr(byte_bpe, "REMEMBERED_CHARS", 3)
    monkeypatch.setattr(byte_bpe, "AT_ONCE", 7)
    monkeypatch.setattr(byte_bpe, "LONG", 20)
    coder, texts = byte_bpe.Codec(model, public_tokenizers.PATTERN), cases.texts() + odd_texts()[:300]
    assert ids_of(coder, texts) == reference.encode_ordinary_batch(texts)


def test_a_whole_piece_is_a_token_whatever_its_merges_give():
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"ab": 257, b"abc": 258, b"xyz": 259}
    coder = byte_bpe.Codec(byte_bpe.serialise(ranks), public_tokenizers.PATTERN)
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in ["abc", "xyz", "xyzw", "abcab", "cabc"]:
        assert ids_of(coder, [text]) == [reference.encode_ordinary(text)]


def test_tables_a_model_cannot_hold():
    every = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError):
        byte_bpe.serialise(every | {b"ab": 300})
    with pytest.raises(ValueError):
        byte_bpe.serialise({bytes([b]): b for b in range(255)})


def test_every_row_of_digests_and_the_round_trip(spark, model, reference):
    found = cases.rows()
    docs = cases.documents(spark, found)
    rows = byte_bpe.digests(docs, model, public_tokenizers.PATTERN).collect()
    ids = [reference.encode_ordinary(t or "") for _, t in found]
    expected = [(i, len(x), sha(" ".join(map(str, x))), sha(t or "")) for (i, t), x in zip(found, ids)]
    assert Counter(map(tuple, rows)) == Counter(expected)
    encoded = byte_bpe.encoded(docs, model, public_tokenizers.PATTERN)
    back = byte_bpe.decoded(encoded, model, public_tokenizers.PATTERN).collect()
    assert Counter((r.doc_id, bytes(r.data)) for r in back) == Counter((i, (t or "").encode()) for i, t in found)
    assert byte_bpe.digests(cases.empty(spark), model, public_tokenizers.PATTERN).isEmpty()


# Hard negatives


def slow_negatives(rows, k=5):
    usable = [
        (i, label, [math.floor(256 * x) for x in v])
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []

    def ranked(found):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0]))

    for at, (anchor, label, v) in enumerate(usable):
        if anchor is None or anchor % 100:
            continue
        scored = [(i, sum(a * b for a, b in zip(v, w)), own == label) for j, (i, own, w) in enumerate(usable) if j != at]
        for positive, p, _ in ranked([s for s in scored if s[2]])[:k]:
            near = [s for s in scored if not s[2] and 80 * p <= 100 * s[1] <= 100 * p]
            out += [(anchor, positive, r, n, p, s) for r, (n, s, _) in enumerate(ranked(near)[:k], 1)]
    return Counter(out)


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, uid string, score string, block string, v string"
    return spark.createDataFrame([(i, v, label, "u", "s", "b", "v") for i, label, v in rows], schema).repartition(3)


def made_vectors(rng, n, width, hot=0):
    def vector():
        return [rng.choice([-1, 1]) * rng.randrange(64) / 64 for _ in range(width)]

    common = vector()
    rows = [(k, 3 if k % 3 == 0 else rng.randrange(5), common if k < hot else vector()) for k in range(n)]
    return rows


@pytest.mark.parametrize(("block", "part"), [(7, 3), (64, 2), (8192, 1024)])
def test_negatives_equal_brute_force(spark, block, part):
    rng = random.Random(block)
    rows = made_vectors(rng, 460, 6, hot=40)
    rows += [(500, 3, [0.0] * 6), (501, 3, [0.0] * 6), (100, 3, rows[9][2]), rows[200], rows[7], (None, 3, rows[8][2])]
    rows += [(600, None, rows[1][2]), (700, 1, None), (800, 1, [1.0, None]), (900, 2, [float("nan")] * 6), (1000, 2, [float("inf")] * 6)]
    rows += [(1100, 1, []), (1200, 1, [0.5, 0.25]), (1201, 2, [0.5])]
    found = hard_negatives.hard_negatives(vectors(spark, rows), F.col("vec_id") % 100 == 0, block_rows=block, slice_anchors=part)
    assert Counter(map(tuple, found.collect())) == slow_negatives(rows)


def test_no_vectors_no_anchors_and_huge_vectors(spark):
    anchor = F.col("vec_id") % 100 == 0
    assert hard_negatives.hard_negatives(vectors(spark, []), anchor).isEmpty()
    assert hard_negatives.hard_negatives(vectors(spark, [(1, 1, [1.0]), (2, 1, [1.0])]), anchor).isEmpty()
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives.hard_negatives(vectors(spark, [(0, 1, [1e12]), (1, 1, [1e12])]), anchor).collect()


def test_the_threshold_ends_a_search_early():
    import numpy as np

    rng = np.random.default_rng(5)
    rows = rng.integers(-60, 60, (4000, 3)).astype(float)
    anchor = np.array([50.0, -30.0, 0.0])
    scores = rows @ anchor
    lists = hard_negatives.Lists(rows)

    def settled(seen, found, threshold):
        rest = np.setdiff1d(np.arange(len(rows)), seen)
        assert len(rest) == 0 or scores[rest].max() <= threshold
        kth = hard_negatives._kth(found, 5)
        return kth is not None and threshold < kth

    seen, found = lists.search(anchor, settled)
    assert len(seen) < 2000
    assert sorted(found)[-5:] == sorted(scores)[-5:]


def test_sql_of_hard_negatives(spark, tmp_path):
    rng = random.Random(12)
    rows = [r for r in made_vectors(rng, 300, 4) if r[0] is not None] + [(600, None, [1.0] * 4), (700, 1, None), (900, 2, [float("nan")] * 4)]
    table = vectors(spark, rows).select("vec_id", "embedding", "label")
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = Counter(con.execute(hard_negatives.SQL).fetchall())
    assert Counter(map(tuple, registry.op13_hard_negatives(spark, str(tmp_path)).collect())) == expected
