import pytest

import model
import wordmill as W
from test_pmi import random_lines

SMALL = ["a b a b c", "a 12 c", "z", ""]


def as_maps(df):
    maps = {}
    for row in df.collect():
        maps.setdefault(row.w1, {}).update(row.stripe)
    return maps


def test_hand_derived(corpus):
    df = corpus(SMALL)
    counts = {("a", "b", 2), ("a", "c", 1), ("b", "a", 1), ("b", "c", 1)}
    assert {tuple(r) for r in W.bigram_counts(df).collect()} == counts
    assert {tuple(r) for r in W.bigram_marginals(df).collect()} == {("a", 3), ("b", 2)}
    totals = {("a", None, 3), ("b", None, 2)}
    assert {tuple(r) for r in W.bigram_grouping_sets(df).collect()} == counts | totals
    shares = {(r.w1, r.w2): r.rf for r in W.bigram_relfreq_pairs(df).collect()}
    assert shares == {
        ("a", "b"): pytest.approx(0.6666667),
        ("a", "c"): pytest.approx(0.33333334),
        ("b", "a"): 0.5,
        ("b", "c"): 0.5,
    }


def test_equal_the_model(corpus):
    lines = random_lines() + ["long " * 300 + "tail"]
    pairs, totals, shares = model.bigram_rows(lines)
    df = corpus(lines)
    assert {(r.w1, r.w2): r.n for r in W.bigram_counts(df).collect()} == pairs
    assert dict(W.bigram_marginals(df).collect()) == totals
    assert {(r.w1, r.w2): r.rf for r in W.bigram_relfreq_pairs(df).collect()} == shares
    maps = as_maps(W.bigram_relfreq_stripes(df))
    assert {(a, b): v for a, m in maps.items() for b, v in m.items()} == shares
    assert all(sum(m.values()) == pytest.approx(1, abs=1e-4) for m in maps.values())


def test_long_stripes_are_spread_without_loss(corpus):
    df = corpus([f"hub {chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)])
    spread = W.bigram_relfreq_stripes(df, buckets=8)
    assert spread.where("w1 = 'hub'").count() == 8
    assert {r.part for r in W.bigram_relfreq_stripes(df).collect()} == {0}
    assert as_maps(spread) == as_maps(W.bigram_relfreq_stripes(df))


def test_one_frequent_first_word(corpus):
    lines = ["the x"] * 1000 + [f"the {w}" for w in ("aa", "bb")] + ["aa bb"]
    shares = {(r.w1, r.w2): r.rf for r in W.bigram_relfreq_pairs(corpus(lines, 6)).collect()}
    assert shares == model.bigram_rows(lines)[2]


def test_empty_corpus(corpus):
    for lines in ([""], ["one", "2 3"]):
        assert W.bigram_relfreq_pairs(corpus(lines)).count() == 0
        assert W.bigram_relfreq_stripes(corpus(lines)).count() == 0
