"""Counts and maps of corpora made apart, kept, and put together."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import model
import wordmill as W
from test_pmi import random_lines
from wordmill.sources import intermediate


def kept(spark, counts, path):
    intermediate.write_counts(counts, str(path))
    return intermediate.read_counts(spark, str(path))


def halves():
    lines = random_lines()
    return lines[::2], lines[1::2]


def pair_rows(pairs):
    return {(r.x, r.y): tuple(r)[2:] for r in pairs.collect()}


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_counts_made_apart_equal_counts_made_together(spark, corpus, tmp_path, broadcast_bytes):
    one, two = halves()
    parts = [kept(spark, W.count_cooccurrence(corpus(h), min_support=1), tmp_path / str(k)) for k, h in enumerate((one, two))]
    merged = W.merge_counts(parts, 5, broadcast_bytes)
    assert pair_rows(W.pairs_from_counts(merged)) == pair_rows(W.pmi_pairs(corpus(one + two), 5))
    stripes = {r.word: r.stripe for r in W.stripes_from_counts(merged).collect()}
    expected = {r.word: r.stripe for r in W.pmi_stripes(corpus(one + two), 5).collect()}
    assert stripes == expected


def test_a_merge_may_be_merged_again(spark, corpus, tmp_path):
    one, two = halves()
    counts = [W.count_cooccurrence(corpus(h), min_support=1) for h in (one[:30], one[30:], two)]
    first = W.merge_counts(counts[:2], min_support=1)
    both = W.merge_counts([kept(spark, first, tmp_path / "first"), counts[2]], 5)
    assert pair_rows(W.pairs_from_counts(both)) == pair_rows(W.pmi_pairs(corpus(one + two), 5))


def test_pruned_or_differently_capped_counts_do_not_add_up(corpus):
    lines = corpus(random_lines())
    whole = W.count_cooccurrence(lines, min_support=1)
    with pytest.raises(ValueError, match="min_support"):
        W.merge_counts([whole, W.count_cooccurrence(lines, min_support=2)])
    with pytest.raises(ValueError, match="caps"):
        W.merge_counts([whole, W.count_cooccurrence(lines, min_support=1, max_tokens=None)])


def test_nothing_and_something(corpus):
    nothing = W.count_cooccurrence(corpus([]), min_support=1)
    lines = ["a b", "a b", "c"]
    merged = W.merge_counts([nothing, W.count_cooccurrence(corpus(lines), min_support=1)], 2)
    assert pair_rows(W.pairs_from_counts(merged)) == pair_rows(W.pmi_pairs(corpus(lines), 2))
    assert W.merge_counts([nothing, nothing]).pairs.isEmpty()


def test_kept_counts_say_how_they_were_made(spark, corpus, tmp_path):
    path = str(tmp_path / "counts")
    intermediate.write_counts(W.count_cooccurrence(corpus(random_lines()), 4, max_tokens=None), path)
    counts = intermediate.read_counts(spark, path)
    assert (counts.min_support, counts.max_tokens) == (4, None)
    assert counts.total().first().n_lines == len(random_lines())
    assert intermediate.read_counts(spark, path, min_support=4, max_tokens=None).max_tokens is None
    with pytest.raises(ValueError, match="min_support=4, not 10"):
        intermediate.read_counts(spark, path, min_support=10)
    with pytest.raises(ValueError, match="max_tokens=None, not 100"):
        intermediate.read_counts(spark, path, max_tokens=100)
    with pytest.raises(TypeError, match="colour"):
        intermediate.read_counts(spark, path, colour=1)
    intermediate.read_kind(spark, path, "word").drop("kind").write.parquet(str(tmp_path / "cut" / "kind=word"))
    with pytest.raises(ValueError, match="one corpus"):
        intermediate.read_counts(spark, str(tmp_path / "cut"))


@pytest.mark.parametrize("buckets", [1, 4])
def test_maps_of_two_corpora_add_up(corpus, buckets):
    one, two = halves()
    merged = W.merge_stripes(*(W.bigram_count_stripes(corpus(h), buckets) for h in (one, two)), "w1")
    rows = merged.select("w1", F.explode("stripe").alias("w2", "n")).collect()
    counts, totals, shares = model.bigram_rows(one + two)
    assert {(r.w1, r.w2): r.n for r in rows} == counts and len(rows) == len(counts)
    normal = W.normalised_stripes(merged, "w1").select("w1", F.explode("stripe").alias("w2", "rf")).collect()
    assert {(r.w1, r.w2): r.rf for r in normal} == {pair: pytest.approx(rf) for pair, rf in shares.items()}


@pytest.mark.parametrize("buckets", [1, 4])
def test_support_is_applied_to_merged_maps(corpus, buckets):
    one, two = halves()
    merged = W.merge_stripes(*(W.pair_count_stripes(corpus(h), 1, buckets=buckets) for h in (one, two)), "word")
    rows = W.supported_stripes(merged, 5).select("word", F.explode("stripe").alias("y", "n")).collect()
    expected = {(r.x, r.y): r.n for r in W.pair_counts(corpus(one + two), 5).collect()}
    assert {(r.word, r.y): r.n for r in rows} == expected


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_word_sets_made_apart_add_up_before_any_pair_is_made(corpus, broadcast_bytes):
    one, two = halves()
    merged = W.merge_word_sets([W.count_word_sets(corpus(h)) for h in (one, two)])
    counts = W.count_pairs(merged, 5, broadcast_bytes)
    assert pair_rows(W.pairs_from_counts(counts)) == pair_rows(W.pmi_pairs(corpus(one + two), 5))
    rows = W.pair_stripes_from_counts(counts, 4).select("word", F.explode("stripe").alias("y", "n")).collect()
    assert {(r.word, r.y): r.n for r in rows} == {(r.x, r.y): r.n for r in W.pair_counts(corpus(one + two), 5).collect()}
    with pytest.raises(ValueError, match="caps"):
        W.merge_word_sets([merged, W.count_word_sets(corpus(one), max_tokens=None)])


def test_merged_queries_keep_no_pairs(spark, tmp_path, monkeypatch):
    one, two = halves()
    spark.createDataFrame(enumerate(one), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(enumerate(two), "conv_id long, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    written = []
    monkeypatch.setattr(intermediate, "write_counts", lambda counts, path: written.append(path))
    pairs = __spark_entry__.pmi_pairs_merged(spark, str(tmp_path)).select("x", "y", "n_xy").collect()
    maps = __spark_entry__.pair_stripes_merged(spark, str(tmp_path)).select("word", "partner", "n").collect()
    assert sorted(map(tuple, pairs)) == sorted(map(tuple, maps)) and pairs and not written
