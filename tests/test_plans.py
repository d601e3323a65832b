"""What the plans must not lose: one scan of one column, few shuffles, no Python, no products."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import wordmill as W
from test_pmi import random_lines
from wordmill.operators import cooccurrence
from wordmill.operators.cooccurrence import count_cooccurrence, dictionary, word_sets
from wordmill.plans.pmi import pairs_from_counts, stripes_from_counts
from wordmill.sources import intermediate
from wordmill.sources.articles import assemble_articles, fragments, read_dump
from wordmill.sources.text import read_table_lines, read_texts


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table") / "t.parquet")
    rows = [(i, line, "x" * 50) for i, line in enumerate(random_lines())]
    spark.createDataFrame(rows, "id bigint, text string, other string").write.parquet(path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition", text))


def test_only_the_text_column_is_read(spark, table):
    for df in (read_table_lines(spark, table, "text"), read_texts(spark, table, "text")):
        assert re.findall(r"ReadSchema: (\S+)", plan(df)) == ["struct<text:string>"]


def test_counts_shuffle_once_after_partial_sums(spark, table):
    lines = read_table_lines(spark, table, "text")
    for df in (
        W.word_count(lines),
        W.line_frequency(lines),
        W.line_total(lines),
        W.bigram_counts(lines),
        W.bigram_marginals(lines),
        word_sets(lines, 100),
    ):
        text = plan(df)
        assert shuffles(text) == 1 and text.count("partial_") == 1


def test_bigrams_are_counted_once(spark, table):
    text = final_plan(W.bigram_relfreq_pairs(read_table_lines(spark, table, "text")))
    assert text.count("posexplode") == 1 and "ReusedExchange" in text and "Window" not in text


def test_the_rarer_word_takes_the_pairs_through_one_shuffle(corpus):
    text = plan(count_cooccurrence(corpus(random_lines())).pairs)
    between = text[text.index("Generate explode(partners") : text.index("Generate posexplode")]
    assert shuffles(between) == 1 and "Sort" in between
    after = text[: text.index("Generate explode(partners")]
    assert shuffles(after) == 0


def test_no_python_and_no_products(spark, corpus):
    df = corpus(random_lines())
    counts = count_cooccurrence(df)
    lines = df.select(
        F.left("value", F.lit(1)).alias("file"),
        F.length("value").alias("block"),
        F.xxhash64("value").alias("pos"),
        "value",
    )
    for result in (
        W.word_count(df),
        dictionary(word_sets(df, 100)),
        W.bigram_relfreq_stripes(df),
        W.bigram_grouping_sets(df),
        pairs_from_counts(counts),
        stripes_from_counts(counts),
        W.pmi_top(pairs_from_counts(counts), 5),
        assemble_articles(lines),
    ):
        assert not re.search(r"Python|Cartesian|NestedLoop", plan(result))


def test_top_k_does_not_sort_everything(corpus):
    text = plan(W.pmi_top(W.pmi_pairs(corpus(random_lines())), 5))
    assert "TakeOrderedAndProject(limit=5" in text


def tasks_with_rows(df):
    """Rows of each partition that has any."""
    sizes = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    return sorted(row["count"] for row in sizes if row["count"])


def test_a_dominating_first_word_is_shared_by_tasks(spark, corpus):
    lines = corpus([f"hub {chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)])
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        shares = W.bigram_relfreq_pairs(lines)
        assert "hashpartitioning(w1" in plan(shares) and "part" in plan(shares)
        sizes = tasks_with_rows(shares)
        assert len(sizes) > 4 and max(sizes) < 1500
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_support_prunes_pairs_whatever_the_size_of_the_dictionary(corpus):
    lines = corpus(random_lines())
    small = count_cooccurrence(lines, 5)
    large = count_cooccurrence(lines, 5, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan(small.pairs)
    assert sorted(map(tuple, small.pairs.collect())) == sorted(map(tuple, large.pairs.collect()))
    frequent = count_cooccurrence(lines, 5, broadcast_bytes=0, frequent_lines=20)
    assert sorted(map(tuple, frequent.pairs.collect())) == sorted(map(tuple, small.pairs.collect()))


def test_a_dump_is_scanned_and_shuffled_once(spark, tmp_path):
    (tmp_path / "d.txt").write_text("<doc>\nx\n</doc>\n" * 50)
    text = plan(fragments(read_dump(spark, str(tmp_path))))
    assert text.count("FileScan") == 1 and shuffles(text) == 1
    # What follows reads the kept fragments, and for the tags of a block not their text.
    rest = plan(assemble_articles(read_dump(spark, str(tmp_path))))
    assert "FileScan text" not in rest
    assert "ReadSchema: struct<file:string,block:bigint,opened:bigint,ended:bigint,closed:boolean>" in rest


def test_one_kind_of_counts_is_read_without_the_others(spark, corpus, tmp_path):
    path = str(tmp_path / "counts")
    intermediate.write_counts(count_cooccurrence(corpus(random_lines())), path)
    assert sorted(p.name for p in (tmp_path / "counts").glob("kind=*")) == ["kind=corpus", "kind=pair", "kind=word"]
    text = plan(intermediate.read_kind(spark, path, "word").select("x", "n"))
    assert re.search(r"PartitionFilters: \[[^]]*kind", text)
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<x:string,n:bigint>"]


def test_ready_maps_are_merged_whole(corpus):
    made = [W.bigram_count_stripes(corpus(random_lines()), 4) for _ in range(2)]
    text = plan(W.merge_stripes(*made, "w1"))
    after = text[: text.index("FullOuter")]
    assert "Generate" not in after and "Exchange" not in after


def test_map_tasks_count_the_pairs_of_a_bounded_number_of_words(corpus, monkeypatch):
    lines = corpus(random_lines())
    expected = sorted(map(tuple, count_cooccurrence(lines, 5).pairs.collect()))
    monkeypatch.setattr(cooccurrence, "REPEATED_WORDS", 3)
    numbers = cooccurrence.numbered(cooccurrence.supported_words(dictionary(word_sets(lines, 100)), 5))
    rows = numbers.orderBy("n", "word").collect()
    assert [r.id for r in rows] == list(range(len(rows))) and dict(numbers.dtypes)["id"] == "int"
    assert cooccurrence._first_repeated(numbers, 1) == (len(rows) - 3, True)
    assert cooccurrence._first_repeated(numbers, 10**6) == (len(rows), False)
    assert sorted(map(tuple, count_cooccurrence(lines, 5, frequent_lines=1).pairs.collect())) == expected


def test_pairs_are_counted_in_as_many_tasks_as_there_are_pairs_for(corpus, monkeypatch):
    lines = corpus(random_lines())
    expected = sorted(map(tuple, count_cooccurrence(lines, 5).pairs.collect()))
    monkeypatch.setattr(cooccurrence, "PAIRS_PER_TASK", 100)
    pairs = count_cooccurrence(lines, 5).pairs
    wide = [int(n) for n in re.findall(r"hashpartitioning\(x[^)]*?, (\d+)\)", plan(pairs))]
    assert max(wide) > 10 and sorted(map(tuple, pairs.collect())) == expected


def test_a_written_map_is_parsed_once_per_line(spark, tmp_path):
    rows = list(enumerate(random_lines()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    result = __spark_entry__.bigram_stripes_text(spark, str(tmp_path))
    after, before = plan(result).split("Generate explode", 1)
    assert "value" not in after and "from_json" in before
    shares = __spark_entry__.bigram_relfreq_pairs(spark, str(tmp_path))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, shares.collect()))


def test_shares_are_joined_without_sorting_the_bigrams(corpus):
    text = plan(W.bigram_relfreq_pairs(corpus(random_lines())))
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_merged_maps_are_made_once_for_their_shares(corpus):
    made = [W.bigram_count_stripes(corpus(random_lines()), 4) for _ in range(2)]
    text = plan(W.normalised_stripes(W.merge_stripes(*made, "w1"), "w1"))
    assert "FullOuter" not in text and "Generate" not in text


def test_partners_travel_in_two_bytes_and_rarer_ones_are_not_lost(corpus, monkeypatch):
    lines = corpus(random_lines())
    expected = sorted(map(tuple, count_cooccurrence(lines, 5).pairs.collect()))
    found = W.count_word_sets(lines)
    numbers = cooccurrence.numbered(cooccurrence.supported_words(found.words, 5))
    sets = cooccurrence.numbered_sets(found.bags, numbers, 0)
    assert dict(cooccurrence._partners(sets).dtypes)["partners"] == "array<smallint>"
    # As if only seven numbers fitted into two bytes.
    monkeypatch.setattr(cooccurrence, "SHORT_MIN", cooccurrence.SHORT_MAX - 6)
    for frequent_lines in (10**6, 60):
        pairs = count_cooccurrence(lines, 5, frequent_lines=frequent_lines).pairs
        assert sorted(map(tuple, pairs.collect())) == expected


def test_ranked_pairs_are_counted_before_the_sort(spark, tmp_path):
    rows = list(enumerate(random_lines()))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    ranked = __spark_entry__.pmi_ranked(spark, str(tmp_path))
    assert "Aggregate(keys=[x" not in plan(ranked) and "rangepartitioning" in plan(ranked)
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, __spark_entry__.pmi_pairs(spark, str(tmp_path)).collect()))


def test_partners_of_a_word_are_sorted_as_plain_numbers(corpus):
    partners = cooccurrence._partners(cooccurrence.numbered_sets(W.count_word_sets(corpus(random_lines())).bags, corpus(["a"]).selectExpr("value word", "1L n", "1 id"), 0))
    assert not partners.schema["partners"].dataType.containsNull


def test_pairs_are_mirrored_without_an_array_of_rows(corpus):
    text = plan(W.pmi_pairs(corpus(random_lines())))
    assert "explode([false,true])" in text and "named_struct" not in text[: text.index("Generate explode(partners")]
