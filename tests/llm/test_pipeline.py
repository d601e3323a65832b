"""The pipeline on a small corpus, against its stages done by hand."""

import random
from collections import Counter

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from llm import cases
from llm.test_free import classes, reference_fingerprint
from llm.test_native import measures
from wordmill.llm import mixing, quality_rules


def prose(rng, n):
    return " ".join(rng.choice(quality_rules.STOP_WORDS[:20]) if rng.random() < 0.3 else f"w{rng.randrange(4000)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng, folder = random.Random(8), str(tmp_path_factory.mktemp("sf"))
    items = [prose(rng, 40) for _ in range(3)]
    texts = [prose(rng, rng.randint(60, 200)) for _ in range(60)]
    texts += [texts[3], texts[3].upper().lower() + "", texts[5] + " end", "too short", None, "$$$ ### &&& " * 40]
    texts += [texts[k] + " " + item + " " + texts[k + 1] for k, item in enumerate(items, 20)]
    rows = [(k, text, "en", "s0" if k % 3 else f"s{k % 5}", len(text or "")) for k, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([*enumerate(items)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, len(items)


def by_hand(rows, leaks):
    good = []
    for row in rows:
        n, chars, symbols, copies, repeated = measures(row[1])
        stop = sum(w in quality_rules.STOP_WORDS for w in (row[1] or "").split())
        bad = n < 50 or 100 * repeated > 50 * n or not 2 * n <= chars <= 20 * n
        if not bad and 100 * symbols <= 20 * n and 100 * stop >= 5 * n:
            good.append(row)
    prints = [reference_fingerprint(row[1]) for row in good]
    groups = classes(len(good), [(a, b) for a in range(len(good)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3])
    firsts = [row for k, row in enumerate(good) if groups[k] == k]
    planted = {row[0] for row in rows[-leaks:]}
    return [row for row in firsts if row[0] not in planted]


def test_every_stage_takes_effect(spark, corpus):
    folder, rows, leaks = corpus
    left = by_hand(rows, leaks)
    assert 40 < len(left) < len(rows) - leaks
    connection = duckdb.connect()
    connection.register("documents", spark.createDataFrame(left, "doc_id long, text string, lang string, source string, n_chars long").toPandas())
    expected = Counter(r[0] for r in connection.sql(mixing.SQL).fetchall())
    out = corpus_pipeline.run(spark, folder).collect()
    assert Counter(r.doc_id for r in out) == expected
    counts = Counter(r.shard for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 8


def test_stages_keep_the_columns_of_documents(spark, corpus):
    folder = corpus[0]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.limit(0)):
            out = stage(spark, table, folder)
            assert out.dtypes == docs.dtypes
            assert out.limit(0).count() == 0


def test_stages_keep_columns_named_like_their_own(spark, corpus):
    docs = cases.documents(spark, [(k, text) for k, text, *_ in corpus[1]])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus[0])
        assert out.dtypes == docs.dtypes and out.count() > 40
        assert out.exceptAll(docs.union(docs).union(docs)).isEmpty()


def test_all_queries_are_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert {name for name in __spark_entry__.oracle_sql() if name.startswith("op")} == {"op4_warc", "op6_substring_dedup", "op7_quality_rules", "op8_mixing", "op13_hard_negatives"}
