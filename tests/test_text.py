import random

import pytest
from pyspark.sql import functions as F

import model
from wordmill.functions import text as T
from wordmill.operators.counts import line_frequency, line_total, word_count
from wordmill.operators.lines import split_lines
from wordmill.sources.text import read_lines

NAMES = ["".join(chr(97 + int(d)) for d in f"{i:03d}") + "w" for i in range(200)]


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("value"))).collect()]


@pytest.mark.parametrize(
    "raw, word",
    [
        ("Hello,", "hello"),
        ("'Tis", "tis"),
        ("don't", "don't"),
        ("123", None),
        ("a1b2", "a1b"),
        ("--x--", "x"),
        ("École", "cole"),
        ("naïve", "naïve"),
        ("FINÉ", "fin"),
        ("off-", "off"),
        ("***", None),
        ("e.g.", "e.g"),
        ("fluff", "fluff"),
        ("a b", "a b"),
        ("a\x0bb", "a\x0bb"),
        (" ab\u0085", "ab"),
    ],
)
def test_cleaning(spark, raw, word):
    assert column(spark, [f"{raw} \t{raw}\f"], T.words) == [[word] * 2 if word else []]
    assert model.words(raw) == ([word] if word else [])


@pytest.mark.parametrize(
    "tokens, size, last",
    [
        (NAMES[:99] + ["123", "456", "inside", "outside"], 100, "inside"),
        (NAMES[:100] + ["outside"], 100, NAMES[99]),
        (NAMES[:98] + ["1", "2", "tail"], 99, "tail"),
        (["7"] * 99 + ["first", "second"], 1, "first"),
        ([], 0, None),
        (NAMES[:100], 100, NAMES[99]),
        (["7"] * 500, 0, None),
    ],
)
def test_token_cap(spark, tokens, size, last):
    line = " ".join(tokens)
    (kept,) = column(spark, [line], T.distinct_words)
    assert len(kept) == size and (last is None or kept[-1] == last)
    assert set(kept) == model.line_set(line)


def test_random_lines_equal_the_model(spark):
    rng = random.Random(7)
    alphabet = ["a", "B", "z", "1", "-", "é", "ß", "K", " ", "\x0b", " ", " ", "\t", "\f", "中"]
    lines = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    assert column(spark, lines, T.words) == [model.words(line) for line in lines]
    for cap in (1, 2, 5):
        kept = column(spark, lines, lambda c: T.distinct_words(c, cap))
        assert [set(k) for k in kept] == [model.line_set(line, cap) for line in lines]


def test_very_long_lines(spark):
    junk, token = "9 " * 200_000, "a" + "1" * 300_000 + "b"
    assert column(spark, [junk + "x y", token], T.distinct_words) == [["x"], [token]]
    assert column(spark, ["1" * 300_000 + "x" + "é" * 300_000], T.words) == [["x"]]


def test_lines_of_a_column(spark):
    texts = ["a\n", "a\n\n", "\n", "", None, "a\r\nb\rc\n\nd", "\n\r", "\r\n"]
    expected = [["a"], ["a", ""], [""], [], None, ["a", "b", "c", "", "d"], ["", ""], [""]]
    assert column(spark, texts, T.lines_of) == expected
    df = spark.createDataFrame([(1, "x\n\ny")], "id int, text string")
    assert [tuple(r) for r in split_lines(df, "text", ["id"]).collect()] == [
        (1, 0, "x"),
        (1, 1, ""),
        (1, 2, "y"),
    ]


def test_lines_of_a_file(spark, tmp_path):
    (tmp_path / "f.txt").write_bytes(b"\xef\xbb\xbfa\r\nb\rc\n\nd")
    lines = read_lines(spark, str(tmp_path / "f.txt"))
    assert [r.value for r in lines.collect()] == ["a", "b", "c", "", "d"]
    assert line_total(lines).first().n_lines == 5


def test_counts(spark, corpus):
    lines = ["the cat the", "The dog", "", "12 34", "x " * 150 + "end"]
    df = corpus(lines)
    assert dict(word_count(df).collect()) == {"the": 3, "cat": 1, "dog": 1, "x": 150, "end": 1}
    assert dict(line_frequency(df).collect()) == {"the": 2, "cat": 1, "dog": 1, "x": 1}
    assert line_total(df).first().n_lines == 5
    assert dict(word_count(corpus(["\n".join(lines)])).collect()) == dict(word_count(df).collect())
    empty = corpus(lines).limit(0)
    assert word_count(empty).count() == 0 and line_total(empty).first().n_lines == 0
