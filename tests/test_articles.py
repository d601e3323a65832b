import random

import model
from wordmill.sources.articles import (
    assemble_articles,
    read_articles,
    read_dump,
    read_well_formed_articles,
)

GOOD = [
    '<doc id="1" t="A">', "A", "", "Hello, World", "</doc>",
    '<doc id="2">', "x", "y", "</doc>",
    '<doc id="3">', "</doc>",
]
BAD = [
    "junk", '<doc id="1" t="A">', "A", "", "Hello, World", "</doc>", "between",
    '<doc id="2">', "x", '<doc id="3">', "y x </doc> z", "</doc>",
    '<doc id="4"></doc>', "q", "</doc>", '<doc id="5">', "unclosed",
]


def in_order(df):
    return [r.article for r in df.orderBy("file", "article_no").collect()]


def placed(spark, files, block_size, partitions=3):
    rows = [
        (name, i // block_size, i, line) for name, lines in files.items() for i, line in enumerate(lines)
    ]
    df = spark.createDataFrame(rows, "file string, block bigint, pos bigint, value string")
    return df.repartition(partitions)


def test_well_formed(spark, tmp_path):
    expected = ["A  Hello, World ", "x y ", ""]
    for end in ("\n", "\r\n"):
        file = tmp_path / f"good{len(end)}.txt"
        file.write_bytes((end.join(GOOD) + end).encode())
        assert in_order(read_articles(spark, str(file))) == expected
        fast = read_well_formed_articles(spark, str(file)).collect()
        assert sorted(r.article for r in fast) == sorted(expected)


def test_malformed(spark, tmp_path):
    (tmp_path / "bad.txt").write_text("\n".join(BAD))
    assert in_order(read_articles(spark, str(tmp_path / "bad.txt"))) == [
        "A  Hello, World ",
        "",
        "",
        "q ",
    ]


def test_files_do_not_run_into_each_other(spark, tmp_path):
    (tmp_path / "a.txt").write_text("<doc>\nx\n")
    (tmp_path / "b.txt").write_text("y\n</doc>\nz\n</doc>\n")
    assert in_order(read_articles(spark, str(tmp_path))) == ["y ", "y z "]


def test_random_dumps_equal_the_state_machine(spark):
    rng = random.Random(11)
    kinds = ["<doc id='1'>", "</doc>", "text", "", "a </doc> b", "x <doc>", "<doc></doc>", "more"]
    weights = [2, 3, 4, 1, 1, 1, 1, 3]
    files = {f"f{i:02d}": rng.choices(kinds, weights, k=rng.randrange(1, 40)) for i in range(40)}
    files["tagless"] = ["text"] * 30
    expected = [a for name in sorted(files) for a in model.articles(files[name])]
    for block_size in (1, 4, 100):
        assert in_order(assemble_articles(placed(spark, files, block_size))) == expected


def test_articles_across_many_blocks(spark):
    """Blocks without any tag, an article closed twice blocks apart, and a tail that never ends."""
    lines = ["<doc>", "a", *["b"] * 9, "</doc>", *["c"] * 7, "</doc>", "d", "<doc>", "e", "f", "g"]
    for block_size in (1, 2, 3, 5, 12):
        assert in_order(assemble_articles(placed(spark, {"f": lines}, block_size))) == model.articles(lines)


def test_a_large_file_is_read_in_blocks(spark, tmp_path):
    files = {"f": [line for i in range(300) for line in (f"<doc id='{i}'>", f"t{i}", "u", "</doc>")]}
    path = tmp_path / "f.txt"
    path.write_text("\n".join(files["f"]))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512")
    try:
        assert read_dump(spark, str(path)).select("block").distinct().count() > 5
        assert in_order(read_articles(spark, str(path))) == model.articles(files["f"])
        fast = [r.article for r in read_well_formed_articles(spark, str(path)).collect()]
        assert sorted(fast) == sorted(model.articles(files["f"]))
    finally:
        spark.conf.set(key, before)
