import json
from pathlib import Path

import pytest

import wordmill as W
from wordmill.__main__ import JOBS, main
from wordmill.sources import sinks
from wordmill.sources.checkpoints import shared_folder


def parts(path):
    return [p.read_text().splitlines() for p in sorted(Path(path).glob("part-*"))]


def written(path):
    return sorted(line for part in parts(path) for line in part)


def test_word_count_text(corpus, tmp_path):
    counts = sinks.render_counts(W.word_count(corpus(["b a b", "c"])))
    out = str(tmp_path / "out")
    sinks.write_text(counts, out)
    assert written(out) == ["a\t1", "b\t2", "c\t1"]
    sinks.write_text(counts.where("value like 'a%'"), out)  # overwrites
    assert written(out) == ["a\t1"]


def test_number_of_files_and_order(spark, tmp_path):
    rows = spark.createDataFrame([(f"{i:03d}",) for i in range(200)], "value string").repartition(5)
    expected = [f"{i:03d}" for i in range(200)]
    sinks.write_text(rows, str(tmp_path / "one"), num_partitions=1, sort=True)
    assert parts(tmp_path / "one") == [expected]
    sinks.write_text(rows, str(tmp_path / "three"), num_partitions=3, sort=True)
    files = parts(tmp_path / "three")
    assert len(files) == 3 and [line for part in files for line in part] == expected
    sinks.write_text(rows, str(tmp_path / "sorted"), sort=True)
    assert [line for part in parts(tmp_path / "sorted") for line in part] == expected
    sinks.write_text(rows, str(tmp_path / "two"), num_partitions=2)
    assert len(parts(tmp_path / "two")) == 2 and written(tmp_path / "two") == expected


def test_rendering(corpus):
    df = corpus(["a b a b c", "a 12 c"])
    pairs = {r.value for r in sinks.render_bigram_pairs(W.bigram_relfreq_pairs(df)).collect()}
    assert "(b, a)\t0.5" in pairs and len(pairs) == 4
    lines = sinks.render_stripes(W.bigram_relfreq_stripes(df), "w1").collect()
    maps = {w: json.loads(m) for w, m in (r.value.split("\t") for r in lines)}
    assert maps["b"] == {"a": 0.5, "c": 0.5}


@pytest.mark.parametrize("job", JOBS)
def test_every_job_runs_from_the_command_line(spark, tmp_path, job):
    source = tmp_path / "in.txt"
    source.write_text("<doc>\n" + "x y\n" * 12 + "x z\n" * 20 + "</doc>\n")
    out = str(tmp_path / "out")
    limits = ["--reducers", "1"]
    if job == "pmi-ranked":  # rank order leaves no choice of files
        with pytest.raises(SystemExit):
            main([job, "--input", str(source), "--output", out, *limits])
        limits = []
    main([job, "--input", str(source), "--output", out, *limits])
    first = {
        "word-count": "doc\t2",
        "pmi-pairs": "(x, y)\t32.00000, 0.94118, 12.00000, 0.35294, 12.00000, 0.35294, 1.06250, 0.02633",
        "pmi-ranked": "(x, y)\t32.00000, 0.94118, 12.00000, 0.35294, 12.00000, 0.35294, 1.06250, 0.02633",
        "bigram-pairs": "(x, y)\t0.375",
        "articles": "x y " * 12 + "x z " * 20,
    }
    lines = written(out)
    if job in first:
        assert lines[0] == first[job]
    else:
        assert lines[0].startswith('x\t{"y":0.') and '"z":0.' in lines[0]


def test_shared_folder_is_the_one_of_the_session(spark):
    folder = shared_folder(spark)
    assert shared_folder(spark) == folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or folder == named
    assert folder in spark.sparkContext.getCheckpointDir()
