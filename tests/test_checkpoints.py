from types import SimpleNamespace

import pytest

from wordmill.sources.checkpoints import kept_path, materialise, release, shared_folder


def fake_session(named=None, folder=None):
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getCheckpointDir=lambda: folder))


def test_the_folder_the_session_names_is_used():
    assert shared_folder(fake_session(named="hdfs:///checkpoints/")) == "hdfs:///checkpoints"
    assert shared_folder(fake_session(folder="hdfs:///set")) == "hdfs:///set"


def test_a_session_without_a_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(fake_session())


def test_kept_results_forget_how_they_were_made_until_released(spark):
    kept = materialise(spark.range(10).selectExpr("id * 2 AS twice"))
    assert kept.agg({"twice": "sum"}).first()[0] == 90
    assert "Range" not in kept._jdf.queryExecution().executedPlan().toString()
    path = kept_path(spark, "left")
    spark.range(1).write.parquet(path)
    release(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
