"""Helpers of the training-data operators: bitmaps of ids, what workers keep, the shared folder."""

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from avmatch.llm import bitmaps, store, worker


@pytest.mark.parametrize("pieces", [1, 4096])
def test_bitmap_split(spark, monkeypatch, pieces):
    """No row of an id is ruled out, however full the bitmap; with room enough few others stay in doubt."""
    monkeypatch.setattr(bitmaps, "MOST", pieces)
    ids = spark.range(0, 60_000, 3).union(spark.createDataFrame([(None,)], "id long"))
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).union(spark.createDataFrame([(None, "n")], "doc_id long, text string"))
    maybe, rest = bitmaps.split(rows, "doc_id", ids)
    assert maybe.columns == rest.columns == ["doc_id", "text"] and maybe.count() + rest.count() == 60_001
    assert maybe.where("doc_id % 3 = 0 or doc_id is null").count() == 20_001
    if pieces > 1:
        assert maybe.count() < 20_001 + 4000


def test_bitmap_split_without_ids(spark):
    maybe, rest = bitmaps.split(spark.range(10), "id", spark.createDataFrame([], "id long"))
    assert (maybe.count(), rest.count()) == (0, 10)


def test_worker_keeps_one_table():
    made = []
    make = lambda x: lambda: made.append(x) or x
    assert [worker.kept("a", make("a")), worker.kept("a", make("a")), worker.kept("b", make("b")), worker.kept("a", make("a"))] == ["a", "a", "b", "a"]
    assert made == ["a", "b", "a"] and list(worker.bounded(iter([1, 2]), keep=True)) == [1, 2] and worker._held
    assert list(worker.bounded(iter([3]))) == [3] and not worker._held


def test_shared_folder():
    conf = {}
    session = lambda master: SimpleNamespace(sparkContext=SimpleNamespace(master=master), conf=SimpleNamespace(get=conf.get, set=conf.__setitem__))
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            store.shared_dir(session(master))
    assert store.shared_dir(session("local[4]")).startswith("file://") and conf
    conf["spark.checkpoint.dir"] = "hdfs://x/y"
    assert store.shared_dir(session("yarn")) == "hdfs://x/y"
