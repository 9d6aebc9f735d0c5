"""Upserts that rewrite parts, manifests, streams of pages."""

import os
import random

import pytest
from pyspark.sql import functions as F

from avmatch.sources import html
from avmatch.sources.keyed import KeyedTable
from avmatch.streaming import upserts

SCHEMA = "k string, v int, date string, seq int"


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def held(table):
    return sorted(((r["k"], r["v"]) for r in table.read().collect()), key=str)


def test_upserts_match_a_dict(spark, tmp_path):
    rng, table, want = random.Random(4), KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=5), {}
    for n in range(4):
        rows = [(rng.choice([None, *"abcdefgh"]), rng.choice([None, 1, 2, 3]), f"d{n}", k) for k in range(8)]
        counts = table.upsert(batch(spark, rows), ["seq"], fill=["v"])
        assert counts["inserted"] == len({r[0] for r in rows} - want.keys())
        for k, v, *_ in rows:
            want[k] = v if v is not None else want.get(k)
        assert held(table) == sorted(want.items(), key=str)
    assert table.versions() == [1, 2, 3, 4] and table.read(version=1).count() <= len(want)
    table.rehash(3)
    assert held(table) == sorted(want.items(), key=str) and table.manifest()["parts"] == 3
    table.upsert(batch(spark, [("a", 9, "d9", 1)]), ["seq"], newer="date")
    assert dict(held(table))["a"] == 9 and table.upsert(batch(spark, [("a", 1, "d0", 1)]), ["seq"], newer="date") == {"inserted": 0, "updated": 0, "skipped": 1}
    table.vacuum()
    assert len(table.versions()) == 1 and dict(held(table))["a"] == 9


def test_one_key_rewrites_one_part(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=8)
    table.upsert(batch(spark, [(f"k{n}", n, "d", n) for n in range(200)]), ["seq"])
    before, folders = files(tmp_path), table.manifest()["folders"]
    table.upsert(batch(spark, [("k7", -1, "d", 0)]).withColumn("extra", F.lit("x")), ["seq"])
    after = table.manifest()["folders"]
    assert len(folders) == 8 and [p for p in folders if folders[p] != after[p]] == [p for p in after if "_part=" in after[p] and after[p] not in folders.values()]
    assert sum(folders[p] != after[p] for p in folders) == 1 and len(files(tmp_path) - before) == 1
    rows = {r["k"]: r for r in table.read().collect()}
    assert len(rows) == 200 and rows["k7"]["v"] == -1 and rows["k7"]["extra"] == "x" and rows["k8"]["extra"] is None
    table.vacuum()
    assert len(files(tmp_path)) == 8 and held(table)[0] == ("k0", 0)


def test_empty_batches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=2)
    nothing = {"inserted": 0, "updated": 0, "skipped": 0}
    assert table.upsert(batch(spark, []), ["seq"]) == nothing and table.versions() == [1] and table.read().columns == ["k", "v", "date"]
    table.upsert(batch(spark, [("a", 1, "d", 0)]), ["seq"])
    assert table.upsert(batch(spark, []), ["seq"]) == nothing and table.versions() == [1, 2] and held(table) == [("a", 1)]


def test_lost_and_second_writers(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=2)
    table.upsert(batch(spark, [("a", 1, "d", 0)]), ["seq"])
    with monkeypatch.context() as m:
        m.setattr(KeyedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError, match="lost"):
            table.upsert(batch(spark, [("a", 2, "d", 0)]), ["seq"])
    assert held(table) == [("a", 1)] and table.versions() == [1]
    with pytest.raises(Exception, match="exist"):
        table._commit(1, table.manifest())
    assert held(table) == [("a", 1)]
    table.vacuum()
    assert len(files(tmp_path)) == 1


def test_a_batch_that_runs_again(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], parts=2)
    assert table.upsert(batch(spark, [("a", 1, "d", 0)]), ["seq"], mark={"feed": 3})["inserted"] == 1
    assert table.upsert(batch(spark, [("a", 2, "d", 0)]), ["seq"], mark={"feed": 3}) == {"inserted": 0, "updated": 0, "skipped": 0}
    assert held(table) == [("a", 1)] and table.read(SCHEMA).count() == 1
    with pytest.raises(FileNotFoundError):
        KeyedTable(spark, str(tmp_path / "none"), ["k"]).read()


def test_pages_are_read_once(spark, tmp_path):
    """Two runs over a growing folder: the second reads only what is new."""
    pages, table = tmp_path / "pages" / "x", KeyedTable(spark, str(tmp_path / "t"), ["page_id"], parts=3)
    pages.mkdir(parents=True)
    seen = []

    def titles(rows):
        seen.append(sorted(r[0] for r in rows.select("file_name").collect()))
        return rows.select("page_id", "changed").join(html.first_text(rows, "title"), "page_id", "left")

    def run():
        stream = upserts.page_stream(spark, str(tmp_path / "pages"))
        upserts.start_keyed_upserts(stream, table, "pages", ["changed"], str(tmp_path / "ledger"), shape=titles).awaitTermination()
        return sorted(r["text"] for r in table.read().collect())

    for n in (1, 2):
        (pages / f"{n}.html").write_text(f"<title>Page {n}</title>")
    assert run() == ["Page 1", "Page 2"]
    (pages / "3.html").write_text("<title>Page 3")
    assert run() == ["Page 1", "Page 2", "Page 3"] and run() == ["Page 1", "Page 2", "Page 3"]
    assert [f for part in seen for f in part] == ["1.html", "2.html", "3.html"]
