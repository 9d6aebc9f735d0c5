"""Keyed tables whose upserts rewrite only the parts that hold a batch's keys.

Rows are dealt to a fixed number of parts by a hash of their keys. A version is a manifest that names each part's folder;
an upsert merges the batch with the parts that its keys fall into, writes those anew, and commits a manifest in which
all other parts stay where they were. A manifest appears whole or not at all, under the next number or not at all: a
writer that dies leaves the old version and folders that nothing names, and of two writers at once one fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from avmatch.operators import merge

#: Parts of a new table. A part should stay near what a task writes well; see `rehash`.
PARTS = 32
#: What a merge says of a row.
ACTIONS = ("inserted", "updated", "skipped")


def described(rows: DataFrame) -> str:
    """The columns of rows, as a schema to read with."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


class KeyedTable:
    """A table of unique keys (nulls are keys too) below a folder of any store that Hadoop reads."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], parts: int = PARTS):
        self.spark, self.path, self.keys, self.parts = spark, path.rstrip("/"), list(keys), parts
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._path(f"{self.path}/{folder}")
        return [s.getPath().getName() for s in self._fs.listStatus(where)] if self._fs.exists(where) else []

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("manifests") if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """The newest manifest, or that of a version: schema, parts, folders by part, and marks of streams."""
        held = self.versions()
        if version is None and not held:
            return None
        file = self._fs.open(self._path(f"{self.path}/manifests/{held[-1] if version is None else version}.json"))
        try:
            return json.loads(bytes(file.readAllBytes()))
        finally:
            file.close()

    def _commit(self, version: int, manifest: dict) -> None:
        jvm = self.spark.sparkContext._jvm
        draft, final = self._path(f"{self.path}/drafts/{uuid.uuid4().hex}"), self._path(f"{self.path}/manifests/{version}.json")
        out = self._fs.create(draft, False)
        try:
            out.write(json.dumps(manifest).encode())
        finally:
            out.close()
        self._fs.mkdirs(final.getParent())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(final), none)  # fails where the version is there

    def read(self, schema: str | None = None, version: int | None = None, parts: Sequence[int] | None = None) -> DataFrame:
        """The newest version, or some parts of it; an empty frame of the schema where there is none."""
        held = self.manifest(version)
        if held is None and schema is None:
            raise FileNotFoundError(self.path)
        folders = [] if held is None else [f for p, f in held["folders"].items() if parts is None or int(p) in set(parts)]
        if not folders:
            return self.spark.createDataFrame([], schema if held is None else held["schema"])
        return self.spark.read.schema(held["schema"]).parquet(*(f"{self.path}/{f}" for f in folders))

    def _part(self, parts: int) -> Column:
        return F.pmod(F.xxhash64(*(F.col(k).cast("string") for k in self.keys)), F.lit(parts)).cast("int")

    def _store(self, rows: DataFrame, parts: int) -> str:
        """Write rows by part; the folder below which they are."""
        folder = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn("_part", self._part(parts)).repartition("_part")
        dealt.write.partitionBy("_part").parquet(f"{self.path}/{folder}")
        return folder

    def upsert(self, batch: DataFrame, order: Sequence[str], fill: Sequence[str] = (), newer: str | None = None, mark: Mapping[str, int] | None = None) -> dict[str, int]:
        """Merge a batch (as merge.merge_latest does) and commit; what was done to how many rows.

        The batch may have new columns: rows of other parts have nulls there. mark: a stream's name and its batch's
        number, kept in the manifest; a batch whose number is there already is not merged again.
        """
        version = (self.versions() or [0])[-1]
        held = self.manifest(version) if version else None
        marks = held["marks"] if held else {}
        if mark and all(marks.get(n, -1) >= k for n, k in mark.items()):
            return dict.fromkeys(ACTIONS, 0)
        parts = held["parts"] if held else self.parts
        # At most one number for each part.
        touched = [r[0] for r in batch.select(self._part(parts).alias("p")).distinct().collect()]
        like = batch.drop(*order)
        if not touched:  # an empty batch: only a new table gets a version, of no rows
            if held is None:
                self._commit(1, {"parts": parts, "schema": described(like), "folders": {}, "marks": dict(mark or {})})
            return dict.fromkeys(ACTIONS, 0)
        stored = merge.widen(self.read(version=version, parts=touched), like.limit(0)) if held else self.spark.createDataFrame([], like.schema)
        seen = Observation()
        merged = merge.merge_latest(stored, merge.widen(batch, stored.limit(0)), self.keys, order, fill, newer)
        merged = merged.observe(seen, *(F.count_if(F.col("action") == a).alias(a) for a in ACTIONS)).drop("action")
        folder = self._store(merged, parts)
        folders = dict(held["folders"]) if held else {}
        folders |= {str(p): f"{folder}/_part={p}" for p in touched}
        self._commit(version + 1, {"parts": parts, "schema": described(stored), "folders": folders, "marks": {**marks, **(mark or {})}})
        return {a: seen.get[a] for a in ACTIONS}

    def rehash(self, parts: int) -> None:
        """The same rows in another number of parts."""
        version = self.versions()[-1]
        held = self.manifest(version)
        folder = self._store(self.read(version=version), parts)
        names = [n for n in self._names(folder) if n.startswith("_part=")]
        self._commit(version + 1, held | {"parts": parts, "folders": {n[6:]: f"{folder}/{n}" for n in names}})

    def vacuum(self, keep: int = 1) -> None:
        """Remove all but the newest `keep` versions, and folders that none of those names. Not beside a writer: what it
        has written is named by no version yet."""
        held = self.versions()
        named = {f.split("/")[1] + "/" + f.split("/")[2] for v in held[-keep:] for f in self.manifest(v)["folders"].values()}
        for v in held[:-keep]:
            self._fs.delete(self._path(f"{self.path}/manifests/{v}.json"), False)
        for name in self._names("data"):
            inside = [n for n in self._names(f"data/{name}") if n.startswith("_part=")]
            gone = [n for n in inside if f"{name}/{n}" not in named]
            for n in gone if len(gone) < len(inside) else [""]:
                self._fs.delete(self._path(f"{self.path}/data/{name}/{n}".rstrip("/")), True)
        self._fs.delete(self._path(f"{self.path}/drafts"), True)
