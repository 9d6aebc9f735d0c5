"""Parquet tables with atomic versions, and report sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that a glob matches, is there."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where))


class VersionedTable:
    """A table as numbered version folders: a version counts once Spark's _SUCCESS mark is in it, so a write that dies
    leaves the table as it was, and writing again is harmless."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
        found = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit()]
        return sorted(v for v in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={v}/_SUCCESS")))

    def read(self, schema: str | None = None) -> DataFrame:
        """The newest version; an empty frame of the schema where there is none."""
        held = self.versions()
        if held:
            return self.spark.read.parquet(f"{self.path}/v={held[-1]}")
        if schema is None:
            raise FileNotFoundError(self.path)
        return self.spark.createDataFrame([], schema)

    def write(self, rows: DataFrame) -> int:
        """A new version from rows, which may read the current one."""
        version = (self.versions() or [0])[-1] + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        return version


def append_dated(rows: DataFrame, path: str, date: str = "ingestion_date") -> None:
    """Replace only the date partitions that rows have."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)


def write_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True)


def write_json_by(rows: DataFrame, path: str, key: str) -> None:
    """One JSON folder per key value."""
    rows.write.mode("overwrite").partitionBy(key).json(path)


def write_counted_json(rows: DataFrame, path: str, key: str) -> DataFrame:
    """One JSON folder per key value below records, and beside it counts: a line {key, records} for each. Returns the
    counts, which are taken of what was written."""
    write_json_by(rows, f"{path}/records", key)
    counts = rows.sparkSession.read.schema(rows.schema).json(f"{path}/records").groupBy(key).agg(F.count("*").alias("records"))
    counts.write.mode("overwrite").json(f"{path}/counts")
    return counts


def flat(rows: DataFrame) -> DataFrame:
    """Maps and arrays as JSON text, for CSV sinks."""
    return rows.select(*(F.to_json(c).alias(c) if t.startswith(("map", "array", "struct")) else F.col(c) for c, t in rows.dtypes))
