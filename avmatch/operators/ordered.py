"""Helpers of operators whose rows depend on earlier ones: rows numbered in order, and what came before each.

Nothing here needs the rows of a key in one task: numbers carry the range partition that a row is in, and a running
maximum is taken within each range first, then over the ranges of a key.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: monotonically_increasing_id puts the partition above this many bits.
PART_BITS = 33


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where it is unset and all runs in one JVM, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: it must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="avmatch-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder and read back; the file goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/avmatch/rows-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(rows: DataFrame, order: Sequence[str], name: str = "_k") -> DataFrame:
    """rows, written, with a number each, from 0 up in the given order (not without gaps)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id()))


def stand_in(key: str) -> Column:
    """The key as text; where it is null or empty, a text of its own for each row that no key equals.

    So rows without a key match nothing and are spread, rather than meeting in one task.
    """
    return F.when(F.col(key).cast("string") != "", F.col(key).cast("string")).otherwise(F.concat(F.lit("\0"), F.monotonically_increasing_id()))


def with_key(rows: DataFrame, key: str, found: DataFrame, found_key: str) -> DataFrame:
    """Left join of rows to found on a text key; rows without one match nothing."""
    return rows.withColumn("_stand", stand_in(key)).join(found, F.col("_stand") == F.col(found_key), "left").drop("_stand", found_key)


def running(rows: DataFrame, key: str, values: Mapping[str, Column], later: bool = False, order: str = "_k", base: DataFrame | None = None) -> DataFrame:
    """rows with, for each of `values`, its maximum over the key's earlier rows (later: its minimum over later ones).

    Rows with an empty or null key have none. base: the same rows in a written table with the values' columns, if there is
    one, from which the ranges' ends are taken.
    """
    best, pick = (F.min, F.least) if later else (F.max, F.greatest)
    part = F.shiftright(F.col(order), PART_BITS)
    by = F.col(order).desc() if later else F.col(order)
    inner = Window.partitionBy("_stand", "_part").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("_end_key").orderBy(F.col("_of").desc() if later else F.col("_of")).rowsBetween(Window.unboundedPreceding, -1)
    some = (rows if base is None else base).where(F.col(key).cast("string") != "")
    ends = some.groupBy(F.col(key).cast("string").alias("_end_key"), part.alias("_of")).agg(*(best(v).alias(f"_end_{n}") for n, v in values.items()))
    ends = ends.select("_end_key", "_of", *(best(f"_end_{n}").over(outer).alias(f"_outer_{n}") for n in values))
    out = rows.withColumn("_stand", stand_in(key)).withColumn("_part", part)
    out = out.select("*", *(best(v).over(inner).alias(f"_inner_{n}") for n, v in values.items()))
    out = out.join(ends, (F.col("_stand") == F.col("_end_key")) & (F.col("_part") == F.col("_of")), "left")
    return out.select(*rows.columns, *(pick(f"_inner_{n}", f"_outer_{n}").alias(n) for n in values))
