"""Scans and reports of stored tables: snapshots, membership, newest rows, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avmatch.functions import clean


def newest_snapshot(rows: DataFrame, date: str) -> DataFrame:
    """Rows of the table's newest date. The date is one value, read first, so a table parted by date is read at one part."""
    newest = rows.agg(F.max(date)).first()[0]
    return rows.where(F.col(date) == F.lit(newest))


def snapshot(rows: DataFrame, date: str, day: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of one date whose keys are filled."""
    out = rows.where(F.col(date) == F.lit(day).cast(dict(rows.dtypes)[date]))
    for k in keys:
        out = out.where(clean.not_blank(F.col(k)))
    return out


def by_values(rows: DataFrame, column: str, values: Sequence, date: str, since: str | None = None) -> DataFrame:
    """Rows with one of the values, newest first, from a date on if given."""
    out = rows.where(F.col(column).isin(list(values)))
    if since is not None:
        out = out.where(F.col(date) >= F.lit(since).cast(dict(rows.dtypes)[date]))
    return out.orderBy(F.desc(date))


def json_is(column: Column, path: str, value: str | None = None) -> Column:
    """Whether a JSON attribute is missing or, if a value is given, has it."""
    found = F.get_json_object(column, path)
    return found.isNull() if value is None else found.isNull() | (found == value)


def newest(rows: DataFrame, date: str, n: int, *ties: str) -> DataFrame:
    """The report's n newest rows, ties by other columns."""
    return rows.orderBy(F.desc(date), *ties).limit(n)


def group_counts(rows: DataFrame, keys: Sequence[str], last: str | None = None, total: str | None = None) -> DataFrame:
    """(keys, n), most frequent first, with the last value of one column and the sum of another if asked. No keys: one row."""
    more = [F.max(last).alias(f"last_{last}")] if last else []
    more += [F.sum(total).alias(f"sum_{total}")] if total else []
    out = rows.groupBy(*keys).agg(F.count("*").alias("n"), *more)
    return out.orderBy(F.desc("n"), *keys)


def contents(files: DataFrame) -> DataFrame:
    """files (file_path, file_name, file_size, content) to one row per content, of the first path, with its hash."""
    rows = files.withColumn("file_hash", F.sha2("content", 256)).drop("content")
    whole = F.struct("file_path", "file_name", "file_size")
    return rows.groupBy("file_hash").agg(F.min_by(whole, "file_path").alias("f"), F.count("*").alias("copies")).select("f.*", "file_hash", "copies")


def set_sides(stored: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """(key, side) of every key of either: missing (stored only), extra (listed only) or common. One shuffle of each."""
    both = stored.select(key, F.lit(1).alias("_side")).unionByName(listed.select(key, F.lit(2).alias("_side")))
    sides = both.groupBy(key).agg(F.bit_or("_side").alias("_side"))
    return sides.select(key, F.when(F.col("_side") == 1, "missing").when(F.col("_side") == 2, "extra").otherwise("common").alias("side"))
