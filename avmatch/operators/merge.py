"""Keyed merges on DataFrames. Operators return frames; only the caller writes, so a dry run is not writing.

Per-key picks are aggregates (max_by of a struct), which combine before the shuffle, rather than sorts of a key's rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool = True, fill: Sequence[str] = ()) -> DataFrame:
    """The last (or first) row of each key by the order columns; null keys form a key of their own. Columns in `fill` have
    the key's last (or first) value that is not null."""
    whole, by = F.struct(*(F.col(c) for c in df.columns)), F.struct(*order)
    # An order of nulls only would make max_by drop the row, so rows are compared with a filled marker in front.
    by = F.struct(F.lit(1).alias("_"), by.alias("by"))
    pick = F.max_by if last else F.min_by
    more = [pick(c, F.when(F.col(c).isNotNull(), by)).alias(f"_fill_{c}") for c in fill]
    out = df.groupBy(*keys).agg(pick(whole, by).alias("_row"), *more)
    return out.select(*(F.col(f"_fill_{c}" if c in fill else f"_row.{c}").alias(c) for c in df.columns))


def merge_latest(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], fill: Sequence[str] = (), newer: str | None = None) -> DataFrame:
    """Upsert of batch into target; both have the target's columns, batch the order columns too.

    The last row per key of the batch wins, as if its rows came one by one: columns in `fill` have the last value that is
    not null, the batch's or else the old one, all others are replaced. newer: a column of which the target's value must not be greater, else the row is skipped.
    The result has a column action: inserted, updated, skipped or kept.
    """
    new = pick_per_key(batch, keys, order, fill=fill).select(*(F.col(c).alias(f"_new_{c}") for c in target.columns), F.lit(True).alias("_new"))
    old = target.withColumn("_old", F.lit(True))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_new_{k}"))
    both = old.join(new, same, "full_outer")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    late = has_old & has_new & F.coalesce(F.col(newer) > F.col(f"_new_{newer}"), F.lit(False)) if newer else F.lit(False)
    take = has_new & ~late
    columns = []
    for c in target.columns:
        value = F.coalesce(f"_new_{c}", c) if c in fill else F.col(f"_new_{c}")
        columns.append(F.when(take, value).otherwise(F.col(c)).alias(c))
    action = F.when(late, "skipped").when(has_new & has_old, "updated").when(has_new, "inserted").otherwise("kept")
    return both.select(*columns, action.alias("action"))


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows to append: the first row per key of the batch, where target lacks the key."""
    new = pick_per_key(batch, keys, order, last=False)
    held = target.select(*(F.col(k).alias(f"_held_{k}") for k in keys))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_held_{k}"))
    return new.join(held, same, "left_anti")


def append_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """target with the batch's rows of keys that it lacks, the first of each."""
    return target.unionByName(insert_absent(target, batch, keys, order).select(*target.columns))


def append_raw(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Records to append to a raw log: JSON of the payload columns, once per key and content (null-safe)."""
    rows = batch.withColumn("raw", F.to_json(F.struct(*payload))).withColumn("raw_hash", F.sha2("raw", 256))
    return insert_absent(target, rows, [*keys, "raw_hash"], order)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break uniqueness, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def widen(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of both, with the columns of both."""
    return old.unionByName(new, allowMissingColumns=True)
