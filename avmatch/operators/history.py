"""Field-level change history of dated snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def logged(x: Column) -> Column:
    """The text that history keeps: zero and empty values become null."""
    text = x.cast("string")
    return F.when((text != "") & (F.coalesce(text.try_cast("double"), F.lit(1.0)) != 0), text)


def changes(events: DataFrame, key: str, order: Sequence[str], fields: Sequence[str], date: str) -> DataFrame:
    """(key, field, old_value, new_value, change_date): one row for each field that differs from the event before.

    The first event of a key logs nothing; comparison is null-safe. One sort by key serves all fields.
    """
    line = Window.partitionBy(key).orderBy(*order)
    rows = events.withColumn("_n", F.row_number().over(line))
    for f in fields:
        rows = rows.withColumn(f"_old_{f}", F.lag(f).over(line))
    each = [F.struct(F.lit(f).alias("field"), logged(F.col(f"_old_{f}")).alias("old_value"), logged(F.col(f)).alias("new_value"), (~F.col(f).eqNullSafe(F.col(f"_old_{f}"))).alias("changed")) for f in fields]
    out = rows.where("_n > 1").select(key, F.col(date).alias("change_date"), F.explode(F.array(*each)).alias("c"))
    return out.where("c.changed").select(key, "c.field", "c.old_value", "c.new_value", "change_date")


def feed_changes(events: DataFrame, key: str = "url", only: str | None = None) -> DataFrame:
    """History of two feeds that describe one listing: index events (feed 0) and detail events (feed 1) by date, feed
    and position. Price is compared over all events, status on index events with the index event before, location on
    detail events with the event before of either feed, description and time with the detail event before. only: a flag
of the events whose changes are asked for; others are just what came before."""
    ties = [only] if only else []  # what was known stands before what is new
    line = Window.partitionBy(key).orderBy("date", "feed", "position", *ties)
    same_feed = Window.partitionBy(key, "feed").orderBy("date", "position", *ties)
    rows = events.withColumn("_n", F.row_number().over(line))
    detail = F.col("feed") == 1
    rules = {
        "price": (F.lag("price").over(line), F.lit(True)),
        "status": (F.lag("status").over(same_feed), ~detail & F.lag("feed").over(same_feed).isNotNull()),
        "location": (F.lag("location").over(line), detail),
        "description": (F.lag("description").over(same_feed), detail),
        "airframe_time": (F.lag("airframe_time").over(same_feed), detail),
    }
    for f, (old, applies) in rules.items():
        rows = rows.withColumn(f"_c_{f}", F.struct(F.lit(f).alias("field"), logged(old).alias("old_value"), logged(F.col(f)).alias("new_value"), (applies & ~F.col(f).eqNullSafe(old)).alias("changed")))
    asked = rows.where("_n > 1") if only is None else rows.where(F.col(only) & (F.col("_n") > 1))
    out = asked.select(key, F.col("date").alias("change_date"), F.explode(F.array(*(f"_c_{f}" for f in rules))).alias("c"))
    return out.where("c.changed").select(key, "c.field", "c.old_value", "c.new_value", "change_date")


def unpivot_engines(df: DataFrame, keep: Sequence[str], fields: Sequence[str], count: int = 2) -> DataFrame:
    """engine1_x, engine2_x, ... columns to rows with position; a row needs a make_model or a serial."""
    each = [F.struct(F.lit(n).alias("position"), *(F.col(f"engine{n}_{f}").alias(f) for f in fields)) for n in range(1, count + 1)]
    rows = df.select(*keep, F.explode(F.array(*each)).alias("e")).select(*keep, "e.*")
    filled = F.lit(False)
    for f in ("make_model", "serial_number"):
        filled = filled | F.coalesce(F.trim(F.col(f).cast("string")) != "", F.lit(False))
    return rows.where(filled)


def apu_rows(df: DataFrame, keep: Sequence[str], column: str = "apu") -> DataFrame:
    return df.where(F.trim(column) != "").select(*keep, F.trim(column).alias("make_model"))
