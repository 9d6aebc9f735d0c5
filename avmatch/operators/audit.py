"""Audits of stored registry rows against the registry file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators.merge import pick_per_key


def fallback_match(rows: DataFrame, stored: DataFrame, order: str) -> DataFrame:
    """rows (n_number, serial, ...) with the stored row of the same N-number, else of the same serial, as a struct
    `stored`, and match_key (n_number, serial or null). The first stored row of a key stands for it."""
    out = rows
    for k in ("n_number", "serial"):
        filled = stored.where(F.trim(k) != "")
        first = pick_per_key(filled, [k], [order], last=False).select(F.col(k).alias(f"_k_{k}"), F.struct(*stored.columns).alias(f"_{k}"))
        # Rows without the key don't take part, so they don't meet in one task.
        has = F.coalesce(F.trim(k) != "", F.lit(False))
        none = out.where(~has).withColumn(f"_{k}", F.lit(None).cast(dict(first.dtypes)[f"_{k}"]))
        out = out.where(has).join(first, F.col(k) == F.col(f"_k_{k}"), "left").drop(f"_k_{k}").unionByName(none)
    key = F.when(F.col("_n_number").isNotNull(), "n_number").when(F.col("_serial").isNotNull(), "serial")
    return out.withColumn("match_key", key).withColumn("stored", F.coalesce("_n_number", "_serial")).drop("_n_number", "_serial")


#: The fields of a registry row that are its owner's, and all that an audit compares.
OWNER_FIELDS = ("registrant", "street", "street2", "city", "state", "zip", "region", "county", "country")
FULL_FIELDS = (
    "code", "engine_code", "year", "registrant_type", *OWNER_FIELDS, "last_action_date", "cert_issue_date", "certification", "expiration_date", "air_worth_date",
    "aircraft_type", "engine_type", "status_code", "mode_s_code", "mode_s_code_hex", "fract_owner", "unique_id", "kit_mfr", "kit_model", "other_names",
)


def _comparable(x: Column, kind: str) -> Column:
    """Text trimmed, blank as null; a list as its filled items, trimmed, none as null."""
    if kind == "array<string>":
        items = F.filter(F.transform(x, lambda y: F.trim(y)), lambda y: y != "")
        return F.when(F.size(items) > 0, F.to_json(items))
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def field_audit(matched: DataFrame, fields: Sequence[str]) -> DataFrame:
    """matched rows with mismatched: names of fields that differ from `stored` (blank equals null, dates and numbers as
    such, lists item by item; a stored list may be JSON text), and both sides as JSON cut to 2000 characters."""
    kinds = {f.name: f.dataType.simpleString() for f in matched.schema}
    held = {f.name: f.dataType.simpleString() for f in matched.schema["stored"].dataType}

    def differs(f: str) -> Column:
        mine, theirs = F.col(f), F.col(f"stored.{f}")
        if kinds[f] == "array<string>" and held[f] == "string":
            return ~_comparable(mine, kinds[f]).eqNullSafe(_comparable(clean.list_from_json(theirs), kinds[f]))
        return ~_comparable(mine, kinds[f]).eqNullSafe(_comparable(theirs, held[f]))

    names = F.array_compact(F.array(*(F.when(differs(f), F.lit(f)) for f in fields)))
    out = matched.withColumn("mismatched", F.when(F.col("match_key").isNotNull(), names)).where("match_key is not null")
    expected = F.substring(F.to_json(F.struct(*fields)), 1, 2000)
    return out.withColumn("expected_json", expected).withColumn("stored_json", F.substring(F.to_json("stored"), 1, 2000))


def audit_summary(matched: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row of counts, by one pass."""
    audited = field_audit(matched.where("match_key is not null"), fields).select(F.lit(True).alias("hit"), F.size("mismatched").cast("long").alias("bad"))
    missing = matched.where("match_key is null").select(F.lit(False).alias("hit"), F.lit(0).cast("long").alias("bad"))
    return audited.unionByName(missing).agg(
        F.count("*").alias("processed"),
        F.count_if(~F.col("hit")).alias("missing"),
        F.count_if("hit").alias("matched"),
        F.count_if(F.col("bad") > 0).alias("mismatched_rows"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("mismatched_fields"),
    )


def registry_audit(rows: DataFrame, stored: DataFrame, aircraft: DataFrame | None = None, owner_only: bool = False, order: str = "seq") -> DataFrame:
    """Typed registry rows against the stored ones of their date, owner fields or all. With aircraft (entity_id, ...) its
    columns stand beside the stored row's, as aircraft_<name>."""
    if aircraft is not None:
        stored = with_entities(stored, aircraft, "aircraft_")
    return field_audit(fallback_match(rows, stored, order), OWNER_FIELDS if owner_only else FULL_FIELDS)


def with_entities(facts: DataFrame, entities: DataFrame, prefix: str = "", key: str = "entity_id") -> DataFrame:
    """facts with their entity's columns, prefixed; facts without an entity stay."""
    named = entities.select(F.col(key).alias("_key"), *(F.col(c).alias(f"{prefix}{c}") for c in entities.columns if c != key))
    some = facts.where(F.col(key).isNotNull()).join(named, F.col(key) == F.col("_key"), "left").drop("_key")
    none = facts.where(F.col(key).isNull()).select("*", *(F.lit(None).cast(t).alias(c) for c, t in named.dtypes if c != "_key"))
    return some.unionByName(none)


#: Characters that a serial's names take in a report. More names than characters can't show.
SHOWN = 4000


def reconcile(master: DataFrame, stored: DataFrame) -> DataFrame:
    """By serial: (serial, side, names, stored_name, name_ok). side: missing (not stored), extra (not in master) or
    common. names: the master's names of that serial, sorted, joined by "; ", 4000 characters. Where a stored serial
    repeats, its greatest name counts.

    However many names a serial has, no task holds more than can show; whether the stored name is one of them is asked by
    serial and name together.
    """
    pairs = master.where(F.trim("serial") != "").groupBy(F.trim("serial").alias("serial"), F.trim("registrant").alias("name")).agg(F.lit(1).alias("_one")).drop("_one")
    first = capped(pairs, "serial", ["name"], SHOWN + 1).groupBy("serial").agg(F.array_sort(F.collect_list("name")).alias("_names"))
    s = stored.where(F.trim("serial") != "").groupBy(F.trim("serial").alias("serial")).agg(F.max(F.trim("registrant")).alias("stored_name"), F.lit(True).alias("_stored"))
    hit = pairs.join(s.select(F.col("serial").alias("_s"), F.col("stored_name").alias("_n")), (F.col("serial") == F.col("_s")) & (F.col("name") == F.col("_n")), "left_semi")
    both = first.join(s, "serial", "full_outer").join(hit.select("serial", F.lit(True).alias("_hit")), "serial", "left")
    side = F.when(F.col("_stored").isNull(), "missing").when(F.col("_names").isNull(), "extra").otherwise("common")
    names = F.substring(F.array_join("_names", "; "), 1, SHOWN)
    return both.select("serial", side.alias("side"), names.alias("names"), "stored_name", F.when(side == "common", F.col("_hit").isNotNull()).alias("name_ok"))


def reconcile_summary(found: DataFrame) -> DataFrame:
    side = F.col("side")
    return found.agg(
        F.count("*").alias("serials"),
        F.count_if(side == "missing").alias("missing"),
        F.count_if(side == "extra").alias("extra"),
        F.count_if(side == "common").alias("common"),
        F.count_if(F.col("name_ok") == False).alias("name_mismatch"),  # noqa: E712
    )


def stacked(found: DataFrame, cap: int | None = None) -> DataFrame:
    """A reconciliation's report rows: missing serials, then extra ones, then names that differ; each class by serial,
    its first `cap` rows if given."""
    kind = F.when(F.col("side") != "common", F.col("side")).when(~F.col("name_ok"), "name_mismatch")
    rows = found.select(kind.alias("kind"), "serial", "names", "stored_name").where("kind is not null")
    rows = rows if cap is None else capped(rows, "kind", ["serial"], cap)
    place = F.when(F.col("kind") == "missing", 0).when(F.col("kind") == "extra", 1).otherwise(2)
    return rows.orderBy(place, "serial")


def capped(df: DataFrame, kind: str, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each class, the report's own limit: each class keeps n per salt before the last sort."""
    salted = Window.partitionBy(kind, "_salt").orderBy(*order)
    some = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(64))).withColumn("_n", F.row_number().over(salted)).where(F.col("_n") <= n)
    return some.withColumn("_n", F.row_number().over(Window.partitionBy(kind).orderBy(*order))).where(F.col("_n") <= n).drop("_n", "_salt")


def coverage_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, filled, total): one pass, then one row per field."""
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(F.trim(F.col(c).cast("string")) != "").alias(c) for c in columns))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns)))
    return counts.select(each.alias("x"), "total").select("x.field", "x.filled", "total")
