"""Matching an internal fleet to the registry by normalised tail and serial numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.functions import clean


def registry_match(fleet: DataFrame, registry: DataFrame, require_serial: bool = False) -> DataFrame:
    """Inner join on the canonical N-number. fleet: id, registration, serial; registry: n_number, serial, registrant,
    date, seq. With require_serial a filled fleet serial must match, too: an extra condition on an equi-join."""
    left = fleet.select("id", "registration", F.col("serial").alias("fleet_serial"), clean.canonical_n(F.col("registration")).alias("n_canon"))
    right = registry.select("n_number", F.col("serial").alias("registry_serial"), "registrant", "date", "seq", clean.canonical_n(F.col("n_number")).alias("n_canon"))
    out = left.where("n_canon is not null").join(right.where("n_canon is not null"), "n_canon")
    if require_serial:
        blank = ~clean.not_blank(F.col("fleet_serial"))
        out = out.where(blank | (clean.serial_key(F.col("fleet_serial")) == clean.serial_key(F.col("registry_serial"))))
    return out


def listed(matches: DataFrame) -> DataFrame:
    """By registration, id, then newest registry date."""
    return matches.orderBy("registration", "id", F.desc_nulls_last("date"))


def stats(matches: DataFrame) -> DataFrame:
    return matches.agg(
        F.count("*").alias("rows"),
        F.count_distinct("id").alias("aircraft"),
        F.count_distinct("registration").alias("registrations"),
        F.count_distinct("n_canon").alias("canonical_n"),
        F.count_distinct("n_number").alias("n_numbers"),
    )


def named(registry: DataFrame, name: str, exact: bool = True) -> DataFrame:
    """Registry rows of a registrant: the same name, or one that contains the text (no wildcards)."""
    if exact:
        return registry.where(F.upper(F.trim("registrant")) == name.strip().upper())
    return registry.where(F.contains(F.lower("registrant"), F.lit(name.lower())))


def coverage(fleet: DataFrame, registry: DataFrame, reference: DataFrame) -> DataFrame:
    """fleet rows (id, registration, serial, model) with three flags: a named registry row has the serial; one has it
    and its type's model contains the fleet model (an ILIKE pattern, wildcards live); the tail is registered.

    Each EXISTS is a set of distinct ids joined back, so patterns are checked only on rows that share a serial.
    """
    rows = fleet.withColumn("_s", F.trim("serial"))
    named_rows = registry.where(clean.not_blank(F.col("registrant")) & clean.not_blank(F.col("serial")))
    named_rows = named_rows.select(F.trim("serial").alias("_s"), "code").distinct()
    joined = rows.where(clean.not_blank(F.col("serial"))).select("id", "_s", "model").join(named_rows, "_s")
    with_serial = joined.select("id").distinct().withColumn("_serial", F.lit(True))
    typed = joined.join(reference.select("code", F.col("model").alias("_model")), "code")
    typed = typed.where(clean.not_blank(F.col("model")) & F.expr("_model ilike concat('%', trim(model), '%')"))
    with_model = typed.select("id").distinct().withColumn("_model_ok", F.lit(True))
    tails = registry.select(clean.plain_registration(F.col("n_number")).alias("_r")).where("_r <> ''").distinct().withColumn("_tail", F.lit(True))
    out = rows.withColumn("_r", clean.plain_registration(F.col("registration"))).join(with_serial, "id", "left").join(with_model, "id", "left").join(tails, "_r", "left")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return out.select("id", flag(F.col("_serial")).alias("serial_match"), flag(F.col("_model_ok")).alias("model_match"), flag(F.col("_tail")).alias("tail_match"))


def coverage_counts(flags: DataFrame) -> DataFrame:
    """Counts over the flags, and the share of rows with either match."""
    s, t = F.col("serial_match"), F.col("tail_match")
    return flags.agg(
        F.count("*").alias("fleet"),
        F.count_if(s).alias("by_serial"),
        F.count_if("model_match").alias("by_serial_and_model"),
        F.count_if(t).alias("by_tail"),
        F.count_if(s & t).alias("by_both"),
        F.count_if(s & ~t).alias("serial_only"),
        F.count_if(t & ~s).alias("tail_only"),
        F.count_if(s | t).alias("by_either"),
        F.count_if(~s & ~t).alias("by_none"),
        F.round(100.0 * F.count_if(s | t) / F.greatest(F.count("*"), F.lit(1)), 4).alias("either_percent"),
    )
