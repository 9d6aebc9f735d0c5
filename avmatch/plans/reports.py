"""User-level reports and repairs: each takes DataFrames and returns DataFrames by name; the caller writes them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import audit, merge, repair
from avmatch.plans import pipelines
from avmatch.sources import html


def snapshot_rows(master: DataFrame, date: str) -> DataFrame:
    """A registry snapshot's rows as its table keeps them: N-numbers squeezed, strict numbers, compact dates; rows without
    an N-number go, and of a repeated one the last counts."""
    c = F.col
    dates = ("last_action_date", "cert_issue_date", "air_worth_date", "expiration_date")
    rows = master.withColumn("n_number", clean.squeezed_n(c("n_number"))).where(clean.not_blank(c("n_number")))
    for d in dates:
        rows = rows.withColumn(d, clean.compact_date(c(d)))
    rows = rows.withColumn("year", clean.strict_whole(c("year"), "smallint")).withColumn("registrant_type", clean.strict_whole(c("registrant_type"), "smallint"))
    return merge.pick_per_key(rows, ["n_number"], ["seq"]).drop("seq").withColumn("ingestion_date", F.lit(date).cast("date"))


def audited(rows: DataFrame, stored: DataFrame, aircraft: DataFrame | None = None, owner_only: bool = False, cap: int | None = None) -> dict[str, DataFrame]:
    """The registry audit: one row for each registry row that differs, its first `cap` by N-number, and the counts."""
    fields = audit.OWNER_FIELDS if owner_only else audit.FULL_FIELDS
    told = audit.with_entities(stored, aircraft, "aircraft_") if aircraft is not None else stored
    matched = audit.fallback_match(rows, told, "seq")
    wrong = audit.field_audit(matched, fields).where(F.size("mismatched") > 0)
    report = wrong.select("seq", "n_number", "serial", "match_key", F.array_join("mismatched", ";").alias("mismatched"), "expected_json", "stored_json")
    if cap is not None:
        report = report.orderBy("n_number", "seq").limit(cap)
    return {"report": report, "summary": audit.audit_summary(matched, fields)}


def reconciled(master: DataFrame, stored: DataFrame, cap: int | None = None) -> dict[str, DataFrame]:
    """Serials and registrant names of both sides: the stacked report and the counts."""
    found = audit.reconcile(master, stored)
    return {"report": audit.stacked(found, cap), "summary": audit.reconcile_summary(found)}


def repaired(stored: DataFrame, master: DataFrame, entities: DataFrame, any_difference: bool = False, same_code: bool = False) -> dict[str, DataFrame]:
    """All three repairs of stored registry rows, and what each did."""
    serials = repair.serial_repairs(stored, master, any_difference)
    tails = repair.tail_repairs(stored, master, same_code=same_code)
    missing = repair.backfill(stored, master, entities)
    counts = repair.outcome_counts(serials).withColumn("repair", F.lit("serial")).unionByName(repair.outcome_counts(tails).withColumn("repair", F.lit("n_number")))
    return {"serials": serials, "n_numbers": tails, "missing": missing, "outcomes": counts, "backfill": repair.backfill_summary(stored, master, missing), "collisions": repair.collision_sample(master)}


def image_report(pages: DataFrame, platforms: Sequence[str]) -> dict[str, DataFrame]:
    """pages (platform, page_id, file_name, html, url, listing, ingestion_date): the image index of each platform, one under
    the other, and its counts."""
    index = None
    for platform in platforms:
        part = pipelines.image_index(pages.where(F.col("platform") == platform), platform)
        index = part if index is None else index.unionByName(part)
    return {"index": index, "counts": pipelines.image_counts(index)}


def fleet_report(pages: DataFrame) -> dict[str, DataFrame]:
    """Fleet pages (page_id, file_name, html): records, their flat export, counts by class, and the pages without records."""
    records = html.fleet_records(pages)
    return {"records": records, "export": pipelines.fleet_export(records), "summary": html.extraction_summary(pages), "skipped": html.skipped_pages(pages)}


def quality_report(records: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, filled, total, percent) of extracted records."""
    found = audit.coverage_profile(records, columns)
    return found.withColumn("percent", F.round(100.0 * F.col("filled") / F.greatest("total", F.lit(1)), 1))


def re_extracted(pages: DataFrame, done: DataFrame, extract: Callable[[DataFrame], DataFrame], key: str = "listing_url") -> DataFrame:
    """done with the records of pages (page_id, html, and the key) that it lacks; only those pages are read again."""
    fresh = html.not_done(pages, done, key)
    new = extract(fresh).join(fresh.select("page_id", F.col(key).alias("_url")), "page_id").withColumn(key, F.col("_url")).drop("_url")
    return merge.append_absent(done, merge.widen(new, done.limit(0)), [key], ["page_id"])
