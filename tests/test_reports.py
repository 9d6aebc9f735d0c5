"""Reports and repairs over small frames."""

from pyspark.sql import functions as F

from avmatch import schemas
from avmatch.operators import audit
from avmatch.plans import pipelines, reports
from avmatch.sources import listing_pages


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def master(spark, *cells):
    """MASTER text rows from dicts of cells."""
    names = list(schemas.MASTER)
    return spark.createDataFrame([(k, *(c.get(n) for n in names)) for k, c in enumerate(cells)], "seq long, " + ", ".join(f"{n} string" for n in names))


def test_registry_audit(spark):
    text = master(
        spark,
        {"n_number": "1", "serial": "A", "code": "c", "registrant": "Ann", "year": "1999", "air_worth_date": "20010203", "other_name_1": "X", "other_name_2": " Y "},
        {"n_number": "9", "serial": "B", "code": "c", "registrant": "Bob", "country": "CA"},
        {"n_number": "7", "serial": "Z"},
    )
    kept = ("engine_code", "region", "county", "certification", "aircraft_type", "engine_type", "fract_owner")
    typed = pipelines.registry_rows(text, spark.createDataFrame([], "seq long, code string, manufacturer string, model string")).join(text.select("seq", *kept), "seq")
    stored = typed.withColumn("other_names", F.to_json("other_names")).withColumn("entity_id", F.concat(F.lit("e"), "seq"))
    stored = stored.where("seq < 2").withColumn("n_number", F.when(F.col("seq") == 1, "8").otherwise(F.col("n_number"))).withColumn("registrant", F.when(F.col("seq") == 1, " Rob ").otherwise(F.concat("registrant", F.lit(" "))))
    aircraft = spark.createDataFrame([("e0", "N1", "Active")], "entity_id string, registration string, status string")
    out = reports.audited(typed, stored, aircraft)
    assert rows(out["report"], "n_number", "match_key", "mismatched") == [("9", "serial", "registrant")]
    assert out["report"].first()["stored_json"].startswith('{"seq":1') and len(audit.FULL_FIELDS) == 28 and len(audit.OWNER_FIELDS) == 9
    assert out["summary"].first().asDict() == {"processed": 3, "missing": 1, "matched": 2, "mismatched_rows": 1, "mismatched_fields": 1}
    changed = typed.withColumn("other_names", F.array(F.lit("X"))).withColumn("year", F.lit(2000)).withColumn("air_worth_date", F.lit("2001-02-03").cast("date"))
    assert rows(reports.audited(changed.where("seq = 0"), stored)["report"], "mismatched") == [("year;other_names",)]
    assert reports.audited(changed.where("seq = 0"), stored, owner_only=True)["report"].count() == 0


def test_snapshot_rows(spark):
    text = master(spark, {"n_number": " n 1 ", "year": "1999", "air_worth_date": "20010203"}, {"n_number": "N1", "year": "2,000", "air_worth_date": "2001-02-03"}, {"serial": "S"})
    assert rows(reports.snapshot_rows(text, "2024-02-01"), "n_number", "year", "air_worth_date", F.col("ingestion_date").cast("string")) == [("N1", None, None, "2024-02-01")]


def test_reconciliation_and_repairs(spark):
    schema = "seq int, n_number string, serial string, code string, registrant string, date string"
    stored = spark.createDataFrame([(1, "1", "A", "c", "Ann", "d"), (2, "2", "B", "c", "Bob", "d"), (3, "5", "5", "c", "Cy", "d")], schema)
    file = spark.createDataFrame([(1, "1", "A", "c", "Ann", "d"), (2, "2", "B", "c", "Rob", "d"), (3, "77", "5", "c", "Cy", "d"), (4, "4", "D", "c", "Dee", "d")], schema)
    out = reports.reconciled(file, stored)
    assert [(r["kind"], r["serial"]) for r in out["report"].collect()] == [("missing", "D"), ("name_mismatch", "B")]
    fixed = reports.repaired(stored, file, spark.createDataFrame([("e", "D")], "entity_id string, serial string"))
    assert rows(fixed["n_numbers"], "seq", "new_n", "outcome") == [(3, "77", "fixed")]
    assert rows(fixed["missing"], "seq", "n_number", "entity_id") == [(2, None, None), (4, "4", "e")]
    assert fixed["backfill"].first()["new_aircraft"] == 1 and rows(fixed["outcomes"].where("repair = 'n_number'"), "outcome", "n") == [("fixed", 1)]


def test_quality_and_re_extraction(spark):
    page = '<div class="detail__specs-wrapper"><div class="detail__specs-label">Year</div><div class="detail__specs-value">{}</div></div>'
    pages = spark.createDataFrame([(k, f"u{k}", page.format(2000 + k)) for k in range(3)], "page_id int, listing_url string, html string")
    done = spark.createDataFrame([(0, "u0", "kept", None)], "page_id int, listing_url string, year string, title string")
    out = reports.re_extracted(pages, done, lambda p: listing_pages.details_a(p).select("page_id", "year", "title"))
    assert rows(out, "listing_url", "year") == [("u0", "kept"), ("u1", "2001"), ("u2", "2002")]
    assert rows(reports.quality_report(out, ["year", "title"]), "field", "filled", "total", "percent") == [("title", 0, 3, 0.0), ("year", 3, 3, 100.0)]


def test_image_and_fleet_reports(spark):
    page = '<meta property="og:image" content="https://x.example/a.jpg"><input name="make_model" value="3"><table class="detail-table"><thead><tr><th>s</th><th>A</th></tr></thead><tbody><tr><th>MFR Year</th><td>1999</td></tr></tbody></table>'
    pages = spark.createDataFrame([("controller", "p", "f.html", page, "http://x", "7", None), ("other", "q", "g.html", "none", "http://y", "8", None)], "platform string, page_id string, file_name string, html string, url string, listing string, ingestion_date date")
    found = reports.image_report(pages, ["controller", "other"])
    assert rows(found["counts"], "platform", "listings", "urls") == [("controller", 1, 1)] and found["index"].first()["page_url"] == "http://x"
    fleet = reports.fleet_report(pages)
    assert rows(fleet["export"], "make_model_id", "serial_number", "mfr_year") == [(3, "A", "1999")] and rows(fleet["skipped"], "file_name", "class") == [("g.html", "no_table")]
