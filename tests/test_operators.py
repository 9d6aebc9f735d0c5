"""Merges, history, resolution, matching, audits and repairs on small frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from avmatch.operators import audit, history, match, merge, repair, resolve
from avmatch.plans import pipelines


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_merge_rules(spark):
    old = spark.createDataFrame([("a", 1, "x", 5), ("b", 1, "y", 5), ("c", 9, "z", 5)], "k string, d int, v string, n int")
    new = spark.createDataFrame([("a", 2, None, 6, 1), ("a", 2, None, 7, 2), ("c", 3, "q", 8, 3), ("d", 2, "w", None, 4), (None, 2, "u", 1, 5)], "k string, d int, v string, n int, seq int")
    out = merge.merge_latest(old, new, ["k"], ["seq"], fill=["v"], newer="d")
    assert rows(out, "k", "v", "n", "action") == sorted([("a", "x", 7, "updated"), ("b", "y", 5, "kept"), ("c", "z", 5, "skipped"), ("d", "w", None, "inserted"), (None, "u", 1, "inserted")], key=str)
    again = merge.merge_latest(out.drop("action"), new, ["k"], ["seq"], fill=["v"], newer="d")
    assert rows(again, "k", "d", "v", "n") == rows(out, "k", "d", "v", "n")


def test_insert_absent_and_raw(spark):
    held = spark.createDataFrame([("a", None)], "k string, u string")
    batch = spark.createDataFrame([("a", None, 1), ("b", None, 2), ("b", None, 3)], "k string, u string, seq int")
    assert rows(merge.insert_absent(held, batch, ["k", "u"], ["seq"]), "k", "seq") == [("b", 2)]
    raw = merge.append_raw(spark.createDataFrame([], "k string, raw_hash string"), batch, ["k"], ["seq"], ["u"])
    assert rows(raw, "k", "raw") == [("a", "{}"), ("b", "{}")]
    assert rows(merge.duplicate_keys(batch, ["k"]), "k", "n") == [("b", 2)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "k string, v string, seq int")
    assert merge.merge_latest(none.drop("seq"), none, ["k"], ["seq"]).count() == 0
    assert history.changes(none, "k", ["seq"], ["v"], "seq").count() == 0


def test_feed_history(spark):
    schema = "url string, date string, feed int, position int, price int, status string, location string, description string, airframe_time int"
    events = [("u", "d1", 0, 0, 10, "A", "X", None, None), ("u", "d2", 0, 0, 0, "A", "Y", None, None), ("u", "d2", 1, 0, 0, None, "Z", "text", 5), ("u", "d3", 0, 0, 12, "B", "Q", None, None), ("v", "d1", 1, 0, 1, None, "L", "t", 1)]
    out = history.feed_changes(spark.createDataFrame(events, schema))
    assert rows(out, "field", "old_value", "new_value", "change_date") == [
        ("airframe_time", None, "5", "d2"),
        ("description", None, "text", "d2"),
        ("location", "Y", "Z", "d2"),
        ("price", "10", None, "d2"),
        ("price", None, "12", "d3"),
        ("status", "A", "B", "d3"),
    ]


def test_resolution(spark):
    entities = spark.createDataFrame([(1, "S1", "N1"), (2, "S2", "N2"), (3, "S1", "")], "entity_id int, serial string, registration string")
    records = spark.createDataFrame([(1, "S1", "N2"), (2, None, "N2"), (3, "S9", "N9"), (4, "S8", "N9"), (5, "", "")], "seq int, serial string, registration string")
    found = resolve.lookup(records, entities)
    assert rows(found, "seq", "entity_id", "matched_by") == [(1, 1, "serial"), (2, 2, "registration"), (3, None, None), (4, None, None), (5, None, None)]
    new = resolve.new_keys(found.where("entity_id is null"), "seq")
    assert rows(new, "seq", "entity_key") == [(3, "S9"), (4, "S9")]


#: (fleet registration, fleet serial, registry N-number, registry serial): hand-made pairs of one registrant.
PAIRS = [("N12VP", "FL-1172", "12VP", "FL-1172"), ("N213EF", "IV-1283", "213EF", "1283"), ("n-7 cd", "00542", "7CD", "542"), ("N33HG", "", "33HG", "4698200"), ("N5", "A", "6", "A")]


@pytest.mark.parametrize(("serial", "want"), [(False, 4), (True, 3)])
def test_registry_match(spark, serial, want):
    fleet = spark.createDataFrame([(n, p[0], p[1]) for n, p in enumerate(PAIRS)], "id int, registration string, serial string")
    registry = spark.createDataFrame([(p[2], p[3], "Trust LLC", "2026-01-23", n) for n, p in enumerate(PAIRS)], "n_number string, serial string, registrant string, date string, seq int")
    report = pipelines.match_report(fleet, registry, serial, " trust llc")
    assert report["list"].count() == want
    assert report["stats"].first()["aircraft"] == want


def test_match_plan_has_no_nested_loop(spark):
    fleet = spark.createDataFrame([(1, "N1", "1")], "id int, registration string, serial string")
    registry = spark.createDataFrame([("1", "1", "x", "d", 1)], "n_number string, serial string, registrant string, date string, seq int")
    plan = match.registry_match(fleet, registry, True)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_audit(spark):
    schema = "n_number string, serial string, registrant string, seq int"
    stored = spark.createDataFrame([("1", "A", "x", 1), ("1", "B", "y", 2), ("", "C", "z", 3)], schema)
    master = spark.createDataFrame([("1", "Q", "x ", 1), ("", "C", "w", 2), ("8", "R", "v", 3)], schema)
    matched = audit.fallback_match(master, stored, "seq")
    assert rows(matched, "seq", "match_key") == [(1, "n_number"), (2, "serial"), (3, None)]
    assert rows(audit.field_audit(matched, ["registrant", "serial"]), "seq", "mismatched") == [(1, ["serial"]), (2, ["registrant"])]
    assert audit.audit_summary(matched, ["registrant", "serial"]).first().asDict() == {"processed": 3, "missing": 1, "matched": 2, "mismatched_rows": 2, "mismatched_fields": 2}


def test_reconcile(spark):
    master = spark.createDataFrame([("A", "x"), ("A", "w"), ("B", "y"), ("", "q")], "serial string, registrant string")
    stored = spark.createDataFrame([("A", "x"), ("C", "z"), ("B", "Y")], "serial string, registrant string")
    found = audit.reconcile(master, stored)
    assert rows(found, "serial", "side", "names", "name_ok") == sorted([("A", "common", "w; x", True), ("B", "common", "y", False), ("C", "extra", None, None)], key=str)
    assert audit.reconcile_summary(found).first()["name_mismatch"] == 1
    assert rows(audit.capped(found, "side", ["serial"], 1), "serial") == [("A",), ("C",)]


def test_reconcile_a_serial_of_many_names(spark, monkeypatch):
    """Names beyond those that show aren't held, but the stored name is looked for among all."""
    monkeypatch.setattr(audit, "SHOWN", 20)
    master = spark.range(3000).selectExpr("'S' as serial", "concat('name', lpad(id, 5, '0')) as registrant").union(spark.createDataFrame([("T", None), ("T", " a ")], "serial string, registrant string"))
    stored = spark.createDataFrame([("S", "name02999"), ("T", "b"), ("U", "c")], "serial string, registrant string")
    assert rows(audit.reconcile(master, stored), "serial", "side", "names", "name_ok") == [("S", "common", "name00000; name00001", True), ("T", "common", "a", False), ("U", "extra", None, None)]


def test_repairs(spark):
    schema = "seq int, n_number string, serial string, code string, registrant string, date string"
    stored = spark.createDataFrame([(1, "123", "N123", "c", "r", "d"), (2, "5", "ok", "c", "r", "d"), (3, "9", "9", "c", "r", "d"), (4, "77", "77", "c", "r", "d")], schema)
    master = spark.createDataFrame([(1, "N123", "S1", "c", "r", "d"), (2, "5", "ok", "c", "r", "d"), (3, "9", "", "c", "r", "d"), (4, "42", "77", "c", "r", "d"), (5, "42", "9", "c", "r2", "d")], schema)
    assert rows(repair.serial_repairs(stored, master), "seq", "outcome") == [(1, "no_match"), (2, "already_right"), (3, "no_serial"), (4, "no_match")]
    assert rows(repair.tail_repairs(stored, master), "seq", "new_n", "outcome") == [(1, None, "no_match"), (3, "42", "fixed"), (4, "42", "conflict")]
    entities = spark.createDataFrame([(7, "S1")], "entity_id int, serial string")
    more = master.union(spark.createDataFrame([(6, "9", "S6", "c", "r3", "d"), (7, "8", "S7", " ", "r3", "d")], schema))
    filled = repair.backfill(stored, more, entities)
    assert rows(filled, "seq", "n_number", "n_conflict", "entity_id", "date") == sorted([(1, "N123", False, 7, "d"), (5, "42", False, None, "d"), (6, None, True, None, "d")], key=str)
    assert repair.backfill_summary(stored, more, filled).first().asDict() == {"processed": 7, "stored_signatures": 4, "inserted": 3, "skipped_existing": 2, "skipped_blank": 2, "n_conflicts": 1, "new_aircraft": 2}
    assert rows(repair.collision_sample(master), "seq", "key", "was", "n_number") == []


def test_fleet_table_is_idempotent(spark):
    schema = "seq int, serial_number string, registration_number string, manufacturer string, model string, manufacturer_year int, delivery_year int, category string, csv_extra string"
    batch = spark.createDataFrame([(1, "A", None, "m", "x", 2000, None, "c", "e1"), (2, "A", None, "m", "x", 2000, None, "c", "e2"), (3, None, " ", "m", "x", 1, 1, "c", "e")], schema)
    first = pipelines.fleet_table(batch)
    assert rows(first, "serial_number", "csv_extra") == [("A", "e2")]
    again = pipelines.fleet_table(batch, first.drop("csv_extra"))
    assert rows(again, "aircraft_id", "csv_extra", "action") == [(first.first()["aircraft_id"], "e2", "updated")]


def test_run_summary(spark):
    df = spark.createDataFrame([("inserted",), ("inserted",), ("kept",)], "action string")
    assert rows(pipelines.run_summary({"a": df, "b": df}), "source", "action", "n") == sorted([("a", "inserted", 2), ("b", "inserted", 2), (None, "inserted", 4), ("a", "kept", 1), ("b", "kept", 1), (None, "kept", 2)], key=str)


def test_listing_load(spark):
    feed = spark.createDataFrame([("u1", "2001 CESSNA CITATION X", "2001", "USD $5", "Here", "1,200.5", dt.date(2024, 1, 2), 0), ("u1", "2001 CESSNA CITATION X", "2001", "USD $6", "Here", None, dt.date(2024, 1, 2), 1), (" ", "x", None, None, None, None, dt.date(2024, 1, 2), 2)], "listing_url string, aircraft_model string, year string, listing_price string, listing_location string, total_time_hours string, ingestion_date date, pos int")
    listings = spark.createDataFrame([], pipelines.LISTING + ", entity_id int")
    entities = spark.createDataFrame([], "entity_id int, serial string, registration string")
    out = pipelines.load_listings(pipelines.index_events(feed, "a"), listings, entities)
    got = out["listings"].select("url", F.col("price").cast("int"), "make", "action").collect()
    assert [tuple(r) for r in got] == [("u1", 6, "CESSNA", "inserted")]
    assert rows(out["history"], "field", "new_value") == [("price", "6.00")]
