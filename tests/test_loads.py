"""Whole loads of snapshot folders into tables."""

import json

import pytest
from pyspark.sql import functions as F

from avmatch import schemas
from avmatch.plans import loads, pipelines
from avmatch.sources import tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def put(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(data if isinstance(data, str) else json.dumps(data))


def store(root, date="2024-02-01", price="$5"):
    a, b, registry, fleet, costs = (root / s for s in schemas.SOURCES)
    put(a / date / "index/listings_metadata.json", [{"listing_url": "u1", "aircraft_model": "2001 CESSNA X", "listing_price": price}, {"listing_url": " "}, {"listing_url": "u2", "aircraft_model": "1999 PIPER", "listing_price": "$7"}])
    put(a / date / "details/details_metadata.json", [{"listing_url": "u1", "serial_number": "S-1", "registration_number": "N1", "asking_price": price, "location": "Here", "engine1_make_model": "PW", "engine1_tbo": "3000 hrs", "apu": "H36"}])
    put(a / "2020-01-01" / "index/listings_metadata.json", [{"listing_url": "old"}])
    put(b / date / "manufacturers/beech/manufacturer_listings_metadata.json", [{"listing_url": "m1", "aircraft_model": "2010 BEECH KING"}])
    put(b / date / "manufacturers/cirrus/listings_metadata.json", [{"listing_url": "m2"}])
    put(b / date / "manufacturers/beech/details/details_metadata.json", [{"listing_url": "m1", "serial_number": "FL-1"}])
    files = registry / date / "extracted"
    put(files / "ACFTREF.txt", "CODE,MFR,MODEL,NO-ENG,\nA1,BEECH,KING AIR,2,\n,NONE,X,1,\n")
    put(files / "MASTER.txt", "N-NUMBER,SERIAL NUMBER,MFR MDL CODE,YEAR MFR,NAME,CITY,STATE,STATUS CODE,AIR WORTH DATE,\n1,S-1,A1,2001,ANN,Here,WA,V,20010203,\n2,S-2,B2,x,BOB,,,R,,\n,,,,C,,,,,\n")
    put(files / "DEALER.txt", "CERTIFICATE-NUMBER,OWNERSHIP,CERTIFICATE-DATE,NAME,OTHER-NAMES-1,OTHER-NAMES-3\nD1,2,20200101,Dee,One,Three\n")
    put(files / "DEREG.txt", 'N-NUMBER,SERIAL-NUMBER,CITY-MAIL,CANCEL-DATE,"KIT MFR, KIT MODEL"\n9,S-9,Town,20190101,"VANS, RV-7"\n8,S-9,Late,,\n7,,,,\n')
    put(files / "ENGINE.txt", "CODE,MFR,MODEL,HORSEPOWER\nE1,PW,PT6,850\n")
    put(files / "DOCINDEX.txt", "TYPE-COLLATERAL,PARTY,SERIAL-ID,DRDATE\n1,P,S-1,20240101\n")
    put(files / "RESERVED.txt", "N-NUMBER,REGISTRANT,RSV DATE\n77,Rex,20240105\n")
    put(registry / date / "ardata.pdf", "pdf")
    put(registry / date / "extracted" / "copy.pdf", "pdf")
    put(fleet / "aircraft.csv", "Serial Number,Registration Number,Make,Model,Category\nS-2,1,PIPER,CUB,Prop\nS-5,N55,CESSNA,X,Jet\n,,,,\n")
    put(fleet / "recent_sales.csv", 'Serial Number,Date Sold,Sold Price\nS-5,1/5/2024,"$5,000"\nS-5,1/5/2024,$9\nS-7,soon,$9\n')
    put(costs / date / "aircraft_details.json", {"data": [{"aircraftDetailId": 1, "name": "x"}, {"name": "none"}]})


def table(spark, root, name, date=None):
    return loads.Tables(spark, str(root))._table(name, date).read()


def test_load_all(spark, tmp_path):
    raw, root = tmp_path / "raw", tmp_path / "tables"
    store(raw)
    dry = loads.load_all(spark, str(raw), str(root), only="aviacost", dry_run=True)
    assert rows(dry.where("file is not null"), "file", "action", "n") == [("details", "inserted", 1), ("details", "skipped", 1)] and not root.exists()
    done = {(r["source"], r["file"], r["action"]): r["n"] for r in loads.load_all(spark, str(raw), str(root)).collect()}
    assert done[("controller", "listings", "inserted")] == 2 and done[("controller", "index", "skipped")] == 1
    assert done[("faa", "master", "inserted")] == 2 and done[("faa", "master", "skipped")] == 1
    assert done[("faa", "deregistered", "inserted")] == 1 and done[("faa", "deregistered", "skipped")] == 2
    assert done[("faa", "documents", "inserted")] == 1 and done[("internaldb", "sales", "inserted")] == 1 and done[("internaldb", "sales", "skipped")] == 2
    assert done[("internaldb", "aircraft", "updated")] == 1 and done[("internaldb", "aircraft", "inserted")] == 1 and done[("aviacost", "details", "skipped")] == 1
    assert done[(None, None, "inserted")] == sum(n for (s, f, a), n in done.items() if f and s != "aircraft" and a == "inserted")
    # One aircraft per serial: found by the marketplace, filled by the registry; its tail can't go to another.
    planes = {r["serial"]: r for r in table(spark, root, "aircraft").collect()}
    assert set(planes) == {"S-1", "S-2", "S-5", "FL-1"}
    assert (planes["S-1"]["registration"], planes["S-1"]["make"], planes["S-1"]["model"], str(planes["S-1"]["air_worth_date"])) == ("1", "BEECH", "KING AIR", "2001-02-03")
    assert (planes["S-2"]["make"], planes["S-2"]["category"], planes["S-2"]["registration"], planes["S-5"]["registration"]) == ("PIPER", "Prop", "2", "N55")
    listings = {r["url"]: r for r in table(spark, root, "listings").collect()}
    assert set(listings) == {"u1", "u2", "m1", "m2"} and listings["u1"]["entity_id"] == planes["S-1"]["entity_id"] and listings["m1"]["make"] == "BEECH"
    assert rows(table(spark, root, "registrations", "2024-02-01"), "n_number", "model", "entity_id") == [("1", "KING AIR", planes["S-1"]["entity_id"]), ("2", None, planes["S-2"]["entity_id"])]
    assert rows(table(spark, root, "engines", "2024-02-01"), "listing_url", "position", "tbo_hours") == [("u1", 1, 3000)]
    assert rows(table(spark, root, "dealers", "2024-02-01"), "ownership", F.col("certificate_date").cast("string"), "other_names") == [(2, "2020-01-01", ["One", "Three"])]
    assert rows(table(spark, root, "deregistered", "2024-02-01"), "n_number", "city_mail", "kit_mfr", "kit_model") == [("9", "Town", "VANS", "RV-7")]
    assert rows(table(spark, root, "sales"), "serial_number", "entity_id") == [("S-5", planes["S-5"]["entity_id"])]
    log = spark.read.schema(loads.RAW).parquet(f"{root}/raw_data")
    assert log.where("source_platform = 'controller'").count() == 4 and log.where("source_type = 'master' and raw like '%KING AIR%'").count() == 1
    # Again: nothing new, nothing logged twice, no history.
    again = {(r["source"], r["file"], r["action"]): r["n"] for s in ("controller", "faa") for r in loads.load_all(spark, str(raw), str(root), only=s).collect()}
    assert not [k for k in again if k[2] == "inserted"] and again[("faa", "documents", "skipped")] == 1
    assert spark.read.schema(loads.RAW).parquet(f"{root}/raw_data").count() == log.count()
    told = rows(table(spark, root, "listing_history", "2024-02-01"), "url", "field", "old_value", "new_value")
    assert told == [("u1", "location", None, "Here")]  # what the detail page says and the index doesn't
    # A newer snapshot with another price.
    store(raw, "2024-03-01", "$6")
    loads.load_all(spark, str(raw), str(root), only="controller")
    assert rows(table(spark, root, "listing_history", "2024-03-01"), "url", "field", "old_value", "new_value") == [*told, ("u1", "price", "5.00", "6.00")]
    assert spark.read.parquet(f"{root}/ingestion_runs").select("loaded_at").distinct().count() == 4


def test_details_carry_over_the_index(spark):
    index = spark.createDataFrame([("u1", "2001 BEECH KING AIR", None), ("u2", "1999 PIPER CUB", "1998"), ("u1", None, None)], "listing_url string, aircraft_model string, year string")
    details = spark.createDataFrame([("u1", " ", None, None, "S1"), ("u2", "1997", "CESSNA", "", "S2"), ("u3", None, None, "X", "S3")], "listing_url string, year string, manufacturer string, model string, serial_number string")
    got = pipelines.carried_over(details, index)
    assert got.columns == details.columns
    assert rows(got, *got.columns) == [("u1", "2001", "BEECH", "KING AIR", "S1"), ("u2", "1997", "CESSNA", "CUB", "S2"), ("u3", None, None, "X", "S3")]


def test_json_with_counts(spark, tmp_path):
    found = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], "site string, n int")
    counts = tables.write_counted_json(found, str(tmp_path / "out"), "site")
    assert rows(counts, "site", "records") == [("a", 2), ("b", 1)] and rows(spark.read.json(str(tmp_path / "out/counts")), "site", "records") == [("a", 2), ("b", 1)]
    assert rows(spark.read.json(str(tmp_path / "out/records")), "site", "n") == [("a", 1), ("a", 3), ("b", 2)]


def test_fleet_page_load(spark, tmp_path):
    put(tmp_path / "raw/2024-02-01/fleet_extracted.json", {"aircraft": [{"aircraft_entity_id": 5, "make_model_id": 3, "serial_number": "S", "fields": {"MFR Year": "1999", "Owner": {"text": "Ann", "href": "/o"}, "Registration": "N5 (x)", "Airframe Hours": "1,200"}}, {"serial_number": "no id"}]})
    tables = loads.Tables(spark, str(tmp_path / "t"))
    loads.load_fleet_pages(tables, str(tmp_path / "raw/2024-02-01"), "2024-02-01")
    got = table(spark, tmp_path / "t", "fleet_pages", "2024-02-01")
    assert rows(got, "entity_id", "year", "owner_url", "registration", "airframe_hours", "make_model_id") == [(5, 1999, "/o", "N5", 1200, 3)]
    assert rows(tables.summary().where("file is not null"), "file", "action", "n") == [("fleet", "inserted", 1), ("fleet", "skipped", 1)]


def test_chosen():
    a, b, registry, fleet, costs = schemas.SOURCES
    assert loads.chosen() == dict.fromkeys(schemas.SOURCES)
    assert loads.chosen({registry: 5}) == {s: 5 if s == registry else -1 for s in schemas.SOURCES}
    assert loads.chosen({registry: 5, a: 2}) == {a: 2, b: None, registry: 5, fleet: None, costs: None}
    assert loads.chosen({a: -1}) == {a: -1, b: None, registry: None, fleet: None, costs: None}
    assert loads.chosen(only=costs) == {s: None if s == costs else -1 for s in schemas.SOURCES}
    assert loads.chosen(test=True) == {s: None if s == costs else 10 for s in schemas.SOURCES}
    with pytest.raises(ValueError, match="no such source"):
        loads.chosen({"x": 1})
