"""Scans, sinks, HTML jobs and streaming over small files."""

import json

import pytest
from pyspark.sql import functions as F

from avmatch import schemas
from avmatch.operators import merge
from avmatch.plans import pipelines
from avmatch.sources import html, readers, tables
from avmatch.streaming import upserts


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_latest_snapshot(spark, tmp_path):
    for name in ("2024-01-02", "2024-02-01", "old", "2024-1-9"):
        (tmp_path / name).mkdir()
    assert readers.latest_snapshot(spark, str(tmp_path)) == f"{tmp_path}/2024-02-01"
    assert readers.latest_snapshot(spark, str(tmp_path / "none")) is None


def test_json_feeds(spark, tmp_path):
    day = tmp_path / "2024-02-01"
    day.mkdir()
    (day / "a.json").write_text(json.dumps([{"listing_url": "u1", "listing_price": "$5"}, {"listing_url": "u2", "extra": 1}]))
    got = readers.json_records(spark, str(day / "a.json"), schemas.INDEX_FEED)
    assert rows(got, "pos", "listing_url", "listing_price", F.col("ingestion_date").cast("string")) == [(0, "u1", "$5", "2024-02-01"), (1, "u2", None, "2024-02-01")]
    (day / "b.json").write_text(json.dumps({"data": [{"aircraftDetailId": 1, "name": "x", "totalVariableCostPerHrsValue": 0, "calc_TotalVariableCostPerHour": 7}]}))
    (day / "c.json").write_text(json.dumps([{"aircraftDetailId": 2}]))
    (day / "d.json").write_text("{}")
    costs = readers.json_records(spark, [str(day / f"{x}.json") for x in "bcd"], schemas.COST_FEED, "data")
    stored = spark.createDataFrame([], "detail_id int, name string, manufacturer string, category string, variable_cost_per_hour double, average_price double, fuel_gallons double, cruise_kts double, updated_on timestamp, raw string")
    assert rows(pipelines.load_costs(costs, stored), "detail_id", "variable_cost_per_hour", "action") == [(1, 7.0, "inserted"), (2, None, "inserted")]


MASTER = """﻿N-NUMBER,SERIAL NUMBER,MFR MDL CODE,YEAR MFR,NAME,CITY,STATE,LAST ACTION DATE,STATUS CODE,OTHER NAMES(1),OTHER NAMES(3),"KIT MFR, KIT MODEL",
12VP  ,FL-1172 ,A1,2018,KENT CO,Here,WA,20240105,V,Ann, Bob,"VANS, RV-7",
,00174,B2,,X,,,,R,,,,
,,B2,,Y,,,,R,,,,
5,9
12VP,FL-1173,A1,2019,KENT CO,Here,WA,20240106,V,,,,
"""


def test_registry_load(spark, tmp_path):
    (tmp_path / "MASTER.txt").write_text(MASTER)
    (tmp_path / "ACFTREF.txt").write_text("CODE,MFR,MODEL,\nA1,BEECH,OLD,\nA1,BEECH,KING AIR,\n")
    master = readers.registry_csv(spark, str(tmp_path / "MASTER.txt"), schemas.MASTER, ["n_number"])
    ref = readers.registry_csv(spark, str(tmp_path / "ACFTREF.txt"), schemas.ACFTREF)
    typed = pipelines.registry_rows(master, ref)
    assert rows(typed, "n_number", "serial", "model", "year", F.col("last_action_date").cast("string"), "status", "other_names", "kit_mfr", "kit_model") == sorted(
        [
            ("12VP", "FL-1172", "KING AIR", 2018, "2024-01-05", "Active", ["Ann", "Bob"], "VANS", "RV-7"),
            ("00174", "00174", None, None, None, "Inactive", None, None, None),
            ("5", "9", None, None, None, "Inactive", None, None, None),
            ("12VP", "FL-1173", "KING AIR", 2019, "2024-01-06", "Active", None, None, None),
        ],
        key=str,
    )
    empty = typed.drop("seq").withColumn("ingestion_date", F.lit(None).cast("date")).limit(0)
    loaded = pipelines.load_registry(typed, empty, "2024-02-01")
    assert rows(loaded, "n_number", "serial", "action") == [("00174", "00174", "inserted"), ("12VP", "FL-1173", "inserted"), ("5", "9", "inserted")]
    again = pipelines.load_registry(typed, loaded.drop("action"), "2024-02-01")
    assert rows(again, *empty.columns) == rows(loaded, *empty.columns)


def test_required_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("A,B\n1,2\n")
    try:
        readers.registry_csv(spark, str(tmp_path / "x.csv"), schemas.MASTER, ["n_number"])
    except ValueError as e:
        assert "N-NUMBER" in str(e)
    else:
        raise AssertionError


def test_dynamic_csv(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Serial Number,Registration Number,Ask Price,Airframe Total Time,Date Listed,Fun Fact,Fun-Fact,9 lives\nA1,N1,\"$1,234.50\",\"1,200.25\",1/5/98,x,y,z\n,,,,,,,\n")
    got = readers.dynamic_csv(spark, str(tmp_path / "f.csv"), schemas.FLEET)
    assert rows(got.where("serial_number is not null"), "ask_price", F.col("airframe_total_time").cast("double"), F.col("date_listed").cast("string"), "csv_fun_fact", "csv_fun_fact_2", "csv_c_9_lives", "engine_program") == [("$1,234.50", 1200.25, "1998-01-05", "x", "y", "z", None)]
    assert pipelines.fleet_table(got).count() == 1


def test_sales(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Serial Number,Date Sold,Sold Price,Features,Has Damage,Engine Program Deferment Amount\nA,1/5/2024,\"$5,000\",\"x, y\",TRUE,3\nA,1/5/2024,$9,,,\n,1/5/2024,$9,,,\nB,soon,$9,,,\n")
    sales = readers.dynamic_csv(spark, str(tmp_path / "s.csv"), schemas.SALES)
    out = pipelines.load_sales(sales, spark.createDataFrame([], "serial_number string, date_sold date"), spark.createDataFrame([(4, "A")], "entity_id int, serial string"))
    assert rows(out, "serial_number", F.col("sold_price").cast("int"), "features", "has_damage", "engine_deferred", "entity_id") == [("A", 5000, ["x", "y"], True, True, 4)]


def test_versioned_table(spark, tmp_path):
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    assert table.read("k int").count() == 0
    table.write(spark.range(3).select(F.col("id").cast("int").alias("k")))
    (tmp_path / "t" / "v=9").mkdir()  # a write that died
    assert table.versions() == [1] and table.write(table.read().where("k > 0")) == 2
    assert rows(table.read(), "k") == [(1,), (2,)]


def test_streaming_upserts(spark, tmp_path):
    schema = "k string, v int, seq int"
    for n, part in enumerate([[("a", 1, 1), ("b", 1, 2)], [("a", 2, 3), ("c", 1, 4)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/p{n}")
    table = tables.VersionedTable(spark, str(tmp_path / "t"))
    for _ in range(2):
        stream = upserts.file_stream(spark, f"{tmp_path}/in/*", schema, files_per_batch=1)
        upserts.start_upserts(stream, table, "k string, v int", ["k"], ["seq"], f"{tmp_path}/cp").awaitTermination()
    assert {k for k, _ in rows(table.read(), "k", "v")} == {"a", "b", "c"}


INDEX = """<html><body>1 - 28 of 5,122 Listings
<div class="card list-listing-card-wrapper"><a href="/listing/for-sale/11/x">2001 CESSNA X</a><span class="price">USD $5</span><span class="machine-location">Here</span><a href="tel:555">call</a><a href="mailto:a@b.c">m</a><i class="premium-badge"></i></div>
<div class="list-listing-card-wrapper"><a href="/listing/for-sale/11/x">again</a></div>
<div class="list-listing-card-wrapper"><div class="listing-card-grid" data-listing-id="900"><a href="/listing/for-sale/12/y">1998 PIPER</a> Jet Aircraft Total Time: 1,234.5 Seller: Ann <b>Payments as low as USD $3,847.10* x</b></div></div></body></html>"""
FLEET = """<h3 class="inline big">King  Air</h3><input type="hidden" name="make_model" id="make_model" value="42"><table class="x detail-table"><thead><tr><th>Serial Number</th>
<th>A1 x<input class="select_aircraft" value="7"></th><th>B2<input class="select_aircraft" value="8"></th><th></th></tr></thead><tbody>
<tr><th>MFR Year</th><td>1999</td><td><a href="/b">2001</a></td></tr><tr><th>For Sale</th><td><i class="fa"></i>✔</td></tr><tr><th class="th-title">Standard</th></tr><tr><th>Seats</th><td>4</td><td>5</td></tr>
<tr><th class="td-sub-title">Avionics</th></tr><tr><th>Radio</th><td></td><td>R9</td></tr></tbody></table><table class="detail-table"><thead><tr><th>x</th><th>Z</th></tr></thead></table>"""


def test_html_jobs(spark):
    pages = spark.createDataFrame([("p1", INDEX), ("p2", FLEET), ("p3", "The page: doesn't exist (404)"), ("p4", None), ("p5", "<p>")], "page_id string, html string")
    cards = html.cards(pages, "list-listing-card-wrapper", "/listing/for-sale/")
    assert rows(cards, "position", "url", "listing_id", "title", "year", "price", "location", "phone", "email", "premium") == [
        (1, "/listing/for-sale/11/x", "11", "2001 CESSNA X", 2001, "USD $5", "Here", "555", "a@b.c", True),
        (2, "/listing/for-sale/12/y", "900", "1998 PIPER", 1998, None, None, None, None, False),
    ]
    assert rows(html.pagination(pages).where("total is not null"), "first", "last", "total", "is_last") == [(1, 28, 5122, False)]
    assert rows(html.fleet_tables(pages), "column", "section", "subsection", "label", "value", "href") == sorted(
        [(1, None, None, "MFR Year", "1999", None), (2, None, None, "MFR Year", "2001", "/b"), (1, None, None, "For Sale", "true", None), (2, None, None, "For Sale", None, None)]
        + [(1, "Standard", None, "Seats", "4", None), (2, "Standard", None, "Seats", "5", None), (1, "Standard", "Avionics", "Radio", None, None), (2, "Standard", "Avionics", "Radio", "R9", None)],
        key=str,
    )
    records = html.fleet_records(pages)
    assert [r.asDict(recursive=True) for r in records.orderBy("column").drop("page_id", "column").collect()] == [
        {"make_model_id": 42, "make_model_name": "King Air", "serial_number": "A1", "aircraft_entity_id": 7, "fields": {"MFR Year": "1999", "For Sale": "true"}, "sections": {"Standard": {"": {"Seats": "4"}, "Avionics": {"Radio": None}}}},
        {"make_model_id": 42, "make_model_name": "King Air", "serial_number": "B2", "aircraft_entity_id": 8, "fields": {"MFR Year": '{"text":"2001","href":"/b"}', "For Sale": None}, "sections": {"Standard": {"": {"Seats": "5"}, "Avionics": {"Radio": "R9"}}}},
    ]
    assert rows(pipelines.fleet_export(records), "serial_number", "mfr_year", "for_sale", "owner") == [("A1", "1999", "Yes", ""), ("B2", "2001 (/b)", "", "")]
    assert len(pipelines.fleet_export(records).columns) == 19
    stored = pipelines.fleet_page_rows(records.withColumn("ingestion_date", F.lit("2024-02-01").cast("date")).withColumn("pos", F.lit(0)))
    assert rows(stored, "entity_id", "year", "for_sale") == [(7, 1999, True), (8, 2001, False)]
    named = pages.withColumn("file_name", F.concat(F.lit("make_model_3_"), "page_id")).where("html is not null")
    assert rows(html.extraction_summary(named), "class", "pages", "records") == [("data", 1, 2), ("no_table", 2, 0), ("not_found", 1, 0)]
    assert html.skipped_pages(named).count() == 3
    assert rows(html.page_classes(pages.where("html is not null")), "class", "pages") == [("data", 1), ("no_table", 2), ("not_found", 1)]
    specs = html.pairs(html.nodes(spark.createDataFrame([(1, '<div class="l">Year:</div><div class="v">1999</div><div class="l">Year</div><div class="v">2000</div><div class="l">None</div>')], "page_id int, html string")), "l", "v")
    assert specs.first()["specs"] == {"Year": "1999"}


def test_cards(spark):
    pages = spark.createDataFrame([("p1", INDEX)], "page_id string, html string")
    found = html.cards(pages, "list-listing-card-wrapper", "/listing/for-sale/").where("position = 2")
    assert rows(found, "aircraft_type", "hours", "payment") == [("Jet Aircraft", "1234.5", "USD $3,847.10")]


def test_images(spark):
    page = """<meta property="og:url" content="https://own.example/7"><meta property="og:image" content="https://x.example/a.jpg"><meta property="og:image" content="https://x.example/a2.jpg"><meta name="twitter:image" content="https://x.example/t.jpg">
<link rel="preload" as="Image" href="https://media.sandhills.com/img.axd?id=1"><link rel="preload" as="image" href="https://x.example/b.jpg"><img src="https://www.gstatic.com/i.png" srcset="https://x.example/c.jpg 1x, https://x.example/d.jpg 2x"><img src="https://x.example/e.png">
<a data-fancybox="gallery" href="https://x.example/g.jpg">g</a><a href="https://x.example/h.jpg">h</a><script>{"MediaUrl":"https://media.sandhills.com/img.axd?a=1\\u0026b=2"}</script>"""
    pages = spark.createDataFrame([("p", "f", page, "http://x", "7", None)], "page_id string, file_name string, html string, url string, listing string, ingestion_date date")
    x = "https://x.example/"
    found = lambda site: [(r["bucket"], r["url"].removeprefix(x)) for r in html.images(pages, site).orderBy("rank", "pos").collect()]
    assert found("aircraftexchange") == [("og", "a.jpg"), ("twitter", "t.jpg"), ("gallery", "g.jpg")]
    host = "https://media.sandhills.com/img.axd?"
    assert found("controller") == [("meta", "a.jpg"), ("meta", "t.jpg"), ("preload", f"{host}id=1"), ("embedded_json", f"{host}a=1&b=2")]
    assert found("aircraftpost") == [("meta", "a.jpg"), *(("img_tags", u) for u in ("c.jpg", "d.jpg", "e.png", "a.jpg", "a2.jpg", "t.jpg", "b.jpg", "g.jpg", "h.jpg"))]
    assert found("other") == [("all", "a.jpg"), ("all", "t.jpg"), ("all", "e.png")]
    one = pipelines.image_index(pages, "controller").first()
    assert (one["key"], one["page_url"], len(one["urls"]), one["source"]) == ("controller:7", "https://own.example/7", 4, "meta")
    listings = spark.createDataFrame([("controller", "https://h.example/listing/for-sale/7/x"), ("controller", "https://h.example/listing/for-sale/8/x")], "platform string, url string")
    index = pipelines.image_index(pages, "controller")
    assert rows(pipelines.with_images(listings, index), F.size("images")) == [(-1,), (4,)] or rows(pipelines.with_images(listings, index), F.size("images")) == [(4,), (None,)]
    assert rows(pipelines.image_counts(index), "platform", "listings", "urls") == [("controller", 1, 4)]


OLDER = """<title>2005 CESSNA XLS For Sale in Austin, Texas | Site</title><script type="application/ld+json">{"@type": "Product", "name": "2005 CESSNA XLS"}</script><h1 class="detail__title">2006 OTHER</h1>
<div class="detail-specs">Total Time: 1,234 Engine 1 Time: 567</div><span class="price-tag">Call us</span><h3>Avionics / Radios</h3><p>Garmin</p><div class="seller-box">Jet Aviation LLC 5</div>"""


def test_older_detail_pages(spark):
    from avmatch.sources import listing_pages

    plain = "<div><p>For sale now, $1,200,000.00 only. TT: 900 hours. Engine hours: 80. A set of avionics with radios and displays of all kinds is there.</p></div>"
    pages = spark.createDataFrame([(1, OLDER), (2, plain), (3, None)], "page_id int, html string")
    out = listing_pages.details_older(pages)
    assert rows(out.where("page_id = 1"), *out.columns[1:]) == [("2005 CESSNA XLS", "2005", "1234", "567", "Garmin", "Call us", "Austin, Texas", "Jet Aviation LLC")]
    two = out.where("page_id = 2").first()
    assert (two["total_time_hours"], two["engine_hours"], two["asking_price"], two["aircraft_model"]) == ("900", "80", "$1,200,000.00", None) and two["avionics_description"].startswith("For sale now")
    assert out.count() == 3


def test_model_page_layouts(spark):
    from avmatch.sources import listing_pages

    box = '<div class="aircraft-box"><h2 class="font-semibold"><a href="/details/3/y">1999 BOX</a></h2><p>Offered by: Box Co</p><a href="/details/3/y">View Details</a></div>'
    bare = '<div><h2>2010 BARE</h2><p>Offered by: Bare Co</p><a href="/details/4/z">View Details</a></div><div><h5>2011 NEXT</h5><a href="/details/5/z">View details</a></div>'
    pages = spark.createDataFrame([(1, box), (2, bare), (3, "<p>none</p>")], "page_id int, html string")
    got = rows(listing_pages.model_listings(pages, "Maker"), "page_id", "position", "url", "title", "year", "dealer", "manufacturer")
    assert got == [(1, 1, "/details/3/y", "1999 BOX", 1999, "Box Co", "Maker"), (2, 1, "/details/4/z", "2010 BARE", 2010, "Bare Co", "Maker"), (2, 2, "/details/5/z", "2011 NEXT", 2011, "Bare Co", "Maker")]


def test_page_files(spark, tmp_path):
    (tmp_path / "2024-02-01").mkdir()
    (tmp_path / "2024-02-01" / "page_0012.html").write_text("<h1>é</h1>")
    (tmp_path / "2024-02-01" / "listing_77.html").write_text("x\ny\n")
    pages = readers.html_pages(spark, str(tmp_path))
    assert rows(pages, readers.page_kind(F.col("file_name"))["kind"], readers.page_kind(F.col("file_name"))["id"]) == [("listing", "77"), ("page", "0012")]
    assert rows(readers.done_pages(spark, str(tmp_path)), "page") == [(12,)]
    assert readers.documents(spark, str(tmp_path)).count() == 2
    assert rows(readers.inventory(spark, str(tmp_path)), "kind", "files") == [("listing", 1), ("page", 1)]
    assert rows(readers.line_counts(spark, str(tmp_path / "2024-02-01")), "lines") == [(1,), (2,), (3,)]
    assert merge.duplicate_keys(pages, ["file_name"]).count() == 0


DETAIL_A = """<h1>2001 CESSNA X</h1><div class="detail__price">USD $1,250,000</div><div class="detail__specs-wrapper"><div class="detail__specs-label">Year</div><div class="detail__specs-value">2001</div>
<div class="detail__specs-label">Total Time</div><div class="detail__specs-value">1,234 SNEW</div><div class="detail__specs-label">Year</div><div class="detail__specs-value">1999</div></div>
<div class="dealer-contact__name">Ann</div><a href="tel:55">c</a><script>{"DetailViewComponent":{"Props":{"serialNumber":"S9","condition":"Used"}}}</script>"""
DETAIL_B = """<title>t</title><p class="mt-2">Price: $5</p><div class="datum"><span class="label">Total Hours</span><div class="value">1,500</div></div><ul class="list-reset"><li><span class="font-bold uppercase tracking-wide">Serial Number</span> A7</li></ul>
<div class="broker">Offered by Jet Co Salt Lake, UT <a href="tel:1">111</a><a href="#">Contact Bob Ray</a></div><div id="other">Stuff</div><div class="mt-4 leading-normal">Nice  jet</div>"""
MAKERS = """<div class="w-full my-4"><p><a href="https://x.example/aircraft-by-manufacturer/75/acj">ACJ</a></p></div><a href="/aircraft-for-sale/75/acj/297/acj320">ACJ320</a><a href="/aircraft-for-sale/75/acj/297/acj320">2</a>
<div class="w-full sm:w-1/2 lg:w-1/4 mb-4"><a href="/details/7/x">2004 ACJ</a> Offered by: Jet Co <a href="/details/7/x">View Details</a></div>"""


def test_listing_pages(spark):
    from avmatch.sources import listing_pages

    pages = spark.createDataFrame([(1, DETAIL_A), (2, DETAIL_B), (3, MAKERS), (4, None)], "page_id int, html string")
    a = listing_pages.details_a(pages)
    assert rows(a.where("page_id = 1"), "year", "total_time", "serial_number", "condition", "title", "asking_price", "seller", "phone") == [("2001", "1234", "S9", "Used", "2001 CESSNA X", "$1,250,000", "Ann", "55")]
    b = listing_pages.details_b(pages)
    assert a.count() == b.count() == 4
    assert rows(b.where("page_id = 2"), "total_time", "serial_number", "asking_price", "location", "phone", "seller", "equipment", "description") == [("1500", "A7", "$5", "Jet Co Salt Lake, UT", "111", "Bob Ray", "Stuff", "Nice jet")]
    assert rows(listing_pages.manufacturers(pages), "name", "manufacturer_id") == [("ACJ", 75)]
    assert rows(listing_pages.model_links(pages), "model_name", "model_id") == [("ACJ320", 297)]
    assert rows(listing_pages.model_listings(pages), "url", "title", "year", "dealer") == [("/details/7/x", "2004 ACJ", 2004, "Jet Co")]
    index = spark.createDataFrame([("u", "2001 X", "2001", "D")], "listing_url string, aircraft_model string, year string, dealer_name string")
    details = spark.createDataFrame([("u", None), ("w", "1990")], "listing_url string, year string")
    assert rows(listing_pages.with_index_fields(details, index), "listing_url", "year", "dealer_name") == [("u", "2001", "D"), ("w", "1990", None)]


@pytest.mark.parametrize("mark", ["", ' id="engine-2"'])
def test_dealer_page_engines_and_avionics(spark, mark):
    from avmatch.sources import listing_pages

    datum = lambda label, value: f'<div class="datum"><span class="label">{label}</span><div class="value">{value}</div></div>'
    engine = lambda k, at: f'<div class="engine"{at}>{datum("Serial Number", f"E{k}")}{datum("Hours Since New", f"{k},100")}{datum("Hours Since Overhaul", f"{k},200")}{datum("Hours Since Hot Section", f"{k},300")}</div>'
    radios = " ".join(f"radio{k}" for k in range(2000))
    html = f'''<div id="engines-section">{engine(1, "")}{engine(2, mark)}{engine(3, "")}</div><div id="avionics-section"><h3>Avionics</h3><div class="datum"><div class="value">{radios}</div></div></div>'''
    pages = spark.createDataFrame([(1, html), (2, DETAIL_B)], "page_id int, html string")
    kinds = ("serial_number", "hours_since_new", "hours_since_overhaul", "hours_since_hot_section")
    out = listing_pages.details_b(pages)
    assert rows(out, "page_id", *(f"engine2_{k}" for k in kinds)) == [(1, "E2", "2100", "2200", "2300"), (2, None, None, None, None)]
    assert rows(out, "page_id", "engine1_hours_since_new", "avionics") == [(1, "1,100", radios), (2, None, None)]
    assert rows(out, "page_id", "serial_number") == [(1, None), (2, "A7")]
