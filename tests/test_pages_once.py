"""Pages are read once, their elements leave in full batches, and titles are those of their SQL."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from avmatch.operators import ordered
from avmatch.plans import pipelines
from avmatch.plans.bindings import ORACLE_SQL, QUERIES
from avmatch.plans.views import saved_pages
from avmatch.sources import html, listing_pages

SPECIAL = ["a&ampb; &amp;lt; x", "  two\n\twords\xa0", "", "&quot;q&quot; &#39; &copy; &amp", "ends\x0b", " wide "]


def test_titles_as_sql(spark, tmp_path):
    """page_titles: only the four entities that end in a semicolon; pages without a title have an empty one."""
    pages = [(k, f"u{k}", f"<html><title>{t}</title><title>x</title>") for k, t in enumerate(SPECIAL)] + [(90, "u", None), (91, "u", "<p>none</p>"), (92, "u", "<title lang='x'>other</title>")]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = QUERIES["page_titles"](spark, str(tmp_path)).collect()
    assert sorted((r["page_id"], r["title"]) for r in got) == sorted(con.execute(ORACLE_SQL["page_titles"]).fetchall())


def test_elements_leave_in_full_batches():
    """A thousand small pages are few batches; a page is cut where it has more elements than a batch."""
    ids = pa.array(range(1000), pa.int64())
    found = [(k, html.parsed(f"<p class='a' id='{k}'>x<b>y", (), None)[0]) for k in range(1000)]
    for _, rows in found:
        html.Asked("p").filled(rows, html.parsed("<p>x<b>y", (), None)[1])
    got = pa.Table.from_batches(list(html._batches(iter(found), ids)))
    assert got.num_rows == 2000 and len(got.to_batches()) == 1
    assert got.column("page_id").to_pylist()[::2] == list(range(1000)) and got.column("attrs")[0].as_py() == [("class", "a"), ("id", "0")]
    rows, page = html.parsed("<p>x" * (html.ROWS + 1), (), None)
    html.Asked().filled(rows, page)
    assert [b.num_rows for b in html._batches([(0, rows)], ids)] == [html.ROWS, 1]


def parses(spark, run, monkeypatch):
    """How often each page is parsed, counted in the tasks."""
    seen, parsed = spark.sparkContext.accumulator(0), html.parsed

    def counted(*a):
        seen.add(1)
        return parsed(*a)

    monkeypatch.setattr(html, "parsed", counted)
    pages = spark.createDataFrame([(k,) for k in range(5)], "p_partkey long").select("p_partkey", F.lit(1).alias("p_size"), *(F.lit("9").alias(c) for c in ("p_brand", "p_type", "p_name")), F.lit(1.0).alias("p_retailprice"))
    monkeypatch.setattr("avmatch.plans.views.table", lambda *a: pages)
    run(saved_pages(spark, "")).collect()
    return seen.value


#: Each query's rules. listed: (what image_index reads besides page_id and html).
RULES = {
    "dealer_cards": listing_pages.model_listings,
    "detail_pages": listing_pages.details_a,
    "dealer_pages": listing_pages.details_b,
    "older_detail_pages": listing_pages.details_older,
    "fleet_pages": html.fleet_records,
    "extraction_summary": html.extraction_summary,
    "index_cards": lambda p: html.cards(p, "list-listing-card-wrapper", "/listing/for-sale/"),
    "image_urls": lambda p: pipelines.image_index(p.withColumn("url", F.lit("")).withColumn("listing", F.col("page_id").cast("string")).withColumn("ingestion_date", F.lit("2024-02-01")), "controller"),
}


@pytest.mark.parametrize("name", sorted(RULES))
def test_pages_are_parsed_once(spark, name, monkeypatch):
    pickled = __import__("pyspark.cloudpickle", fromlist=["register_pickle_by_value"])
    pickled.register_pickle_by_value(html)
    try:
        assert parses(spark, RULES[name], monkeypatch) == 5
    finally:
        pickled.unregister_pickle_by_value(html)


def test_nested_cards_keep_their_own_class(spark):
    """A box inside a card is part of the card, and a card of its own in the other layout."""
    page = f"<div class='{listing_pages.CARD}'><a href='/details/1/a'>1990 Out</a><div class='{listing_pages.BOX}'><a href='/details/2/b'>1991 In</a></div></div>"
    rows = ordered.cut(html.card_nodes(spark.createDataFrame([(1, page)], "page_id long, html string"), (listing_pages.CARD, listing_pages.BOX)))
    assert [[r["url"] for r in html.cards_of(rows, "/details/", place=k).collect()] for k in range(2)] == [["/details/1/a"], ["/details/2/b"]]
