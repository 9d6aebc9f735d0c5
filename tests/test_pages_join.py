"""Pages are far larger than Spark guesses from the table that they are made of: no join sends them to the driver."""

import random

import pytest
from pyspark.sql import functions as F

from avmatch.plans.bindings import QUERIES
from avmatch.plans.views import saved_pages
from avmatch.sources import html, listing_pages


@pytest.fixture
def parts(spark, tmp_path):
    """A folder with a part table, whose pages Spark takes for smaller than what it may broadcast; they are twenty times that."""
    rows = spark.range(200).select(F.col("id").alias("p_partkey"), F.lit(1).alias("p_size"), *(F.lit("9").alias(c) for c in ("p_brand", "p_type", "p_name")), F.lit(1.0).alias("p_retailprice"))
    rows.coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    yield str(tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def plan_of(df):
    """The plan that ran."""
    assert df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_older_detail_pages_broadcasts_no_page(spark, parts):
    """older_detail_pages: neither the pages nor their titles."""
    pages = saved_pages(spark, parts)
    assert pages._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 16_000 < pages.agg(F.sum(F.length("html"))).first()[0] / 20
    assert "Broadcast" not in plan_of(QUERIES["older_detail_pages"](spark, parts))


def test_texts_of_broadcasts_no_page(spark, parts):
    picked = spark.range(5000).select((F.col("id") % 200).alias("page_id"), (F.col("id") % 25).cast("int").alias("node"))
    assert "Broadcast" not in plan_of(html.texts_of(saved_pages(spark, parts), picked))


def beside_by_rules(page):
    """The text beside a page's first avionics heading, from its elements one by one: of those after it at its depth the
    first that may hold text, if nothing above it comes before."""
    rows, text = html.parsed(page, (), None)
    html.Asked(short=1 << 31).filled(rows, text)
    heading = next((r for r in rows if r["tag"] in ("h2", "h3", "h4") and "avionics" in r["text"].lower()), None)
    if heading is None:
        return None
    after = [r for r in rows if r["node"] > heading["node"]]
    near = min((r["node"] for r in after if r["depth"] == heading["depth"] and r["tag"] in ("div", "section", "p")), default=None)
    end = min((r["node"] for r in after if r["depth"] < heading["depth"]), default=None)
    return None if near is None or (end is not None and near > end) else rows[near]["text"]


def test_text_beside_a_heading_by_rules(spark):
    """details_older: the text beside the heading, of any length, is what the rules say; empty texts count."""
    rng = random.Random(5)
    word = lambda: rng.choice(["AVIONICS ", "a ", "long " * 500, ""])
    made = ["".join(rng.choice([f"<{t}>{word()}", f"</{t}>", f"<{t}>{word()}</{t}>"]) for t in rng.choices(["div", "p", "section", "h2", "h4", "b", "br", "script"], k=25)) for _ in range(300)]
    want = {k: found for k, page in enumerate(made) if (found := beside_by_rules(page)) is not None}
    assert len(want) > 50 and "" in want.values() and max(map(len, want.values())) > 1999
    pages = spark.createDataFrame(list(enumerate(made)), "page_id long, html string")
    got = {r["page_id"]: r["avionics_description"] for r in listing_pages.details_older(pages).collect()}
    assert {k: got[k] for k in want} == want
