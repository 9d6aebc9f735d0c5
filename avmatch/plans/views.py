"""Domain views over the driver's tables, in Spark and as DuckDB CTEs of the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing snapshots: each customer is a listing, each order a dated state of it."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("https://m.example/listing/for-sale/"), F.col("o_custkey"), F.lit("/x")).alias("url"),
        F.concat(F.lit("USD $"), F.floor("o_totalprice").cast("long")).alias("price_text"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("location"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").alias("seq"),
    )


SNAP = """snap AS (SELECT 'https://m.example/listing/for-sale/' || o_custkey || '/x' AS url,
  'USD $' || CAST(floor(o_totalprice) AS BIGINT) AS price_text, o_orderstatus AS status, o_orderpriority AS location,
  strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey AS seq FROM orders)"""


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    registration = F.when(k % 3 == 0, F.concat(F.lit("N-"), k)).when(k % 3 == 1, F.concat(F.lit("n "), k)).otherwise("")
    serial = F.when(k % 7 == 0, F.concat(F.lit("X"), k)).when(k % 4 == 0, F.lpad(k.cast("string"), 8, "0")).when(k % 4 == 1, F.concat(F.lit("FL-"), k)).when(k % 4 == 2, "").otherwise(k.cast("string"))
    return table(spark, sf_dir, "part").select(k.alias("id"), registration.alias("registration"), serial.alias("serial"), F.col("p_brand").alias("make"), F.col("p_type").alias("model"), F.col("p_size").alias("size"))


FLEET = """fleet AS (SELECT p_partkey AS id,
  CASE p_partkey % 3 WHEN 0 THEN 'N-' || p_partkey WHEN 1 THEN 'n ' || p_partkey ELSE '' END AS registration,
  CASE WHEN p_partkey % 7 = 0 THEN 'X' || p_partkey WHEN p_partkey % 4 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 8, '0')
    WHEN p_partkey % 4 = 1 THEN 'FL-' || p_partkey WHEN p_partkey % 4 = 2 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS serial, p_brand AS make, p_type AS model, p_size AS size FROM part)"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_custkey")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    serial = F.when(k % 4 == 1, F.concat(F.lit("FL "), k)).when(k % 4 == 2, F.concat(F.lit("N"), k)).otherwise(k.cast("string"))
    return orders.join(customer, k == F.col("c_custkey")).select(
        k.cast("string").alias("n_number"),
        serial.alias("serial"),
        F.col("c_name").alias("registrant"),
        F.col("c_mktsegment").alias("code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").alias("seq"),
    )


REG = """reg AS (SELECT CAST(o_custkey AS VARCHAR) AS n_number,
  CASE o_custkey % 4 WHEN 1 THEN 'FL ' || o_custkey WHEN 2 THEN 'N' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS serial,
  c_name AS registrant, c_mktsegment AS code, strftime(o_orderdate, '%Y-%m-%d') AS date, o_orderkey AS seq
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Type codes: a market segment stands for the types of the parts whose key ends alike."""
    parts = table(spark, sf_dir, "part")
    return parts.select(F.element_at(F.array(*map(F.lit, CODES)), (F.col("p_partkey") % 5 + 1).cast("int")).alias("code"), F.col("p_type").alias("model")).distinct()


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type reference file: a code repeats, in the order of seq."""
    parts = table(spark, sf_dir, "part")
    code = F.element_at(F.array(*map(F.lit, CODES)), (F.col("p_partkey") % 5 + 1).cast("int"))
    return parts.select(code.alias("code"), F.col("p_brand").alias("manufacturer"), F.col("p_type").alias("model"), F.col("p_partkey").alias("seq"))


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages: each part is an aircraft with a page of its own, which has a bit of every layout.

    A page is a hundred times as large as its part, so parts are dealt to all cores before their pages are made: the
    table's files are too few for that.
    """
    c = F.col
    k, year = c("p_partkey"), c("p_partkey") % 30 + 1990
    parts = [
        "<title>", year, " ", "Make Model", c("p_size"), ' for Sale | x</title><meta property="og:url" content="https://own.example/', k, '"><meta property="og:image" content="https://img.example/', k, '.jpg?a=1&amp;b=2">',
        '<meta name="twitter:image" content="https://img.example/t', k, '.jpg">1 - 28 of ', k * 14, " Listings",
        '<div class="card list-listing-card-wrapper"><div data-listing-id="L', k, '"><a href="/listing/for-sale/', k, '/x">', year, " ", c("p_brand"), '</a><span class="price">USD $', F.floor("p_retailprice"), '</span><div class="machine-location">Location: ',
        c("p_type"), '</div><a href="tel:555-', k, '">call</a> Total Time: 1,', F.lpad((k % 1000).cast("string"), 3, "0"), "</div></div>",
        '<div class="w-full sm:w-1/2 lg:w-1/4 mb-4"><a href="/details/', k, '/y">', year, " ", c("p_name"), "</a><p>Offered by: ", c("p_name"), "</p></div>",
        '<div class="w-full my-4"><a href="https://x.example/aircraft-by-manufacturer/', k % 100, '/m">', c("p_name"), '</a></div><a href="/aircraft-for-sale/', k % 100, "/m/", k, '/n">', c("p_brand"), "</a>",
        '<div class="detail__specs-wrapper"><div class="detail__specs-label">Year</div><div class="detail__specs-value">', year, '</div><div class="detail__specs-label">Total Time</div><div class="detail__specs-value">', k, " SNEW</div></div>",
        '<script>{"DetailViewComponent":{"Props":{"serialNumber":"P', k, '"}}}</script>',
        '<div class="datum"><span class="label">Total Hours</span><div class="value">', k, '</div></div><div class="datum"><span class="label">Tail Number</span><div class="value">N', k, "</div></div>",
        '<table class="detail-table"><thead><tr><th>Serial Number</th><th>S', k, ' x<input class="select_aircraft" value="', k, '"></th><th>T', k, '<input class="select_aircraft" value="', k + 1000000, '"></th></tr></thead><tbody><tr><th>MFR Year</th><td>', year,
        '</td><td><a href="/b">', c("p_size"), '</a></td></tr><tr><th class="th-title">Extra</th></tr><tr><th>Seats</th><td>', c("p_size"), '</td></tr></tbody></table><input name="make_model" value="', k % 50, '">',
    ]
    dealt = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_brand", "p_retailprice", "p_type", "p_name").repartition(4 * spark.sparkContext.defaultParallelism)
    return dealt.select(k.alias("page_id"), F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts)).alias("html"))


CODES = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REF = f"""ref AS (SELECT DISTINCT (['{"', '".join(CODES)}'])[p_partkey % 5 + 1] AS code, p_type AS model FROM part)"""
