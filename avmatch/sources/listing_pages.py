"""Rule sets of marketplace pages over the element table: specs, dealer data, manufacturers and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import ordered
from avmatch.sources import html
from avmatch.sources.html import Asked, attr, has_class, nodes

#: Spec label -> column, as marketplace A prints them. Columns in TIMES lose commas and time marks.
SPECS = {
    "Year": "year",
    "Manufacturer": "manufacturer",
    "Model": "model",
    "Serial Number": "serial_number",
    "Registration #": "registration_number",
    "Condition": "condition",
    "Description": "description",
    "Based at": "based_at",
    "Total Time": "total_time",
    "Total Landings": "total_landings",
    "Complete Logs": "complete_logs",
    "Maintenance Tracking": "maintenance_tracking",
    "Airframe Notes": "airframe_notes",
    "Engine 1 Make/Model": "engine1_make_model",
    "Engine 1 Time": "engine1_time",
    "Engine 1 Cycles": "engine1_cycles",
    "Engine TBO": "engine1_tbo",
    "Engine Notes": "engine1_notes",
    "Engine 2 Make/Model": "engine2_make_model",
    "Engine 2 Time": "engine2_time",
    "Engine 2 Cycles": "engine2_cycles",
    "Engine 2 TBO": "engine2_tbo",
    "Engine 2 Notes": "engine2_notes",
    "Prop Notes": "props",
    "Avionics/Radios": "avionics",
    "Additional Equipment": "equipment",
    "Exterior Notes": "exterior_notes",
    "Interior Notes": "interior_notes",
    "Inspection Status": "inspection_status",
    "Year Painted": "year_painted",
    "Number of Seats": "number_of_seats",
    "Galley": "galley",
    "Galley Configuration": "galley_configuration",
    "APU": "apu",
    "APU Maintenance Program": "apu_maintenance_program",
    "APU Notes": "apu_notes",
}
TIMES = ("total_time", "total_landings", "engine1_time", "engine1_cycles", "engine1_tbo", "engine2_time", "engine2_cycles", "engine2_tbo")


def details_a(pages: DataFrame) -> DataFrame:
    """(page_id, the SPECS columns, title, price, location, seller, phone, email, page_props).

    Of a repeated label the first value wins. A spec that the page doesn't print is taken from the embedded
    component's JSON, under the column's own name in camel case.
    """
    rows = ordered.cut(nodes(pages, scopes=["detail__specs-wrapper"], asked=Asked("h1", ".detail__specs-", ".price", ".location", ".dealer-contact__name")))
    specs = html.pairs(rows.where("scope >= 0"), "detail__specs-label", "detail__specs-value")
    first = lambda cond: F.min_by(F.when(cond, F.col("text")), F.when(cond, F.col("node")))
    like = lambda part: F.coalesce(attr("class").contains(part), F.lit(False))
    tel = (F.col("tag") == "a") & F.coalesce(attr("href").startswith("tel:"), F.lit(False))
    mail = (F.col("tag") == "a") & F.coalesce(attr("href").startswith("mailto:"), F.lit(False))
    around = rows.groupBy("page_id").agg(
        first(F.col("tag") == "h1").alias("title"),
        first(like("price")).alias("asking_price"),
        first(like("location")).alias("location"),
        first(like("dealer-contact__name")).alias("seller"),
        F.min_by(F.when(tel, F.substring(attr("href"), 5, 60)), F.when(tel, F.col("node"))).alias("phone"),
        F.min_by(F.when(mail, F.substring(attr("href"), 8, 200)), F.when(mail, F.col("node"))).alias("email"),
    )
    props = pages.select("page_id", F.nullif(F.regexp_extract("html", r'(?s)"DetailViewComponent".*?"Props"\s*:\s*(\{.*)', 1), F.lit("")).alias("page_props"))
    out = props.join(specs, "page_id", "left").join(around, "page_id", "left")
    columns = []
    for label, name in SPECS.items():
        words = name.split("_")
        value = F.coalesce(F.col("specs")[label], F.get_json_object("page_props", "$." + words[0] + "".join(w.title() for w in words[1:])))
        columns.append((clean.hours_text(value) if name in TIMES else value).alias(name))
    price = F.trim(F.regexp_replace("asking_price", r"^\s*USD\s*", ""))
    return out.select("page_id", *columns, "title", price.alias("asking_price"), "location", "seller", "phone", "email", "page_props")


def details_b(pages: DataFrame) -> DataFrame:
    """Dealer pages: label and value of each datum, list items with a label, price, broker and section texts."""
    first = [("p", "Price:"), *(("li", f"^{label}") for label in ("Serial Number", "Tail Number", "Hours", "Cycles"))]
    rows = ordered.cut(nodes(pages, scopes=["datum", "broker"], asked=Asked("a", "title", ".label", ".value", ".broker", ".mt-4 leading-normal", "#avionics-section", "#other", "#inspections-section", first=first)))
    text, node = F.col("text"), F.col("node")
    pick = lambda value, cond: F.min_by(F.when(cond, value), F.when(cond, node))
    datum = rows.where("scope_class = 'datum'").groupBy("page_id", "scope").agg(pick(text, has_class("label")).alias("label"), pick(text, has_class("value")).alias("value"), F.min_by("section", "node").alias("section"), F.min_by("depth", "node").alias("depth"))
    in_engines = F.coalesce(F.col("section").startswith("engine"), F.lit(False))
    engines = rows.where((F.col("tag") == "div") & has_class("engine") & in_engines).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("node", "depth"))).alias("engines"))
    second, third = F.get("engines", F.lit(1)), F.get("engines", F.lit(2))
    inside = in_engines & (F.col("scope") > second["node"]) & (F.col("depth") > second["depth"]) & F.coalesce(F.col("scope") < third["node"], F.lit(True))
    datum = datum.join(engines, "page_id", "left").withColumn("engine2", F.coalesce(F.col("section") == "engine-2", F.lit(False)) | F.coalesce(inside, F.lit(False)))
    by_label = lambda part, where=F.lit(True): F.min_by(F.when(F.lower("label").contains(part) & where, F.col("value")), F.when(F.lower("label").contains(part) & where, F.col("scope")))
    engine2 = F.col("engine2")
    # Of the second engine the last value of a label stands.
    second_label = lambda part: F.max_by(F.when(F.lower("label").contains(part) & engine2, F.col("value")), F.when(F.lower("label").contains(part) & engine2, F.col("scope")))
    plain = lambda value: F.trim(F.regexp_replace(value, ",", ""))
    data = datum.where("value <> ''").groupBy("page_id").agg(
        by_label("total hours").alias("total_time"),
        by_label("total cycles").alias("total_cycles"),
        by_label("serial number", F.coalesce(F.col("section") != "engines-section", F.lit(True)) & ~engine2).alias("serial_number"),
        by_label("tail number").alias("registration_number"),
        by_label("hours since new", ~engine2).alias("engine1_hours_since_new"),
        by_label("hours since overhaul", ~engine2).alias("engine1_hours_since_overhaul"),
        by_label("hours since hot section", ~engine2).alias("engine1_hours_since_hot_section"),
        F.min_by(F.when(F.col("label").isNull() & (F.col("section") == "engines-section"), F.col("value")), F.when(F.col("label").isNull() & (F.col("section") == "engines-section"), F.col("scope"))).alias("engine1_make_model"),
        F.trim(second_label("serial number")).alias("engine2_serial_number"),
        plain(second_label("hours since new")).alias("engine2_hours_since_new"),
        plain(second_label("hours since overhaul")).alias("engine2_hours_since_overhaul"),
        plain(second_label("hours since hot section")).alias("engine2_hours_since_hot_section"),
    )
    whole = lambda name: pick(text, attr("id") == name)
    section = lambda name, n: F.substring(whole(name), 1, n)
    broker = F.col("scope_class") == "broker"
    rest = rows.groupBy("page_id").agg(
        pick(F.regexp_extract(text, r"Price:\s*(.+)$", 1), text.contains("Price:") & (F.col("tag") == "p")).alias("asking_price"),
        pick(F.regexp_extract(text, r"([A-Z][a-z]+(?: [A-Z][a-z]+)*, [A-Z]{2})\b", 1), has_class("broker")).alias("location"),
        pick(text, broker & F.coalesce(attr("href").startswith("tel:"), F.lit(False))).alias("phone"),
        pick(F.substring(attr("href"), 8, 200), broker & F.coalesce(attr("href").startswith("mailto:"), F.lit(False))).alias("seller_email"),
        pick(text, F.col("tag") == "title").alias("_title"),
        pick(F.regexp_extract(text, r"(?i)Contact\s+(.+)", 1), broker & (F.col("tag") == "a") & text.rlike(r"(?i)^Contact\s")).alias("seller"),
        F.substring(pick(text, F.coalesce(attr("class").contains("mt-4 leading-normal"), F.lit(False))), 1, 2000).alias("description"),
        F.coalesce(pick(text, has_class("value") & (F.col("section") == "avionics-section")), whole("avionics-section")).alias("avionics"),
        section("other", 1000).alias("equipment"),
        section("inspections-section", 500).alias("inspection_status"),
        *(
            pick(F.trim(F.regexp_replace(text, f"^{label}:?", "")), (F.col("tag") == "li") & F.col("lead").startswith(label)).alias(name)
            for label, name in (("Serial Number", "_serial"), ("Tail Number", "_tail"), ("Hours", "_hours"), ("Cycles", "_cycles"))
        ),
    )
    out = pages.select("page_id").join(rest, "page_id", "left").join(data, "page_id", "left")
    for listed, name in (("_serial", "serial_number"), ("_tail", "registration_number"), ("_hours", "total_time"), ("_cycles", "total_cycles")):
        # The summary list names the aircraft; its hours only fill a gap.
        out = out.withColumn(name, F.coalesce(name, listed) if listed == "_hours" else F.coalesce(listed, name)).drop(listed)
    shape = r"([0-9]{4})?\s*([A-Z][A-Za-z0-9\s-]+?)\s+for\s+Sale"
    name = F.split(F.trim(F.regexp_extract("_title", shape, 2)), r"\s+")
    several = F.size(name) > 1
    out = out.withColumn("year", F.nullif(F.regexp_extract("_title", shape, 1), F.lit("")))
    out = out.withColumn("manufacturer", F.when(several, name[0])).withColumn("model", F.nullif(F.when(several, F.array_join(F.slice(name, 2, 100), " ")).otherwise(name[0]), F.lit("")))
    out = out.withColumn("tail_number", F.col("registration_number")).drop("_title")
    return out.withColumn("total_time", clean.hours_text(F.col("total_time"))).withColumn("total_cycles", clean.hours_text(F.col("total_cycles")))


#: Patterns of the older detail page, tried in this order.
PRICES = (r"(\$[\d,]+(?:\.\d{2})?)", r"(?i)(call\s+for\s+price)", r"(?i)(poa)")
TOTAL_TIMES = (r"(?i)total\s+time[:\s]+([\d,]+)", r"(?i)tt[:\s]+([\d,]+)")
ENGINE_TIMES = (r"(?i)engine\s+(?:1\s+)?time[:\s]+([\d,]+)", r"(?i)engine\s+hours?[:\s]+([\d,]+)", r"(?i)eh[:\s]+([\d,]+)")
SELLER_NAME = r"([A-Z][a-zA-Z\s&,]+(?:LLC|Inc|Corp|Aircraft|Aviation)?)"


def details_older(pages: DataFrame) -> DataFrame:
    """Detail pages of the older kind: (page_id, aircraft_model, year, total_time_hours, engine_hours, avionics_description,
    asking_price, location, seller_broker_name).

    First the product of the page's linked data, then elements by class, then patterns in the text. Of an element that
    a text stands in, the innermost counts.
    """
    classes = (".spec", ".price", ".location", ".avionics", ".seller", ".broker", ".dealer", ".detail__title")
    beside = (("h2", "h3", "h4"), "avionics", ("div", "section", "p"))
    rows = ordered.cut(nodes(pages, asked=Asked("h1", "h2", "h3", "h4", "title", "script", *classes, short=1999, longest=True, beside=beside)))
    tag, text, node, low = F.col("tag"), F.col("text"), F.col("node"), F.lower(attr("class"))
    in_class = lambda *parts: F.coalesce(reduce(lambda a, b: a | b, (low.contains(p) for p in parts)), F.lit(False))
    first = lambda value, cond: F.min_by(F.when(cond, value), F.when(cond, node))
    found = lambda x, *shapes: F.coalesce(*(F.nullif(F.trim(F.regexp_extract(x, shape, 1)), F.lit("")) for shape in shapes))
    product = (tag == "script") & (attr("type") == "application/ld+json") & (F.get_json_object("text", "$['@type']") == "Product")
    kinds = ("div", "span", "p")
    section = tag.isin("div", "section")
    told = text.rlike("(?i)Seller Information|Dealer|Broker") & ~tag.isin("script", "style")
    page = rows.groupBy("page_id").agg(
        first(F.coalesce(F.get_json_object("text", "$.name"), F.get_json_object("text", "$.model")), product).alias("product"),
        first(F.get_json_object("text", "$.name"), product).alias("product_name"),
        first(text, (tag == "h1") & has_class("detail__title")).alias("title"),
        first(text, section & in_class("spec")).alias("specs"),
        *(first(text, (tag == k) & in_class("price")).alias(f"price_{k}") for k in kinds),
        *(first(text, (tag == k) & in_class("location") & (text != "")).alias(f"location_{k}") for k in kinds),
        first(text, tag == "title").alias("page_title"),
        first(text, F.col("beside")).alias("beside_heading"),
        first(text, section & in_class("avionics")).alias("avionics_class"),
        first(text, tag.isin("div", "section", "p", "li") & F.lower("text").contains("avionics") & F.length("text").between(51, 1999)).alias("avionics_text"),
        F.min_by(F.when(told, text), F.when(told, F.struct(F.length("text"), node))).alias("seller_text"),
        *(first(text, (tag == k) & in_class("seller", "broker", "dealer")).alias(f"seller_{k}") for k in ("div", "span")),
        F.max_by(text, F.when(~tag.isin("script", "style") & text.isNotNull(), F.struct(F.length("text"), -node))).alias("whole"),
    )
    prices = [F.when(F.col(f"price_{k}").contains("$") | F.lower(f"price_{k}").contains("price") | F.lower(f"price_{k}").contains("call"), F.col(f"price_{k}")) for k in kinds]
    sellers = [F.when(F.length(c).between(3, 199), F.col(c)) for c in ("seller_text", "seller_div", "seller_span")]
    seller = F.coalesce(*sellers)
    hours = lambda shapes: F.regexp_replace(F.coalesce(found("specs", shapes[0]), found("whole", *shapes)), ",", "")
    return pages.select("page_id").join(page, "page_id", "left").select(
        "page_id",
        F.coalesce("product", "title").alias("aircraft_model"),
        F.coalesce(clean.year_in(F.col("product_name")), clean.year_in(F.coalesce("title", "product"))).cast("string").alias("year"),
        hours(TOTAL_TIMES).alias("total_time_hours"),
        hours(ENGINE_TIMES).alias("engine_hours"),
        F.coalesce("beside_heading", "avionics_class", "avionics_text").alias("avionics_description"),
        F.coalesce(*prices, found("whole", *PRICES)).alias("asking_price"),
        F.coalesce(*(F.col(f"location_{k}") for k in kinds), found("page_title", r"(?i)in\s+([^|]+)")).alias("location"),
        F.coalesce(found(seller, SELLER_NAME), F.substring(seller, 1, 100)).alias("seller_broker_name"),
    )


def with_index_fields(details: DataFrame, index: DataFrame, columns=("aircraft_model", "year", "dealer_name")) -> DataFrame:
    """Details with what only the index row of their URL says."""
    base = index.groupBy("listing_url").agg(*(F.first(c, ignorenulls=True).alias(f"_{c}") for c in columns))
    out = details.join(base, "listing_url", "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(c, f"_{c}") if c in details.columns else F.col(f"_{c}")).drop(f"_{c}")
    return out


def manufacturers(pages: DataFrame) -> DataFrame:
    """(page_id, name, url, manufacturer_id), in page order once per URL."""
    rows = nodes(pages, scopes=["w-full my-4"], tags=["a"]).where((F.col("scope") >= 0) & attr("href").isNotNull())
    first = rows.where("tag = 'a'").groupBy("page_id", "scope").agg(F.min_by(F.struct(F.col("text").alias("name"), attr("href").alias("url")), "node").alias("a"))
    return first.select("page_id", "a.name", "a.url", F.nullif(F.regexp_extract("a.url", r"/aircraft-by-manufacturer/([0-9]+)", 1), F.lit("")).try_cast("int").alias("manufacturer_id")).distinct()


def model_links(pages: DataFrame) -> DataFrame:
    """(page_id, model_name, url, model_id): the first named link of each model page; count badges are ignored."""
    shape = r"/aircraft-for-sale/[0-9]+/[^/]+/([0-9]+)/[^/]+"
    rows = html.links(pages).where(F.col("href").rlike(shape) & (F.col("label") != "") & ~F.col("label").rlike("^[0-9]+$"))
    once = rows.groupBy("page_id", F.col("href").alias("url")).agg(F.min_by("label", "pos").alias("model_name"))
    return once.select("page_id", "model_name", "url", F.regexp_extract("url", shape, 1).cast("int").alias("model_id"))


#: Card classes of the two layouts of a model's page.
CARD, BOX = "w-full sm:w-1/2 lg:w-1/4 mb-4", "aircraft-box"


def model_listings(pages: DataFrame, manufacturer: str | None = None) -> DataFrame:
    """Dealer cards: (page_id, position, url, title, year, dealer, manufacturer), once per page and URL.

    Cards of the index layout, else boxes; on a page with neither, every link to details, with the heading before it.
    """
    offered = lambda x: F.nullif(F.trim(F.regexp_extract(x, r"(?i)Offered by:\s*(.*?)\s*(?:View Details|$)", 1)), F.lit(""))
    every = ordered.cut(html.card_nodes(pages, (CARD, BOX), "h2", "h5", "p"))
    layouts = [html.cards_of(every, "/details/", place=k).select("page_id", "position", "url", "title", offered(F.col("text")).alias("dealer"), F.lit(k).alias("layout")) for k in range(2)]
    rows = every.where(F.col("tag").isin("a", "h2", "h5", "p"))
    down = Window.partitionBy("page_id").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    before = lambda cond: F.last(F.when(cond, F.col("text")), ignorenulls=True).over(down)
    rows = rows.withColumn("title", before(F.col("tag").isin("h2", "h5"))).withColumn("dealer", before((F.col("tag") == "p") & F.col("text").contains("Offered by:")))
    plain = rows.where((F.col("tag") == "a") & F.col("text").rlike("(?i)View Details") & attr("href").rlike("(?i)/details/[0-9]+/"))
    plain = plain.groupBy("page_id", attr("href").alias("url")).agg(F.min_by(F.struct("title", "dealer"), "node").alias("c"), F.min("node").alias("node"))
    layouts.append(plain.select("page_id", F.row_number().over(Window.partitionBy("page_id").orderBy("node")).alias("position"), "url", "c.title", offered(F.col("c.dealer")).alias("dealer"), F.lit(2).alias("layout")))
    found = reduce(DataFrame.unionByName, layouts)
    found = found.withColumn("best", F.min("layout").over(Window.partitionBy("page_id"))).where("layout = best")
    return found.select("page_id", "position", "url", "title", clean.year_in(F.col("title")).alias("year"), "dealer", F.lit(manufacturer).cast("string").alias("manufacturer"))
