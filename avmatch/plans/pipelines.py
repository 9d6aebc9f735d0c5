"""User-level pipelines: each takes DataFrames, returns DataFrames by table name and writes nothing but
scratch rows.

A merged table has a column action (inserted, updated, skipped, kept), from which ``run_summary`` counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import history, match, merge, ordered, resolve
from avmatch.sources import html, listing_pages

LISTING = "url string, date date, feed int, position int, title string, make string, model string, year int, price decimal(15,2), status string, location string, description string, airframe_time decimal(10,1), serial string, registration string, features array<string>, platform string"
LISTING_FILL = ["title", "make", "model", "year", "price", "status", "location", "description", "airframe_time", "serial", "registration", "features"]


def index_events(feed: DataFrame, platform: str, keep: Sequence[str] = ()) -> DataFrame:
    """Index records as listing events (feed 0), with the columns of `keep`. Records without a URL are dropped."""
    c = F.col
    return feed.where(clean.not_blank(c("listing_url"))).select(
        F.trim("listing_url").alias("url"), c("ingestion_date").alias("date"), F.lit(0).alias("feed"), c("pos").alias("position"),
        clean.collapse(c("aircraft_model")).alias("title"), clean.make_of(c("aircraft_model")).alias("make"), clean.model_of(c("aircraft_model")).alias("model"),
        F.coalesce(clean.whole(c("year")), clean.year_in(c("aircraft_model"))).alias("year"), clean.price(c("listing_price")).alias("price"),
        F.lit("for_sale").alias("status"), clean.blank_to_null(c("listing_location")).alias("location"), F.lit(None).cast("string").alias("description"),
        clean.number(clean.hours_text(c("total_time_hours")), "decimal(10,1)").alias("airframe_time"), F.lit(None).cast("string").alias("serial"),
        F.lit(None).cast("string").alias("registration"), F.lit(None).cast("array<string>").alias("features"), F.lit(platform).alias("platform"), *keep,
    )


def detail_events(feed: DataFrame, platform: str, keep: Sequence[str] = ()) -> DataFrame:
    """Detail records as listing events (feed 1), with the columns of `keep`."""
    c = F.col
    return feed.where(clean.not_blank(c("listing_url"))).select(
        F.trim("listing_url").alias("url"), c("ingestion_date").alias("date"), F.lit(1).alias("feed"), c("pos").alias("position"),
        F.concat_ws(" ", "year", "manufacturer", "model").alias("title"), clean.clip(c("manufacturer"), 200).alias("make"), clean.clip(c("model"), 200).alias("model"),
        clean.whole(c("year")).alias("year"), clean.price(c("asking_price")).alias("price"), F.lit("for_sale").alias("status"),
        clean.blank_to_null(c("location")).alias("location"), clean.blank_to_null(c("description")).alias("description"),
        clean.number(clean.hours_text(c("total_time")), "decimal(10,1)").alias("airframe_time"), clean.clip(c("serial_number"), 100).alias("serial"),
        clean.registration(c("registration_number")).alias("registration"), clean.feature_labels(c("avionics"), c("equipment"), c("props")).alias("features"), F.lit(platform).alias("platform"), *keep,
    )


def carried_over(details: DataFrame, index: DataFrame) -> DataFrame:
    """Detail records with the make, model and year that the index gives for their URL, where they have none."""
    wide = listing_pages.with_index_fields(details.withColumn("year", clean.blank_to_null(F.col("year"))), index, ("aircraft_model", "year"))
    for name, part in (("manufacturer", clean.make_of), ("model", clean.model_of)):
        wide = wide.withColumn(name, F.coalesce(clean.blank_to_null(F.col(name)), part(F.col("aircraft_model"))))
    return wide.withColumn("year", F.coalesce("year", clean.year_in(F.col("aircraft_model")).cast("string"))).select(*details.columns)


def load_listings(events: DataFrame, listings: DataFrame, entities: DataFrame, past_events: DataFrame | None = None) -> dict[str, DataFrame]:
    """Listings upsert with history and entities. listings: LISTING columns and entity_id.

    The newest event per URL wins; missing fields keep what is stored, and a batch older than the stored row is
    skipped. history covers all given events; with past_events also what changed against them.
    """
    known = resolve.lookup(events, entities).drop("matched_by")
    merged = merge.merge_latest(listings, known, ["url"], ["date", "feed", "position"], fill=[*LISTING_FILL, "entity_id"], newer="date")
    fresh = known.where("entity_id is null").withColumn("_order", F.concat_ws("|", "date", "feed", F.lpad(F.col("position").cast("string"), 10, "0")))
    new = resolve.new_keys(fresh, "_order").groupBy("entity_key").agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("serial", "registration", "make", "model", "year")))
    told = events if past_events is None else past_events.unionByName(events)
    return {"listings": merged, "new_entities": new, "history": history.feed_changes(told)}


def engines(details: DataFrame) -> DataFrame:
    """Engine rows of detail records: two positions, overhaul limits parsed."""
    rows = history.unpivot_engines(details, ["listing_url", "ingestion_date"], ["make_model", "serial_number", "tbo"])
    return rows.withColumn("make_model", clean.clip_with_dots(F.col("make_model"))).withColumn("tbo_hours", clean.overhaul_hours(F.col("tbo"))).withColumn("tbo_years", clean.overhaul_years(F.col("tbo"))).drop("tbo")


def decoded(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """rows with their code's maker and model; of a repeated reference code the last row counts."""
    ref = merge.pick_per_key(reference.where(clean.not_blank(F.col("code"))), ["code"], ["seq"]).select("code", "manufacturer", F.col("model").alias("aircraft_model"))
    return rows.join(ref, "code", "left")


def registry_rows(master: DataFrame, acftref: DataFrame) -> DataFrame:
    """MASTER text rows, typed and decoded. A blank N-number falls back to the serial; a row with neither goes."""
    c = F.col
    names = clean.filled_list(*(c(f"other_name_{k}") for k in range(1, 6)))
    dates = ("last_action_date", "cert_issue_date", "air_worth_date", "expiration_date")
    rows = decoded(master.where(clean.not_blank(c("n_number")) | clean.not_blank(c("serial"))), acftref)
    return rows.select(
        "seq", F.coalesce("n_number", "serial").alias("n_number"), "serial", "code", "manufacturer", c("aircraft_model").alias("model"), clean.whole(c("year")).alias("year"),
        clean.strict_whole(c("registrant_type"), "smallint").alias("registrant_type"), "registrant", "street", "street2", "city", "state", "zip", clean.country_or_us(c("country")).alias("country"),
        clean.place(c("city"), c("state")).alias("based_at"), *(clean.registry_date(c(d)).alias(d) for d in dates), clean.status_name(c("status_code")).alias("status"), "status_code",
        F.coalesce("kit_mfr", clean.kit_maker(c("kit"))).alias("kit_mfr"), F.coalesce("kit_model", clean.kit_model(c("kit"))).alias("kit_model"), names.alias("other_names"), "mode_s_code", "mode_s_code_hex", "unique_id",
    )


def load_registry(rows: DataFrame, stored: DataFrame, date: str) -> DataFrame:
    """Registry rows of one snapshot date upserted by (n_number, ingestion_date); the last row of a key wins."""
    batch = rows.withColumn("ingestion_date", F.lit(date).cast("date"))
    return merge.merge_latest(stored, batch, ["n_number", "ingestion_date"], ["seq"])


def load_reference(rows: DataFrame, stored: DataFrame, key: str = "code") -> DataFrame:
    """Reference rows (types, engines) upserted by key; blank keys go."""
    return merge.merge_latest(stored, rows.where(clean.not_blank(F.col(key))), [key], ["seq"])


def load_once(rows: DataFrame, stored: DataFrame, key: str, date: str) -> DataFrame:
    """Rows to append, first per (key, date), never updated: deregistered, document index, reserved."""
    batch = rows.where(clean.not_blank(F.col(key))).withColumn("ingestion_date", F.lit(date).cast("date"))
    return merge.insert_absent(stored, batch, [key, "ingestion_date"], ["seq"])


def sale_rows(rows: DataFrame) -> DataFrame:
    """Sales with a serial and a sale date, flags and features typed."""
    valid = rows.where(clean.not_blank(F.col("serial_number")) & F.col("date_sold").isNotNull())
    out = valid.withColumn("features", clean.comma_list(F.col("features"))).withColumn("has_damage", clean.is_true_text(F.col("has_damage")))
    return out.withColumn("engine_deferred", clean.deferred(F.col("engine_program_deferment_amount"))).withColumn("apu_deferred", clean.deferred(F.col("apu_program_deferment_amount")))


def load_sales(rows: DataFrame, stored: DataFrame, entities: DataFrame) -> DataFrame:
    """Sales to append: a serial and a sale date are needed, once per both; the aircraft is found by serial only."""
    new = merge.insert_absent(stored, sale_rows(rows), ["serial_number", "date_sold"], ["seq"])
    ids = entities.where(F.trim("serial") != "").groupBy(F.col("serial").alias("serial_number")).agg(F.min("entity_id").alias("entity_id"))
    return new.join(ids, "serial_number", "left")


def cost_rows(feed: DataFrame) -> DataFrame:
    """Cost records with a detail id, typed; nested maker and category become columns, raw is the whole record."""
    c = F.col
    text = lambda name: clean.blank_to_null(c(name))
    return feed.where("aircraftDetailId is not null").select(
        c("aircraftDetailId").alias("detail_id"), text("name").alias("name"), text("description").alias("description"),
        c("aircraftManufacturer.aircraftManufacturerId").alias("manufacturer_id"), text("aircraftManufacturer.name").alias("manufacturer"),
        c("aircraftCategory.aircraftCategoryId").alias("category_id"), text("aircraftCategory.category").alias("category"),
        text("avionics").alias("avionics"), text("yearsInProduction").alias("years_in_production"), c("averagePreOwnedPrice").alias("average_price"),
        clean.either_cost(c("totalVariableCostPerHrsValue"), c("calc_TotalVariableCostPerHour")).alias("variable_cost_per_hour"),
        c("fuelGallons").alias("fuel_gallons"), c("normalCruiseSpeedKts").alias("cruise_kts"), c("seatsFullRangeNm").alias("seats_full_range_nm"),
        c("typicalPassengerCapacityMax").cast("int").alias("passengers_max"), c("maxTakeoffWeight").cast("int").alias("max_takeoff_weight"), text("powerplant").alias("powerplant"),
        text("model").alias("engine_model"), clean.iso_timestamp(c("lastUpdatedOn")).alias("updated_on"), F.to_json(F.struct(*feed.columns)).alias("raw"), "pos",
    )


def load_costs(feed: DataFrame, stored: DataFrame) -> DataFrame:
    """Cost reference upserted by detail id."""
    return merge.merge_latest(stored, cost_rows(feed), ["detail_id"], ["pos"])


def fleet_page_rows(records: DataFrame) -> DataFrame:
    """Fleet page records with an entity id: named fields become typed columns, all fields and sections stay."""
    c = F.col
    cell = lambda name: clean.cell_text(c("fields")[name])
    return records.where("aircraft_entity_id is not null").select(
        c("aircraft_entity_id").alias("entity_id"), c("ingestion_date"), "make_model_id", "make_model_name", clean.clip(c("serial_number"), 100).alias("serial"),
        clean.registration(cell("Registration")).alias("registration"), clean.whole(cell("MFR Year")).alias("year"), clean.clip(cell("EIS Date"), 20).alias("eis_date"),
        clean.clip(cell("Country"), 10).alias("country_code"), clean.clip(cell("Base"), 20).alias("base_code"), clean.cell_href(c("fields")["Owner"]).alias("owner_url"),
        *(clean.whole(cell(label)).alias(name) for label, name in (("Airframe Hours", "airframe_hours"), ("Total Landings", "total_landings"), ("Prior Owners", "prior_owners"), ("Passengers", "passengers"))),
        clean.for_sale(c("fields")["For Sale"]).alias("for_sale"), clean.clip(cell("Engine Program Type"), 100).alias("engine_program_type"), clean.clip(cell("APU Program"), 100).alias("apu_program"),
        "fields", *(x for x in ("sections", "file_path") if x in records.columns), "pos",
    )


def load_fleet_pages(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Fleet page records upserted by (entity, date)."""
    return merge.merge_latest(stored, fleet_page_rows(records), ["entity_id", "ingestion_date"], ["pos"])


def fleet_table(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Fleet CSV rows with their stable ids (last row per id); with stored, merged into it, its columns widened."""
    id_fields = ("serial_number", "registration_number", "manufacturer", "model", "manufacturer_year", "delivery_year", "category")
    valid = rows.where(clean.not_blank(F.col("serial_number")) | clean.not_blank(F.col("registration_number")))
    named = merge.pick_per_key(valid.withColumn("aircraft_id", clean.stable_id(*map(F.col, id_fields))), ["aircraft_id"], ["seq"])
    if stored is None:
        return named.drop("seq")
    wide = merge.widen(stored, named.drop("seq").limit(0))
    batch = merge.widen(named, stored.limit(0))
    return merge.merge_latest(wide, batch, ["aircraft_id"], ["seq"])


def match_report(fleet: DataFrame, registry: DataFrame, require_serial: bool = False, registrant: str | None = None) -> dict[str, DataFrame]:
    """The match list, its distinct pairs and registrations, and its counts; of one registrant if asked."""
    side = match.named(registry, registrant) if registrant else registry
    found = match.registry_match(fleet, side, require_serial)
    return {"list": match.listed(found), "pairs": found.select("registration", "n_number").distinct(), "registrations": found.select("registration").distinct(), "stats": match.stats(found)}


def image_index(pages: DataFrame, platform: str) -> DataFrame:
    """pages (page_id, file_name, html, url, listing, ingestion_date) to one row per <platform>:<listing> with its photo
    URLs, by the platform's rule set; the page says its own address, or has `url`."""
    rows = ordered.cut(html.nodes(pages, tags=html.IMAGE_TAGS, asked=html.Asked()))
    own = html.own_urls(pages, rows)
    told = pages.join(own, "page_id", "left").select("page_id", "listing", F.coalesce("own_url", "url").alias("page_url"), "ingestion_date")
    found = html.images(pages, platform, rows).join(told, "page_id")
    place = F.struct("rank", "pos").alias("pos")
    rows = found.select(F.concat_ws(":", F.lit(platform), "listing").alias("key"), F.col("ingestion_date").alias("date"), "page_id", place, F.col("url"), F.col("bucket").alias("source"), "page_url")
    return html.merge_urls(rows)


def image_counts(index: DataFrame) -> DataFrame:
    """(platform, listings, urls) of an image index."""
    return index.groupBy(F.split("key", ":")[0].alias("platform")).agg(F.count("*").alias("listings"), F.sum(F.size("urls")).alias("urls"))


def with_images(listings: DataFrame, index: DataFrame) -> DataFrame:
    """listings (platform, url, ...) with images: the URLs of their page, null where none was saved."""
    found = index.select(F.col("key").alias("_key"), F.col("urls").alias("images"))
    return listings.withColumn("_key", F.concat_ws(":", "platform", clean.listing_id(F.col("url")))).join(found, "_key", "left").drop("_key")


#: The flat export's columns and the field each is read from.
EXPORT = {"registration": "Registration", "mfr_year": "MFR Year", "eis_date": "EIS Date", "country": "Country", "base": "Base", "owner": "Owner", "for_sale": "For Sale", "prior_owners": "Prior Owners", "airframe_hours": "Airframe Hours", "total_landings": "Total Landings", "engine_program_type": "Engine Program Type", "apu_program": "APU Program", "passengers": "Passengers"}


def fleet_export(records: DataFrame) -> DataFrame:
    """Fleet records as 19 flat columns: links as text (href), booleans as Yes or No, all fields and sections as JSON."""
    shown = (F.coalesce(clean.cell_shown(F.col("fields")[label]), F.lit("")).alias(name) for name, label in EXPORT.items())
    return records.select("make_model_id", "make_model_name", "serial_number", "aircraft_entity_id", *shown, F.to_json("fields").alias("fields_json"), F.to_json("sections").alias("sections_json"))


def run_summary(merged: dict[str, DataFrame]) -> DataFrame:
    """(source, action, n) of merged tables, with totals over sources."""
    rows = None
    for name, df in merged.items():
        part = df.groupBy("action").agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "action", "n")
        rows = part if rows is None else rows.unionByName(part)
    return rows.rollup("action", "source").agg(F.sum("n").alias("n")).where("action is not null").select("source", "action", "n")
