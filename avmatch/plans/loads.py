"""Loads of saved snapshots into versioned tables: one function for each source, and all of them in order.

A load reads the newest dated folder of its source, logs the raw records, resolves aircraft, merges, writes each table
once, and returns what it did to each file's records. With dry_run nothing is written, and every step sees the tables as
they are. A table, or each date of a dated one, is a folder of versions, so a load that dies may just run again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from avmatch import schemas
from avmatch.functions import clean
from avmatch.operators import history, merge, resolve
from avmatch.plans import pipelines
from avmatch.sources import readers
from avmatch.sources.keyed import KeyedTable
from avmatch.sources.tables import VersionedTable, path_exists

ACTIONS = ("inserted", "updated", "skipped")
AIRCRAFT = "entity_id string, serial string, registration string, make string, model string, year int, delivery_year int, category string, status string, passengers int, registration_country string, based_country string, air_worth_date date, certification string, aircraft_type string, engine_type string, mode_s_code string, mode_s_code_hex string"
RAW = "source_type string, listing_url string, file_path string, raw string, raw_hash string, source_platform string, ingestion_date date"
RAW_KEYS = ["source_platform", "source_type", "ingestion_date", "listing_url", "file_path"]
HISTORY = ["url", "field", "old_value", "new_value", "change_date"]
#: A limit that skips its source.
SKIP = -1


class Tables:
    """The tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str, dry_run: bool = False):
        self.spark, self.root, self.dry_run = spark, root.rstrip("/"), dry_run
        #: (source, file, action, n) of all that was done.
        self.done: list[tuple[str, str, str, int]] = []

    def _table(self, name: str, date: str | None, keys: Sequence[str] = ()) -> VersionedTable | KeyedTable:
        """A table of versions, or (given keys, or where it is one) of parts by key."""
        path = f"{self.root}/{name}" + (f"/ingestion_date={date}" if date else "")
        keyed = KeyedTable(self.spark, path, keys)
        return keyed if keys or keyed.versions() else VersionedTable(self.spark, path)

    def held(self, name: str, like: DataFrame | str, date: str | None = None) -> DataFrame:
        """A table, or one date of it, with the columns of `like` and any others it has."""
        empty = self.spark.createDataFrame([], like if isinstance(like, str) else like.schema)
        table = self._table(name, date)
        return merge.widen(empty, table.read()) if table.versions() else empty

    def write(self, source: str, file: str, name: str, merged: DataFrame, date: str | None = None) -> None:
        """A new version from rows with a column action, which is counted while they are written."""
        seen = Observation()
        rows = merged.observe(seen, *(F.count_if(F.col("action") == a).alias(a) for a in ACTIONS)).drop("action")
        if self.dry_run:
            rows.write.format("noop").mode("overwrite").save()
        else:
            self._table(name, date).write(rows)
        self.done += [(source, file, a, n) for a, n in seen.get.items() if n]

    def append(self, name: str, rows: DataFrame, by: Sequence[str]) -> None:
        if not self.dry_run:
            rows.write.mode("append").partitionBy(*by).parquet(f"{self.root}/{name}")

    def upsert(self, source: str, file: str, name: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], date: str | None = None, fill: Sequence[str] = ()) -> None:
        """Only the parts that the batch's keys fall into are written."""
        if self.dry_run:
            stored = self.held(name, batch.drop(*order), date)
            self.write(source, file, name, merge.merge_latest(stored, merge.widen(batch, stored.limit(0)), keys, order, fill), date)
            return
        counts = self._table(name, date, keys).upsert(batch, order, fill)
        self.done += [(source, file, a, n) for a, n in counts.items() if n]

    def add_once(self, source: str, file: str, name: str, batch: DataFrame, keys: Sequence[str], order: Sequence[str], date: str | None = None) -> None:
        """Rows of keys that the table lacks; others count as skipped."""
        stored = self.held(name, batch.drop(*order), date)
        new = merge.insert_absent(stored, batch, keys, order).drop(*order).withColumn("action", F.lit("inserted"))
        before = len(self.done)
        self.write(source, file, name, merge.widen(stored.withColumn("action", F.lit("kept")), new), date)
        added = sum(n for _, _, _, n in self.done[before:])
        self.count(source, file, "skipped", batch.count() - added)

    def count(self, source: str, file: str, action: str, n: int) -> None:
        if n:
            self.done.append((source, file, action, n))

    def log_raw(self, platform: str, kind: str, date: str, rows: DataFrame, payload: Sequence[str], order: str, url: str | None = None) -> None:
        """The records as JSON, once for each content of a (platform, type, date, URL, path)."""
        path = f"{self.root}/raw_data"
        held = self.spark.read.schema(RAW).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], RAW)
        held = held.where((F.col("source_platform") == platform) & (F.col("ingestion_date") == F.lit(date).cast("date")) & (F.col("source_type") == kind))
        batch = rows.select("*", *(F.lit(x).alias(c) for c, x in (("source_platform", platform), ("source_type", kind)) if c not in rows.columns))
        batch = batch.withColumn("ingestion_date", F.lit(date).cast("date"))
        for c, value in (("listing_url", F.col(url) if url else F.lit(None).cast("string")), ("file_path", F.lit(kind))):
            batch = batch if c in batch.columns else batch.withColumn(c, value)
        new = merge.append_raw(held, batch, RAW_KEYS, [order], payload)
        self.append("raw_data", new.select(*(f.split()[0] for f in RAW.split(", "))), ["source_platform", "ingestion_date"])

    def aircraft(self, rows: DataFrame, order: Sequence[str]) -> None:
        """Fill the aircraft that rows of resolve_in_order name; new ones are inserted."""
        stored = self.held("aircraft", AIRCRAFT)
        batch = resolve.entity_rows(rows, order)
        facts = [c for c in stored.columns if c != "entity_id"]
        wide = merge.widen(batch, stored.limit(0)).withColumn("_one", F.lit(1))
        self.write("aircraft", "aircraft", "aircraft", merge.merge_latest(stored, wide, ["entity_id"], ["_one"], fill=facts))

    def summary(self) -> DataFrame:
        """(source, file, action, n), with totals of each action over files, and over all sources but the aircraft table."""
        rows = self.spark.createDataFrame(self.done, "source string, file string, action string, n long")
        each = rows.groupBy("source", "file", "action").agg(F.sum("n").alias("n"))
        whole = rows.where("source <> 'aircraft'").rollup("action", "source").agg(F.sum("n").alias("n")).where("action is not null")
        return each.unionByName(whole.select("source", F.lit(None).cast("string").alias("file"), "action", "n"))


def _feed(tables: Tables, path: str, schema: str, limit: int | None) -> DataFrame | None:
    """Records of a feed's files in file order, the first `limit` of each; None where there is no file."""
    if not path_exists(tables.spark, path):
        return None
    rows = readers.json_records(tables.spark, path, schema)
    return rows if limit is None else rows.where(F.col("pos") < limit)


def load_marketplace(tables: Tables, source: str, folder: str, date: str, limit: int | None = None, skip_index: bool = False, manufacturers: bool = False) -> None:
    """A marketplace's index and detail feeds (and those in its manufacturers' folders) into listings, engines and, without
    manufacturers' folders, also history and APUs. Details come after the index, so they win; those of a marketplace with
    manufacturers' folders have what only the index says of their URL."""
    feeds = [("index", f"{folder}/index/listings_metadata.json", False), ("details", f"{folder}/details/details_metadata.json", True)]
    if manufacturers:
        feeds += [("manufacturer_index", f"{folder}/manufacturers/*/{{manufacturer_listings_metadata,listings_metadata}}.json", False), ("manufacturer_details", f"{folder}/manufacturers/*/details/details_metadata.json", True)]
    events, details, base, skipped = None, None, None, []
    for rank, (kind, path, is_detail) in enumerate(feeds):
        feed = None if skip_index and not is_detail else _feed(tables, path, schemas.DETAIL_FEED if is_detail else schemas.INDEX_FEED, limit)
        if feed is None:
            continue
        feed = feed.withColumn("ingestion_date", F.coalesce("ingestion_date", F.lit(date).cast("date")))
        payload = [c for c in feed.columns if c not in ("pos", "file_path", "ingestion_date")]
        tables.log_raw(source, kind, date, feed, payload, "pos")
        skipped.append(feed.where(~clean.not_blank(F.col("listing_url"))).select(F.lit(kind).alias("kind")))
        if not is_detail:
            base = feed if base is None else base.unionByName(feed)
        elif manufacturers and base is not None:
            feed = pipelines.carried_over(feed, base)
        placed = feed.withColumn("rank", F.lit(rank)).withColumn("manufacturer_folder", F.coalesce(readers.folder_of("manufacturers", F.col("file_path")), F.lit("")))
        part = (pipelines.detail_events if is_detail else pipelines.index_events)(placed, source, ["rank", "manufacturer_folder"])
        events = part if events is None else events.unionByName(part)
        if is_detail:
            details = feed if details is None else details.unionByName(feed)
    if events is None:
        return
    for row in reduce(DataFrame.unionByName, skipped).groupBy("kind").count().collect():
        tables.count(source, row["kind"], "skipped", row["count"])
    order = ["date", "rank", "manufacturer_folder", "position"]
    entities = tables.held("aircraft", AIRCRAFT)
    known = resolve.resolve_in_order(events, entities, order)
    stored = tables.held("listings", known.drop("is_new", "took", *(c for c in order if c != "date")).limit(0))
    mine = [c for c in stored.columns if c in known.columns]
    batch = merge.widen(known.select(*mine, *(c for c in order if c not in mine)), stored.limit(0))
    merged = merge.merge_latest(stored, batch, ["url"], order, fill=[*pipelines.LISTING_FILL, "entity_id"], newer="date")
    if not manufacturers:
        shape = ["url", "date", "feed", "position", *("price", "status", "location", "description", "airframe_time")]
        now = events.select(*shape).withColumn("fresh", F.lit(True))
        # What the tables know of a URL is its last event of each feed: that is all that changes are held against.
        past = tables.held("listing_state", now.drop("fresh"))
        told = history.feed_changes(past.withColumn("fresh", F.lit(False)).unionByName(now), only="fresh")
        state = merge.pick_per_key(past.unionByName(now.drop("fresh")), ["url", "feed"], ["date", "position"]).withColumn("action", F.lit("kept"))
        tables.add_once(source, "history", "listing_history", told.withColumn("_one", F.lit(1)), HISTORY, ["_one"], date)
        tables.write(source, "state", "listing_state", state)
    new = known.where("is_new").select(F.col("entity_id").alias("_new"))
    facts = known.join(new, F.col("entity_id") == F.col("_new"), "left_semi").select("entity_id", "is_new", "took", "serial", "registration", "make", "model", "year", *order)
    tables.aircraft(facts, order)
    tables.write(source, "listings", "listings", merged)
    if details is not None:
        where = ["listing_url", "ingestion_date"]
        tables.upsert(source, "engines", "engines", pipelines.engines(details.select("*")).withColumn("_one", F.lit(1)), [*where, "position"], ["_one"], date)
        if not manufacturers:
            apus = history.apu_rows(details, where).withColumn("_one", F.lit(1))
            tables.upsert(source, "apus", "apus", apus, where, ["_one"], date)


def registry_file_rows(rows: DataFrame, columns: Mapping[str, Sequence[str]], ints: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """A registry file's text cells, typed; other names become one list, the kit field two columns."""
    names = [c for c in columns if c.startswith("other_name_")]
    plain = [c for c in columns if c not in names and c != "kit"]
    out = [(clean.whole(F.col(c)) if c in ints else clean.registry_date(F.col(c)) if c in dates else F.col(c)).alias(c) for c in plain]
    if names:
        out.append(clean.filled_list(*map(F.col, names)).alias("other_names"))
    if "kit" in columns:
        out += [clean.kit_maker(F.col("kit"), needs_comma=True).alias("kit_mfr"), clean.kit_model(F.col("kit")).alias("kit_model")]
    return rows.select("seq", *out)


def _limited(rows: DataFrame, offset: int, limit: int | None) -> DataFrame:
    return rows if not offset and limit is None else readers.row_range(rows, "seq", offset, limit)


def load_registry(tables: Tables, folder: str, date: str, limit: int | None = None, master_offset: int = 0) -> None:
    """The registry's seven files into seven tables, its aircraft, and its documents' hashes.

    The type reference is read whole, since it decodes MASTER's codes; limit bounds what is stored of each file.
    """
    spark, source, files = tables.spark, "faa", f"{folder}/extracted"
    reference = None
    for name, file, columns, key, ints, dates, once in schemas.REGISTRY_FILES:
        if not path_exists(spark, f"{files}/{file}"):
            continue
        text = readers.registry_csv(spark, f"{files}/{file}", columns)
        if name == "aircraft_reference":
            reference = text
        text = _limited(text, 0, limit)
        tables.log_raw(source, name, date, text, list(columns), "seq")
        typed = registry_file_rows(text, columns, ints, dates).where(clean.not_blank(F.col(key)))
        tables.count(source, name, "skipped", text.where(~clean.not_blank(F.col(key))).count())
        typed = typed.withColumn("ingestion_date", F.lit(date).cast("date"))
        dated = None if name.endswith("_reference") else date
        (tables.add_once if once else tables.upsert)(source, name, name, typed, [key], ["seq"], dated)
    if path_exists(spark, f"{files}/MASTER.txt"):
        _load_master(tables, f"{files}/MASTER.txt", date, reference, limit, master_offset)
    known = tables.held("documents", "file_path string, file_name string, file_size long, file_hash string, source_platform string, ingestion_date date")
    if path_exists(spark, f"{folder}/*.pdf") or path_exists(spark, f"{files}/*.pdf"):
        found = readers.documents(spark, folder, "*.pdf").withColumn("source_platform", F.lit(source)).withColumn("ingestion_date", F.lit(date).cast("date"))
        new = readers.unknown_documents(found, known).withColumn("action", F.lit("inserted"))
        tables.count(source, "documents", "skipped", found.count() - new.count())
        tables.write(source, "documents", "documents", known.withColumn("action", F.lit("kept")).unionByName(new.select(*known.columns, "action")))


def _load_master(tables: Tables, path: str, date: str, reference: DataFrame | None, limit: int | None, offset: int) -> None:
    spark, source = tables.spark, "faa"
    text = _limited(readers.registry_csv(spark, path, schemas.MASTER), offset, limit)
    if reference is None:
        reference = spark.createDataFrame([], "seq long, code string, manufacturer string, model string")
    rows = pipelines.registry_rows(text, reference)
    kept = ("engine_code", "region", "county", "certification", "aircraft_type", "engine_type", "fract_owner")
    rows = rows.join(text.select("seq", *kept), "seq")
    decoded = text.join(rows.select("seq", "manufacturer", "model", "based_at"), "seq", "left")
    tables.log_raw(source, "master", date, decoded, [*schemas.MASTER, "manufacturer", "model", "based_at"], "seq")
    tables.count(source, "master", "skipped", text.where(~clean.not_blank(F.col("n_number")) & ~clean.not_blank(F.col("serial"))).count())
    tail = text.select("seq", F.col("n_number").alias("_tail"))
    rows = rows.join(tail, "seq").withColumn("registration", F.coalesce(clean.registration(F.col("_tail")), F.lit(""))).drop("_tail")
    found = resolve.get_or_create(rows.withColumn("serial", F.coalesce("serial", F.lit(""))), tables.held("aircraft", AIRCRAFT), "seq", fill=True)
    facts = found.select(
        "entity_id", "is_new", "took", "serial", "registration", F.col("manufacturer").alias("make"), "model", "year", "status", F.col("country").alias("registration_country"),
        F.col("country").alias("based_country"), "air_worth_date", "certification", "aircraft_type", "engine_type", "mode_s_code", "mode_s_code_hex", "seq",
    )
    batch = found.drop("registration", "is_new", "took").withColumn("ingestion_date", F.lit(date).cast("date"))
    tables.upsert(source, "master", "registrations", batch, ["n_number"], ["seq"], date)
    tables.aircraft(facts, ["seq"])


def load_internal(tables: Tables, folder: str, limit: int | None = None, aircraft: bool = True, sales: bool = True) -> None:
    """The internal fleet's aircraft and sales. A registration that another aircraft has is not set."""
    spark, source = tables.spark, "internaldb"
    if aircraft and path_exists(spark, f"{folder}/{schemas.FLEET_FILE}"):
        rows = _limited(readers.dynamic_csv(spark, f"{folder}/{schemas.FLEET_FILE}", schemas.FLEET), 0, limit)
        valid = rows.where(clean.not_blank(F.col("serial_number")) | clean.not_blank(F.col("registration_number")))
        tables.count(source, "aircraft", "skipped", rows.count() - valid.count())
        c = F.col
        found = valid.select(
            F.coalesce("serial_number", F.lit("")).alias("serial"), F.coalesce("registration_number", F.lit("")).alias("registration"), c("manufacturer").alias("make"), "model",
            c("manufacturer_year").alias("year"), "delivery_year", "category", c("aircraft_status").alias("status"), c("number_of_passengers").alias("passengers"), "registration_country", "based_country", "seq",
        )
        found = resolve.get_or_create(found, tables.held("aircraft", AIRCRAFT), "seq", fill=True)
        tables.count(source, "aircraft", "inserted", n := found.where("is_new").select("entity_id").distinct().count())
        tables.count(source, "aircraft", "updated", found.select("entity_id").distinct().count() - n)
        tables.aircraft(found, ["seq"])
    if sales and path_exists(spark, f"{folder}/{schemas.SALES_FILE}"):
        rows = _limited(readers.dynamic_csv(spark, f"{folder}/{schemas.SALES_FILE}", schemas.SALES), 0, limit)
        ids = tables.held("aircraft", AIRCRAFT).where("serial <> ''").groupBy(F.col("serial").alias("serial_number")).agg(F.min("entity_id").alias("entity_id"))
        valid = pipelines.sale_rows(rows)
        tables.count(source, "sales", "skipped", rows.count() - valid.count())
        tables.add_once(source, "sales", "sales", valid.join(ids, "serial_number", "left"), ["serial_number", "date_sold"], ["seq"])


def load_costs(tables: Tables, folder: str, date: str, limit: int | None = None, raw: bool = True) -> None:
    """The cost reference, upserted by its detail id."""
    path = f"{folder}/aircraft_details.json"
    if not path_exists(tables.spark, path):
        return
    feed = readers.json_records(tables.spark, path, schemas.COST_FEED, "data")
    feed = feed if limit is None else feed.where(F.col("pos") < limit)
    if raw:
        tables.log_raw("aviacost", "aircraft_details", date, feed, [c for c in feed.columns if c not in ("pos", "file_path", "ingestion_date")], "pos")
    tables.count("aviacost", "details", "skipped", feed.where("aircraftDetailId is null").count())
    batch = pipelines.cost_rows(feed).withColumn("ingestion_date", F.lit(date).cast("date"))
    tables.upsert("aviacost", "details", "cost_reference", batch, ["detail_id"], ["pos"])


def load_fleet_pages(tables: Tables, folder: str, date: str, limit: int | None = None, raw: bool = True) -> None:
    """Extracted fleet pages, upserted by entity and date. Not part of load_all."""
    path = f"{folder}/fleet_extracted.json"
    if not path_exists(tables.spark, path):
        return
    feed = readers.json_records(tables.spark, path, schemas.FLEET_PAGES, "aircraft").withColumn("ingestion_date", F.lit(date).cast("date"))
    feed = feed if limit is None else feed.where(F.col("pos") < limit)
    if raw:
        tables.log_raw("aircraftpost", "fleet_aircraft", date, feed, [c for c in feed.columns if c not in ("pos", "file_path", "ingestion_date")], "pos")
    tables.count("aircraftpost", "fleet", "skipped", feed.where("aircraft_entity_id is null").count())
    tables.upsert("aircraftpost", "fleet", "fleet_pages", pipelines.fleet_page_rows(feed), ["entity_id"], ["pos"], date)


def chosen(limits: Mapping[str, int] | None = None, only: str | None = None, test: bool = False) -> dict[str, int | None]:
    """Each source's limit: None for all records, a number for the first ones, SKIP for none.

    only: a single source. test: the first ten records, but for the cost reference. Where exactly one source is given a
    limit, the others are skipped.
    """
    out: dict[str, int | None] = {s: (limits or {}).get(s) for s in schemas.SOURCES}
    if unknown := {*(limits or {}), *([only] if only else [])} - set(schemas.SOURCES):
        raise ValueError(f"no such source: {', '.join(sorted(unknown))}")
    if test:
        out |= {s: 10 for s in schemas.SOURCES if s != "aviacost"}
    given = [s for s, n in out.items() if n is not None]
    alone = only or (given[0] if len(given) == 1 and not test and out[given[0]] != SKIP else None)
    return {s: n if alone in (None, s) else SKIP for s, n in out.items()}


def load_all(spark: SparkSession, raw: str, root: str, limits: Mapping[str, int] | None = None, only: str | None = None, test: bool = False, skip_index: bool = False, internal: str | None = None, master_offset: int = 0, dry_run: bool = False) -> DataFrame:
    """Load the newest snapshot of every source under `raw` into the tables under `root`, in order; returns the summary.

    skip_index: without the first marketplace's index. internal: aircraft_only or sales_only.
    """
    tables, limit = Tables(spark, root, dry_run), chosen(limits, only, test)
    a, b, registry, fleet, costs = schemas.SOURCES
    for source in (s for s in schemas.SOURCES if limit[s] != SKIP):
        folder = f"{raw.rstrip('/')}/{source}"
        if source == fleet:
            load_internal(tables, folder, limit[source], aircraft=internal != "sales_only", sales=internal != "aircraft_only")
            continue
        newest = readers.latest_snapshot(spark, folder)
        if newest is None:
            continue
        date = newest.rsplit("/", 1)[1]
        if source == a:
            load_marketplace(tables, source, newest, date, limit[source], skip_index)
        elif source == b:
            load_marketplace(tables, source, newest, date, limit[source], manufacturers=True)
        elif source == registry:
            load_registry(tables, newest, date, limit[source], master_offset)
        elif source == costs:
            load_costs(tables, newest, date, limit[source])
    out = tables.summary()
    if not dry_run:
        out.withColumn("loaded_at", F.current_timestamp()).write.mode("append").parquet(f"{root.rstrip('/')}/ingestion_runs")
    return out
