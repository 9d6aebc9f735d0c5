"""Scalar cleaning functions over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.plans import pipelines
from avmatch.plans.registry import query
from avmatch.plans.views import FLEET, REG, SNAP, fleet, registry, snapshots, table


@query(f"WITH {SNAP} SELECT seq, CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS DOUBLE) AS price FROM snap")
def clean_price(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots(spark, sf).select("seq", clean.price(F.col("price_text")).cast("double").alias("price"))


FORMS = "CASE event_id % 6 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%m/%d/%Y') WHEN 2 THEN strftime(ts, '%Y/%m/%d') WHEN 3 THEN strftime(ts, '%d/%m/%Y') WHEN 4 THEN strftime(ts, '%Y%m%d') ELSE 'n/a' END"


@query(
    f"""WITH e AS (SELECT event_id, {FORMS} AS x FROM events), p AS (SELECT event_id, x, coalesce(try_strptime(x, '%Y-%m-%d'),
  try_strptime(x, '%m/%d/%Y'), try_strptime(x, '%Y/%m/%d'), try_strptime(x, '%d/%m/%Y')) AS d,
  CASE WHEN regexp_full_match(x, '[0-9]{{8}}') THEN try_strptime(x, '%Y%m%d') END AS c FROM e)
SELECT event_id, strftime(CASE WHEN NOT regexp_full_match(x, '[0-9]{{8}}') THEN d END, '%Y-%m-%d') AS loader_date, strftime(c, '%Y-%m-%d') AS compact_date,
  strftime(coalesce(c, d), '%Y-%m-%d') AS registry_date FROM p"""
)
def clean_dates(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id") % 6
    forms = ("yyyy-MM-dd", "MM/dd/yyyy", "yyyy/MM/dd", "dd/MM/yyyy", "yyyyMMdd")
    text = F.lit("n/a")
    for n, form in enumerate(forms):
        text = F.when(k == n, F.date_format("ts", form)).otherwise(text)
    x = F.col("x")
    out = table(spark, sf, "events").select("event_id", text.alias("x"))
    return out.select("event_id", *(f(x).cast("string").alias(n) for f, n in ((clean.date, "loader_date"), (clean.compact_date, "compact_date"), (clean.registry_date, "registry_date"))))


@query("""WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '1,' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') WHEN 1 THEN CAST(value AS VARCHAR)
  WHEN 2 THEN 'x' || event_id ELSE '-' || event_id || '.75' END AS x FROM events), p AS (SELECT event_id, x,
  CASE WHEN regexp_full_match(replace(x, ',', ''), '\\s*[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*') THEN try_cast(replace(x, ',', '') AS DOUBLE) END AS v FROM e)
SELECT event_id, CAST(trunc(v) AS INTEGER) AS whole, v AS number, CASE WHEN regexp_full_match(x, '-?[0-9]+') THEN try_cast(x AS SMALLINT) END AS small FROM p""")
def clean_ints(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    text = F.when(k % 4 == 0, F.concat(F.lit("1,"), F.lpad((k % 1000).cast("string"), 3, "0"))).when(k % 4 == 1, F.col("value").cast("string")).when(k % 4 == 2, F.concat(F.lit("x"), k))
    rows = table(spark, sf, "events").select("event_id", text.otherwise(F.concat(F.lit("-"), k, F.lit(".75"))).alias("x"))
    x = F.col("x")
    return rows.select("event_id", clean.whole(x).alias("whole"), clean.number(x).alias("number"), clean.strict_whole(x, "smallint").alias("small"))


@query("""WITH p AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'M/O' WHEN 1 THEN '$1,' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.50' WHEN 2 THEN '—'
  WHEN 3 THEN ' tbd ' ELSE '€ ' || p_size END AS x FROM part)
SELECT p_partkey, CASE WHEN upper(trim(x)) NOT IN ('M/O', 'N/A', '-', '—', 'NA', 'TBD') THEN try_cast(regexp_replace(x, '[$€£, ]', '', 'g') AS DOUBLE) END AS amount FROM p""")
def clean_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey") % 5, F.col("p_size").cast("string")
    text = F.when(k == 0, "M/O").when(k == 1, F.concat(F.lit("$1,"), F.lpad(size, 3, "0"), F.lit(".50"))).when(k == 2, "—").when(k == 3, " tbd ").otherwise(F.concat(F.lit("€ "), size))
    return table(spark, sf, "part").select("p_partkey", clean.money(text).cast("double").alias("amount"))


CANON = "nullif(regexp_replace(regexp_replace(upper(trim({0})), '[ -]', '', 'g'), '^N', ''), '')"
NORM = "regexp_replace(upper(trim({0})), '[ .-]', '', 'g')"
SKEY = f"CASE WHEN regexp_full_match({NORM}, '[0-9]+') THEN regexp_replace({NORM}, '^0+([0-9])', '\\1') ELSE {NORM} END"
REGN = "nullif(substr(split_part(regexp_replace(trim(regexp_replace({0}, '\\([^)]*\\)', '', 'g')), '\\s+', ' ', 'g'), ' ', 1), 1, 50), '')"
RKEY = f"nullif(replace(upper({REGN}), '-', ''), '')"


@query(f"WITH {FLEET} SELECT id, {REGN.format('registration')} AS cleaned, {RKEY.format('registration')} AS reg_key, {CANON.format('registration')} AS n_canon, regexp_replace(upper(trim(registration)), '[ -]', '', 'g') AS plain FROM fleet")
def clean_registration(spark: SparkSession, sf: str) -> DataFrame:
    r = F.col("registration")
    return fleet(spark, sf).select("id", clean.registration(r).alias("cleaned"), clean.registration_key(r).alias("reg_key"), clean.canonical_n(r).alias("n_canon"), clean.plain_registration(r).alias("plain"))


@query(f"WITH {FLEET} SELECT id, {NORM.format('serial')} AS norm, {SKEY.format('serial')} AS serial_key, CASE WHEN regexp_matches(serial, '^0+[^0]') THEN regexp_replace(serial, '^0+', '') END AS alias FROM fleet")
def serial_keys(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("serial")
    return fleet(spark, sf).select("id", clean.serial_norm(s).alias("norm"), clean.serial_key(s).alias("serial_key"), F.get(clean.serial_lookup_keys(s), F.lit(1)).alias("alias"))


BARE = "regexp_replace({0}, '^N', '')"
TAIL = f"coalesce({RKEY.format('serial')} = {RKEY.format('n_number')} OR {BARE.format(RKEY.format('serial'))} = {RKEY.format('n_number')} OR {RKEY.format('serial')} = {BARE.format(RKEY.format('n_number'))}, false)"


@query(f"WITH {REG} SELECT seq, {TAIL} AS is_tail, upper(regexp_replace(n_number, '\\s+', '', 'g')) AS squeezed FROM reg")
def tail_equals_serial(spark: SparkSession, sf: str) -> DataFrame:
    return registry(spark, sf).select("seq", clean.serial_is_tail(F.col("serial"), F.col("n_number")).alias("is_tail"), clean.squeezed_n(F.col("n_number")).alias("squeezed"))


@query("""SELECT p_partkey, nullif(substr(trim(p_name), 1, 5), '') AS clipped, CASE WHEN length(p_type) > 4 THEN substr(p_type, 1, 4) || '...' ELSE p_type END AS dotted,
  CASE WHEN trim(CASE WHEN p_size % 2 = 0 THEN 'V ' ELSE 'R' END) = 'V' THEN 'Active' ELSE 'Inactive' END AS status,
  coalesce(nullif(trim(CASE WHEN p_size % 3 = 0 THEN ' ' ELSE p_brand END), ''), 'US') AS country,
  nullif(trim(split_part(p_name || ', ' || p_type, ',', 1)), '') AS kit_maker, p_type AS kit_model FROM part""")
def text_fields(spark: SparkSession, sf: str) -> DataFrame:
    kit = F.concat("p_name", F.lit(", "), "p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        clean.clip(F.col("p_name"), 5).alias("clipped"),
        clean.clip_with_dots(F.col("p_type"), 4).alias("dotted"),
        clean.status_name(F.when(F.col("p_size") % 2 == 0, "V ").otherwise("R")).alias("status"),
        clean.country_or_us(F.when(F.col("p_size") % 3 == 0, " ").otherwise(F.col("p_brand"))).alias("country"),
        clean.kit_maker(kit, needs_comma=True).alias("kit_maker"),
        clean.kit_model(kit).alias("kit_model"),
    )


@query("""WITH p AS (SELECT p_partkey, list_filter([trim(p_name), CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END, NULL, p_type], lambda x: x IS NOT NULL AND x <> '') AS names,
  list_filter(list_transform(string_split(p_name || ', ,' || p_type, ','), lambda x: trim(x)), lambda x: x <> '') AS parts, p_size, p_name, p_type FROM part)
SELECT p_partkey, array_to_string(names, '|') AS names, array_to_string(parts, '|') AS parts, p_size - 25 > 0 AS deferred,
  CASE WHEN p_size % 3 = 0 THEN false WHEN p_size % 3 = 1 THEN true END AS for_sale, p_size % 5 = 0 AS damaged,
  array_to_string(list_filter([CASE WHEN p_size % 2 = 0 THEN 'Avionics: ' || p_name END, 'Equipment: ' || p_type], lambda x: x IS NOT NULL), '|') AS labels FROM p""")
def list_fields(spark: SparkSession, sf: str) -> DataFrame:
    even, third = F.col("p_size") % 2 == 0, F.col("p_size") % 3
    none = F.lit(None).cast("string")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array_join(clean.filled_list(F.col("p_name"), F.when(even, "").otherwise(F.col("p_brand")), none, F.col("p_type")), "|").alias("names"),
        F.array_join(clean.comma_list(F.concat("p_name", F.lit(", ,"), "p_type")), "|").alias("parts"),
        clean.deferred(F.col("p_size") - 25).alias("deferred"),
        clean.for_sale(F.when(third == 1, "true").when(third == 2, "maybe")).alias("for_sale"),
        clean.is_true_text(F.when(F.col("p_size") % 5 == 0, " TRUE").otherwise(F.col("p_type"))).alias("damaged"),
        F.array_join(clean.feature_labels(F.when(even, F.col("p_name")), F.col("p_type"), none), "|").alias("labels"),
    )


@query(f"""WITH {SNAP}, t AS (SELECT seq, url, substr(date, 1, 4) || ' Make' || (seq % 7) || ' Model ' || status || ' X' AS title, (seq % 3000) || ' hrs / ' || (seq % 9) || ' Years' AS tbo FROM snap)
SELECT seq, 'Make' || (seq % 7) AS make, split_part(title, ' ', 3) || ' ' || split_part(title, ' ', 4) || ' ' || split_part(title, ' ', 5) AS model, CAST(substr(title, 1, 4) AS INTEGER) AS year,
  CAST(seq % 3000 AS INTEGER) AS hours, CAST(seq % 9 AS INTEGER) AS years, regexp_extract(url, '/for-sale/([^/]+)', 1) AS listing FROM t""")
def title_fields(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    title = F.concat(F.substring("date", 1, 4), F.lit(" Make"), F.col("seq") % 7, F.lit(" Model "), F.col("status"), F.lit(" X"))
    tbo = F.concat(F.col("seq") % 3000, F.lit(" hrs / "), F.col("seq") % 9, F.lit(" Years"))
    return rows.select("seq", clean.make_of(title).alias("make"), clean.model_of(title).alias("model"), clean.year_in(title).alias("year"), clean.overhaul_hours(tbo).alias("hours"), clean.overhaul_years(tbo).alias("years"), clean.listing_id(F.col("url")).alias("listing"))


@query("""SELECT page_id, try_cast(nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS INTEGER) AS page, nullif(regexp_extract(url, '^[a-z]+://([^/]*)', 1), '') AS host,
  nullif(regexp_extract(regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*', ''), '[?#].*$', ''), '/([^/]+)/[^/]*/?$', 1), '') AS listing FROM pages""")
def url_parts(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", clean.page_number(u).alias("page"), F.nullif(F.regexp_extract(u, "^[a-z]+://([^/]*)", 1), F.lit("")).alias("host"), clean.listing_id(u).alias("listing"))


@query(f"""WITH {FLEET}, h AS (SELECT id, sha1(unhex('{clean.FLEET_NAMESPACE}') || encode(serial || '|' || registration || '|' || make || '|' || model || '|' || size || '||')) AS h FROM fleet)
SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4 + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS aircraft_id FROM h""")
def stable_uuid(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return fleet(spark, sf).select("id", clean.stable_id(F.col("serial"), F.col("registration"), F.col("make"), F.col("model"), F.col("size"), none, none).alias("aircraft_id"))


@query("""SELECT CAST(event_id AS INTEGER) AS detail_id, nullif(trim(CASE WHEN event_id % 5 = 0 THEN ' ' ELSE event_type END), '') AS name, 'M' || user_id AS manufacturer, event_type AS category,
  coalesce(nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0), value) AS variable_cost_per_hour, CAST(json_extract_string(props, '$.k') AS INTEGER) AS passengers_max, strftime(ts, '%Y-%m-%d %H:%M') AS updated_on FROM events""")
def json_flatten(spark: SparkSession, sf: str) -> DataFrame:
    c, none = F.col, F.lit(None)
    k = F.get_json_object("props", "$.k")
    feed = table(spark, sf, "events").select(
        c("event_id").cast("int").alias("aircraftDetailId"), F.when(c("event_id") % 5 == 0, " ").otherwise(c("event_type")).alias("name"), none.cast("string").alias("description"),
        F.struct(none.cast("int").alias("aircraftManufacturerId"), F.concat(F.lit("M"), "user_id").alias("name")).alias("aircraftManufacturer"), F.struct(none.cast("int").alias("aircraftCategoryId"), c("event_type").alias("category")).alias("aircraftCategory"),
        *(none.cast("string").alias(x) for x in ("avionics", "yearsInProduction", "powerplant", "model")), *(none.cast("double").alias(x) for x in ("averagePreOwnedPrice", "fuelGallons", "normalCruiseSpeedKts", "seatsFullRangeNm", "maxTakeoffWeight")),
        k.cast("double").alias("totalVariableCostPerHrsValue"), c("value").alias("calc_TotalVariableCostPerHour"), k.cast("double").alias("typicalPassengerCapacityMax"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("lastUpdatedOn"), F.lit(0).alias("pos"),
    )
    out = pipelines.cost_rows(feed)
    return out.select("detail_id", "name", "manufacturer", "category", "variable_cost_per_hour", "passengers_max", F.date_format("updated_on", "yyyy-MM-dd HH:mm").alias("updated_on"))


@query("""SELECT p_partkey AS entity_id, 'S' || p_partkey AS serial, CAST(p_size + 1950 AS INTEGER) AS year, substr(p_type, 1, 20) AS base_code, '/o/' || p_partkey AS owner_url, upper(p_brand) AS owner,
  CAST(p_partkey AS INTEGER) AS airframe_hours, CASE p_partkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS for_sale FROM part""")
def map_projection(spark: SparkSession, sf: str) -> DataFrame:
    k, text = F.col("p_partkey"), lambda x: x.cast("string")
    owner = F.to_json(F.struct(F.upper("p_brand").alias("text"), F.concat(F.lit("/o/"), k).alias("href")))
    sale = F.when(k % 3 == 0, "true").when(k % 3 == 2, "maybe")
    fields = F.create_map(F.lit("MFR Year"), text(F.col("p_size") + 1950), F.lit("Base"), F.col("p_type"), F.lit("Owner"), owner, F.lit("Airframe Hours"), F.concat(F.lit(" "), text(k)), F.lit("For Sale"), sale)
    records = table(spark, sf, "part").select(k.alias("aircraft_entity_id"), F.lit("2024-02-01").cast("date").alias("ingestion_date"), F.lit(1).alias("make_model_id"), F.lit("m").alias("make_model_name"), F.concat(F.lit("S"), k).alias("serial_number"), fields.alias("fields"), F.lit(0).alias("pos"))
    out = pipelines.fleet_page_rows(records)
    return out.select("entity_id", "serial", "year", "base_code", "owner_url", clean.cell_text(F.col("fields")["Owner"]).alias("owner"), "airframe_hours", "for_sale")


@query("""WITH e AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M') WHEN 1 THEN strftime(ts, '%m/%d/') || '98' WHEN 2 THEN strftime(ts, '%m/%d/') || '07' WHEN 3 THEN strftime(ts, '%d/%m/%Y') ELSE 'soon' END AS x, ts FROM events),
  p AS (SELECT event_id, CASE event_id % 5 WHEN 0 THEN try_strptime(substr(x, 1, 10), '%Y-%m-%d') WHEN 1 THEN try_strptime(strftime(ts, '%m/%d/') || '1998', '%m/%d/%Y') WHEN 2 THEN try_strptime(strftime(ts, '%m/%d/') || '2007', '%m/%d/%Y')
    WHEN 3 THEN coalesce(try_strptime(x, '%m/%d/%Y'), try_strptime(x, '%d/%m/%Y')) END AS d, ts FROM e)
SELECT event_id, strftime(d, '%Y-%m-%d') AS fleet_date, CASE WHEN event_id % 7 > 0 THEN strftime(ts, '%Y-%m-%d %H:%M') END AS stamp FROM p""")
def fleet_dates(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id") % 5
    text = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).when(k == 1, F.concat(F.date_format("ts", "MM/dd/"), F.lit("98"))).when(k == 2, F.concat(F.date_format("ts", "MM/dd/"), F.lit("07"))).when(k == 3, F.date_format("ts", "dd/MM/yyyy")).otherwise("soon")
    stamp = F.when(F.col("event_id") % 7 > 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("not a time")
    return table(spark, sf, "events").select("event_id", clean.fleet_date(text).cast("string").alias("fleet_date"), F.date_format(clean.iso_timestamp(stamp), "yyyy-MM-dd HH:mm").alias("stamp"))


@query("""SELECT p_partkey, nullif(trim(p_brand), '') AS stripped, CASE WHEN p_size % 2 = 0 THEN p_brand || '|' || p_type ELSE p_type END AS listed, CASE WHEN p_size % 3 = 0 THEN p_type ELSE p_brand END AS first_filled,
  'https://x.example/' || p_partkey || '/a?b=1&c=' || p_size AS url, CAST(p_partkey AS VARCHAR) || '000' AS hours, p_name || ' ' || p_brand AS collapsed,
  CASE p_size % 3 WHEN 0 THEN p_brand || ', ' || p_type WHEN 1 THEN p_type END AS place FROM part""")
def text_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    brand, kind = F.col("p_brand"), F.col("p_type")
    as_list = F.when(size % 2 == 0, F.to_json(F.array(F.concat(F.lit(" "), brand), kind, F.lit(" ")))).otherwise(F.concat(F.lit(" "), kind))
    url = F.concat(F.lit("https:\\u002f\\u002fx.example/"), k, F.lit("/a?b=1&amp;c="), size)
    return table(spark, sf, "part").select(
        "p_partkey",
        clean.strip_nulls(F.concat(F.lit(" \u0000"), brand, F.lit("\u0000 "))).alias("stripped"),
        F.array_join(clean.list_from_json(as_list), "|").alias("listed"),
        clean.first_filled(F.when(size % 3 == 0, " ").otherwise(brand), kind).alias("first_filled"),
        clean.normal_url(url).alias("url"),
        clean.hours_text(F.concat(k, F.lit(",000 SNEW"))).alias("hours"),
        clean.collapse(F.concat(F.lit("  "), F.col("p_name"), F.lit(" \n\t"), brand)).alias("collapsed"),
        clean.place(F.when(size % 3 == 0, brand).otherwise(" "), F.when(size % 3 < 2, kind)).alias("place"),
    )
