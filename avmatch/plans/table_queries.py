"""Merges, history, matching, audits and repairs over the domain views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from avmatch import schemas
from avmatch.functions import clean
from avmatch.operators import audit, history, lookup, match, merge, repair, resolve
from avmatch.plans import pipelines
from avmatch.plans.registry import query
from avmatch.plans.scalar_queries import CANON, SKEY, TAIL
from avmatch.plans.views import CODES, FLEET, REF, REG, SNAP, fleet, reference, registry, snapshots, table, types
from avmatch.sources import readers

#: Snapshots up to this date are the stored table, later ones the batch.
CUT = "1998-06-30"


@query(f"WITH {SNAP} SELECT * FROM snap WHERE date = (SELECT max(date) FROM snap)")
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.newest_snapshot(snapshots(spark, sf), "date")


def _per_key(order: str) -> str:
    return f"WITH {SNAP} SELECT * FROM snap QUALIFY row_number() OVER (PARTITION BY url ORDER BY {order}) = 1"


@query(_per_key("date DESC, seq DESC"))
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge.pick_per_key(snapshots(spark, sf), ["url"], ["date", "seq"])


@query(_per_key("seq"))
def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge.pick_per_key(snapshots(spark, sf), ["url"], ["seq"], last=False)


@query(_per_key("seq DESC"))
def last_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return merge.pick_per_key(snapshots(spark, sf), ["url"], ["seq"])


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 100")
def row_window(spark: SparkSession, sf: str) -> DataFrame:
    return readers.row_range(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 500)


LAST = "SELECT * FROM snap WHERE {0} QUALIFY row_number() OVER (PARTITION BY url ORDER BY {1}) = 1"
SPLIT = f"{SNAP}, old AS ({LAST.format(f'date <= {CUT!r}', 'date DESC, seq DESC')}), new AS ({LAST.format(f'date > {CUT!r}', 'seq DESC')})"


def _stored(rows: DataFrame) -> DataFrame:
    return merge.pick_per_key(rows.where(F.col("date") <= CUT), ["url"], ["date", "seq"])


@query(f"""WITH {SPLIT} SELECT coalesce(n.url, o.url) AS url, coalesce(n.price_text, o.price_text) AS price_text, coalesce(n.date, o.date) AS date, coalesce(n.seq, o.seq) AS seq,
  CASE WHEN n.url IS NULL THEN 'kept' WHEN o.url IS NULL THEN 'inserted' ELSE 'updated' END AS action FROM old o FULL JOIN new n ON o.url = n.url""")
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    out = merge.merge_latest(_stored(rows), rows.where(F.col("date") > CUT), ["url"], ["seq"])
    return out.select("url", "price_text", "date", "seq", "action")


@query(f"""WITH {SPLIT}, told AS (SELECT url, arg_max(location, seq) AS location FROM snap WHERE date > {CUT!r} AND location NOT LIKE '1%' GROUP BY url)
SELECT coalesce(n.url, o.url) AS url, coalesce(t.location, o.location) AS location, CASE WHEN n.url IS NULL THEN o.status ELSE n.status END AS status FROM old o FULL JOIN new n ON o.url = n.url LEFT JOIN told t ON t.url = n.url""")
def merge_fill(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    batch = rows.where(F.col("date") > CUT).withColumn("location", F.when(~F.col("location").like("1%"), F.col("location")))
    return merge.merge_latest(_stored(rows), batch, ["url"], ["seq"], fill=["location"]).select("url", "location", "status")


@query(f"""WITH {SNAP}, old AS ({LAST.format('seq % 2 = 0', 'date DESC, seq DESC')}), new AS ({LAST.format('seq % 2 = 1', 'seq DESC')})
SELECT coalesce(n.url, o.url) AS url, CASE WHEN n.url IS NULL OR o.date > n.date THEN o.seq ELSE n.seq END AS seq,
  CASE WHEN n.url IS NULL THEN 'kept' WHEN o.url IS NULL THEN 'inserted' WHEN o.date > n.date THEN 'skipped' ELSE 'updated' END AS action FROM old o FULL JOIN new n ON o.url = n.url""")
def older_batch_skip(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    stored = merge.pick_per_key(rows.where("seq % 2 = 0"), ["url"], ["date", "seq"])
    return merge.merge_latest(stored, rows.where("seq % 2 = 1"), ["url"], ["seq"], newer="date").select("url", "seq", "action")


@query(f"""WITH {SNAP}, old AS (SELECT * FROM snap WHERE date <= '1995-12-31'), new AS (SELECT * FROM snap WHERE date > '1995-12-31' QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1)
SELECT url, seq FROM new WHERE url NOT IN (SELECT url FROM old)""")
def insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    return merge.insert_absent(rows.where("date <= '1995-12-31'"), rows.where("date > '1995-12-31'"), ["url"], ["seq"]).select("url", "seq")


RAW = "SELECT event_type AS kind, CAST(ts AS DATE) AS day, event_id, '{\"event_type\":\"' || event_type || '\",\"k\":' || json_extract_string(props, '$.k') || '}' AS raw FROM events"


@query(f"""WITH r AS ({RAW}), held AS (SELECT * FROM r WHERE event_id % 3 = 0), new AS (SELECT * FROM r WHERE event_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY kind, day, raw ORDER BY event_id) = 1)
SELECT kind, event_id, raw, sha256(raw) AS raw_hash FROM new n WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.kind = n.kind AND h.day = n.day AND h.raw = n.raw)""")
def raw_append_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select("event_id", "event_type", F.col("event_type").alias("kind"), F.to_date("ts").alias("day"), F.get_json_object("props", "$.k").cast("int").alias("k"))
    held = rows.where("event_id % 3 = 0").withColumn("raw_hash", F.sha2(F.to_json(F.struct("event_type", "k")), 256))
    out = merge.append_raw(held, rows.where("event_id % 3 <> 0"), ["kind", "day"], ["event_id"], ["event_type", "k"])
    return out.select("kind", "event_id", "raw", "raw_hash")


CHANGES = f"""{SNAP}, ev AS (SELECT *, CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS BIGINT) AS price FROM snap),
  l AS (SELECT *, lag(price) OVER w AS p0, lag(location) OVER w AS l0, lag(status) OVER w AS s0, row_number() OVER w AS n FROM ev WINDOW w AS (PARTITION BY url ORDER BY date, seq)),
  ch AS (SELECT url, 'price' AS field, CAST(nullif(p0, 0) AS VARCHAR) AS old_value, CAST(nullif(price, 0) AS VARCHAR) AS new_value, date AS change_date FROM l WHERE n > 1 AND price IS DISTINCT FROM p0
    UNION ALL SELECT url, 'location', l0, location, date FROM l WHERE n > 1 AND location IS DISTINCT FROM l0
    UNION ALL SELECT url, 'status', s0, status, date FROM l WHERE n > 1 AND status IS DISTINCT FROM s0)"""


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf).withColumn("price", clean.price(F.col("price_text"), "bigint"))
    return history.changes(rows, "url", ["date", "seq"], ["price", "location", "status"], "date")


@query(f"WITH {CHANGES} SELECT * FROM ch")
def change_history(spark: SparkSession, sf: str) -> DataFrame:
    return _changes(spark, sf)


@query(f"WITH {CHANGES} SELECT field, count(*) AS n, max(change_date) AS last_change FROM ch GROUP BY field ORDER BY n DESC, field")
def history_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _changes(spark, sf).groupBy("field").agg(F.count("*").alias("n"), F.max("change_date").alias("last_change")).orderBy(F.desc("n"), "field")


@query("""SELECT l_orderkey, l_linenumber, position, make_model, serial_number FROM (
  SELECT l_orderkey, l_linenumber, 1 AS position, l_returnflag AS make_model, CAST(l_partkey AS VARCHAR) AS serial_number FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 2, CASE WHEN l_suppkey % 2 = 0 THEN l_linestatus END, CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_suppkey AS VARCHAR) ELSE '' END FROM lineitem)
WHERE coalesce(trim(make_model) <> '', false) OR coalesce(trim(serial_number) <> '', false)""")
def engine_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_suppkey")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_returnflag").alias("engine1_make_model"),
        F.col("l_partkey").cast("string").alias("engine1_serial_number"),
        F.when(k % 2 == 0, F.col("l_linestatus")).alias("engine2_make_model"),
        F.when(k % 3 == 0, k.cast("string")).otherwise("").alias("engine2_serial_number"),
    )
    return history.unpivot_engines(rows, ["l_orderkey", "l_linenumber"], ["make_model", "serial_number"])


@query("SELECT l_orderkey, l_linenumber, l_linestatus AS make_model FROM lineitem WHERE l_returnflag = 'R'")
def apu_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").withColumn("apu", F.when(F.col("l_returnflag") == "R", F.col("l_linestatus")))
    return history.apu_rows(rows, ["l_orderkey", "l_linenumber"])


@query(f"""WITH {REG}, t AS (SELECT (['{"', '".join(CODES)}'])[p_partkey % 5 + 1] AS code, p_brand, p_type, p_partkey FROM part), one AS (SELECT code, arg_max(p_brand, p_partkey) AS manufacturer, arg_max(p_type, p_partkey) AS aircraft_model FROM t GROUP BY code)
SELECT seq, n_number, reg.code, manufacturer, aircraft_model FROM reg LEFT JOIN one ON reg.code = one.code""")
def code_decode(spark: SparkSession, sf: str) -> DataFrame:
    return pipelines.decoded(registry(spark, sf), types(spark, sf)).select("seq", "n_number", "code", "manufacturer", "aircraft_model")


ENTITIES = "ent AS (SELECT id AS entity_id, serial, regexp_replace(upper(trim(registration)), '[ -]', '', 'g') AS registration FROM fleet)"


@query(f"""WITH {REG}, {FLEET}, {ENTITIES}, bs AS (SELECT serial, min(entity_id) AS i FROM ent WHERE serial <> '' GROUP BY serial), br AS (SELECT registration, min(entity_id) AS i FROM ent WHERE registration <> '' GROUP BY registration)
SELECT seq, coalesce(bs.i, br.i) AS entity_id, CASE WHEN bs.i IS NOT NULL THEN 'serial' WHEN br.i IS NOT NULL THEN 'registration' END AS matched_by
FROM reg LEFT JOIN bs ON reg.serial = bs.serial LEFT JOIN br ON 'N' || reg.n_number = br.registration""")
def entity_resolve(spark: SparkSession, sf: str) -> DataFrame:
    entities = fleet(spark, sf).select(F.col("id").alias("entity_id"), "serial", clean.plain_registration(F.col("registration")).alias("registration"))
    records = registry(spark, sf).select("seq", "serial", F.concat(F.lit("N"), "n_number").alias("registration"))
    return resolve.lookup(records, entities).select("seq", "entity_id", "matched_by")


@query(f"""WITH {REG}, own AS (SELECT seq, serial, n_number, coalesce(nullif(serial, ''), n_number) AS own FROM reg)
SELECT o.seq, arg_min(h.own, h.seq) AS entity_key FROM own o JOIN own h ON h.serial = o.serial OR h.n_number = o.n_number GROUP BY o.seq""")
def entity_new_keys(spark: SparkSession, sf: str) -> DataFrame:
    records = registry(spark, sf).select("seq", "serial", F.col("n_number").alias("registration"))
    return resolve.new_keys(records, "seq").select("seq", "entity_key")


#: Records whose serials and registrations chain: a registration may be the next customer's. Chains end between customers
#: of which neither an order nor a stored aircraft names the next one.
CHAIN_ROWS = """src AS (SELECT o_orderkey AS seq, o_custkey AS c, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'S' || o_custkey END AS s,
    CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'N' || (o_custkey + CASE WHEN o_orderkey % 40 = 7 THEN 1 ELSE 0 END) END AS r FROM orders),
  ent AS (SELECT 'e' || c_custkey AS id, 'S' || c_custkey AS s, 'N' || (c_custkey + 1) AS r, c_custkey AS c FROM customer WHERE c_custkey % 9 = 0),
  linked AS (SELECT c FROM src WHERE seq % 40 = 7 UNION SELECT c FROM ent), every AS (SELECT c FROM src UNION SELECT c + 1 FROM src UNION SELECT c FROM ent UNION SELECT c + 1 FROM ent),
  part_of AS (SELECT c, sum(CASE WHEN before THEN 0 ELSE 1 END) OVER (ORDER BY c) AS comp FROM (SELECT e.c, l.c IS NOT NULL AS before FROM every e LEFT JOIN linked l ON l.c = e.c - 1)),
  num AS (SELECT seq, s, r, comp, row_number() OVER (PARTITION BY comp ORDER BY seq) AS n FROM src JOIN part_of USING (c)),
  begin AS (SELECT comp, coalesce(list({'id': id, 's': s, 'r': r} ORDER BY id) FILTER (id IS NOT NULL), []) AS ents FROM part_of LEFT JOIN ent USING (c) GROUP BY comp)"""


def _chain_sql(fill: bool) -> str:
    """One row of each chain at a time, with the aircraft that it has so far."""
    took = "x.r <> '' AND (by_s IS NULL AND by_r IS NULL" + (" OR by_s IS NOT NULL AND (by_r IS NULL OR by_r = by_s))" if fill else ")")
    moved = "WHEN by_s IS NOT NULL AND took THEN list_transform(ents, lambda e: {'id': e.id, 's': e.s, 'r': CASE WHEN e.id = by_s THEN r ELSE e.r END})" if fill else ""
    return f"""WITH RECURSIVE {CHAIN_ROWS}, step AS (SELECT comp, CAST(0 AS BIGINT) AS n, ents, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS id, false AS is_new, false AS took FROM begin
  UNION ALL SELECT comp, n, CASE WHEN is_new THEN list_append(ents, {{'id': id, 's': s, 'r': r}}) {moved} ELSE ents END, seq, id, is_new, took FROM
  (SELECT *, CASE WHEN by_s IS NULL AND by_r IS NULL AND (s <> '' OR r <> '') THEN 'n' || seq ELSE coalesce(by_s, by_r) END AS id, by_s IS NULL AND by_r IS NULL AND (s <> '' OR r <> '') AS is_new FROM
  (SELECT x.comp, x.n, x.seq, x.s, x.r, ents, by_s, by_r, {took} AS took FROM
  (SELECT num.*, t.ents, CASE WHEN num.s <> '' THEN list_filter(t.ents, lambda e: e.s = num.s)[1].id END AS by_s, CASE WHEN num.r <> '' THEN list_filter(t.ents, lambda e: e.r = num.r)[1].id END AS by_r
   FROM step t JOIN num ON num.comp = t.comp AND num.n = t.n + 1) x)))
SELECT seq, CASE WHEN id LIKE 'e%' THEN id END AS known_id, CASE WHEN id LIKE 'n%' THEN CAST(substr(id, 2) AS BIGINT) END AS made_by, is_new, took FROM step WHERE n > 0"""


def _entity_chain(spark: SparkSession, sf: str, fill: bool) -> DataFrame:
    """For each record the stored aircraft that it is, or the record that made its aircraft."""
    c, k = F.col("o_custkey"), F.col("o_orderkey")
    serial = F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("S"), c))
    registration = F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("N"), c + F.when(k % 40 == 7, 1).otherwise(0)))
    records = table(spark, sf, "orders").select(k.alias("seq"), serial.alias("serial"), registration.alias("registration"))
    p = F.col("c_custkey")
    entities = table(spark, sf, "customer").where("c_custkey % 9 = 0").select(F.concat(F.lit("e"), p).alias("entity_id"), F.concat(F.lit("S"), p).alias("serial"), F.concat(F.lit("N"), p + 1).alias("registration"))
    found = resolve.resolve_in_order(records, entities, ["seq"], fill)
    made = found.where("is_new").select(F.col("entity_id").alias("_id"), F.col("seq").alias("made_by"))
    out = found.join(made, F.col("entity_id") == F.col("_id"), "left")
    return out.select("seq", F.when(F.col("made_by").isNull(), F.col("entity_id")).alias("known_id"), "made_by", "is_new", "took")


@query(_chain_sql(False))
def entity_chain(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_chain(spark, sf, False)


@query(_chain_sql(True))
def entity_chain_filled(spark: SparkSession, sf: str) -> DataFrame:
    return _entity_chain(spark, sf, True)


@query("""WITH s AS (SELECT CAST(l_partkey AS VARCHAR) AS serial FROM lineitem), e AS (SELECT CASE WHEN p_size % 4 = 0 THEN 'X' ELSE '' END || p_partkey AS serial, p_partkey AS id FROM part)
SELECT s.serial, count(*) AS sales, count(e.id) AS linked, min(e.id) AS entity_id FROM s LEFT JOIN e ON s.serial = e.serial GROUP BY s.serial""")
def sale_lookup(spark: SparkSession, sf: str) -> DataFrame:
    sales = table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("serial"), F.lit(None).cast("string").alias("registration"))
    serial = F.concat(F.when(F.col("p_size") % 4 == 0, "X").otherwise(""), "p_partkey")
    entities = table(spark, sf, "part").select(F.col("p_partkey").alias("entity_id"), serial.alias("serial"), F.lit("").alias("registration"))
    out = resolve.lookup(sales, entities)
    return out.groupBy("serial").agg(F.count("*").alias("sales"), F.count("entity_id").alias("linked"), F.min("entity_id").alias("entity_id"))


MATCH = f"""{FLEET}, {REG}, m AS (SELECT f.id, f.registration, f.serial AS fleet_serial, r.n_number, r.serial AS registry_serial, r.registrant, r.date, r.seq, {CANON.format('f.registration')} AS n_canon
  FROM fleet f JOIN reg r ON {CANON.format('f.registration')} = {CANON.format('r.n_number')}),
  ms AS (SELECT * FROM m WHERE coalesce(trim(fleet_serial), '') = '' OR {SKEY.format('fleet_serial')} = {SKEY.format('registry_serial')})"""
SHOWN = "id, registration, fleet_serial, n_number, registry_serial, registrant, date, seq"


def _match(spark: SparkSession, sf: str, serial: bool) -> DataFrame:
    return match.registry_match(fleet(spark, sf), registry(spark, sf), serial)


@query(f"WITH {MATCH} SELECT {SHOWN} FROM m")
def registry_match(spark: SparkSession, sf: str) -> DataFrame:
    return match.listed(_match(spark, sf, False)).select(*SHOWN.split(", "))


@query(f"WITH {MATCH} SELECT {SHOWN} FROM ms")
def registry_match_serial(spark: SparkSession, sf: str) -> DataFrame:
    return match.listed(_match(spark, sf, True)).select(*SHOWN.split(", "))


@query(f"WITH {MATCH} SELECT DISTINCT registration, n_number FROM ms")
def registry_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf, True).select("registration", "n_number").distinct().orderBy("registration", "n_number")


@query(f"WITH {MATCH} SELECT DISTINCT registration FROM ms")
def registry_list(spark: SparkSession, sf: str) -> DataFrame:
    return _match(spark, sf, True).select("registration").distinct().orderBy("registration")


@query(f"WITH {MATCH} SELECT count(*) AS rows, count(DISTINCT id) AS aircraft, count(DISTINCT registration) AS registrations, count(DISTINCT n_canon) AS canonical_n, count(DISTINCT n_number) AS n_numbers FROM ms")
def registry_stats(spark: SparkSession, sf: str) -> DataFrame:
    return match.stats(_match(spark, sf, True))


@query(f"WITH {MATCH} SELECT {SHOWN} FROM m WHERE upper(trim(registrant)) = 'CUSTOMER#000000042'")
def registrant_exact(spark: SparkSession, sf: str) -> DataFrame:
    return match.registry_match(fleet(spark, sf), match.named(registry(spark, sf), " customer#000000042 ")).select(*SHOWN.split(", "))


@query(f"WITH {MATCH} SELECT {SHOWN} FROM ms WHERE contains(lower(registrant), '#00000000')")
def registrant_contains(spark: SparkSession, sf: str) -> DataFrame:
    return match.registry_match(fleet(spark, sf), match.named(registry(spark, sf), "#00000000", exact=False), True).select(*SHOWN.split(", "))


FLAGS = f"""{FLEET}, {REG}, {REF}, fl AS (SELECT id, EXISTS (SELECT 1 FROM reg r WHERE trim(r.serial) = trim(f.serial) AND trim(f.serial) <> '' AND trim(r.registrant) <> '') AS serial_match,
  EXISTS (SELECT 1 FROM reg r JOIN ref ON ref.code = r.code WHERE trim(r.serial) = trim(f.serial) AND trim(f.serial) <> '' AND trim(r.registrant) <> '' AND ref.model ILIKE '%' || trim(f.model) || '%') AS model_match,
  regexp_replace(upper(trim(registration)), '[ -]', '', 'g') IN (SELECT regexp_replace(upper(trim('N' || n_number)), '[ -]', '', 'g') FROM reg) AS tail_match FROM fleet f)"""


def _flags(spark: SparkSession, sf: str) -> DataFrame:
    tails = registry(spark, sf).withColumn("n_number", F.concat(F.lit("N"), "n_number"))
    return match.coverage(fleet(spark, sf), tails, reference(spark, sf))


@query(f"WITH {FLAGS} SELECT * FROM fl")
def coverage_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return _flags(spark, sf)


@query(f"""WITH {FLAGS} SELECT count(*) AS fleet, count(*) FILTER (serial_match) AS by_serial, count(*) FILTER (model_match) AS by_serial_and_model, count(*) FILTER (tail_match) AS by_tail,
  count(*) FILTER (serial_match AND tail_match) AS by_both, count(*) FILTER (serial_match AND NOT tail_match) AS serial_only, count(*) FILTER (tail_match AND NOT serial_match) AS tail_only,
  count(*) FILTER (serial_match OR tail_match) AS by_either, count(*) FILTER (NOT serial_match AND NOT tail_match) AS by_none,
  round(100.0 * count(*) FILTER (serial_match OR tail_match) / greatest(count(*), 1), 4) AS either_percent FROM fl""")
def match_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return match.coverage_counts(_flags(spark, sf))


AUDIT = f"""{REG}, early AS (SELECT * FROM reg WHERE date <= '1998-06-30'), late AS (SELECT * FROM reg WHERE date > '1998-06-30'),
  bn AS (SELECT * FROM early WHERE trim(n_number) <> '' QUALIFY row_number() OVER (PARTITION BY n_number ORDER BY seq) = 1), bs AS (SELECT * FROM early WHERE trim(serial) <> '' QUALIFY row_number() OVER (PARTITION BY serial ORDER BY seq) = 1),
  a AS (SELECT l.*, CASE WHEN bn.seq IS NOT NULL THEN 'n_number' WHEN bs.seq IS NOT NULL THEN 'serial' END AS match_key, coalesce(bn.seq, bs.seq) AS stored_seq,
    coalesce(bn.registrant, bs.registrant) AS r0, coalesce(bn.code, bs.code) AS c0, coalesce(bn.date, bs.date) AS d0 FROM late l LEFT JOIN bn ON bn.n_number = l.n_number LEFT JOIN bs ON bs.serial = l.serial),
  f AS (SELECT *, list_filter([CASE WHEN registrant IS DISTINCT FROM r0 THEN 'registrant' END, CASE WHEN code IS DISTINCT FROM c0 THEN 'code' END, CASE WHEN date IS DISTINCT FROM d0 THEN 'date' END], lambda x: x IS NOT NULL) AS bad FROM a)"""


def _matched(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    return audit.fallback_match(rows.where(F.col("date") > CUT), rows.where(F.col("date") <= CUT), "seq")


@query(f"WITH {AUDIT} SELECT seq, match_key, stored_seq FROM a")
def fallback_match(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf).select("seq", "match_key", F.col("stored.seq").alias("stored_seq"))


@query(f"WITH {AUDIT} SELECT seq, match_key, array_to_string(bad, ';') AS mismatched FROM f WHERE match_key IS NOT NULL")
def audit_fields(spark: SparkSession, sf: str) -> DataFrame:
    out = audit.field_audit(_matched(spark, sf), ["registrant", "code", "date"])
    return out.select("seq", "match_key", F.array_join("mismatched", ";").alias("mismatched"))


@query(f"""WITH {AUDIT} SELECT count(*) AS processed, count(*) FILTER (match_key IS NULL) AS missing, count(match_key) AS matched, count(*) FILTER (match_key IS NOT NULL AND len(bad) > 0) AS mismatched_rows,
  CAST(coalesce(sum(len(bad)) FILTER (match_key IS NOT NULL), 0) AS BIGINT) AS mismatched_fields FROM f""")
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit_summary(_matched(spark, sf), ["registrant", "code", "date"])


RECON = f"""{REG}, mm AS (SELECT trim(serial) AS serial, array_to_string(list_sort(list_distinct(list(trim(registrant)))), '; ') AS names, list(trim(registrant)) AS l FROM reg WHERE date > '{CUT}' AND trim(serial) <> '' GROUP BY 1),
  ss AS (SELECT trim(serial) AS serial, max(CASE WHEN seq % 7 = 0 THEN registrant || ' X' ELSE registrant END) AS stored_name FROM reg WHERE date <= '{CUT}' GROUP BY 1),
  rc AS (SELECT coalesce(mm.serial, ss.serial) AS serial, CASE WHEN ss.serial IS NULL THEN 'missing' WHEN mm.serial IS NULL THEN 'extra' ELSE 'common' END AS side, substr(names, 1, 4000) AS names, stored_name,
    CASE WHEN ss.serial IS NOT NULL AND mm.serial IS NOT NULL THEN list_contains(l, stored_name) END AS name_ok FROM mm FULL JOIN ss ON mm.serial = ss.serial)"""


def _reconciled(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    stored = rows.where(F.col("date") <= CUT).withColumn("registrant", F.when(F.col("seq") % 7 == 0, F.concat("registrant", F.lit(" X"))).otherwise(F.col("registrant")))
    return audit.reconcile(rows.where(F.col("date") > CUT), stored)


@query(f"WITH {RECON} SELECT serial, side FROM rc")
def reconcile_serials(spark: SparkSession, sf: str) -> DataFrame:
    return _reconciled(spark, sf).select("serial", "side")


@query(f"WITH {RECON} SELECT serial, names, stored_name FROM rc WHERE side = 'common' AND NOT name_ok")
def reconcile_names(spark: SparkSession, sf: str) -> DataFrame:
    return _reconciled(spark, sf).where("side = 'common' and not name_ok").select("serial", "names", "stored_name")


@query(f"WITH {RECON} SELECT count(*) AS serials, count(*) FILTER (side = 'missing') AS missing, count(*) FILTER (side = 'extra') AS extra, count(*) FILTER (side = 'common') AS common, count(*) FILTER (NOT name_ok) AS name_mismatch FROM rc")
def reconcile_summary(spark: SparkSession, sf: str) -> DataFrame:
    return audit.reconcile_summary(_reconciled(spark, sf))


@query(f"WITH {RECON} SELECT side, serial FROM rc QUALIFY row_number() OVER (PARTITION BY side ORDER BY serial) <= 20")
def capped_report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.capped(_reconciled(spark, sf).select("side", "serial"), "side", ["serial"], 20)


@query(f"""WITH {REG}, st AS (SELECT * FROM reg WHERE seq % 3 = 0), ms AS (SELECT n_number AS t, CASE WHEN seq % 4 = 2 THEN '' ELSE 'S' || (seq % 50) END AS ns FROM reg WHERE seq % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY n_number ORDER BY seq DESC) = 1),
  j AS (SELECT st.*, nullif(ns, '') AS new_serial, t FROM st LEFT JOIN ms ON st.n_number = ms.t)
SELECT seq, new_serial, CASE WHEN t IS NULL THEN 'no_match' WHEN new_serial IS NULL THEN 'no_serial' WHEN trim(serial) IS NOT DISTINCT FROM new_serial THEN 'already_right' WHEN {TAIL} THEN 'fixed' ELSE 'skipped' END AS outcome FROM j""")
def repair_serial(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    master = rows.where("seq % 3 <> 0").withColumn("serial", F.when(F.col("seq") % 4 == 2, "").otherwise(F.concat(F.lit("S"), F.col("seq") % 50)))
    return repair.serial_repairs(rows.where("seq % 3 = 0"), master).select("seq", "new_serial", "outcome")


def _tail_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    stored = rows.where("seq % 3 = 0")
    master = rows.where("seq % 3 <> 0").withColumn("n_number", F.concat(F.lit("N"), F.col("seq") % 900))
    return repair.tail_repairs(stored, master)


TAILS = f"""{REG}, st AS (SELECT * FROM reg WHERE seq % 3 = 0), bad AS (SELECT * FROM st WHERE {TAIL}),
  k AS (SELECT upper(serial) AS key, 'N' || (seq % 900) AS new_n FROM reg WHERE seq % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY upper(serial) ORDER BY seq DESC) = 1),
  j AS (SELECT b.*, new_n, row_number() OVER (PARTITION BY b.date, new_n ORDER BY seq) AS claim, EXISTS (SELECT 1 FROM st s WHERE s.date = b.date AND s.n_number = new_n) AS taken FROM bad b LEFT JOIN k ON upper(b.serial) = k.key),
  o AS (SELECT seq, new_n, CASE WHEN new_n IS NULL THEN 'no_match' WHEN n_number = new_n THEN 'already_right' WHEN taken OR claim > 1 THEN 'conflict' ELSE 'fixed' END AS outcome FROM j)"""


@query(f"WITH {TAILS} SELECT * FROM o")
def repair_n(spark: SparkSession, sf: str) -> DataFrame:
    return _tail_report(spark, sf).select("seq", "new_n", "outcome")


#: Stored tails of which most should be a neighbour's, in blocks of 25 customers, and in an order that is not theirs.
WANTS = """st AS (SELECT c_custkey AS c, (c_custkey * 7919) % 1000003 AS seq, 'N' || c_custkey AS tail, c_custkey + CASE WHEN c_custkey % 11 = 4 THEN -1 WHEN c_custkey % 7 = 3 THEN 2 ELSE 1 END AS w FROM customer WHERE c_custkey % 6 <> 1),
  bad AS (SELECT *, c // 25 AS block, CASE WHEN w // 25 = c // 25 THEN 'N' || w END AS new_n FROM st WHERE c % 10 <> 9)"""


def _wants(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = F.col("c_custkey")
    customers = table(spark, sf, "customer").where(c % 6 != 1)
    serial = F.when(c % 10 == 9, F.concat(F.lit("X"), c)).otherwise(c.cast("string"))
    stored = customers.select((c * 7919 % 1000003).alias("seq"), F.concat(F.lit("N"), c).alias("n_number"), serial.alias("serial"), F.lit("c").alias("code"), F.lit("2024-01-01").alias("date"))
    want = c + F.when(c % 11 == 4, -1).when(c % 7 == 3, 2).otherwise(1)
    master = customers.where(F.floor(want / 25) == F.floor(c / 25)).select(c.alias("seq"), F.concat(F.lit("N"), want).alias("n_number"), c.cast("string").alias("serial"), F.lit("c").alias("code"))
    return stored, master


@query(f"""WITH {WANTS} SELECT seq, new_n, CASE WHEN new_n IS NULL THEN 'no_match' WHEN EXISTS (SELECT 1 FROM st WHERE st.tail = bad.new_n) THEN 'conflict' ELSE 'fixed' END AS outcome FROM bad""")
def repair_n_dry(spark: SparkSession, sf: str) -> DataFrame:
    return repair.tail_repairs(*_wants(spark, sf), dry_run=True).select("seq", "new_n", "outcome")


@query(f"""WITH RECURSIVE {WANTS}, num AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY seq) AS n FROM bad), begin AS (SELECT c // 25 AS block, list({{'seq': seq, 'tail': tail}} ORDER BY seq) AS held FROM st GROUP BY 1),
  step AS (SELECT block, CAST(0 AS BIGINT) AS n, held, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS new_n, CAST(NULL AS VARCHAR) AS outcome FROM begin
  UNION ALL SELECT block, n, CASE WHEN outcome = 'fixed' THEN list_transform(held, lambda e: {{'seq': e.seq, 'tail': CASE WHEN e.seq = seq THEN new_n ELSE e.tail END}}) ELSE held END, seq, new_n, outcome FROM
  (SELECT num.block, num.n, t.held, num.seq, num.new_n, CASE WHEN num.new_n IS NULL THEN 'no_match' WHEN len(list_filter(t.held, lambda e: e.tail = num.new_n AND e.seq <> num.seq)) > 0 THEN 'conflict' ELSE 'fixed' END AS outcome
   FROM step t JOIN num ON num.block = t.block AND num.n = t.n + 1))
SELECT seq, new_n, outcome FROM step WHERE n > 0""")
def repair_n_applied(spark: SparkSession, sf: str) -> DataFrame:
    return repair.applied_tail_repairs(*_wants(spark, sf)).select("seq", "new_n", "outcome")


@query(f"WITH {TAILS} SELECT outcome, count(*) AS n FROM o GROUP BY outcome")
def repair_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return repair.outcome_counts(_tail_report(spark, sf))


@query(f"""WITH {REG}, k AS (SELECT upper(serial) AS key, 'N' || (seq % 900) AS n, seq FROM reg), l AS (SELECT key, n, lag(n) OVER (PARTITION BY key ORDER BY seq) AS was FROM k)
SELECT key, count(*) AS collisions FROM l WHERE was <> n GROUP BY key""")
def key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf).withColumn("n_number", F.concat(F.lit("N"), F.col("seq") % 900))
    return repair.key_collisions(rows)


@query(f"""WITH {REG}, st AS (SELECT * FROM reg WHERE seq % 40 = 0), nw AS (SELECT * FROM reg r WHERE seq % 40 <> 0 AND NOT EXISTS (SELECT 1 FROM st WHERE st.serial = r.serial AND st.code = r.code AND st.registrant = r.registrant)
    QUALIFY row_number() OVER (PARTITION BY serial, code, registrant ORDER BY seq) = 1),
  c AS (SELECT *, 'N' || (seq % 5000) AS n, row_number() OVER (PARTITION BY seq % 5000 ORDER BY seq) AS claim FROM nw), lost AS (SELECT *, claim > 1 OR n IN (SELECT n_number FROM st) AS l FROM c)
SELECT seq, serial, CASE WHEN NOT l THEN n END AS n_number, l AS n_conflict, p_partkey AS entity_id FROM lost LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = serial""")
def backfill_missing(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    master = rows.where("seq % 40 <> 0").withColumn("n_number", F.concat(F.lit("N"), F.col("seq") % 5000))
    entities = table(spark, sf, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_partkey").cast("string").alias("serial"))
    return repair.backfill(rows.where("seq % 40 = 0"), master, entities).select("seq", "serial", "n_number", "n_conflict", "entity_id")


@query(f"""WITH {SPLIT}, {REG}, ol AS (SELECT DISTINCT n_number FROM reg WHERE date <= {CUT!r}), nl AS (SELECT DISTINCT n_number FROM reg WHERE date > {CUT!r}),
  m AS (SELECT 'snapshots' AS source, CASE WHEN n.url IS NULL THEN 'kept' WHEN o.url IS NULL THEN 'inserted' ELSE 'updated' END AS action FROM old o FULL JOIN new n ON o.url = n.url
    UNION ALL SELECT 'registry', CASE WHEN nl.n_number IS NULL THEN 'kept' WHEN ol.n_number IS NULL THEN 'inserted' ELSE 'updated' END FROM ol FULL JOIN nl ON ol.n_number = nl.n_number)
SELECT source, action, count(*) AS n FROM m GROUP BY GROUPING SETS ((source, action), (action))""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows, reg = snapshots(spark, sf), registry(spark, sf)
    stored = merge.pick_per_key(reg.where(F.col("date") <= CUT), ["n_number"], ["date", "seq"])
    merged = {"snapshots": merge.merge_latest(_stored(rows), rows.where(F.col("date") > CUT), ["url"], ["seq"]), "registry": merge.merge_latest(stored, reg.where(F.col("date") > CUT), ["n_number"], ["seq"])}
    return pipelines.run_summary(merged)


@query(f"WITH {SNAP} SELECT status, location, count(*) AS n, max(date) AS last_date, sum(seq) AS sum_seq FROM snap GROUP BY status, location")
def group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.group_counts(snapshots(spark, sf), ["status", "location"], last="date", total="seq").withColumn("sum_seq", F.col("sum_seq").cast("decimal(38,0)"))


@query(f"""WITH {FLEET} SELECT unnest([{{'field': 'registration', 'filled': count(*) FILTER (trim(registration) <> '')}}, {{'field': 'serial', 'filled': count(*) FILTER (trim(serial) <> '')}},
  {{'field': 'make', 'filled': count(*) FILTER (trim(make) <> '')}}], recursive := true), count(*) AS total FROM fleet""")
def field_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return audit.coverage_profile(fleet(spark, sf), ["registration", "serial", "make"])


@query(f"WITH {SNAP} SELECT url, date, seq FROM snap ORDER BY date DESC, seq LIMIT 25")
def topk_latest(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.newest(snapshots(spark, sf).select("url", "date", "seq"), "date", 25, "seq")


@query("""SELECT min(lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS file_path, min(lpad(CAST(doc_id AS VARCHAR), 12, '0')) || '.txt' AS file_name, CAST(min(length(text)) AS BIGINT) AS file_size, sha256(text) AS file_hash, count(*) AS copies FROM documents GROUP BY sha256(text)""")
def document_hash_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    path = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    files = table(spark, sf, "documents").select(path.alias("file_path"), F.concat(path, F.lit(".txt")).alias("file_name"), F.length("text").cast("long").alias("file_size"), F.col("text").alias("content"))
    return lookup.contents(files)


@query("""WITH d AS (SELECT sha256(text) AS file_hash, source FROM documents), k AS (SELECT DISTINCT b.file_hash FROM (SELECT sha256(text) AS file_hash FROM benchmark) b)
SELECT 'documents' AS source_platform, file_hash, count(*) AS n FROM d WHERE file_hash NOT IN (SELECT file_hash FROM k) GROUP BY file_hash""")
def unknown_documents(spark: SparkSession, sf: str) -> DataFrame:
    hashed = lambda name: table(spark, sf, name).select(F.lit("documents").alias("source_platform"), F.sha2("text", 256).alias("file_hash"))
    return readers.unknown_documents(hashed("documents"), hashed("benchmark")).groupBy("source_platform", "file_hash").agg(F.count("*").alias("n"))


@query(f"WITH {REG} SELECT seq, serial, n_number, date FROM reg WHERE serial IN ('FL 1', 'N2', '3', '4') AND date >= '1996-01-01'")
def membership_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.by_values(registry(spark, sf), "serial", ["FL 1", "N2", "3", "4"], "date", "1996-01-01").select("seq", "serial", "n_number", "date")


@query(f"WITH {REG} SELECT seq, n_number, serial FROM reg WHERE date = '1996-01-02' AND trim(serial) <> ''")
def snapshot_rows(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.snapshot(registry(spark, sf), "date", "1996-01-02", ["serial"]).select("seq", "n_number", "serial")


@query("SELECT event_id, event_type FROM events WHERE json_extract_string(props, '$.source') IS NULL AND coalesce(json_extract_string(props, '$.k'), '90') = '90' ORDER BY ts DESC, event_id LIMIT 10")
def json_predicate(spark: SparkSession, sf: str) -> DataFrame:
    props = F.col("props")
    return lookup.newest(table(spark, sf, "events").where(lookup.json_is(props, "$.source") & lookup.json_is(props, "$.k", "90")), "ts", 10, "event_id").select("event_id", "event_type")


@query(f"WITH {REG}, {FLEET}, e AS (SELECT serial, min(id) AS id FROM fleet WHERE serial <> '' GROUP BY serial), l AS (SELECT * FROM reg QUALIFY row_number() OVER (PARTITION BY n_number ORDER BY date DESC, seq DESC) = 1) SELECT l.n_number, l.registrant, l.date, e.id AS entity_id, f.model AS aircraft_model FROM l LEFT JOIN e ON l.serial = e.serial LEFT JOIN fleet f ON f.id = e.id")
def registration_report(spark: SparkSession, sf: str) -> DataFrame:
    latest = merge.pick_per_key(registry(spark, sf), ["n_number"], ["date", "seq"]).withColumn("registration", F.lit(""))
    aircraft = fleet(spark, sf).select(F.col("id").alias("entity_id"), "serial", F.lit("").alias("registration"), "model")
    known = resolve.lookup(latest, aircraft)
    return audit.with_entities(known, aircraft, "aircraft_").select("n_number", "registrant", "date", "entity_id", "aircraft_model")


@query(f"WITH {CHANGES} SELECT change_date, field, old_value, new_value FROM ch WHERE url = 'https://m.example/listing/for-sale/42/x'")
def one_listing_history(spark: SparkSession, sf: str) -> DataFrame:
    out = _changes(spark, sf).where("url = 'https://m.example/listing/for-sale/42/x'")
    return out.select("change_date", "field", "old_value", "new_value").orderBy(F.desc("change_date"), "field")


@query(f"""WITH {REG}, a AS (SELECT DISTINCT serial FROM reg WHERE date <= '1995-12-31'), b AS (SELECT DISTINCT serial FROM reg WHERE date > '1995-12-31')
SELECT 'missing' AS kind, serial FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'extra', serial FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT 'common', serial FROM (SELECT * FROM a INTERSECT SELECT * FROM b)""")
def serial_sets(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    return lookup.set_sides(rows.where("date <= '1995-12-31'"), rows.where("date > '1995-12-31'"), "serial").select(F.col("side").alias("kind"), "serial")


@query(f"WITH {RECON}, k AS (SELECT CASE WHEN side <> 'common' THEN side WHEN NOT name_ok THEN 'name_mismatch' END AS kind, serial, names, stored_name FROM rc) SELECT * FROM k WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY kind ORDER BY serial) <= 50")
def stacked_report(spark: SparkSession, sf: str) -> DataFrame:
    return audit.stacked(_reconciled(spark, sf), 50)


OWNER = f"""{REG}, m AS (SELECT *, CASE seq % 4 WHEN 0 THEN [registrant, code] WHEN 1 THEN [' ' || code || ' '] END AS other_names FROM reg WHERE date > {CUT!r}), s AS (SELECT *, CASE seq % 3 WHEN 0 THEN [registrant, code] WHEN 1 THEN [code] END AS other_names FROM reg WHERE date <= {CUT!r}),
  bn AS (SELECT * FROM s WHERE trim(n_number) <> '' QUALIFY row_number() OVER (PARTITION BY n_number ORDER BY seq) = 1), bs AS (SELECT * FROM s WHERE trim(serial) <> '' QUALIFY row_number() OVER (PARTITION BY serial ORDER BY seq) = 1),
  j AS (SELECT m.seq, CASE WHEN bn.seq IS NOT NULL THEN 'n_number' ELSE 'serial' END AS match_key, m.code AS c1, coalesce(bn.code, bs.code) AS c0, m.registrant AS r1, coalesce(bn.registrant, bs.registrant) AS r0, m.date AS d1, coalesce(bn.date, bs.date) AS d0,
    list_transform(m.other_names, lambda x: trim(x)) AS o1, CASE WHEN bn.seq IS NOT NULL THEN bn.other_names ELSE bs.other_names END AS o0 FROM m LEFT JOIN bn ON bn.n_number = m.n_number LEFT JOIN bs ON bs.serial = m.serial WHERE coalesce(bn.seq, bs.seq) IS NOT NULL)"""


@query(f"""WITH {OWNER} SELECT seq, match_key, array_to_string(list_filter([CASE WHEN c1 IS DISTINCT FROM c0 THEN 'code' END, CASE WHEN r1 IS DISTINCT FROM r0 THEN 'registrant' END, CASE WHEN d1 IS DISTINCT FROM d0 THEN 'last_action_date' END,
  CASE WHEN o1 IS DISTINCT FROM o0 THEN 'other_names' END], lambda x: x IS NOT NULL), ';') AS mismatched FROM j""")
def registry_audit(spark: SparkSession, sf: str) -> DataFrame:
    """All 28 fields; those that the tables lack are null on both sides."""
    blank = [f for f in audit.FULL_FIELDS if f not in ("code", "registrant", "last_action_date", "other_names")]
    rows = registry(spark, sf).select("*", F.to_date("date").alias("last_action_date"), *(F.lit(None).cast("string").alias(f) for f in blank))
    k = F.col("seq")
    new = rows.where(F.col("date") > CUT).withColumn("other_names", F.when(k % 4 == 0, F.array("registrant", "code")).when(k % 4 == 1, F.array(F.concat(F.lit(" "), "code", F.lit(" ")))))
    old = rows.where(F.col("date") <= CUT).withColumn("other_names", F.to_json(F.when(k % 3 == 0, F.array("registrant", "code")).when(k % 3 == 1, F.array("code"))))
    return audit.registry_audit(new, old).select("seq", "match_key", F.array_join("mismatched", ";").alias("mismatched"))


BACKFILL = f"""{REG}, st AS (SELECT * FROM reg WHERE date <= {CUT!r}), ms AS (SELECT * FROM reg WHERE date > {CUT!r}), nw AS (SELECT * FROM ms r WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.serial = r.serial AND st.code = r.code AND st.registrant = r.registrant)
    QUALIFY row_number() OVER (PARTITION BY serial, code, registrant ORDER BY seq) = 1), c AS (SELECT *, 'N' || (seq % 5000) AS n, row_number() OVER (PARTITION BY seq % 5000 ORDER BY seq) AS claim FROM nw), lost AS (SELECT *, claim > 1 OR n IN (SELECT n_number FROM st) AS l FROM c)"""


@query(f"""WITH {BACKFILL} SELECT (SELECT count(*) FROM ms) AS processed, (SELECT count(*) FROM (SELECT DISTINCT serial, code, registrant FROM st)) AS stored_signatures, count(*) AS inserted, (SELECT count(*) FROM ms) - count(*) AS skipped_existing, 0 AS skipped_blank,
  count(*) FILTER (l) AS n_conflicts, count(DISTINCT serial) FILTER (p_partkey IS NULL) AS new_aircraft FROM lost LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = serial""")
def backfill_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = registry(spark, sf)
    stored, master = rows.where(F.col("date") <= CUT), rows.where(F.col("date") > CUT).withColumn("n_number", F.concat(F.lit("N"), F.col("seq") % 5000))
    entities = table(spark, sf, "part").select(F.col("p_partkey").alias("entity_id"), F.col("p_partkey").cast("string").alias("serial"))
    return repair.backfill_summary(stored, master, repair.backfill(stored, master, entities))


@query(f"""WITH {REG}, k AS (SELECT upper(serial) AS key, 'N' || (seq % 900) AS n_number, seq FROM reg), l AS (SELECT *, lag(n_number) OVER (PARTITION BY key ORDER BY seq) AS was FROM k)
SELECT seq, key, was, n_number FROM l WHERE was <> n_number ORDER BY seq, key LIMIT 12""")
def collision_sample(spark: SparkSession, sf: str) -> DataFrame:
    return repair.collision_sample(registry(spark, sf).withColumn("n_number", F.concat(F.lit("N"), F.col("seq") % 900)))


@query(f"WITH {SNAP} SELECT url, seq, price_text, CAST(NULL AS VARCHAR) AS kind FROM snap UNION ALL SELECT NULL, event_id, NULL, event_type FROM events")
def widened(spark: SparkSession, sf: str) -> DataFrame:
    more = table(spark, sf, "events").select(F.col("event_id").alias("seq"), F.col("event_type").alias("kind"))
    return merge.widen(snapshots(spark, sf).select("url", "seq", "price_text"), more)


@query(f"WITH {SPLIT} SELECT url, seq, date, price_text FROM old UNION ALL SELECT url, seq, date, price_text FROM new WHERE url NOT IN (SELECT url FROM old)")
def merge_append(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots(spark, sf)
    new = merge.pick_per_key(rows.where(F.col("date") > CUT), ["url"], ["seq"])
    return merge.append_absent(_stored(rows), new, ["url"], ["seq"]).select("url", "seq", "date", "price_text")


@query(f"WITH {SNAP}, r AS (SELECT status, seq, row_number() OVER (PARTITION BY status ORDER BY seq) AS n FROM snap) SELECT status, seq FROM r WHERE n <= 40")
def per_source_limit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.capped(snapshots(spark, sf).select("status", "seq"), "status", ["seq"], 40)


@query("""WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"text":"' || event_type || '","href":"/e/' || event_id || '"}' WHEN 1 THEN 'true' WHEN 2 THEN 'false' ELSE ' ' || event_type END AS cell FROM events)
SELECT event_id, CASE WHEN cell = 'true' THEN 'Yes' WHEN cell = 'false' THEN 'No' WHEN cell LIKE '{%' THEN json_extract_string(cell, '$.text') || ' (' || json_extract_string(cell, '$.href') || ')' ELSE trim(cell) END AS shown FROM c""")
def cell_display(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    linked = F.concat(F.lit('{"text":"'), "event_type", F.lit('","href":"/e/'), k, F.lit('"}'))
    cell = F.when(k % 4 == 0, linked).when(k % 4 == 1, "true").when(k % 4 == 2, "false").otherwise(F.concat(F.lit(" "), "event_type"))
    return table(spark, sf, "events").select("event_id", clean.cell_shown(cell).alias("shown"))


@query(f"""WITH {SNAP} SELECT url, string_agg(DISTINCT status, '; ' ORDER BY status) AS statuses, count(*) AS n FROM snap GROUP BY url""")
def collected_set(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots(spark, sf).groupBy("url").agg(F.array_join(F.array_sort(F.collect_set("status")), "; ").alias("statuses"), F.count("*").alias("n"))


@query("""WITH s AS (SELECT CAST(l_orderkey AS VARCHAR) || '-' || l_linenumber AS serial_number, CASE WHEN l_linenumber % 4 > 0 THEN l_shipdate END AS sold, CASE WHEN l_linenumber % 5 = 0 THEN ' ' END AS blank, l_quantity, l_returnflag, l_linestatus FROM lineitem)
SELECT serial_number, l_returnflag || '|' || l_linestatus AS features, l_returnflag = 'R' AS has_damage, l_quantity > 25 AS engine_deferred FROM s WHERE sold IS NOT NULL AND blank IS NULL""")
def valid_sales(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("l_linenumber")
    serial = F.when(n % 5 == 0, " ").otherwise(F.concat("l_orderkey", F.lit("-"), n))
    rows = table(spark, sf, "lineitem").select(
        serial.alias("serial_number"), F.when(n % 4 > 0, F.to_date("l_shipdate")).alias("date_sold"), F.concat("l_returnflag", F.lit(", ,"), "l_linestatus").alias("features"),
        F.when(F.col("l_returnflag") == "R", "True ").otherwise("no").alias("has_damage"), (F.col("l_quantity") - 25).alias("engine_program_deferment_amount"), F.lit(None).cast("double").alias("apu_program_deferment_amount"),
    )
    return pipelines.sale_rows(rows).select("serial_number", F.array_join("features", "|").alias("features"), "has_damage", "engine_deferred")


@query(f"""WITH {REG}, t AS (SELECT (['{"', '".join(CODES)}'])[p_partkey % 5 + 1] AS code, p_type, p_partkey FROM part), one AS (SELECT code, arg_max(p_type, p_partkey) AS model FROM t GROUP BY code),
  m AS (SELECT *, CASE WHEN seq % 4 = 0 THEN '' ELSE n_number END AS n, CASE WHEN seq % 3 = 0 THEN '' ELSE serial END AS s FROM reg)
SELECT seq, coalesce(nullif(n, ''), s) AS n_number, one.model, CAST(substr(date, 1, 4) AS INTEGER) AS year, registrant || ', ' || m.code AS based_at, strftime(CAST(date AS DATE), '%Y-%m-%d') AS last_action_date, CASE WHEN seq % 2 = 0 THEN 'Active' ELSE 'Inactive' END AS status,
  registrant AS kit_mfr, CASE WHEN seq % 5 = 0 THEN registrant || '|' || m.code ELSE m.code END AS other_names FROM m LEFT JOIN one ON one.code = m.code WHERE n <> '' OR s <> ''""")
def registry_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Registry text rows, typed, decoded and filtered."""
    k, none = F.col("seq"), F.lit(None).cast("string")
    rows = registry(spark, sf)
    filled = {"n_number": F.when(k % 4 != 0, F.col("n_number")), "serial": F.when(k % 3 != 0, F.col("serial")), "code": F.col("code"), "year": F.substring("date", 1, 4), "registrant": F.col("registrant"), "city": F.col("registrant"), "state": F.col("code")}
    filled |= {"last_action_date": F.replace(F.col("date"), F.lit("-"), F.lit("")), "status_code": F.when(k % 2 == 0, "V").otherwise("R"), "other_name_1": F.when(k % 5 == 0, F.col("registrant")), "other_name_2": F.col("code"), "kit": F.concat("registrant", F.lit(", x"))}
    text = rows.select("seq", *(filled.get(c, none).alias(c) for c in schemas.MASTER))
    out = pipelines.registry_rows(text, types(spark, sf))
    return out.select("seq", "n_number", "model", "year", "based_at", F.col("last_action_date").cast("string").alias("last_action_date"), "status", "kit_mfr", F.array_join("other_names", "|").alias("other_names"))


@query(f"""WITH {FLEET} SELECT serial, registration, model, count(*) AS rows, max(id) AS last_seq FROM fleet WHERE trim(serial) <> '' OR trim(registration) <> '' GROUP BY serial, registration, make, model, size""")
def fleet_table(spark: SparkSession, sf: str) -> DataFrame:
    """Fleet rows twice over: each id once, its last row; rows without identifiers go."""
    rows = fleet(spark, sf).select(F.col("id").alias("seq"), F.col("serial").alias("serial_number"), F.col("registration").alias("registration_number"), F.col("make").alias("manufacturer"), "model", F.col("size").alias("manufacturer_year"), F.lit(None).cast("int").alias("delivery_year"), F.lit(None).cast("string").alias("category"))
    named = pipelines.fleet_table(rows.withColumn("last_seq", F.col("seq")))
    size = rows.groupBy("serial_number", "registration_number", "manufacturer", "model", "manufacturer_year").agg(F.count("*").alias("rows"))
    return named.join(size, ["serial_number", "registration_number", "manufacturer", "model", "manufacturer_year"]).select(F.col("serial_number").alias("serial"), F.col("registration_number").alias("registration"), "model", "rows", "last_seq")


@query(f"""WITH {SNAP} SELECT url, seq AS position, CAST(regexp_replace(price_text, '[^0-9.]', '', 'g') AS BIGINT) AS price, 'Make' || (seq % 7) AS make, 'M ' || status AS model, CAST(substr(date, 1, 4) AS INTEGER) AS year, nullif(trim(CASE WHEN seq % 3 = 0 THEN ' ' ELSE location END), '') AS location
FROM snap WHERE seq % 11 <> 0""")
def index_events(spark: SparkSession, sf: str) -> DataFrame:
    """Index records as events; every eleventh lacks its URL."""
    k, none = F.col("seq"), F.lit(None).cast("string")
    feed = snapshots(spark, sf).select(
        F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit(" "), "url")).alias("listing_url"), F.to_date("date").alias("ingestion_date"), k.alias("pos"), F.concat(F.substring("date", 1, 4), F.lit(" Make"), k % 7, F.lit("  M "), "status").alias("aircraft_model"),
        none.alias("year"), F.col("price_text").alias("listing_price"), F.when(k % 3 == 0, " ").otherwise(F.col("location")).alias("listing_location"), none.alias("total_time_hours"),
    )
    return pipelines.index_events(feed, "a").select("url", "position", F.col("price").cast("bigint").alias("price"), "make", "model", "year", "location")
