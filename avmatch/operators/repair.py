"""Repairs of registry rows: serials and N-numbers that were stored wrongly, and rows that are missing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import ordered
from avmatch.operators.merge import insert_absent, pick_per_key


def serial_repairs(stored: DataFrame, master: DataFrame, any_difference: bool = False) -> DataFrame:
    """(seq, n_number, serial, new_serial, outcome) for stored rows; the master's last serial of a tail is right.

    outcome: no_match (tail not in master), no_serial, already_right, fixed (the serial was the tail, or, with
    any_difference, just differed) or skipped.
    """
    tails = master.select(clean.registration_key(F.col("n_number")).alias("_tail"), clean.blank_to_null(F.col("serial")).alias("new_serial"), "seq").where("_tail is not null")
    tails = pick_per_key(tails, ["_tail"], ["seq"]).drop("seq").withColumn("_hit", F.lit(True))
    rows = stored.withColumn("_tail", clean.registration_key(F.col("n_number"))).join(tails, "_tail", "left")
    wrong = clean.serial_is_tail(F.col("serial"), F.col("n_number"))
    differs = ~F.trim("serial").eqNullSafe(F.col("new_serial"))
    fixes = differs if any_difference else wrong
    outcome = F.when(F.col("_hit").isNull(), "no_match").when(F.col("new_serial").isNull(), "no_serial").when(~differs, "already_right").when(fixes, "fixed").otherwise("skipped")
    return rows.select("seq", "n_number", "serial", "new_serial", outcome.alias("outcome"))


def _tail_wants(stored: DataFrame, master: DataFrame, alias: bool, same_code: bool) -> DataFrame:
    """Stored rows whose serial is their tail, with new_n, the master's last N-number of the serial (exact key first, then
    without leading zeros), and its squeezed form _want."""
    keys = master.where(clean.not_blank(F.col("n_number"))).select(F.posexplode(clean.serial_lookup_keys(F.col("serial"), alias)).alias("_p", "_key"), F.col("n_number").alias("new_n"), F.col("code").alias("_code"), "seq")
    keys = pick_per_key(keys, ["_key"], ["seq"]).select("_key", "new_n", "_code")
    bad = stored.where(clean.serial_is_tail(F.col("serial"), F.col("n_number")))
    tried = bad.select("seq", F.posexplode_outer(clean.serial_lookup_keys(F.col("serial"), alias)).alias("_p", "_key"), "code").join(keys, "_key", "left")
    if same_code:
        tried = tried.withColumn("new_n", F.when(F.col("code").eqNullSafe(F.col("_code")), F.col("new_n")))
    best = tried.groupBy("seq").agg(F.min_by("new_n", F.when(F.col("new_n").isNotNull(), F.col("_p"))).alias("new_n"))
    return bad.join(best, "seq").withColumn("_want", clean.squeezed_n(F.col("new_n")))


def _outcome(taken: Column) -> Column:
    right = clean.squeezed_n(F.col("n_number")) == F.col("_want")
    return F.when(F.col("new_n").isNull(), "no_match").when(right, "already_right").when(taken, "conflict").otherwise("fixed").alias("outcome")


def tail_repairs(stored: DataFrame, master: DataFrame, alias: bool = True, same_code: bool = False, dry_run: bool = False) -> DataFrame:
    """(seq, n_number, serial, new_n, outcome) for stored rows whose serial is their tail; the master's last N-number of
    the serial is right, unless another row of that date has it in the stored table or, but for a dry run, an earlier
    row claims it. A dry run changes nothing, so its rows don't see each other's claims. All at once: see
    applied_tail_repairs for row by row."""
    rows = _tail_wants(stored, master, alias, same_code)
    taken = stored.select(F.col("date").alias("_date"), clean.squeezed_n(F.col("n_number")).alias("_n")).where("_n <> ''").distinct().withColumn("_taken", F.lit(True))
    rows = rows.join(taken, (F.col("_want") == F.col("_n")) & (F.col("date") == F.col("_date")), "left")
    # Rows that want no tail claim nothing: each is a group of its own, so they don't meet in one task.
    lone = F.when(F.col("_want").isNull(), F.col("seq"))
    late = F.lit(False) if dry_run else F.row_number().over(Window.partitionBy("date", "_want", lone).orderBy("seq")) > 1
    return rows.select("seq", "n_number", "serial", "new_n", _outcome(F.col("_taken").isNotNull() | late))


def applied_tail_repairs(stored: DataFrame, master: DataFrame, alias: bool = True, same_code: bool = False) -> DataFrame:
    """As tail_repairs, but as if rows were repaired one by one in the order of seq, each change in force for the next:
    a tail that an earlier repair leaves is free for later rows.

    A row gets its tail if every row that had it has left before, and no other row has claimed it since. So its answer is
    known at once, or it is that of the rows that have its tail now: pointers, which are doubled until all are known. A
    chain of n rows takes log2(n) rounds. Where several rows have one tail (it is spelt in two ways), a round also
    asks whether all of them have left.
    """
    wants = ordered.cut(_tail_wants(stored, master, alias, same_code).select("date", "seq", "n_number", "serial", "new_n", "_want"))
    moves = wants.where(clean.squeezed_n(F.col("n_number")) != F.col("_want"))
    key = F.concat_ws("|", "date", "_want")
    claims = ordered.numbered(moves.select("seq", key.alias("_key")), ["seq"])
    claims = ordered.cut(ordered.running(claims, "_key", {"_before": F.col("seq")}))
    # Rows that have a tail somebody wants: those that don't want another one never leave it.
    holders = stored.select("seq", F.concat_ws("|", "date", clean.squeezed_n(F.col("n_number"))).alias("_key"), clean.squeezed_n(F.col("n_number")).alias("_n")).where("_n <> ''")
    holders = holders.join(claims.select("_key").distinct(), "_key", "left_semi").join(claims.select("seq", F.lit(True).alias("_moves")), "seq", "left")
    held = holders.groupBy(F.col("_key").alias("_held")).agg(F.count("*").alias("n"), F.count_if(F.col("_moves").isNull()).alias("stay"), F.max("seq").alias("last"))
    rows = claims.join(held, F.col("_key") == F.col("_held"), "left")
    first, last = F.col("_before").isNull(), F.col("last")
    possible = (F.col("stay") == 0) & (last < F.col("seq")) & (first | (last > F.col("_before")))
    known = F.when(F.col("n").isNull(), first).when(~possible, F.lit(False))
    rows = ordered.cut(rows.select("seq", "_key", known.alias("ok"), F.when(known.isNull() & (F.col("n") == 1), last).alias("at")))
    several = rows.where("ok is null and at is null").select(F.col("seq").alias("_claim"), "_key")
    several = ordered.cut(several.join(holders.select("_key", F.col("seq").alias("_holder")), "_key").select("_claim", "_holder"))
    while not rows.where("ok is null").isEmpty():
        there = rows.select(F.col("seq").alias("_at"), F.col("ok").alias("_ok"), F.col("at").alias("_next"))
        left = several.join(rows.where("ok is not null").select(F.col("seq").alias("_holder"), "ok"), "_holder", "left")
        left = left.groupBy("_claim").agg(F.min(F.coalesce("ok", F.lit(True))).alias("_all"), F.count_if(F.col("ok").isNull()).alias("_open"))
        next_ = rows.join(there, F.col("at") == F.col("_at"), "left").join(left, F.col("seq") == F.col("_claim"), "left")
        from_all = F.when(~F.col("_all"), F.lit(False)).when(F.col("_open") == 0, F.lit(True))
        rows = ordered.cut(next_.select("seq", "_key", F.coalesce("ok", "_ok", from_all).alias("ok"), F.coalesce("_next", "at").alias("at")))
    told = wants.join(rows.select("seq", "ok"), "seq", "left")
    return told.select("seq", "n_number", "serial", "new_n", _outcome(~F.col("ok")))


def key_collisions(master: DataFrame, alias: bool = True) -> DataFrame:
    """(key, collisions): how often, in row order, a lookup key changes its N-number."""
    keys = master.where(clean.not_blank(F.col("n_number"))).select(F.explode(clean.serial_lookup_keys(F.col("serial"), alias)).alias("key"), clean.squeezed_n(F.col("n_number")).alias("n"), "seq")
    before = F.lag("n").over(Window.partitionBy("key").orderBy("seq"))
    return keys.withColumn("_was", before).groupBy("key").agg(F.count_if(F.col("_was") != F.col("n")).alias("collisions")).where("collisions > 0")


def collision_sample(master: DataFrame, alias: bool = True, n: int = 12) -> DataFrame:
    """(seq, key, was, n_number): the report's first n rows, in row order, where a lookup key changes its N-number."""
    keys = master.where(clean.not_blank(F.col("n_number"))).select("seq", F.explode(clean.serial_lookup_keys(F.col("serial"), alias)).alias("key"), clean.squeezed_n(F.col("n_number")).alias("n_number"))
    rows = keys.withColumn("was", F.lag("n_number").over(Window.partitionBy("key").orderBy("seq"))).where("was <> n_number")
    return rows.select("seq", "key", "was", "n_number").orderBy("seq", "key").limit(n)


def backfill(stored: DataFrame, master: DataFrame, entities: DataFrame) -> DataFrame:
    """Master rows to insert, with all their columns: the first row of each (serial, code, registrant) that is not stored.

    Rows without a serial or a code go. n_number is null where it is stored already or an earlier row of the batch claims it; entity_id is the lowest
    one of the serial, null for a new aircraft.
    """
    valid = master.where(clean.not_blank(F.col("serial")) & clean.not_blank(F.col("code")))
    new = insert_absent(stored, valid, ["serial", "code", "registrant"], ["seq"])
    key = clean.squeezed_n(F.col("n_number"))
    lone = F.when(F.coalesce(key, F.lit("")) == "", F.col("seq"))  # rows without a tail claim nothing
    claim = F.row_number().over(Window.partitionBy(key, lone).orderBy("seq"))
    held = stored.select(key.alias("_n")).where("_n <> ''").distinct().withColumn("_held", F.lit(True))
    rows = new.withColumn("_claim", claim).withColumn("_key", key).join(held, F.col("_key") == F.col("_n"), "left")
    known = entities.where(F.trim("serial") != "").groupBy(F.col("serial").alias("_serial")).agg(F.min("entity_id").alias("entity_id"))
    rows = rows.join(known, F.col("serial") == F.col("_serial"), "left")
    lost = (F.col("_claim") > 1) | F.col("_held").isNotNull()
    kept = [F.when(~lost, F.col(c)).alias(c) if c == "n_number" else F.col(c) for c in master.columns if c != "entity_id"]
    return rows.select(*kept, F.coalesce(lost & (F.col("_key") != ""), F.lit(False)).alias("n_conflict"), "entity_id")


def backfill_summary(stored: DataFrame, master: DataFrame, inserted: DataFrame) -> DataFrame:
    """One row: processed master rows, stored signatures, rows inserted, skipped as stored or repeated, without a serial or
    code, N-numbers left out of inserted rows, and new aircraft (serials without an entity)."""
    valid = clean.not_blank(F.col("serial")) & clean.not_blank(F.col("code"))
    counts = [
        master.agg(F.count("*").alias("processed"), F.count_if(valid).alias("_valid")),
        stored.select("serial", "code", "registrant").distinct().agg(F.count("*").alias("stored_signatures")),
        inserted.agg(F.count("*").alias("inserted"), F.count_if("n_conflict").alias("n_conflicts"), F.count_distinct(F.when(F.col("entity_id").isNull(), F.col("serial"))).alias("new_aircraft")),
    ]
    # Each is one row, so they are stacked and summed rather than joined.
    named = [c for df in counts for c in df.columns]
    rows = reduce(DataFrame.unionByName, (df.select(*(F.col(c) if c in df.columns else F.lit(0).cast("long").alias(c) for c in named)) for df in counts))
    out = rows.agg(*(F.sum(c).alias(c) for c in named))
    return out.select("processed", "stored_signatures", "inserted", (F.col("_valid") - F.col("inserted")).alias("skipped_existing"), (F.col("processed") - F.col("_valid")).alias("skipped_blank"), "n_conflicts", "new_aircraft")


def outcome_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("outcome").agg(F.count("*").alias("n"))
