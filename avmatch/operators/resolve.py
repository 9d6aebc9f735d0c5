"""Entity resolution: which known aircraft a record is, by serial or else by registration.

Two equi-joins instead of one join with OR, which Spark can only plan as a nested loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avmatch.functions import clean
from avmatch.operators import ordered
from avmatch.operators.merge import pick_per_key
from avmatch.operators.ordered import with_key


def lookup(records: DataFrame, entities: DataFrame) -> DataFrame:
    """records (serial, registration, ...) with entity_id and matched_by; the lowest id of a key wins."""
    out = records
    for k in ("serial", "registration"):
        by = entities.where(F.col(k).isNotNull() & (F.col(k) != "")).groupBy(F.col(k).alias(f"_k_{k}")).agg(F.min("entity_id").alias(f"_by_{k}"))
        out = with_key(out, k, by, f"_k_{k}")
    out = out.withColumn("entity_id", F.coalesce("_by_serial", "_by_registration"))
    matched = F.when(F.col("_by_serial").isNotNull(), "serial").when(F.col("_by_registration").isNotNull(), "registration")
    return out.withColumn("matched_by", matched).drop("_by_serial", "_by_registration")


def new_keys(records: DataFrame, order: str) -> DataFrame:
    """For records without an entity: the key of the new entity each belongs to.

    A record with both identifiers joins the earliest record that shares either (one hop, no closure); the new
    entity is keyed by that record's serial, else its registration. Records without identifiers have no entity.
    """
    rows = records.withColumn("_own", F.coalesce(F.nullif("serial", F.lit("")), F.nullif("registration", F.lit("")))).where("_own is not null")
    first = rows
    for k in ("serial", "registration"):
        heads = rows.where(F.col(k).isNotNull() & (F.col(k) != "")).groupBy(F.col(k).alias(f"_k_{k}")).agg(F.min(F.struct(order, "_own")).alias(f"_h_{k}"))
        first = with_key(first, k, heads, f"_k_{k}")
    head = F.least("_h_serial", "_h_registration")
    return first.withColumn("entity_key", head["_own"]).drop("_own", "_h_serial", "_h_registration")


def _owners(entities: DataFrame, key: str) -> DataFrame:
    """(key, entity_id): the lowest id that has a key."""
    return entities.where(F.col(key) != "").groupBy(F.col(key).alias(f"_own_{key}")).agg(F.min("entity_id").alias(f"_has_{key}"))


def _named(serial: Column, registration: Column) -> Column:
    """The id of a new entity, from its serial or else its registration."""
    by_registration = clean.stable_id(F.lit("aircraft"), F.lit("registration"), registration)
    return F.when(serial != "", clean.stable_id(F.lit("aircraft"), serial)).otherwise(by_registration)


def resolve_in_order(records: DataFrame, entities: DataFrame, order: Sequence[str], fill: bool = False) -> DataFrame:
    """Which entity each record is, as if records (serial, registration, ...) came one by one in the given order.

    A record is the entity that has its serial, or else the one that has its registration just then, or else a new
    entity with both. An entity keeps its serial. fill: a record found by its serial also gives the entity its
    registration, unless another entity has it at that moment; the entity's former registration is free from then on.
    Without fill identifiers stay as they were first stored. Of several entities with a key the lowest id has it.

    Records get entity_id (text; null without any identifier), is_new (this record made it) and took (the entity has the
    record's registration by this record). Ties in the order are told by serial, then registration.

    The rule is sequential, but a record only waits for earlier ones that could change its answer. Rounds answer all
    records that no open earlier one could change, and hold open records only, with what these still have to know. So there
    are as many rounds as the longest chain of dependences, and what is written shrinks with the open records; a serial, a
    registration or a pair that very many records share costs two rounds, not one for each.
    """
    shown = records.columns
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = ordered.numbered(records.withColumn("_s", text("serial")).withColumn("_r", text("registration")), [*order, "_s", "_r"])
    held = entities.select("entity_id", text("serial").alias("serial"), text("registration").alias("registration"))
    answered = (_filled if fill else _first_come)(rows, _owners(held, "serial"), _owners(held, "registration"))
    return answered.select(*(c for c in shown if c not in ("entity_id", "is_new", "took")), "entity_id", "is_new", "took")


def _first_come(rows: DataFrame, by_serial: DataFrame, by_registration: DataFrame) -> DataFrame:
    """Answers without fill. Only the first row of a serial and a registration can make an entity, and it does if no earlier
    maker has either: the greedy matching of serials and registrations. Each round takes all rows that are the first
    open one of both, and drops those that share a key with them."""
    open_rows = rows.where("_s <> '' or _r <> ''").groupBy("_s", "_r").agg(F.min("_k").alias("_k"))
    for key, owners, name in (("_s", by_serial, "serial"), ("_r", by_registration, "registration")):
        open_rows = with_key(open_rows, key, owners, f"_own_{name}").where(F.col(f"_has_{name}").isNull()).drop(f"_has_{name}")
    open_rows, made = ordered.cut(open_rows), None
    while made is None or not open_rows.isEmpty():
        marked = open_rows
        for key in ("_s", "_r"):
            heads = open_rows.where(F.col(key) != "").groupBy(F.col(key).alias("_own")).agg(F.min("_k").alias(f"_head{key}"))
            marked = with_key(marked, key, heads, "_own")
        is_head = F.coalesce(F.col("_head_s") == F.col("_k"), F.lit(True)) & F.coalesce(F.col("_head_r") == F.col("_k"), F.lit(True))
        marked = ordered.cut(marked.select("_s", "_r", "_k", is_head.alias("makes")))
        now, open_rows = marked.where("makes").drop("makes"), marked.where("not makes").drop("makes")
        for key in ("_s", "_r"):
            taken = now.where(F.col(key) != "").select(F.col(key).alias("_own"), F.lit(True).alias("_taken"))
            open_rows = with_key(open_rows, key, taken, "_own").where("_taken is null").drop("_taken")
        open_rows = ordered.cut(open_rows)
        made = now if made is None else made.unionByName(now)
    made = made.withColumn("_id", _named(F.col("_s"), F.col("_r")))
    out = rows
    for key, owners, name in (("_s", by_serial, "serial"), ("_r", by_registration, "registration")):
        stored = owners.select(F.col(f"_own_{name}").alias("_own"), F.lit(-1).cast("long").alias(f"_at{key}"), F.col(f"_has_{name}").cast("string").alias(f"_id{key}"))
        new = made.where(F.col(key) != "").select(F.col(key).alias("_own"), F.col("_k").alias(f"_at{key}"), F.col("_id").alias(f"_id{key}"))
        out = with_key(out, key, stored.unionByName(new), "_own")
    k = F.col("_k")
    is_new = F.coalesce(F.col("_at_s") == k, F.lit(False)) | F.coalesce(F.col("_at_r") == k, F.lit(False))
    out = out.drop("entity_id", "is_new", "took").withColumn("entity_id", F.when(F.col("_at_s") <= k, F.col("_id_s")).when(F.col("_at_r") <= k, F.col("_id_r")))
    return out.withColumn("is_new", is_new).withColumn("took", is_new & (F.col("_r") != ""))


def _filled(rows: DataFrame, by_serial: DataFrame, by_registration: DataFrame) -> DataFrame:
    """Answers with fill: rounds over open rows and the takers of registrations that those still have to know."""
    events = with_key(rows.select("_k", "_s", "_r"), "_s", by_serial, "_own_serial").select("_k", "_s", "_r", F.col("_has_serial").cast("string").alias("aid"), F.lit(False).alias("done"))
    # What is stored comes first: owners of a registration that the batch names.
    named = rows.where("_r <> ''").select(F.col("_r").alias("_own_registration")).distinct()
    first = by_registration.join(named, "_own_registration", "left_semi").select(F.lit(-1).cast("long").alias("_k"), F.lit("").alias("_s"), F.col("_own_registration").alias("_r"), F.col("_has_registration").cast("string").alias("aid"), F.lit(True).alias("done"))
    state = ordered.cut(events.where("_s <> '' or _r <> ''").unionByName(first))
    no, yes = F.lit(False), F.lit(True)
    answers = rows.where("_s = '' and _r = ''").select("_k", F.lit(None).cast("string").alias("entity_id"), no.alias("is_new"), no.alias("took"))
    open_rows = state.where("not done")
    while not open_rows.isEmpty():
        after = ordered.cut(_round(state))
        open_rows = after.where("not done and not now")
        answers = answers.unionByName(after.where("now").select("_k", F.col("aid").alias("entity_id"), "is_new", "took"))
        made = after.where("is_new and _s <> ''").select(F.col("_s").alias("_own"), F.col("aid").alias("_made"))
        left = with_key(open_rows, "_s", made, "_own").select("_k", "_s", "_r", F.coalesce("aid", "_made").alias("aid"), no.alias("done"))
        # Of takers those that have, or had, a registration of an open row, with all that these did.
        takers = after.where("done or moves").select("_k", "_s", "_r", "aid", yes.alias("done"))
        asked = open_rows.where("_r <> ''").select("_r").distinct()
        state = left.unionByName(takers.join(takers.join(asked, "_r", "left_semi").select("aid").distinct(), "aid", "left_semi"))
    return rows.drop("entity_id", "is_new", "took").join(answers, "_k")


def _round(state: DataFrame) -> DataFrame:
    """state: open rows, and done ones, each of which took its registration. now: rows that this round answers; moves: of
    those, the ones by which a registration changed hands."""
    k, aid, filled = F.col("_k"), F.col("aid"), F.col("_r") != ""
    # When a taker took another registration (_moved), or may have (_turn): rows by which the one that its entity named changes.
    acts = filled & aid.isNotNull()
    here = F.struct("_k", "_r")
    rows = ordered.cut(ordered.running(state, "aid", {"_acted": F.when(acts, here), "_took": F.when(acts & F.col("done"), here)}))
    unknown = rows.where(aid.isNull() & ~F.col("done") & (F.col("_s") != "")).groupBy(F.col("_s").alias("_own")).agg(F.min("_k").alias("_head_s"))
    open_r = rows.where(~F.col("done") & filled).groupBy(F.col("_r").alias("_own")).agg(F.min("_k").alias("_head_r"))
    changed = lambda c: F.coalesce(F.col(c)["_r"] != F.col("_r"), F.lit(True))
    turns = {"_turn": F.when(acts & changed("_acted"), k), "_moved": F.when(acts & F.col("done") & changed("_took"), k)}
    rows = ordered.running(rows, "aid", turns, later=True, base=rows).drop("_acted", "_took")
    rows = ordered.running(rows, "_r", {"_last": F.when(F.col("done"), F.struct("_k", "aid", "_moved", "_turn"))})
    rows = with_key(with_key(rows, "_s", unknown, "_own"), "_r", open_r, "_own")
    last = F.col("_last")
    holds = last.isNotNull() & F.coalesce(last["_turn"] >= k, F.lit(True))
    free = (last.isNull() | F.coalesce(last["_moved"] < k, F.lit(False))) & (k == F.col("_head_r")) | ~filled
    mover, finder = aid.isNotNull(), aid.isNull() & ((F.col("_s") == "") | (k == F.col("_head_s")))
    now = F.coalesce(~F.col("done") & (mover | finder) & (free | holds), F.lit(False))
    is_new, moves = now & finder & free, now & filled & free
    took = moves | now & filled & F.coalesce(holds & mover & (last["aid"] == aid), F.lit(False))
    found = F.when(now & finder, F.when(free, _named(F.col("_s"), F.col("_r"))).otherwise(last["aid"])).otherwise(aid)
    no = lambda c: F.coalesce(c, F.lit(False))
    return rows.select("_k", "_s", "_r", found.alias("aid"), "done", now.alias("now"), no(is_new).alias("is_new"), no(moves).alias("moves"), no(took).alias("took"))


def get_or_create(records: DataFrame, entities: DataFrame, order: str, fill: bool = False) -> DataFrame:
    """resolve_in_order by one column."""
    return resolve_in_order(records, entities, [order], fill)


def entity_rows(records: DataFrame, order: Sequence[str]) -> DataFrame:
    """What records of resolve_in_order fill in, a row for each entity: of every column the last value that is not null
    (blank text is null), but serials only from the record that made the entity, and registrations only from records
    by which it has them."""
    rows = records.where("entity_id is not null")
    rows = rows.select(*((clean.blank_to_null(F.col(c)) if t == "string" and c != "entity_id" else F.col(c)).alias(c) for c, t in rows.dtypes))
    rows = rows.withColumn("serial", F.when(F.col("is_new"), F.col("serial"))).withColumn("registration", F.when(F.col("took"), F.col("registration")))
    facts = [c for c in rows.columns if c not in ("entity_id", "is_new", "took", *order)]
    return pick_per_key(rows, ["entity_id"], order, fill=facts).drop("is_new", "took")
