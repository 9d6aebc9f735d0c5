"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources by code point (null last) weigh 1, 2, 3, repeating. Their targets share the corpus's words by weight; one
that passes ``times`` its source's size stops there, and the excess is shared among the rest by weight. Blocks of
about ``block`` words are then given to sources by highest quotients (target over 1, 3, 5, ...), each source's blocks
to its groups of ``GROUP`` shards, and each group's to its shards likewise. A shard is a line of its documents in
seeded order, cut into equal blocks; its quota is whole passes over the line and, for the rest, a run of blocks from a
seeded start, around the end. A document's take is what the picked blocks cover of it.

Equal quotients go to the source that comes first, then to the lower shard. Null texts have size 0 and are never taken.
Rows that repeat a doc_id are mixed one by one; a text of any length counts whole. An empty table, or one without
words, takes nothing. Totals of sources meet in one group, and those of at most ``GROUP`` shards or of a source's
groups of shards; documents never do.
"""

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK, SHARD_DOCS, GROUP, TIMES, SEED = 16, 2000, 1024, 3, 17


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sainte_lague(votes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats by highest quotients votes / (2k + 1), with at most `most` for each.

    A divisor gives the seats whose quotients surely win; the few that are left go one by one by a priority queue.
    """
    seats = int(min(seats, most.sum()))
    held = np.zeros(len(votes), np.int64)
    if seats <= 0 or votes.sum() <= 0:
        return held

    def at(divisor: float) -> np.ndarray:
        return np.minimum(most, np.floor(votes / divisor + 0.5).astype(np.int64))

    low, high = 1e-12, 3 * float(votes.max()) + 1
    for _ in range(200):
        middle = (low * high) ** 0.5
        low, high = (middle, high) if at(middle).sum() > seats else (low, middle)
    held = at(high)
    queue = [(-v / (2 * k + 1), n) for n, (v, k, m) in enumerate(zip(votes.tolist(), held.tolist(), most.tolist(), strict=True)) if v > 0 and k < m]
    heapq.heapify(queue)
    for _ in range(seats - int(held.sum())):
        if not queue:
            break
        _, n = heapq.heappop(queue)
        held[n] += 1
        if held[n] < most[n]:
            heapq.heappush(queue, (-votes[n] / (2 * held[n] + 1), n))
    return held


def targets(sources: DataFrame, times: int = TIMES) -> DataFrame:
    """sources (source, source_size, ...) with weight and target. One row for each source is all that meets here."""
    everything = Window.partitionBy(F.lit(0))
    rows = sources.withColumn("weight", (F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))) - 1) % 3 + 1)
    rows = rows.withColumn("cap", times * F.col("source_size"))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    rows = rows.withColumn("level", left / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    capped = F.col("cap") <= F.col("weight") * F.col("level")
    level = F.max(F.when(~capped, F.col("level"))).over(everything)
    return rows.withColumn("target", F.when(capped, F.col("cap").cast("double")).otherwise(F.col("weight") * level)).drop("cap", "level")


def _divided(parts: DataFrame, whole: DataFrame, keys: list[str], order: list[str], quota: str) -> DataFrame:
    """parts (keys..., order..., length, blocks) with `quota`: the seats of their whole (keys..., seats), by length."""
    named = whole.select(*(F.col(k).alias(f"_{k}") for k in keys), "seats")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    columns = [f.name for f in parts.schema]

    def divide(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        seats = sainte_lague(pdf["length"].to_numpy(float), int(pdf["seats"].iloc[0]), TIMES * pdf["blocks"].to_numpy(np.int64))
        return pdf.assign(**{quota: seats})[[*columns, quota]]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return parts.join(named, same).drop(*(f"_{k}" for k in keys)).groupBy(*keys).applyInPandas(divide, f"{schema}, {quota} long")


def taken(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, shard, size, source_size, target, taken) for each row of docs (doc_id, text, source)."""
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    sources = targets(sources.withColumn("shards", F.ceil(F.col("docs") / SHARD_DOCS).cast("int")))
    keyed = sources.select(F.col("source").alias("_source"), "source_size", "target", "shards")
    rows = sized.join(keyed, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(seed)), "shards").cast("int"))

    shards = rows.groupBy("source", "shard").agg(F.sum("size").alias("length"))
    shards = shards.withColumn("blocks", F.when(F.col("length") > 0, F.greatest(F.lit(1), F.round(F.col("length") / block))).otherwise(0).cast("long"))
    shards = shards.withColumn("group", F.floor(F.col("shard") / GROUP).cast("int"))
    groups = shards.groupBy("source", "group").agg(F.sum("length").alias("length"), F.sum("blocks").alias("blocks"))
    total = groups.groupBy("source").agg(F.sum("blocks").alias("blocks"), F.sum("length").alias("length"))
    total = total.join(keyed.select("_source", "target"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    def by_source(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source", na_position="last", kind="stable")
        seats = int(pdf["blocks"].sum())
        return pdf.assign(seats=sainte_lague(pdf["target"].to_numpy(float), seats, TIMES * pdf["blocks"].to_numpy(np.int64)))[["source", "seats"]]

    seats = total.withColumn("one", F.lit(0)).groupBy("one").applyInPandas(by_source, "source string, seats long")
    quotas = _divided(groups, seats, ["source"], ["group"], "seats")
    quotas = _divided(shards, quotas.select("source", "group", "seats"), ["source", "group"], ["shard"], "quota")
    quotas = quotas.select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "length", "blocks", "quota")

    line = Window.partitionBy("source", "shard").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "size")
    rows = rows.withColumn("at", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rows = rows.join(quotas, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    width = F.col("length") / F.col("blocks")
    rest = F.col("quota") % F.col("blocks")
    start = F.pmod(F.xxhash64("source", "shard", F.lit(seed)), F.col("blocks"))

    def covered(first: Column, last: Column) -> Column:
        """Words of the document in blocks first to last (exclusive)."""
        inside = F.least(F.floor(last * width), F.col("at") + F.col("size")) - F.greatest(F.floor(first * width), F.col("at"))
        return F.greatest(inside, F.lit(0))

    some = covered(start, F.least(start + rest, F.col("blocks"))) + covered(F.lit(0), F.greatest(start + rest - F.col("blocks"), F.lit(0)))
    words_taken = F.when(F.col("size") > 0, F.floor(F.col("quota") / F.col("blocks")) * F.col("size") + some).otherwise(0).cast("long")
    return rows.select("doc_id", "source", "shard", "size", "source_size", "target", words_taken.alias("taken"))


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row of docs (doc_id, text, source)."""
    return taken(docs, block, seed).select("doc_id", "size", "source_size", "target", "taken")


def copies(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, times): how often whole documents stand in the mix, for those that do.

    Shares taken of documents are rounded along each shard's line by size, so that the rounding of one is made up by
    the next, which is about as long; a source's words stay within some documents' sizes of its target. A source of a
    single document of which less than half is taken has none. Rows that repeat a doc_id share one number.
    """
    each = taken(docs, seed=seed).where("size > 0")
    line = Window.partitionBy("source", "shard").orderBy("size", F.xxhash64("doc_id", F.lit(seed + 2)), "doc_id", "taken")
    share = F.col("taken") / F.col("size")
    upto = F.sum(share).over(line.rowsBetween(Window.unboundedPreceding, 0))
    times = F.floor(F.round(upto, 6) + 0.5) - F.floor(F.round(upto - share, 6) + 0.5)
    found = each.withColumn("times", times).groupBy("doc_id").agg(F.round(F.avg("times")).cast("int").alias("times"))
    return found.where("times > 0")
