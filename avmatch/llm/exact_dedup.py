"""Exact dedup with a heavy-hitter split: copies of frequent texts never meet in a shuffle.

DataFrame functions only.

1. Every row becomes its id and the SHA-256 digest of its text with white space runs as one blank; texts stay where
   they are.
2. Misra-Gries: Spark's frequent-items sketch keeps a bounded number of counters for each task; sketches are merged in
   two steps. Every digest that holds more than one in ``counters`` rows is among its candidates, with others.
3. Candidates are verified by exact counts. Fewer than ``counters`` digests can hold more than one in ``counters`` rows,
   so the table of their winners is bounded; it is broadcast, and their copies are told by the task that read them.
4. All other digests are shuffled as usual: no group there is more than one in ``counters`` of all rows.

Null texts are empty, and so equal to blank ones only after those became one blank: "" and " " differ. The winner is the
row with the smallest doc_id, null last; of rows that repeat it, one. A group of null ids only has no keep_id, but a row
that stays. Texts of any length are digested whole; an empty table gives an empty table.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from avmatch.llm.store import stash

#: A digest is frequent if it holds more than one row in so many.
COUNTERS = 4096
#: The sketch errs by up to 3.5 rows in as many as it has cells (a power of two, three quarters of it used), and names
#: items that surely hold more than that. Six times the counters make eight times as many cells.
ROOM = 6
#: Groups of tasks whose sketches are merged first.
FAN = 64


def digest(text: Column) -> Column:
    """SHA-256 of a text (null: empty) with each run of white space as one blank, in 32 bytes."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256))


def frequent(rows: DataFrame, column: str, counters: int) -> DataFrame:
    """(hash): 64-bit hashes among which is that of every value of the column that more than one in `counters` rows has.

    At most 2 * counters of them. rows: a written table.
    """
    part = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(FAN)).alias("part")).agg(F.expr(f"approx_top_k_accumulate(xxhash64({column}), {ROOM * counters})").alias("sketch"))
    # Grouped, since the sketch of a task without rows has no item type and can't be merged.
    whole = part.groupBy(F.lit(0).alias("all")).agg(F.expr(f"approx_top_k_combine(sketch, {ROOM * counters})").alias("sketch"))
    return whole.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {2 * counters})")).alias("found")).select(F.col("found.item").alias("hash"))


def winners(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(digest, size, winner): verified groups of more than one in `counters` rows; fewer than `counters`."""
    total = rows.count()
    if not total:
        return rows.groupBy("digest").agg(F.count("*").alias("size"), F.min(order()).alias("winner"))
    found = rows.join(F.broadcast(frequent(rows, "digest", counters)), F.xxhash64("digest") == F.col("hash"), "left_semi")
    return found.groupBy("digest").agg(F.count("*").alias("size"), F.min(order()).alias("winner")).where(F.col("size") * counters > total)


def order() -> Column:
    """What the winner of a group is the least of."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest) for each row of docs (doc_id, text); extra columns are ignored."""
    rows = stash(docs.select("doc_id", digest(F.col("text")).alias("digest"), F.monotonically_increasing_id().alias("row")), "digests")
    heavy = stash(winners(rows, counters), "winners")
    told = rows.join(F.broadcast(heavy), "digest")
    rest = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    same = Window.partitionBy("digest")
    rest = rest.withColumn("size", F.count("*").over(same)).withColumn("winner", F.min(order()).over(same))
    return told.unionByName(rest).select("doc_id", F.col("winner.doc_id").alias("keep_id"), F.col("size").alias("group_size"), (F.col("row") == F.col("winner.row")).alias("kept"), "digest")


def deduplicate(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """The rows of docs that stay, with all their columns: one of each group of equal texts.

    Columns named `_digest`, `_doc` or `_same` must not be there.
    """
    stay = groups(docs, counters).where("kept").select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_same"))
    rows = docs.withColumn("_digest", digest(F.col("text")))
    kept = rows.join(stay, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_digest") == F.col("_same")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_digest"]).select(*docs.columns)
