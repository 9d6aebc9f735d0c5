"""Fixed-size bitmaps of ids, so that rows which certainly aren't among them needn't be shuffled to find out.

DataFrame functions only. The bitmap has at least ``PER_ID`` bits for each id, and ``MOST`` pieces of 4 kB at most, so
its broadcast is bounded; a fuller one only leaves more rows in doubt, which an exact join decides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of one of Spark's bitmaps, bits for each id, and pieces (16 MB in all).
PIECE, PER_ID, MOST = 32_768, 16, 4096


def split(rows: DataFrame, column: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may have one of the ids, rows that certainly have none). ids: one column of `column`'s type, in a
    written table, since it is read more than once. A null counts as an id."""
    pieces = max(1, min(MOST, -(-ids.count() * PER_ID // PIECE)))
    slot = F.pmod(F.xxhash64(ids.columns[0]), F.lit(pieces * PIECE))
    bits = ids.select(F.floor(slot / PIECE).cast("int").alias("_piece"), (slot % PIECE).alias("_at")).groupBy("_piece").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    mine = F.pmod(F.xxhash64(column), F.lit(pieces * PIECE))
    at = mine % PIECE
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    tested = rows.withColumn("_piece", F.floor(mine / PIECE).cast("int")).join(F.broadcast(bits), "_piece", "left")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return tested.where(maybe).select(*rows.columns), tested.where(~maybe).select(*rows.columns)
