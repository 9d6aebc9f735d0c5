"""Hard-negative mining with exact scores from a residue number system.

A row's score for an anchor is the inner product of their integer vectors, floor(scale * component). Products are
made by single-precision matrix products modulo small primes: residues lie within half a prime of zero, and primes are
chosen so that a sum of products stays below 2**24, where single precision is exact. Chinese remaindering turns the
residues of a score into the score, with as many primes as the largest possible score asks for.

1. Rows are dealt to shards and anchors to blocks, by hash, so that a common label is many shards. In the shards of its
   own label an anchor meets its positives: the `k` best rows of its label, ties to the smaller vec_id.
2. Every anchor, with its positives' scores, then meets the shards of all rows. For each positive the `k` best rows of
   another label count whose score s is in the window low * p <= 100 * s <= 100 * p.
3. Each cell returns at most k rows for an anchor and positive; a window over those gives the ranks.

Rows without vec_id, label or vector, or with a null or non-finite component (also after scaling), take no part. Vectors
of another length than the anchor's are no candidates. Rows that repeat a vec_id all count, and only the row itself is
not its own positive. Scores beyond the long range stand at its end. Extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avmatch.llm.store import shuffle_partitions, stash
from avmatch.llm.vectors import matrix, usable
from avmatch.llm.worker import small_batches

SCALE = 256
#: Components of a shard, or of a block of anchors, at least and at most.
LEAST, MOST = 1 << 18, 1 << 22
#: Anchors and rows that are multiplied at once.
ASK, STEP = 256, 2048
#: Sums of products below this are exact in single precision.
EXACT = 1 << 24
#: Components that are summed at once, at most.
RUN = 256
LONG = 2**63


@cache
def primes(width: int, bound: int) -> tuple[int, tuple[int, ...]]:
    """(components that are summed at once, odd primes): the largest primes p for which that many squares of half of p
    stay below EXACT, as many as tell scores of -bound to bound apart. Fewer components leave room for more primes."""
    run = max(1, min(RUN, width))
    while True:
        found, product = [], 1
        for p in range(2 * int((EXACT / run) ** 0.5) + 1, 2, -1):
            if run * ((p - 1) // 2) ** 2 < EXACT and all(p % q for q in range(2, int(p**0.5) + 1)):
                found.append(p)
                product *= p
                if product > 2 * bound:
                    return run, tuple(found)
        if run == 1:
            raise ValueError(f"products of up to {bound} are beyond the residues of single precision")
        run = -(-run // 2)


def residues(x: np.ndarray, p: int) -> np.ndarray:
    """Integers modulo p, within half of p of zero, in single precision."""
    r = np.fmod(x, p)
    r -= p * np.rint(r / p)
    return r.astype(np.float32)


class Scores:
    """Exact products of two sets of integer vectors (in doubles), block by block."""

    def __init__(self, q: np.ndarray, c: np.ndarray):
        top = int(np.abs(q).max(initial=0)) * int(np.abs(c).max(initial=0)) * max(1, q.shape[1])
        self.run, self.primes = primes(q.shape[1], top)
        self.q, self.c = [residues(q, p) for p in self.primes], [residues(c, p) for p in self.primes]
        #: Digits are joined in Python integers where the product of primes leaves 64 bits.
        product = 1
        for p in self.primes:
            product *= p
        self.product, self.dtype = product, np.int64 if product < LONG else object
        #: Inverse of the product of the primes before each, modulo it.
        self.inverse, before = [], 1
        for p in self.primes:
            self.inverse.append(pow(before, -1, p))
            before *= p

    def block(self, a: slice, b: slice) -> np.ndarray:
        """Scores of q[a] for c[b]: mixed-radix digits, prime by prime, and their value around zero."""
        value, before = None, 1
        for p, inverse, q, c in zip(self.primes, self.inverse, self.q, self.c, strict=True):
            r = sum((q[a, n : n + self.run] @ c[b, n : n + self.run].T).astype(np.int64) for n in range(0, q.shape[1], self.run))
            if value is None:
                value = r % p if self.dtype is np.int64 else (r % p).astype(object)
            else:
                digit = (r - (value % p).astype(np.int64)) % p * inverse % p
                value = value + digit.astype(self.dtype) * before
            before *= p
        value = np.where(value > self.product // 2, value - self.product, value)
        return value if self.dtype is np.int64 else np.clip(value, -LONG, LONG - 1).astype(np.int64)


def best(score: np.ndarray, mask: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest scores of each row where the mask holds, ties to the smaller column."""
    width = score.shape[1]
    some = np.flatnonzero(mask.any(1))
    if not len(some):
        return some, some
    score, mask = score[some], mask[some]
    if width > k and width <= STEP and max(-int(score.min()), int(score.max())) < 1 << 50:
        # Score and place in one key: no two are equal.
        key = np.where(mask, score * STEP + (STEP - 1 - np.arange(width)), np.iinfo(np.int64).min)
        top = np.partition(key, width - k, axis=1)[:, width - k :]
        i, j = np.nonzero(top != np.iinfo(np.int64).min)
        return some[i], STEP - 1 - top[i, j] % STEP
    i, j = np.nonzero(mask)
    rank_order = np.lexsort((j, ~score[i, j], i))
    i, j = i[rank_order], j[rank_order]
    first = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1]]))
    rank = np.arange(len(i)) - np.repeat(first, np.diff(np.append(first, len(i))))
    return some[i[rank < k]], j[rank < k]


class Found:
    """The k best (score, then smaller id) of each query, of all blocks so far."""

    def __init__(self, k: int):
        self.k, self.query, self.score, self.row = k, *(np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, score: np.ndarray, row: np.ndarray, ids: np.ndarray) -> None:
        query, score, row = np.concatenate([self.query, query]), np.concatenate([self.score, score]), np.concatenate([self.row, row])
        order = np.lexsort((ids[row], ~score, query))
        query, score, row = query[order], score[order], row[order]
        first = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else query
        keep = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query)))) < self.k
        self.query, self.score, self.row = query[keep], score[keep], row[keep]


def integers(column, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(column))


def values(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def by_id(table: pa.Table) -> pa.Table:
    """Candidates in the order of ties."""
    return table.sort_by([("vec_id", "ascending"), ("row", "ascending")])


def positives(anchors: pa.Table, rows: pa.Table, k: int, scale: int) -> pa.Table:
    """(anchor, row, vec_id, score): the k best rows of one shard for each anchor of its label."""
    found = Found(k)
    rows = by_id(rows)
    if len(anchors) and len(rows):
        mine, own, ids = values(anchors, "row"), values(rows, "row"), values(rows, "vec_id")
        scores = Scores(integers(anchors.column("embedding"), scale), integers(rows.column("embedding"), scale))
        for a in range(0, len(mine), ASK):
            for b in range(0, len(own), STEP):
                score = scores.block(slice(a, a + ASK), slice(b, b + STEP))
                i, j = best(score, mine[a : a + ASK, None] != own[None, b : b + STEP], k)
                found.add(i + a, score[i, j], j + b, ids)
        return pa.table({"anchor": mine[found.query], "row": own[found.row], "vec_id": ids[found.row], "score": found.score})
    return pa.table({x: pa.array([], pa.int64()) for x in ("anchor", "row", "vec_id", "score")})


NEGATIVE = ("anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score")


def negatives(anchors: pa.Table, rows: pa.Table, k: int, scale: int, low: int) -> pa.Table:
    """The k best rows of one shard within the window of each anchor and positive, of other labels."""
    if not len(anchors) or not len(rows):
        return pa.table({x: pa.array([], pa.int64()) for x in NEGATIVE})
    rows = by_id(rows)
    ids, label, other = values(rows, "vec_id"), values(rows, "label"), values(anchors, "label")
    lists = anchors.column("positives").combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    many = int(size.max(initial=0))
    at = np.repeat(np.arange(len(size)), size), np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat = lists.flatten()
    high = np.full((len(size), many), -LONG)
    high[at] = flat.field("score").to_numpy()
    # 100 * s >= low * p, without leaving 64 bits: s >= p - floor((100 - low) * p / 100).
    part = (100 - low) * (high // 100) + (100 - low) * (high % 100) // 100
    floor = np.full(high.shape, LONG - 1)
    floor[at] = (high - part)[at]
    scores, found = Scores(integers(anchors.column("embedding"), scale), integers(rows.column("embedding"), scale)), Found(k)
    for a in range(0, len(size), ASK):
        mine = slice(a, min(a + ASK, len(size)))
        least, most = floor[mine].min(1, initial=LONG - 1)[:, None], high[mine].max(1, initial=-LONG)[:, None]
        for b in range(0, len(ids), STEP):
            score = scores.block(mine, slice(b, b + STEP))
            mask = (score >= least) & (score <= most) & (label[None, b : b + STEP] != other[mine, None])
            left = np.flatnonzero(mask.any(0))  # few columns are in any window
            score, mask = score[:, left], mask[:, left]
            for n in range(many if len(left) else 0):
                i, j = best(score, mask & (score >= floor[mine, n, None]) & (score <= high[mine, n, None]), k)
                found.add((i + a) * many + n, score[i, j], left[j] + b, ids)
    anchor, place = np.divmod(found.query, max(1, many))
    positive = (np.cumsum(size) - size)[anchor] + place
    pick = lambda name: flat.field(name).to_numpy()[positive]
    columns = [values(anchors, "row")[anchor], values(anchors, "vec_id")[anchor], place, pick("vec_id"), pick("score"), ids[found.row], found.score]
    return pa.table(dict(zip(NEGATIVE, columns, strict=True)))


def pieces(rows: str, width: str, partitions: int):
    """How many shards or blocks: enough to keep the tasks busy, each of LEAST to MOST components."""
    cells = F.col(rows) * F.col(width)
    return F.greatest(F.lit(1), F.ceil(cells / MOST), F.least(F.lit(partitions), F.ceil(cells / LEAST))).cast("int")


def dealt(rows: DataFrame, sizes: DataFrame, keys: list[str], own: str, times: str, salt: int) -> DataFrame:
    """rows, each in one of the `own` parts of its key, and once for each of the `times` parts of the other side.

    sizes: a row for each key, with columns shards and blocks; whether to broadcast it is Spark's to tell by its size.
    """
    names = {"shards": "shard", "blocks": "block"}
    out = rows.join(sizes, keys).withColumn(names[own], F.pmod(F.xxhash64("row", F.lit(salt)), F.col(own)).cast("int"))
    out = out.withColumn(names[times], F.explode(F.sequence(F.lit(0), F.col(times) - 1)))
    return out.select(*(F.col(c).alias(c) for c in out.columns if c not in names))  # columns of its own: both sides read the same table


def mine(table: DataFrame, k: int = 5, every: int = 100, low: int = 80, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of table (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by `every`; k positives of each, and k negatives of each positive with
    low percent to all of its score.
    """
    spark = table.sparkSession
    small_batches(spark)
    rows = usable(table, extra=["label"]).where(F.col("label").isNotNull()).where(F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < float("inf")))
    rows = rows.select("vec_id", "embedding", F.col("label").cast("long").alias("label"), F.size("embedding").alias("width"), F.monotonically_increasing_id().alias("row"))
    rows = stash(rows, "vectors")
    is_anchor = F.col("vec_id") % every == 0
    parts = shuffle_partitions(spark)

    def sizes(keys: list[str]) -> DataFrame:
        found = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(is_anchor).alias("asked")).where("asked > 0")
        return stash(found.select(*keys, pieces("n", "width", parts).alias("shards"), F.greatest(F.lit(1), F.ceil(F.col("asked") * F.col("width") / MOST)).cast("int").alias("blocks")), "sizes")

    def meet(anchors: DataFrame, keys: list[str], task, schema: str) -> DataFrame:
        found, cell = sizes(keys), [*keys, "shard", "block"]
        asked, held = dealt(anchors, found, keys, "blocks", "shards", 2), dealt(rows, found, keys, "shards", "blocks", 1)
        return asked.groupBy(*cell).cogroup(held.groupBy(*cell)).applyInArrow(task, schema)

    anchors = rows.where(is_anchor)
    near = meet(anchors, ["width", "label"], lambda q, c: positives(q, c, k, scale), "anchor long, row long, vec_id long, score long")
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "row"))).where(F.col("place") <= k)
    near = stash(near.groupBy(F.col("anchor").alias("row")).agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("positives")), "positives")
    out = meet(anchors.join(near, "row"), ["width"], lambda q, c: negatives(q, c, k, scale, low), ", ".join(f"{x} long" for x in NEGATIVE))
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id"))
    out = out.withColumn("rank", rank).where(F.col("rank") <= k)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
