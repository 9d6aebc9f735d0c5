"""Exact top-k search with multi-resolution segment statistics.

For vectors cut into segments, each segment's mean m and deviation s (a norm) bound the inner product from above:
q.c <= sum(L * m_q * m_c + s_q * s_c), so |q|^2 + |c|^2 - 2 * bound bounds the squared distance from below. Coarse
segments come first; a pair whose bound can't reach the query's k-th best so far is dropped, survivors go on to finer
segments, and what is left gets exact integer products.

Before that, whole clusters of candidates are dropped: a bounded sample (about ``CELLS`` components) gives centres, by
which every row is indexed, and each query its k-th best among the sample, which its true k-th best can't be below. A
query goes to a cluster only if its product with the centre, plus its norm times the cluster's radius, reaches that.
Large clusters are cut into shards, many queries into blocks; each block of queries meets each shard of its clusters by
an equi-join. How much is dropped depends on the data: vectors without any structure are told apart by the finest
segments only.

Products are exact: in doubles below 2**53, in 64-bit integers below 2**63, in Python integers beyond that, where a
score stands at the end of the long range. Vectors of another length than the query's are no candidates; where an id
repeats, every row is a candidate and, if asked, a query of its own. An empty table gives an empty table; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avmatch.llm.store import stash
from avmatch.llm.vectors import by_length, kind, kmeans, matrix, nearest, usable
from avmatch.llm.worker import bounded, small_batches

#: Vectors in a shard, queries in a block, and the parts of both that are compared at once.
SHARD, BLOCK, STEP, ASK = 32_768, 8192, 2048, 512
#: Components in a segment, coarse to fine.
WIDTHS = (16, 4, 2)
#: Components of the sample in all, and clusters of each length.
CELLS, CLUSTERS = 1 << 18, 64
SCALE = 256
#: Share of a block's pairs up to which survivors are multiplied one by one.
SPARSE = 0.5


def integers(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * x)


def statistics(x: np.ndarray, width: int) -> np.ndarray:
    """Rows of sqrt(L) * means and deviations: the product of two such rows is the upper bound."""
    cuts = np.arange(0, x.shape[1], width)
    size = np.diff(np.append(cuts, x.shape[1]))
    mean = np.add.reduceat(x, cuts, axis=1) / size
    rest = np.add.reduceat((x - np.repeat(mean, size, axis=1)) ** 2, cuts, axis=1)
    return np.hstack([mean * np.sqrt(size), np.sqrt(rest)])


def slack(q: np.ndarray, c: np.ndarray) -> float:
    """More than rounding can take from a bound."""
    norm = lambda x: float(np.sqrt((x**2).sum(1)).max(initial=0))
    return 1e-9 * norm(q) * norm(c) + 1e-6


class Best:
    """The k best (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int, floor: np.ndarray, dtype):
        self.k, self.floor = k, floor
        self.query, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, dtype), np.zeros(0, np.int64)
        self.worst = floor.copy()

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = np.concatenate([self.query, query]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        new = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else np.zeros(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(new, np.diff(np.append(new, len(query))))
        keep = rank < self.k
        self.query, self.score, self.id = query[keep], score[keep], ids[keep]
        last = query[rank == self.k - 1]
        self.worst[last] = np.maximum(self.floor[last], score[rank == self.k - 1].astype(np.float64))


def best(q: np.ndarray, q_rows: np.ndarray, floor: np.ndarray, c: np.ndarray, c_rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query, id, score) of each query's k best candidates of one shard, and how many exact products that took.

    q, c: integer vectors; floor: what a score must reach to matter. A candidate with the query's row is its own.
    """
    top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * q.shape[1]
    if top >= 2**63:
        return plain_best(q, q_rows, c, c_rows, ids, k)
    dtype = np.float64 if top < 2**53 else np.int64
    out, done, more = [], 0, slack(q, c)
    levels = [(statistics(q, w), statistics(c, w)) for w in dict.fromkeys(min(w, q.shape[1]) for w in WIDTHS)]
    exact_q, exact_c = q.astype(dtype), c.astype(dtype)
    for a in range(0, len(q), ASK):
        mine = slice(a, min(a + ASK, len(q)))
        found = Best(mine.stop - a, k, floor[mine], dtype)
        for lo in range(0, len(c), STEP):
            at, rows = np.arange(lo, min(lo + STEP, len(c))), np.arange(mine.stop - a)
            mask = np.ones((len(rows), len(at)), bool)
            for stat_q, stat_c in levels:
                bound = stat_q[mine][rows] @ stat_c[at].T
                mask &= bound + more >= found.worst[rows, None]
                keep = mask.any(0)
                some = mask.any(1)
                at, rows, mask = at[keep], rows[some], mask[some][:, keep]
            if not mask.size:
                continue
            if mask.mean() > SPARSE:
                score = exact_q[mine][rows] @ exact_c[at].T
                done += score.size
                if len(at) > k + 1:  # one more than k, since a query's own row may be among them
                    mask &= score >= np.partition(score, len(at) - k - 1, axis=1)[:, len(at) - k - 1][:, None]
                i, j = np.nonzero(mask)
                values = score[i, j]
            else:
                i, j = np.nonzero(mask)
                done += len(i)
                values = np.concatenate([np.zeros(0, dtype), *(np.einsum("ij,ij->i", exact_q[mine][rows[i[s : s + 65536]]], exact_c[at[j[s : s + 65536]]]) for s in range(0, len(i), 65536))])
            other = (q_rows[mine][rows[i]] != c_rows[at[j]]) & (values >= found.worst[rows[i]])
            found.add(rows[i][other], values[other], ids[at[j]][other])
        out.append((found.query + a, found.id, found.score.astype(np.int64)))
    return *(np.concatenate([x[n] for x in out]) if out else np.zeros(0, np.int64) for n in range(3)), done


def plain_best(q: np.ndarray, q_rows: np.ndarray, c: np.ndarray, c_rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The same for components so large that products need Python integers."""
    big = [[int(x) for x in row] for row in c]
    out = []
    for n, row in enumerate(q):
        mine = [int(x) for x in row]
        scores = sorted((-sum(map(int.__mul__, mine, other)), i) for other, i, r in zip(big, ids.tolist(), c_rows.tolist(), strict=True) if r != q_rows[n])
        out += [(n, i, max(-(2**63), min(2**63 - 1, -s))) for s, i in scores[:k]]
    cells = np.array(out, np.int64).reshape(-1, 3)
    return cells[:, 0], cells[:, 1], cells[:, 2], len(q) * len(c)


class Clusters:
    """Centres and sample of one length, in integer vectors."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        some = min(CLUSTERS, len(x) // 32)
        self.centres = kmeans(x, some, np.random.default_rng(3))[0] if some > 1 else np.zeros((1, x.shape[1]))

    def floors(self, ids: np.ndarray, q: np.ndarray, k: int) -> np.ndarray:
        """What each query's k-th best score is at least."""
        floor = np.full(len(q), -np.inf)
        if len(self.x) > k:
            for a in range(0, len(q), ASK):
                score = q[a : a + ASK] @ self.x.T
                score[ids[a : a + ASK, None] == self.ids[None]] = -np.inf
                floor[a : a + ASK] = np.partition(score, len(self.x) - k, axis=1)[:, len(self.x) - k]
        return floor - slack(q, self.x)


def search(table: DataFrame, k: int = 5, every: int = 50, scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose vec_id is divisible by `every`, the k rows with the highest
    inner product of floor(scale * component) vectors, ties to the smaller id. Only the row itself is its own."""
    spark = table.sparkSession
    small_batches(spark)
    rows = usable(table)
    total = rows.agg(F.sum(F.size("embedding").cast("long"))).first()[0] or 0
    share = int((1 << 30) * min(1.0, CELLS / max(1, total)))
    sample: dict[int, list] = {}
    for r in rows.where(F.pmod(F.xxhash64("vec_id", F.lit("segments")), F.lit(1 << 30)) < share).collect():
        sample.setdefault(len(r["embedding"]), []).append((r["vec_id"], r["embedding"]))
    models = {d: Clusters(np.array([i for i, _ in found]), integers(np.array([e for _, e in found], np.float64), scale)) for d, found in ((d, sorted(found)) for d, found in sample.items())}
    of = lambda d: models.get(d) or Clusters(np.zeros(0, np.int64), np.zeros((0, d)))

    def place(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in by_length(batch):
                x = integers(matrix(part.column("embedding")), scale)
                at = nearest(x, of(d).centres)
                far = np.sqrt(((x - of(d).centres[at]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), d)), pa.array(at), pa.array(far), *part.columns], ["d", "cluster", "far", *part.schema.names])

    index = rows.mapInArrow(lambda b: bounded(place(b)), f"d long, cluster long, far double, vec_id long, embedding {kind(table)}")
    index = stash(index.withColumn("row", F.monotonically_increasing_id()), "vectors")
    is_query = F.col("vec_id") % every == 0
    # A row for each cluster of each length.
    clusters = index.groupBy("d", "cluster").agg(F.count("*").alias("n"), F.count_if(is_query).alias("asked"), F.max("far").alias("far")).collect()
    shards = {(r["d"], r["cluster"]): -(-r["n"] // SHARD) for r in clusters}
    radius = {(r["d"], r["cluster"]): r["far"] for r in clusters}
    blocks = max(1, -(-sum(r["asked"] for r in clusters) // BLOCK))

    def ask(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in by_length(batch):
                model = of(d)
                q, ids = integers(matrix(part.column("embedding")), scale), part.column("vec_id").to_numpy()
                floor = model.floors(ids, q, k)
                reach = q @ model.centres.T + np.sqrt((q**2).sum(1))[:, None] * np.array([radius.get((d, c), -np.inf) for c in range(len(model.centres))])
                i, j = np.nonzero(reach * (1 + 1e-9 * np.sign(reach)) + slack(q, model.centres) >= floor[:, None])
                times = np.array([shards.get((d, c), 0) for c in range(len(model.centres))])[j]
                shard = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
                i, j = np.repeat(i, times), np.repeat(j, times)
                some = part.take(pa.array(i))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), d)), pa.array(j), pa.array(shard), pa.array(floor[i]), *(some.column(x) for x in ("row", "vec_id", "embedding"))], ["d", "cluster", "shard", "floor", "row", "vec_id", "embedding"])

    asking = index.where(is_query).select("row", "vec_id", "embedding").mapInArrow(lambda b: bounded(ask(b)), f"d long, cluster long, shard long, floor double, row long, vec_id long, embedding {kind(table)}")
    asking = asking.withColumn("block", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(blocks)).cast("int"))
    many = F.create_map(*(F.lit(x) for (d, c), n in shards.items() for x in (f"{d}:{c}", n))) if shards else F.create_map(F.lit(""), F.lit(1))
    held = index.withColumn("shard", F.pmod(F.xxhash64("row", F.lit(1)), many[F.concat_ws(":", "d", "cluster")]))
    held = held.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).drop("far")

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        if not len(queries) or not len(candidates):
            return pa.table({x: pa.array([], pa.int64()) for x in ("row", "query_id", "vec_id", "score")})
        q, c = (integers(matrix(x.column("embedding")), scale) for x in (queries, candidates))
        get = lambda x, name: x.column(name).to_numpy()
        at, ids, score, _ = best(q, get(queries, "row"), get(queries, "floor").copy(), c, get(candidates, "row"), get(candidates, "vec_id"), k)
        return pa.table({"row": get(queries, "row")[at], "query_id": get(queries, "vec_id")[at], "vec_id": ids, "score": score})

    keys = ["d", "cluster", "shard", "block"]
    met = asking.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(meet, "row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("row", "query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
