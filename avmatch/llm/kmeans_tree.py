"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a sample drawn by a hash of the id: a sixteenth of the rows, but ``SAMPLE`` at least (or all) and
``MOST`` at most. Every row goes down to its leaf, and rows are written by leaf. A query walks the tree through one
priority queue of nodes by distance to their centres, and visits leaves in that order. How many is calibrated: on the
sample, with exact neighbours known, leaf visits widen until mean recall reaches ``RECALL``; a fuller table only makes
neighbours nearer. Walks go on until the leaves hold more than k rows. Distances inside leaves are exact.

A leaf with many rows (say, of one very common vector) is salted over several groups, all of which its queries meet.
Each length of vectors has a tree of its own; one that the sample lacks is a single leaf. Where an id repeats, every row
is a candidate and, if asked, a query of its own. An empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avmatch.llm.store import stash
from avmatch.llm.vectors import by_length, kind, kmeans, matrix, nearest, usable
from avmatch.llm.worker import bounded, small_batches

SAMPLE, MOST, BRANCH, LEAF, RECALL, PROBES = 12_000, 100_000, 8, 64, 0.97, 200
#: Rows of a leaf that one group holds.
GROUP = 4096
#: Differences of components that are held at once.
CELLS = 1 << 20


class Tree:
    """children[n]: first and one past the last child of node n, or (leaf number, -1)."""

    def __init__(self, x: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.centres: list[np.ndarray] = [x.mean(0) if len(x) else np.zeros(x.shape[1])]
        self.children: list[tuple[int, int]] = []
        self.leaves = 0
        todo = [(0, x)]
        spans: dict[int, tuple[int, int]] = {}
        while todo:
            node, part = todo.pop(0)
            if len(part) <= LEAF or (part == part[0]).all():
                spans[node] = (self.leaves, -1)
                self.leaves += 1
                continue
            centres, of = kmeans(part, BRANCH, rng)
            full = [c for c in range(BRANCH) if (of == c).any()]
            if len(full) < 2:
                spans[node] = (self.leaves, -1)
                self.leaves += 1
                continue
            spans[node] = (len(self.centres), len(self.centres) + len(full))
            for c in full:
                todo.append((len(self.centres), part[of == c]))
                self.centres.append(centres[c])
        self.children = [spans[n] for n in range(len(self.centres))]
        self.points = np.stack(self.centres)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            lo, hi = self.children[node]
            if hi < 0:
                out[at] = lo
            elif len(at):
                of = nearest(x[at], self.points[lo:hi])
                todo += [(lo + c, at[of == c]) for c in range(hi - lo)]
        return out

    def walk(self, q: np.ndarray):
        """Leaves, best bin first."""
        far = ((self.points - q) ** 2).sum(1)
        queue = [(far[0], 0)]
        while queue:
            _, node = heappop(queue)
            lo, hi = self.children[node]
            if hi < 0:
                yield lo
            else:
                for c in range(lo, hi):
                    heappush(queue, (far[c], c))


def calibrate(tree: Tree, x: np.ndarray, k: int, recall: float = RECALL) -> int:
    """The least number of leaf visits with mean recall of at least `recall` on the sample."""
    leaf = tree.descend(x)
    asked = np.linspace(0, len(x) - 1, min(PROBES, len(x))).astype(int)
    found = np.zeros(tree.leaves)
    for a in asked.tolist():
        far = ((x - x[a]) ** 2).sum(1)
        far[a] = np.inf
        near = leaf[np.argpartition(far, min(k, len(x) - 1) - 1)[:k]] if len(x) > 1 else leaf[:0]
        place = np.empty(tree.leaves, int)
        place[list(tree.walk(x[a]))] = np.arange(tree.leaves)
        np.add.at(found, place[near], 1 / max(1, len(near)))
    good = np.flatnonzero(np.cumsum(found) >= recall * len(asked) - 1e-9)
    return int(good[0]) + 1 if len(good) else tree.leaves


class Forest:
    """A tree for each length of vectors. Leaves are numbered through; a length without a tree has leaf -length."""

    def __init__(self, sample: dict[int, np.ndarray], k: int):
        self.trees, self.first, self.visits, self.leaves = {}, {}, {}, 0
        for d, x in sorted(sample.items()):
            tree = self.trees[d] = Tree(x)
            self.first[d], self.visits[d] = self.leaves, calibrate(tree, x, k)
            self.leaves += tree.leaves

    def descend(self, d: int, x: np.ndarray) -> np.ndarray:
        return self.first[d] + self.trees[d].descend(x) if d in self.trees else np.full(len(x), -d)

    def walk(self, d: int, q: np.ndarray):
        return (self.first[d] + leaf for leaf in self.trees[d].walk(q)) if d in self.trees else iter([-d])


def search(table: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """(query_id, rank, vec_id, score): for rows whose vec_id is divisible by `every`, the k nearest rows found by
    Euclidean distance, nearest first, ties to the smaller id. Only the row itself is its own."""
    spark = table.sparkSession
    small_batches(spark)
    rows = usable(table, zero=False)
    n = rows.count()
    share = int((1 << 30) * min(1.0, min(max(SAMPLE, n / 16), MOST) / max(1, n)))
    found: dict[int, list] = {}
    for r in rows.where(F.pmod(F.xxhash64("vec_id", F.lit("tree")), F.lit(1 << 30)) < share).collect():
        found.setdefault(len(r["embedding"]), []).append((r["vec_id"], r["embedding"]))
    forest = Forest({d: np.array([e for _, e in sorted(x)], np.float64) for d, x in found.items()}, k)

    def place(batches):
        for batch in batches:
            for d, part in by_length(batch):
                yield pa.RecordBatch.from_arrays([pa.array(forest.descend(d, matrix(part.column("embedding")))), *part.columns], ["leaf", *part.schema.names])

    index = rows.mapInArrow(lambda b: bounded(place(b)), f"leaf long, vec_id long, embedding {kind(table)}")
    index = stash(index.withColumn("row", F.monotonically_increasing_id()), "leaves")
    # A row for each leaf, of which the sample's bound sets the number, or each length that it lacks.
    size = {r["leaf"]: r["count"] for r in index.groupBy("leaf").count().collect()}
    salts = {leaf: -(-held // GROUP) for leaf, held in size.items()}

    def ask(batches):
        for batch in batches:
            for d, part in by_length(batch):
                at, leaf, salt = [], [], []
                for row, q in enumerate(matrix(part.column("embedding"))):
                    held = 0
                    for seen, where in enumerate(forest.walk(d, q)):
                        if seen >= forest.visits.get(d, 1) and held > k:
                            break
                        held += size.get(where, 0)
                        many = salts.get(where, 0)
                        at += [row] * many
                        leaf += [where] * many
                        salt += range(many)
                some = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int64()), pa.array(salt, pa.int64()), *some.columns], ["leaf", "salt", *some.schema.names])

    asking = index.where(F.col("vec_id") % every == 0).select("row", "vec_id", "embedding")
    asking = asking.mapInArrow(lambda b: bounded(ask(b)), f"leaf long, salt long, row long, vec_id long, embedding {kind(table)}")
    crowded = {leaf: many for leaf, many in salts.items() if many > 1}
    many = F.coalesce(F.create_map(*(F.lit(x) for pair in crowded.items() for x in pair))[F.col("leaf")], F.lit(1)) if crowded else F.lit(1)
    salted = index.withColumn("salt", F.pmod(F.xxhash64("row"), many.cast("long")))

    def meet(queries: pa.Table, held: pa.Table) -> pa.Table:
        empty = pa.table({**{x: pa.array([], pa.int64()) for x in ("row", "query_id", "vec_id")}, "score": pa.array([], pa.float64())})
        if not len(queries) or not len(held):
            return empty
        held = held.sort_by("vec_id")
        q, c = matrix(queries.column("embedding")), matrix(held.column("embedding"))
        mine, of = queries.column("row").to_numpy(), queries.column("vec_id").to_numpy()
        theirs, ids = held.column("row").to_numpy(), held.column("vec_id").to_numpy()
        step, out = max(1, CELLS // max(1, c.size)), [empty]
        for lo in range(0, len(q), step):
            own = theirs[None] == mine[lo : lo + step, None]
            far = np.sqrt(((c[None] - q[lo : lo + step, None]) ** 2).sum(2))
            far[own] = np.inf
            at = np.argsort(far, axis=1, kind="stable")[:, : k + 1]
            ok = ~np.take_along_axis(own, at, 1)
            ok &= np.cumsum(ok, axis=1) <= k
            n, j = np.nonzero(ok)
            found = at[n, j]
            out.append(pa.table({"row": mine[lo + n], "query_id": of[lo + n], "vec_id": ids[found], "score": far[n, found]}))
        return pa.concat_tables(out)

    met = asking.groupBy("leaf", "salt").cogroup(salted.groupBy("leaf", "salt")).applyInArrow(meet, "row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("row", "query_id").orderBy("score", "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
