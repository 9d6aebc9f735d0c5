"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

An exact join of documents whose distinct n-word shingles have Jaccard similarity of at least ``percent / 100``:

1. Documents with the same shingle set form a class; only its smallest id goes on.
2. A shingle counts for a document only if another class has it too. Overlap with any partner is at most the
   number of such shared shingles, so a document with fewer than ``percent`` % of its set shared can't link and
   leaves. Shared shingles are found by hash ranges: each map task ships every distinct shingle of a run of
   documents once, so a shingle that all documents have costs one entry per run.
3. The columns of what is left are ordered by document frequency; a linked pair must share a column in a short
   prefix of each row. Rows that share a prefix column fall into one block (components of a star graph).
4. Blocks, tiled when large, are multiplied with their transpose: overlap counts are accumulated column group by
   column group, and pairs below the size-derived bound are dropped inside the task. A tile returns one row per
   document: its root in the tile and its number of links. No list of pairs is ever emitted.

Null, empty or blank texts have an empty set and link with nothing. A text of any length is one row of the incidence
matrix, read whole. Rows that repeat a doc_id are joined one by one; a null doc_id is never the smallest, and a group
of only such rows has none. Extra columns are ignored; an empty table gives an empty table.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.llm import bitmaps
from avmatch.llm import words as W
from avmatch.llm.components import components
from avmatch.llm.store import shuffle_partitions, stash
from avmatch.llm.worker import bounded, small_batches

#: Postings a map task gathers before it ships them.
RUN = 1_000_000
#: Cells of a tile's row block: a block of the sparse product holds at most about this many postings.
TILE = 1_000_000
#: Index pairs of a product that are added up at once.
PAIRS = 1_000_000
#: What tells shingle sets apart: their size and two digests of 64 bits.
KEY = ["n_shingles", "d1", "d2"]


def class_table(batches, n: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_shingles, two halves of a set digest) for each row."""
    for batch in batches:
        for rows, hashes, first in W.hashed_rows(batch, "text"):
            ids = batch.column("doc_id").slice(rows.start, rows.stop - rows.start)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, digests(W.shingle_sets(hashes, first, n)))], ["doc_id", *KEY])


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes and two order-free 64-bit digests of each set."""
    size = np.array([len(s) for s in sets], np.int64)
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    for k, s in enumerate(sets):
        if len(s):
            a[k], b[k] = s.sum(dtype=np.uint64), W.mix(s ^ np.uint64(W.BASE)).sum(dtype=np.uint64)
    return size, a.view(np.int64), b.view(np.int64)


def tags(size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit class tags from 1 up; 0 stands for several classes at once."""
    return np.maximum(W.mix(a.view(np.uint64) ^ W.mix(b.view(np.uint64) + size.astype(np.uint64))), np.uint64(1))


SHIPPED = "bucket int, grp long, hs binary, tags binary, own_tags binary, own_counts binary"


def run_starts(x: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin in a sorted array."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def ship_shingles(batches, n: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct shingles of runs of documents, cut by hash range. A shingle of one class carries its tag, others 0.

    Within a run classes are told apart by their whole key; a tag only tells those of two runs apart.
    """
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    sets: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        key = digests(sets)
        _, one = np.unique(np.stack(key, 1), axis=0, return_index=True)  # copies within the run count once
        some = [sets[k] for k in one.tolist()]
        h = np.concatenate(some)
        order = np.argsort(h)
        h, of = h[order], np.repeat(np.arange(len(some), dtype=np.int32), [len(s) for s in some])[order]
        tag = tags(*(x[one] for x in key))
        new = run_starts(h)
        size = np.diff(np.append(new, len(h)))
        counts = np.bincount(of[np.repeat(size > 1, size)], minlength=len(some))
        own, counts = tag[counts > 0], counts[counts > 0]
        h, t = h[new], np.where(size > 1, np.uint64(0), tag[of[new]])
        bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        h = h.astype(np.uint32)
        rows = [k for k in range(buckets) if cut[k + 1] > cut[k]] or [0]
        carry = rows[(part + seq) % len(rows)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(rows, pa.int32()),
                pa.array([(part << 24) + seq] * len(rows), pa.int64()),
                pa.array([h[cut[k] : cut[k + 1]].tobytes() for k in rows], pa.binary()),
                pa.array([t[cut[k] : cut[k + 1]].tobytes() for k in rows], pa.binary()),
                pa.array([own.tobytes() if k == carry else None for k in rows], pa.binary()),
                pa.array([counts.astype(np.uint32).tobytes() if k == carry else None for k in rows], pa.binary()),
            ],
            ["bucket", "grp", "hs", "tags", "own_tags", "own_counts"],
        )

    for batch in batches:
        for _, hashes, first in W.hashed_rows(batch, "text"):
            new = W.shingle_sets(hashes, first, n)
            sets += [s for s in new if len(s)]
            held += sum(map(len, new))
            if held >= RUN:
                yield flush()
                sets, held, seq = [], 0, seq + 1
    if sets:
        yield flush()


def joined(cells: list[bytes], kind) -> np.ndarray:
    return np.frombuffer(b"".join(cells), kind)


def count_shared(table: pa.Table) -> pa.Table:
    """For one hash range and each run: how many shingles of each class in it another class has too."""
    cells = table.column("hs").to_pylist()
    sizes = np.array([len(x) // 4 for x in cells])
    h, t = joined(cells, np.uint32), joined(table.column("tags").to_pylist(), np.uint64)
    order = np.argsort(h)
    h, t = h[order], t[order]
    where = np.repeat(np.arange(len(cells), dtype=np.int32), sizes)[order]
    new = run_starts(h)
    low, high = np.minimum.reduceat(t, new), np.maximum.reduceat(t, new)
    shared = np.repeat((low == 0) | (low != high), np.diff(np.append(new, len(h)))) & (t > 0)
    t, where = t[shared], where[shared]
    order = np.lexsort((t, where))
    t, where = t[order], where[order]
    new = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (where[1:] != where[:-1])])) if len(t) else np.zeros(0, np.int64)
    counts = np.diff(np.append(new, len(t))).astype(np.uint32)
    cut = np.searchsorted(where[new], np.arange(len(cells) + 1))
    own = [pa.array([x[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()) for x in (t[new], counts)]
    grp = table.column("grp").combine_chunks()
    out = pa.Table.from_arrays([grp, *own], ["grp", "tags", "counts"])
    inside = pa.Table.from_arrays([grp, *(table.column(c).combine_chunks() for c in ("own_tags", "own_counts"))], ["grp", "tags", "counts"])
    return pa.concat_tables([out, inside.filter(inside.column("tags").is_valid())])


def sum_shared(table: pa.Table) -> pa.Table:
    """For one run: the number of shared shingles of each class in it."""
    tag, cnt = joined(table.column("tags").to_pylist(), np.uint64), joined(table.column("counts").to_pylist(), np.uint32)
    tag, at = np.unique(tag, return_inverse=True)
    return pa.table({"tag": tag.view(np.int64), "cnt": np.bincount(at, cnt, len(tag)).astype(np.int64)})


def sets_of(batches, n: int) -> Iterator[pa.RecordBatch]:
    """The key of each text's class and its shingles."""
    for batch in batches:
        for _, hashes, first in W.hashed_rows(batch, "text"):
            sets = W.shingle_sets(hashes, first, n)
            size, a, b = digests(sets)
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*map(pa.array, (size, a, b)), lists], [*KEY, "hs"])


def overlaps(rows: np.ndarray, cols: np.ndarray, ok: np.ndarray, n_cols: int, heights: tuple[int, int]) -> np.ndarray:
    """Overlap counts of row block x row block from postings (rows, cols): one product of an incidence matrix.

    ok: whether a posting is of the left block (else of the right). Frequent columns go through dense slabs, the
    rest as index pairs; both add into the same accumulator.
    """
    out = np.zeros(heights, np.int32)
    left, right = np.bincount(cols[ok], minlength=n_cols), np.bincount(cols[~ok], minlength=n_cols)
    dense = np.minimum(left, right) > 48
    for c in np.array_split(np.flatnonzero(dense), max(1, int(dense.sum()) // 512)):
        if not len(c):
            continue
        index = np.full(n_cols, -1)
        index[c] = np.arange(len(c))
        slabs = []
        for side, height in ((ok, heights[0]), (~ok, heights[1])):
            slab = np.zeros((height, len(c)), np.float32)
            r, k = rows[side], index[cols[side]]
            slab[r[k >= 0], k[k >= 0]] = 1
            slabs.append(slab)
        out += (slabs[0] @ slabs[1].T).astype(np.int32)
    light = ~dense & (left > 0) & (right > 0)
    a, b = ok & light[cols], ~ok & light[cols]
    oa, ob = np.argsort(cols[a], kind="stable"), np.argsort(cols[b], kind="stable")
    ra, ca, rb = rows[a][oa], cols[a][oa], rows[b][ob]
    start = np.concatenate([[0], np.cumsum(np.where(light, right, 0))])
    flat = out.reshape(-1)
    reach = right[ca]
    for part in np.array_split(np.arange(len(ra)), max(1, int(reach.sum()) // PAIRS)):
        times = reach[part]
        first = np.repeat(start[ca[part]] - np.concatenate([[0], np.cumsum(times)[:-1]]) if len(part) else part, times)
        partner = rb[first + np.arange(int(times.sum()))]
        cells, counts = np.unique(np.repeat(ra[part], times) * heights[1] + partner, return_counts=True)
        flat[cells] += counts.astype(np.int32)
    return out


def multiply(table: pa.Table, percent: int) -> pa.Table:
    """One tile: links between its two row blocks (or inside its only one), as each class's root and degree."""
    ids, n, copies, block = (table.column(c).to_numpy() for c in ("id", "n", "copies", "block"))
    low, high = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    hs = table.column("hs").combine_chunks()
    cols, size = hs.flatten().to_numpy(), np.diff(hs.offsets.to_numpy())
    _, cols = np.unique(cols, return_inverse=True)
    sides = [np.flatnonzero(block == low), np.flatnonzero(block == high)]
    at = np.empty(len(ids), np.int64)
    for s in sides:
        at[s] = np.arange(len(s))
    doc = np.repeat(np.arange(len(ids)), size)
    is_left, is_right = (block == low)[doc], (block == high)[doc]
    rows = np.concatenate([at[doc[is_left]], at[doc[is_right]]])
    ok = np.concatenate([np.ones(int(is_left.sum()), bool), np.zeros(int(is_right.sum()), bool)])
    both = np.concatenate([cols[is_left], cols[is_right]])
    root, degree = np.arange(len(ids)), np.zeros(len(ids), np.int64)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    if len(sides[0]) and len(sides[1]):
        counts = overlaps(rows, both, ok, int(cols.max(initial=-1)) + 1, (len(sides[0]), len(sides[1])))
        for k, i in enumerate(sides[0].tolist()):
            union = n[i] + n[sides[1]] - counts[k]
            j = sides[1][(100 * counts[k].astype(np.int64) >= percent * union) & (counts[k] > 0)]
            j = j[j != i]
            degree[i] += copies[j].sum()
            if low != high:
                degree[j] += copies[i]
            for x in np.unique(root[j]).tolist():
                a, b = find(i), find(x)
                if a != b:
                    a, b = (a, b) if ids[a] < ids[b] else (b, a)
                    root[b] = a
    top = np.array([find(x) for x in range(len(ids))], np.int64)
    return pa.table({"id": ids, "root": ids[top] if len(ids) else ids, "degree": degree})


def join_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of docs (doc_id, text).

    n: words in a shingle; percent: least Jaccard similarity. component_id is the smallest doc_id reachable by
    links, n_links the number of documents linked directly, copies included. Rows that repeat a doc_id stay.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select("doc_id", "text")
    run = lambda f, *more: lambda batches: bounded(f(batches, *more))
    table = stash(docs.mapInArrow(run(class_table, n), "doc_id long, n_shingles long, d1 long, d2 long"), "classes")
    classes = table.where("n_shingles > 0").groupBy(*KEY).agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))

    buckets = 2 * shuffle_partitions(spark)
    shipped = docs.select("text").mapInArrow(run(ship_shingles, n, buckets), SHIPPED)
    shared = shipped.groupBy("bucket").applyInArrow(count_shared, "grp long, tags binary, counts binary")
    shared = shared.groupBy("grp").applyInArrow(sum_shared, "tag long, cnt long").groupBy("tag").agg(F.max("cnt").alias("cnt"))
    tagged = classes.mapInArrow(with_tags, "n_shingles long, d1 long, d2 long, rep long, copies long, tag long")
    alive = tagged.join(shared, "tag").where(F.col("cnt") * 100 >= F.col("n_shingles") * percent)
    alive = stash(alive.select(F.monotonically_increasing_id().alias("id"), *KEY, "rep", "copies"), "alive")

    # One text of each class that is left: those of its smallest doc_id, of which its key tells the right one.
    reps = alive.select(F.col("rep").alias("_rep"))
    sets = bitmaps.split(docs, "doc_id", reps)[0].join(reps.distinct(), F.col("doc_id").eqNullSafe(F.col("_rep")), "left_semi").select("text")
    sets = sets.mapInArrow(run(sets_of, n), "n_shingles long, d1 long, d2 long, hs array<long>").groupBy(*KEY).agg(F.first("hs").alias("hs"))
    sets = stash(sets.join(alive, KEY).select("id", F.col("n_shingles").alias("n"), "hs"), "sets")
    postings = sets.select("id", "n", F.explode("hs").alias("h"))
    # Written apart, so that the join's sides are plain exchanges, which Spark can split where a shingle is very common.
    frequency = stash(postings.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "frequency")
    rows = postings.join(frequency, "h").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("cols"))
    rows = rows.where(F.size("cols") * 100 >= F.col("n") * percent)
    rows = stash(rows.select("id", "n", F.col("cols.h").alias("hs")), "rows")
    # A linked pair shares one of the first n - ceil(percent * n / 100) + 1 columns of each; unshared ones come first.
    head = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.size("hs"))).cast("int")
    heads = rows.where(head > 0).select("id", F.explode(F.slice("hs", 1, head)).alias("h"))
    leader = stash(heads.groupBy("h").agg(F.min("id").alias("v"), F.count("*").alias("df")).where("df > 1"), "leaders")
    star = heads.join(leader, "h").select(F.col("id").alias("u"), "v")
    blocks = components(star).withColumnRenamed("node", "id")

    rows = rows.join(blocks, "id").join(alive.select("id", "copies"), "id")
    weight = rows.groupBy("component").agg(F.ceil(F.sum(F.size("hs")) / TILE).cast("int").alias("m"), F.count("*").alias("docs"))
    weight = weight.select("component", F.greatest("m", F.ceil(F.col("docs") / 2048).cast("int")).alias("m"))
    rows = rows.join(weight, "component").withColumn("block", F.pmod(F.xxhash64("id"), "m").cast("int"))
    tiles = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    tiles = tiles.select("component", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "id", "n", "copies", "block", "hs")
    # Dealt by tile: left to Spark, a component's tiles would stay in the one task that its rows were joined in.
    tiles = tiles.repartition("component", "lo", "hi")
    out = tiles.groupBy("component", "lo", "hi").applyInArrow(lambda t: multiply(t, percent), "id long, root long, degree long")
    out = stash(out, "tiles")
    found = components(out.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")))
    degree = out.groupBy("id").agg(F.sum("degree").alias("degree"))

    found = alive.select("id", "rep").join(found.withColumnRenamed("node", "id"), "id")
    least = found.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = found.join(least, "component").select("id", "component_id").join(degree, "id", "full")
    named = alive.join(named, "id").select(*KEY, F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("degree", F.lit(0)).alias("degree"))
    named = classes.join(named, KEY, "left").select(*KEY, "copies", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("degree", F.lit(0)).alias("degree"))
    named = stash(named, "named")  # so that Spark can split a class with very many copies
    return table.join(named, KEY, "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("degree") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
    )


def with_tags(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tag = tags(*(batch.column(c).to_numpy() for c in KEY))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tag.view(np.int64))], [*batch.schema.names, "tag"])
