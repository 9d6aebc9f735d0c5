"""LM scoring with a hidden Markov model over word classes.

Vocabulary: the end token and the ``TOP`` - 1 most frequent other training tokens are classes of their own; every
other word, known or not, belongs to one of ``TAILS`` classes by its last three bytes, and has in it the share
(c + 0.5) / (N_k + 0.5 * (V_k + 1)).
Latent states emit classes. So the tables that tasks need have a fixed size, while the counts of all words stay
distributed: they are summed by hash range, and each document's rarer words meet them there.

Training: word counts over every training document; the states' starting points are a k-means of the class histograms
of about ``SAMPLE_DOCS`` whole documents, drawn by a hash of doc_id alone; then ``ROUNDS`` Baum-Welch rounds over all
training documents, whose expected counts are summed across partitions. Training cuts a document into segments of
``SEGMENT`` tokens; scoring runs the scaled forward recursion over the whole token sequence.

Null texts are empty: they hold only the end token. A null doc_id counts as a training document. Repeated rows are
scored one by one, and those of one doc_id are in the sample together or not at all. A text of any length is one
sequence. Without training documents every token is unknown and the classes are equally likely.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from avmatch.llm import words as W
from avmatch.llm.store import shuffle_partitions, stash
from avmatch.llm.worker import bounded, small_batches

STATES, TOP, TAILS = 8, 4096, 4096
CLASSES = TOP + TAILS
SAMPLE_DOCS, ROUNDS, SEGMENT = 1500, 3, 1024
#: Tokens a map task gathers before it ships or multiplies them.
RUN = 600_000
#: The hash of the end token.
END = np.uint64(0xE4D0F7E47)


def tail_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Class of a rare word by its last three bytes."""
    code = np.zeros(len(starts), np.uint64)
    for k in range(1, 4):
        at = ends - k
        code = code * np.uint64(257) + np.where(at >= starts, W.LOWER[data[np.maximum(at, 0)]].astype(np.uint64) + np.uint64(1), np.uint64(0))
    return (W.mix(code) % np.uint64(TAILS)).astype(np.uint16)


def token_rows(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, token hashes with an end after each row, tail classes, first token of each row and the end)."""
    data, offsets = W.column_bytes(batch.column("text"))
    for lo, hi in W.row_chunks(offsets, W.CHUNK):
        part = data[offsets[lo] : offsets[hi]]
        starts, ends, first = W.spans(part, offsets[lo : hi + 1] - offsets[lo])
        at = np.arange(len(starts)) + np.repeat(np.arange(hi - lo), np.diff(first))
        first = first + np.arange(hi - lo + 1)
        tokens, tails = np.full(first[-1], END, np.uint64), np.zeros(first[-1], np.uint16)
        tokens[at], tails[at] = W.hash_words(part, starts, ends), tail_class(part, starts, ends)
        yield slice(lo, hi), tokens, tails, first


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


def ship_counts(batches, buckets: int) -> Iterator[pa.RecordBatch]:
    """Distinct tokens of runs of documents with their counts, cut by hash range."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        h, at, c = np.unique(np.concatenate([x[0] for x in held]), return_index=True, return_counts=True)
        k = np.concatenate([x[1] for x in held])[at]
        cut = np.searchsorted(bucket_of(h, buckets), np.arange(buckets + 1))
        rows = [b for b in range(buckets) if cut[b + 1] > cut[b]]
        cells = [pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in rows], pa.binary()) for x in (h, c.astype(np.uint32), k)]
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *cells], ["bucket", "hs", "cs", "ks"])

    for batch in batches:
        for _, tokens, tails, _ in token_rows(batch):
            held.append((tokens, tails))
            size += len(tokens)
            if size >= RUN:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


def cells(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x, dtype) for x in table.column(name).to_pylist() if x)])


def most_frequent(h: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Places of the TOP most frequent tokens, and of the end token, however rare it is."""
    order = np.lexsort((h, -c, h != END))
    return order[: TOP + (END in h)]


def sum_counts(table: pa.Table) -> pa.Table:
    """One hash range: its sorted token hashes, counts and tail classes; its most frequent tokens and the end apart."""
    h, c, k = cells(table, "hs", np.uint64), cells(table, "cs", np.uint32).astype(np.int64), cells(table, "ks", np.uint16)
    order = np.argsort(h, kind="stable")
    h, c, k = h[order], c[order], k[order]
    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    h, c, k = h[new], np.add.reduceat(c, new), k[new]
    top = most_frequent(h, c)
    n, v = np.bincount(k, c, TAILS).astype(np.int64), np.bincount(k, minlength=TAILS).astype(np.int64)
    row = [h.tobytes(), c.tobytes(), h[top].tobytes(), c[top].tobytes(), k[top].tobytes(), n.tobytes(), v.tobytes()]
    return pa.Table.from_arrays([table.column("bucket").slice(0, 1).combine_chunks(), *(pa.array([x], pa.binary()) for x in row)], COUNTED_NAMES)


def merge_summaries(table: pa.Table) -> pa.Table:
    """The most frequent tokens of several hash ranges together, with the end, and the sums of their tail class sizes."""
    h, c, k = cells(table, "top_h", np.uint64), cells(table, "top_c", np.int64), cells(table, "top_k", np.uint16)
    top = most_frequent(h, c)
    n, v = (cells(table, x, np.int64).reshape(-1, TAILS).sum(0) for x in ("n", "v"))
    return pa.Table.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in (h[top], c[top], k[top], n, v)], ["top_h", "top_c", "top_k", "n", "v"])


COUNTED_NAMES = ["bucket", "hs", "cs", "top_h", "top_c", "top_k", "n", "v"]
COUNTED = "bucket int, hs binary, cs binary, top_h binary, top_c binary, top_k binary, n binary, v binary"
SUMMARY = "top_h binary, top_c binary, top_k binary, n binary, v binary"


class Model:
    """Fixed-size tables: frequent tokens, tail class sizes, and the HMM's start, move and emission probabilities."""

    def __init__(self, top: list[tuple[int, int, int]], n: np.ndarray, v: np.ndarray):
        self.tokens, self.types = int(n.sum()), int(v.sum())
        n, v = n.copy(), v.copy()
        ends = [x for x in top if x[0] == int(END)]
        frequent = [*ends, *[x for x in top if x[0] != int(END)][: TOP - 1]]
        for _, c, k in frequent:
            n[k] -= c
            v[k] -= 1
        frequent = sorted([(h, c) for h, c, _ in frequent] + ([] if ends else [(int(END), 0)]))
        self.hashes = np.array([h for h, _ in frequent], np.uint64)
        self.counts = np.array([c for _, c in frequent], np.int64)
        self.size = n + 0.5 * (v + 1)
        weight = np.zeros(CLASSES)
        weight[: len(self.counts)] = self.counts + 0.5
        weight[TOP:] = self.size
        self.prior = weight / weight.sum()
        self.start = np.full(STATES, 1 / STATES)
        self.move = np.full((STATES, STATES), 0.02 / (STATES - 1))
        np.fill_diagonal(self.move, 0.98)
        self.emit = np.tile(self.prior, (STATES, 1))

    def classes(self, tokens: np.ndarray, tails: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, tokens), len(self.hashes) - 1)
        return np.where(self.hashes[at] == tokens, at, TOP + tails.astype(np.int64))

    def maximise(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """New probabilities from expected counts; emissions keep a small share of the corpus-wide ones."""
        self.start = (start + 1) / (start + 1).sum()
        move = move + 0.1 + 5 * np.eye(STATES)
        self.move = move / move.sum(1, keepdims=True)
        emit = emit + 200 * self.prior
        self.emit = emit / emit.sum(1, keepdims=True)


def packed(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences in time-major order, longest first: (classes, sequence of each cell, start of each time step)."""
    size = np.array([len(c) for c in classes], np.int64)
    order = np.argsort(-size, kind="stable")
    rank = np.empty(len(size), np.int64)
    rank[order] = np.arange(len(size))
    active = len(size) - np.cumsum(np.bincount(size, minlength=1))[:-1] if len(size) else np.zeros(0, np.int64)
    step = np.concatenate([[0], np.cumsum(active)])
    flat = np.concatenate([np.zeros(0, np.int64), *classes])
    time = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    seq = np.repeat(np.arange(len(size)), size)
    at = step[time] + rank[seq]
    out, which = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    out[at], which[at] = flat, seq
    return out, which, step


def forward(model: Model, cls: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward recursion: (state shares, scale of each cell, emissions)."""
    seen = np.ascontiguousarray(model.emit.T)[cls]
    alpha, scale = np.empty_like(seen), np.empty(len(cls))
    for t in range(len(step) - 1):
        a, b = step[t], step[t + 1]
        now = seen[a:b] * (model.start if t == 0 else alpha[step[t - 1] : step[t - 1] + b - a] @ model.move)
        total = now.sum(1)
        scale[a:b] = total
        np.divide(now, total[:, None], out=alpha[a:b])
    return alpha, scale, seen


def expect(model: Model, classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected start, move and emission counts of sequences (the E step)."""
    cls, _, step = packed(classes)
    alpha, scale, seen = forward(model, cls, step)
    start, move = np.zeros(STATES), np.zeros((STATES, STATES))
    beta = np.ones((step[1] if len(step) > 1 else 0, STATES))
    for t in range(len(step) - 2, -1, -1):
        a, b = step[t], step[t + 1]
        if t < len(step) - 2:
            c, d = step[t + 1], step[t + 2]
            ahead = seen[c:d] * beta[: d - c] / scale[c:d, None]
            move += alpha[a : a + d - c].T @ ahead
            beta[: d - c] = ahead @ model.move.T
            beta[d - c : b - a] = 1
        alpha[a:b] *= beta[: b - a]
    if len(step) > 1:
        start = alpha[: step[1]].sum(0)
    emit = np.stack([np.bincount(cls, alpha[:, s], CLASSES) for s in range(STATES)])
    return start, move * model.move, emit


def segments(tokens: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    return [tokens[k : min(k + SEGMENT, b)] for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True) for k in range(a, b, SEGMENT)]


def expect_rows(batches, model: Model) -> Iterator[pa.RecordBatch]:
    """Expected counts of one partition, as one row of counts for each state."""
    from pyspark import TaskContext

    total, held, size = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((STATES, CLASSES))], [], 0

    def add() -> None:
        for x, y in zip(total, expect(model, held), strict=True):
            x += y

    for batch in batches:
        for _, tokens, tails, first in token_rows(batch):
            held += segments(model.classes(tokens, tails), first)
            size += len(tokens)
            if size >= RUN // 3:
                add()
                held, size = [], 0
    if size:
        add()
    rows = [np.concatenate([total[0][s : s + 1], total[1][s], total[2][s]]).tobytes() for s in range(STATES)]
    salt = TaskContext.get().partitionId() % 64
    yield pa.RecordBatch.from_arrays([pa.array(range(STATES), pa.int32()), pa.array([salt] * STATES, pa.int32()), pa.array(rows, pa.binary())], ["state", "salt", "counts"])


def add_rows(table: pa.Table) -> pa.Table:
    total = np.sum([np.frombuffer(x, np.float64) for x in table.column("counts").to_pylist()], axis=0)
    return pa.Table.from_arrays([*(table.column(c).slice(0, 1).combine_chunks() for c in ("state", "salt")), pa.array([total.tobytes()], pa.binary())], ["state", "salt", "counts"])


def baum_welch(model: Model, train: DataFrame) -> None:
    """One round over all training documents: partitions' counts are summed in two levels, then maximised."""
    schema = "state int, salt int, counts binary"
    counts = train.select("text").mapInArrow(lambda b: bounded(expect_rows(b, model)), schema).groupBy("state", "salt").applyInArrow(add_rows, schema)
    counts = counts.groupBy("state").applyInArrow(lambda t: add_rows(t), schema)
    found = np.zeros((STATES, 1 + STATES + CLASSES))
    for row in counts.collect():
        found[row["state"]] = np.frombuffer(row["counts"], np.float64)
    model.maximise(found[:, 0], found[:, 1 : 1 + STATES], found[:, 1 + STATES :])


def begin(model: Model, sample: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Starting points of the states: a k-means of documents' class histograms (classes, counts)."""
    if not sample:
        return
    rng = np.random.default_rng(7)
    share = [np.sqrt(n / n.sum()) for _, n in sample]
    dense = lambda k: np.bincount(sample[k][0], share[k], CLASSES)
    like = lambda centres: np.stack([centres[:, c] @ x for (c, _), x in zip(sample, share, strict=True)])
    centres = dense(int(rng.integers(len(sample))))[None]
    while len(centres) < min(STATES, len(sample)):
        far = np.maximum(2 - 2 * like(centres).max(1), 1e-9)
        centres = np.vstack([centres, dense(int(rng.choice(len(sample), p=far / far.sum())))])
    for _ in range(8):
        of = like(centres).argmax(1)
        sums = np.zeros_like(centres)
        for k, (c, _) in enumerate(sample):
            sums[of[k], c] += share[k]
        centres = np.where((np.bincount(of, minlength=len(centres)) > 0)[:, None], sums, centres)
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    emit = np.zeros((STATES, CLASSES))
    for k, (c, n) in enumerate(sample):
        emit[of[k], c] += n
    model.maximise(np.bincount(of, minlength=STATES).astype(float), model.move * emit.sum(1, keepdims=True), emit)


def score_rows(batches, model: Model, buckets: int) -> Iterator[pa.RecordBatch]:
    """Forward scores, and each document's rarer words cut by hash range to meet their counts."""
    from pyspark import TaskContext

    part, seq = TaskContext.get().partitionId(), 0
    log_size, log_count = np.log10(model.size), np.log10(model.counts + 0.5)
    base = np.log10(model.tokens + 0.5 * (model.types + 1))
    for batch in batches:
        for rows, tokens, tails, first in token_rows(batch):
            n = np.diff(first)
            cls = model.classes(tokens, tails)
            flat, which, step = packed([cls[a:b] for a, b in zip(first[:-1], first[1:], strict=True)])
            _, scale, _ = forward(model, flat, step)
            score = np.bincount(which, np.log10(scale), len(n))
            owner = np.repeat(np.arange(len(n)), n)
            rare = cls >= TOP
            score -= np.bincount(owner[rare], log_size[cls[rare] - TOP], len(n))
            own = np.bincount(owner[~rare], log_count[cls[~rare]], len(n))
            known = np.bincount(owner[~rare], model.counts[cls[~rare]] > 0, len(n))
            h, o = tokens[rare], owner[rare].astype(np.uint32)
            order = np.lexsort((o, h))
            h, o = h[order], o[order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])) if len(h) else np.zeros(0, np.int64)
            times = np.diff(np.append(new, len(h))).astype(np.uint32)
            h, o = h[new], o[new]
            cut = np.searchsorted(bucket_of(h, buckets), np.arange(buckets + 1))
            filled = [k for k in range(buckets) if cut[k + 1] > cut[k]] or [seq % buckets]
            ids = batch.column("doc_id").slice(rows.start, len(n))
            held = batch.column("held_out").slice(rows.start, len(n))
            # The documents' own values ride on one hash range of the run, another one each time.
            carry = (part + seq) % len(filled)
            info = pa.StructArray.from_arrays([ids, held, *map(pa.array, (n, known.astype(np.int64), own - n * base, score))], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
            info = pa.ListArray.from_arrays(pa.array([0] * (carry + 1) + [len(n)] * (len(filled) - carry), pa.int32()), info)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(filled, pa.int32()),
                    pa.array([(part << 24) + seq] * len(filled), pa.int64()),
                    *(pa.array([x[cut[k] : cut[k + 1]].tobytes() for k in filled], pa.binary()) for x in (h, o, times)),
                    info,
                ],
                ["bucket", "grp", "hs", "owners", "times", "info"],
            )
            seq += 1


INFO = "array<struct<doc_id: long, held_out: boolean, n_tokens: long, n_known: long, base_score: double, score: double>>"


def meet(shipped: pa.Table, counts: pa.Table) -> pa.Table:
    """One hash range: sums of log10(c + 0.5) and numbers of known tokens for each document that came by."""
    keys, c = cells(counts, "hs", np.uint64), cells(counts, "cs", np.int64)
    owners, sums, known = [], [], []
    for h, o, t in zip(*(shipped.column(x).to_pylist() for x in ("hs", "owners", "times")), strict=True):
        h, o, t = np.frombuffer(h, np.uint64), np.frombuffer(o, np.uint32), np.frombuffer(t, np.uint32)
        found = np.zeros(len(h), np.int64)
        if len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            found = np.where(keys[at] == h, c[at], 0)
        own, inverse = np.unique(o, return_inverse=True)
        owners.append(own.astype(np.uint32).tobytes())
        sums.append(np.bincount(inverse, t * np.log10(found + 0.5), len(own)).tobytes())
        known.append(np.bincount(inverse, t * (found > 0), len(own)).astype(np.uint32).tobytes())
    return pa.Table.from_arrays([shipped.column("grp"), *(pa.array(x, pa.binary()) for x in (owners, sums, known)), shipped.column("info")], ["grp", "owners", "sums", "known", "info"])


def combine(table: pa.Table) -> pa.Table:
    """The documents of one map run, with what every hash range found for them."""
    info = table.column("info").combine_chunks().flatten()
    get = {f.name: info.field(k) for k, f in enumerate(info.type)}
    o = cells(table, "owners", np.uint32)
    extra = np.bincount(o, cells(table, "sums", np.float64), len(info))
    known = np.bincount(o, cells(table, "known", np.uint32), len(info)).astype(np.int64)
    return pa.table(
        {
            "doc_id": get["doc_id"],
            "held_out": get["held_out"],
            "n_tokens": get["n_tokens"],
            "n_known": get["n_known"].to_numpy() + known,
            "base_score": get["base_score"].to_numpy() + extra,
            "score": get["score"].to_numpy() + extra,
        }
    )


def fit(train: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and the counts of all training tokens by hash range. train: texts."""
    small_batches(train.sparkSession)
    buckets = shuffle_partitions(train.sparkSession)
    counts = train.select("text").mapInArrow(lambda b: bounded(ship_counts(b, buckets)), "bucket int, hs binary, cs binary, ks binary")
    counts = stash(counts.groupBy("bucket").applyInArrow(sum_counts, COUNTED), "counts")
    # Fixed-size summaries, merged in two levels; only the last comes to the driver.
    parts = counts.drop("hs", "cs").withColumn("part", F.col("bucket") % max(1, round(buckets**0.5)))
    last = parts.groupBy("part").applyInArrow(lambda t: merge_summaries(t), SUMMARY).withColumn("part", F.lit(0)).groupBy("part").applyInArrow(merge_summaries, SUMMARY).collect()
    read = lambda name, kind: np.frombuffer(bytes(last[0][name]), kind) if last else np.zeros(TAILS if name in "nv" else 0, kind)
    tops = list(zip(read("top_h", np.uint64).tolist(), read("top_c", np.int64).tolist(), read("top_k", np.uint16).tolist(), strict=True))
    n, v = read("n", np.int64), read("v", np.int64)
    model = Model(tops, n, v)
    total = sum(c for h, c, _ in tops if h == int(END))
    few = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * min(1, SAMPLE_DOCS / max(1, total))))

    def histograms(batches):
        for batch in batches:
            for _, tokens, tails, first in token_rows(batch):
                cls = model.classes(tokens, tails)
                found = [np.unique(cls[a:b], return_counts=True) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[k].astype(np.int64).tobytes() for x in found], pa.binary()) for k in (0, 1)], ["c", "n"])

    rows = few.select("text").mapInArrow(lambda batches: bounded(histograms(batches)), "c binary, n binary").collect()
    begin(model, [(np.frombuffer(c, np.int64), np.frombuffer(n, np.int64)) for c, n in sorted((bytes(r["c"]), bytes(r["n"])) for r in rows)])
    for _ in range(rounds):
        baum_welch(model, train)
    return model, counts


def score_documents(docs: DataFrame, held_out=None, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of docs (doc_id, text).

    held_out: boolean column of rows that are scored but not learnt from; by default crc32(doc_id) mod 5 = 1.
    rounds: Baum-Welch rounds over all training rows.
    """
    buckets = shuffle_partitions(docs.sparkSession)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1 if held_out is None else held_out
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model, counts = fit(docs.where(~F.col("held_out")), rounds)
    shipped = docs.mapInArrow(lambda b: bounded(score_rows(b, model, buckets)), f"bucket int, grp long, hs binary, owners binary, times binary, info {INFO}")
    met = shipped.groupBy("bucket").cogroup(counts.select("bucket", "hs", "cs").groupBy("bucket"))
    met = met.applyInArrow(meet, f"grp long, owners binary, sums binary, known binary, info {INFO}")
    out = met.groupBy("grp").applyInArrow(combine, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
