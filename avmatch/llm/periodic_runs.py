"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period q, at least max(12, 2 * q) long, that no neighbouring word
extends while keeping that period. Per text:

1. Suffixes are sorted by prefix doubling, and neighbours' longest common prefixes (LCP) read from its ranks.
2. Neighbours are united by decreasing LCP. A class holds the ordered positions of its suffixes; the smaller class goes
   into the larger one. All suffixes of a class agree in as many words as the present LCP says.
3. Two positions that become adjacent in a class, at a distance within the LCP, seed a run: its period is the distance
   (any smaller one would have brought a position between them into the class before), its length distance plus LCP,
   and it begins there, unless the words before both positions agree too; then an earlier pair has seeded it.

A run of 12 words needs an LCP of at least 6, so classes are united no further, and a text in which no six words in a row
occur twice has none to unite. Many texts are sorted together, as one sequence with an end of its own after each.

Null texts have no words. Texts of any length are read whole, each by one task; rows that repeat are read one by one; a null
doc_id is kept; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from avmatch.llm import words as W
from avmatch.llm.worker import bounded, small_batches

#: Shortest run in words, and the LCP that its seed has at least.
SHORTEST, SEED = 12, 6
#: Text bytes whose words are looked at at once, and words that are sorted together.
CHUNK, TOGETHER = 1 << 20, 1 << 18
#: Positions in a piece of an ordered set.
PIECE = 512
SPACE = r"[\x20\x09-\x0D]+"


class Positions:
    """An ordered set of positions in sorted pieces of bounded size."""

    __slots__ = ("lows", "pieces", "size")

    def __init__(self, first: int):
        self.pieces, self.lows, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for piece in self.pieces:
            yield from piece

    def add(self, x: int) -> tuple[int, int]:
        """Insert a new position; its neighbours before and after, -1 where there is none."""
        at = max(0, bisect_left(self.lows, x) - 1)
        piece = self.pieces[at]
        k = bisect_left(piece, x)
        before = piece[k - 1] if k else -1
        after = piece[k] if k < len(piece) else self.lows[at + 1] if at + 1 < len(self.lows) else -1
        piece.insert(k, x)
        self.size += 1
        if not k:
            self.lows[at] = x
        if len(piece) > PIECE:
            half = len(piece) // 2
            self.pieces.insert(at + 1, piece[half:])
            self.lows.insert(at + 1, piece[half])
            del piece[half:]
        return before, after


def suffix_order(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, LCP of each with the next) of a sequence of small integers, by prefix doubling."""
    n = len(ids)
    levels, rank, step = [], np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        levels.append(rank.astype(np.int32))
        if int(rank.max(initial=-1)) + 1 >= n or step >= n:
            break
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])])
        step *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.flatnonzero(np.maximum(a, b) < n)
        same = inside[levels[k][a[inside]] == levels[k][b[inside]]]
        lcp[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, lcp


def kruskal(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs in a sequence; a run stays within positions that hold repeated ids."""
    order, lcp = suffix_order(ids)
    edges = np.flatnonzero(lcp >= SEED)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    root, sets, runs = {}, {}, []
    word = ids.tolist()

    def find(x: int) -> int:
        while (up := root[x]) != x:
            root[x] = x = root[up]
        return x

    def seed(a: int, b: int, common: int) -> None:
        if a >= 0 <= b and b - a <= common and b - a + common >= SHORTEST and (not a or word[a - 1] != word[b - 1]):
            runs.append((a, b - a + common, b - a))

    for a, b, common in zip(order[edges].tolist(), order[edges + 1].tolist(), lcp[edges].tolist(), strict=True):
        for x in (a, b):
            if x not in root:
                root[x], sets[x] = x, Positions(x)
        a, b = find(a), find(b)
        if sets[a].size < sets[b].size:
            a, b = b, a
        root[b] = a
        large, small = sets[a], sets.pop(b)
        own = [*small]
        for at, x in enumerate(own):
            before, after = large.add(x)
            # Neighbours of one class are no new ones; the smaller class's next position is not in yet.
            if not at or before != own[at - 1]:
                seed(before, x, common)
            if at + 1 == len(own) or after < own[at + 1]:
                seed(x, after, common)
    return sorted(runs, key=lambda r: (r[0], r[2]))


def repeats(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Texts in which some SEED words in a row occur twice (by hashes, so perhaps one more)."""
    count = len(words) - SEED + 1
    if count < 2:
        return np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = W.mix(of[:count].astype(np.uint64))
    for k in range(SEED):
        key = W.mix(key * np.uint64(W.BASE) ^ words[k : k + count])
    inside = np.flatnonzero(of[:count] == of[SEED - 1 :])
    key, of = key[inside], of[inside]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    return np.unique(of[order[1:][same]])


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Runs of each text, given as words; all are sorted together."""
    number: dict[bytes, int] = {}
    ids, starts = [], []
    for k, text in enumerate(texts):
        starts.append(len(ids))
        ids += [number.setdefault(w, len(number)) for w in text]
        ids.append(-1 - k)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = kruskal(np.array(ids, np.int64))
    for (start, length, period), k in zip(found, (np.searchsorted(starts, [r[0] for r in found], "right") - 1).tolist(), strict=True):
        out[k].append((start - starts[k], length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """Words outside every run's repetitions, joined by blanks; of a run its first period stays."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge)[: len(words)] == 0
    return b" ".join(words[k] for k in np.flatnonzero(keep).tolist())


def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        for lo, hi in W.row_chunks(offsets, CHUNK):
            part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            starts, ends, first = W.spans(part, at)
            texts = [part[a:b].tobytes().split() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            runs: list[list] = [[] for _ in texts]
            odd = repeats(W.hash_words(part, starts, ends, lower=False), first).tolist()
            while odd:  # as many texts together as have so many words, but one at least
                size = np.cumsum([len(texts[k]) for k in odd])
                some, odd = odd[: max(1, int(np.searchsorted(size, TOGETHER, "right")))], odd[max(1, int(np.searchsorted(size, TOGETHER, "right"))) :]
                for k, found in zip(some, runs_of([texts[k] for k in some]), strict=True):
                    runs[k] = found
            collapsed = [(collapse(text, found) if found else b" ".join(text)) for text, found in zip(texts, runs, strict=True)]
            lists = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found in runs], kind)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), lists, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs: array of (start, length, period) by start and period, collapsed) for each row of docs (doc_id, text)."""
    small_batches(docs.sparkSession)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(lambda b: bounded(read(b)), f"doc_id {kind}, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def longest(runs: Column) -> Column:
    """The longest run; of equally long ones that with the smallest start, then period. Null without runs."""
    key = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(key)


def listed(runs: Column) -> Column:
    """A line `start,length,period` for each run."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")


def planted(doc_id: Column, text: Column) -> Column:
    """A tenth of texts with a periodic tail, by the crc32 of their id: word i >= a becomes word a + (i - a) % p."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1))
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    part = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    return F.when((h % 10 == 0) & (F.size(words) > 0), F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")).otherwise(text)
