"""Token-ID output: a wavelet matrix per shard, with access, counting and lookup from one compressed file.

A shard holds the ids of a run of documents as succinct bit planes, highest bit first. Each plane is the bits of
the ids in that level's order (zeros of the level above first, then ones), packed, with a running count of ones
every ``BLOCK`` bits. A shard row of the written table is one such file with its documents' ids and lengths.
"""

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from avmatch.llm import words as W
from avmatch.llm.spans import NEWER, ending_after, gather, hash_spans, kinds
from avmatch.llm.store import new_path, shuffle_partitions
from avmatch.llm.worker import bounded, kept, small_batches

BLOCK = 512
#: Ids in a shard, but for longer single runs of text.
SHARD = 2_000_000
MAGIC = b"WVM1"
#: Distinct words a worker keeps the ids of, and new ones that go to the library together.
WORDS, TOGETHER = 1_000_000, 2048


def build(ids: np.ndarray, bits: int) -> bytes:
    """The file of one shard. Raises where an id needs more bits."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"token id {int(ids.max())} needs more than {bits} bits")
    now = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    parts = [MAGIC, np.array([len(now), bits], "<u8").tobytes()]
    for level in range(bits - 1, -1, -1):
        bit = (now >> np.array(level, now.dtype)) & np.array(1, now.dtype)
        plane = np.packbits(bit.astype(bool), bitorder="little")
        pad = np.zeros(-(-len(now) // BLOCK) * BLOCK // 8, np.uint8)
        pad[: len(plane)] = plane
        ones = np.bitwise_count(pad.view(np.uint64)).reshape(-1, BLOCK // 64).sum(1, dtype=np.uint64)
        parts += [np.concatenate([[0], np.cumsum(ones)]).astype("<u4").tobytes(), pad.tobytes()]
        one = bit.astype(bool)
        now = np.concatenate([now[~one], now[one]])
    return b"".join(parts)


class Wavelet:
    """A shard's file: reads stay on the packed planes; only whole() unpacks them all."""

    def __init__(self, file: bytes):
        if file[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self.n, self.bits = (int(x) for x in np.frombuffer(file, "<u8", 2, 4))
        blocks = -(-self.n // BLOCK)
        at, self.ranks, self.planes = 20, [], []
        for _ in range(self.bits):
            self.ranks.append(np.frombuffer(file, "<u4", blocks + 1, at))
            at += 4 * (blocks + 1)
            self.planes.append(np.frombuffer(file, np.uint8, blocks * BLOCK // 8, at))
            at += blocks * BLOCK // 8
        self.zeros = [self.n - int(r[-1]) for r in self.ranks]

    def rank1(self, level: int, at: int) -> int:
        """Ones before a position of a plane."""
        block, rest = divmod(at, BLOCK)
        if not rest:
            return int(self.ranks[level][block])
        part = np.unpackbits(self.planes[level][block * BLOCK // 8 : block * BLOCK // 8 + -(-rest // 8)], bitorder="little")
        return int(self.ranks[level][block]) + int(part[:rest].sum())

    def select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) such bit of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        if not bit:
            ranks = np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(ranks, k, "right")) - 1
        part = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8], bitorder="little")
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(ranks[block])])

    def access(self, at: int) -> int:
        value = 0
        for level in range(self.bits):
            bit = int(self.planes[level][at >> 3] >> (at & 7)) & 1
            ones = self.rank1(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self.rank1(level, lo), self.rank1(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if token >> (self.bits - 1 - level) & 1 else (lo - a, hi - b)
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of a token in positions lo to hi."""
        a, b = self._range(token, lo, self.n if hi is None else hi)
        return b - a

    def locate(self, token: int, k: int) -> int:
        """Position of the token's k-th (from 0) occurrence."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        at = a + k
        for level in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - level) & 1
            at = self.select(level, 1, at - self.zeros[level]) if bit else self.select(level, 0, at)
        return at

    def whole(self) -> np.ndarray:
        """All tokens in order: from the last level up, each level's order is unfolded into the one above."""
        now = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for level in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            z = self.zeros[level]
            now[z:] |= np.array(1 << (self.bits - 1 - level), now.dtype)
            out = np.empty_like(now)
            out[~one], out[one] = now[:z], now[z:]
            now = out
        return now


def word_starts(cp: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the byte-level split rule starts a word, in texts that lie end to end and begin at edges.

    A run of letters, of numbers or of others is a word, with one blank before it if there is one. Of a white space
    run before text the last character stands alone, unless it is such a blank. An apostrophe that starts a run of
    others, with no blank before it, takes one of the endings s, t, re, ve, m, ll, d from the letters that follow.
    """
    n = len(cp)
    first = np.zeros(n + 1, bool)
    first[edges] = True
    first[n] = True
    run = first.copy()
    run[1:n] |= kind[1:] != kind[:-1]
    start = run[:n].copy()
    space = kind == 3
    last = np.zeros(n, bool)  # the last of a white space run that text follows
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    start |= last
    blank = last & (cp == 32)
    start[1:] &= ~blank[:-1] | first[1:n]
    lone = np.flatnonzero((cp == 39) & run[:n])
    lone = lone[(lone == 0) | first[lone] | ~blank[lone - 1]]
    if len(lone):
        size = ending_after(cp, first, lone)
        lone, size = lone[size > 0], size[size > 0]
        start[lone + 1] = False
        after = lone + size + 1
        start[after[after < n]] = True
    return np.flatnonzero(start)


def sorted_together(*tables: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Rows of tables in the order of their first column."""
    columns = [np.concatenate(x) for x in zip(*tables, strict=True)]
    order = np.argsort(columns[0])
    return tuple(x[order] for x in columns)


class Words:
    """Ids of texts by the tokenizers library, each distinct word encoded once.

    Texts are cut by the library's own split rule in numpy, words are hashed (64 bits) where they lie, and only words
    that a worker hasn't met go to the library, many at a time. Its table is bounded and starts afresh when full.
    Texts with an added token in them, or with code points newer than Python's tables, go to the library whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism here
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.kinds = kinds()
        self.clear()

    def clear(self) -> None:
        #: Ids of all words in the order they were met; and, sorted by hash, where each word's are and how many: in a
        #: large table, and in a small one of newer words, so that a run's words don't cost a sort of all.
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.table = self.recent = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def __len__(self) -> int:
        return len(self.table[0]) + len(self.recent[0])

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether it is there, where its ids begin, how many) for each hash."""
        hit, first, size = np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        for known, at, n in (self.table, self.recent):
            if len(known):
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                same = known[place] == hashes
                hit |= same
                first[same], size[same] = at[place[same]], n[place[same]]
        return hit, first, size

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def learn(self, hashes: np.ndarray, cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Words side by side in one text stay words of their own behind their blank, or else behind a line end."""
        blank = self.kinds[cp[ends - 1]] == 3  # of white space only
        spaced = ~blank & (cp[starts] == 32)
        order, sizes, flat = [], [], []
        for group, glue in ((np.flatnonzero(spaced), 0), (np.flatnonzero(~spaced & ~blank), 1)):
            for lo in range(0, len(group), TOGETHER):
                part = group[lo : lo + TOGETHER]
                letters = gather(cp, starts[part], ends[part] - starts[part])
                if glue:
                    letters = np.insert(letters, np.concatenate([[0], np.cumsum(ends[part] - starts[part])[:-1]]), 10)
                code = self.library.encode(letters.tobytes().decode("utf-32-le"), add_special_tokens=False)
                ids, of = np.array(code.ids, np.uint32), np.array(code.word_ids)
                if of[-1] + 1 == len(part) * (1 + glue):
                    at = np.arange(len(part)) * (1 + glue) + glue
                    first = np.searchsorted(of, at)
                    sizes.append(np.searchsorted(of, at, "right") - first)
                    flat.append(gather(ids, first, sizes[-1]))
                    order.append(part)
                else:
                    blank[part] = True  # the library cuts them otherwise: one by one
        alone = np.flatnonzero(blank)
        each = [self.whole(cp[a:b].tobytes().decode("utf-32-le")) for a, b in zip(starts[alone].tolist(), ends[alone].tolist(), strict=True)]
        order, sizes = np.concatenate([*order, alone]).astype(np.int64), np.concatenate([*sizes, [len(x) for x in each]]).astype(np.int64)
        flat = np.concatenate([*flat, *each])
        if len(self) + len(hashes) > WORDS:
            self.clear()
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(flat)] = flat
        new = (hashes[order], self.used + np.cumsum(sizes) - sizes, sizes)
        self.used += len(flat)
        self.recent = sorted_together(self.recent, new)
        if len(self.recent[0]) > WORDS // 8:
            self.table, self.recent = sorted_together(self.table, self.recent), tuple(x[:0] for x in self.recent)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each). data: the texts' UTF-8 bytes, text k at offsets[k]."""
        n = len(offsets) - 1
        text = data.tobytes()
        odd = {k for k in range(n) if any(s in text[offsets[k] : offsets[k + 1]] for s in self.added)} if any(s in text for s in self.added) else set()
        cp = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        kind = self.kinds[cp]
        odd.update((np.searchsorted(at, np.flatnonzero(kind == NEWER), "right") - 1).tolist())
        starts = word_starts(cp, kind, at[:-1][np.diff(at) > 0]) if len(cp) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(cp)) if len(starts) else starts
        h = hash_spans(cp, starts, ends)
        distinct, where, inverse = np.unique(h, return_index=True, return_inverse=True)
        hit, first, size = self.find(distinct)
        if not hit.all():
            some = np.flatnonzero(~hit) if len(self) + int((~hit).sum()) <= WORDS else np.arange(len(distinct))
            self.learn(distinct[some], cp, starts[where[some]], ends[where[some]])
            _, first, size = self.find(distinct)
        size = size[inverse]
        ids = gather(self.ids, first[inverse], size)
        cuts = np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, at)]
        if odd:
            parts = [self.whole(text[offsets[k] : offsets[k + 1]].decode()) if k in odd else ids[cuts[k] : cuts[k + 1]] for k in range(n)]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        return ids, np.diff(cuts)


def encode_shards(batches, path: str, bits: int, end: int) -> Iterator[pa.RecordBatch]:
    """Documents in order to shard rows; shard numbers ascend with doc_id."""
    from pyspark import TaskContext

    code, shard = kept(("words", path), lambda: Words(path)), TaskContext.get().partitionId() << 32
    docs: list[pa.Array] = []
    ids: list[np.ndarray] = []
    lengths: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        keys, n = pa.concat_arrays(docs), np.concatenate(lengths)
        one = pa.array([0, len(n)], pa.int32())
        row = [pa.array([shard]), pa.ListArray.from_arrays(one, keys), pa.ListArray.from_arrays(one, pa.array(n)), pa.array([size]), pa.array([build(np.concatenate(ids), bits)], pa.binary())]
        return pa.RecordBatch.from_arrays(row, ["shard", "doc_ids", "lengths", "n_tokens", "file"])

    for batch in batches:
        data, offsets = W.column_bytes(batch.column("text"))
        for lo, hi in W.row_chunks(offsets, W.CHUNK):
            flat, n = code.encode(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            if size and size + len(flat) + len(n) > SHARD:
                yield flush()
                docs, ids, lengths, size, shard = [], [], [], 0, shard + 1
            docs.append(batch.column("doc_id").slice(lo, hi - lo))
            lengths.append(n + 1)
            ids.append(np.insert(flat, np.cumsum(n), end))
            size += len(flat) + len(n)
    if size:
        yield flush()


def bits_of(tokenizer: str, end: int) -> int:
    """Bits that any id of a tokenizer's file, or the end id, needs."""
    from tokenizers import Tokenizer

    ids = Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values()
    return max(1, int(max(end, *ids)).bit_length())


def write_shards(docs: DataFrame, tokenizer: str, path: str, bits: int | None = None, end: int = 0) -> None:
    """Encode docs (doc_id, text) in ascending doc_id order, ids ended by `end`, into wavelet shards at path.

    bits: planes; by default as many as the tokenizer's ids need, and a larger id is an error. Null texts are empty; a
    null doc_id comes first. Rows that repeat a doc_id stand next to each other, in no set order if their texts differ.
    A text of any length is encoded whole, and a shard holds one at least. An empty table gives no shards.
    """
    small_batches(docs.sparkSession)
    bits = bits_of(tokenizer, end) if bits is None else bits
    parts = shuffle_partitions(docs.sparkSession)
    ordered = docs.select("doc_id", "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id")
    schema = "shard long, doc_ids array<long>, lengths array<long>, n_tokens long, file binary"
    ordered.mapInArrow(lambda b: bounded(encode_shards(b, tokenizer, bits, end), keep=True), schema).write.parquet(path)


def read_shards(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the shards' files.

    One task adds up the shards' lengths: a row of two numbers for each shard of some ``SHARD`` ids.
    """
    shards = spark.read.parquet(path)
    # One small row for each shard, never the ids: their running total is the shard's place in the whole.
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = shards.select("shard", "n_tokens").select("shard", F.coalesce(before, F.lit(0)).alias("shard_start"))

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                ids = Wavelet(batch.column("file")[row].as_py()).whole().astype("<u4")
                n = batch.column("lengths")[row].values.to_numpy()
                cuts = np.concatenate([[0], np.cumsum(n)])
                view = memoryview(ids.tobytes())
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                shard = batch.column("shard").take(pa.array([row] * len(n)))
                yield pa.RecordBatch.from_arrays([shard, batch.column("doc_ids")[row].values, pa.array(cuts[:-1]), pa.array(n), pa.array(crc, pa.int64())], ["shard", "doc_id", "at", "n", "ids_crc32"])

    read = shards.mapInArrow(lambda batches: bounded(run(batches)), "shard long, doc_id long, at long, n long, ids_crc32 long").join(starts, "shard")
    return read.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), F.col("n").alias("n_tokens"), "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end: int = 0) -> DataFrame:
    path = new_path(docs.sparkSession, "shards")
    write_shards(docs, tokenizer, path, end=end)
    return read_shards(docs.sparkSession, path)
