"""BPE encoding and decoding: a priority queue of merge ranks over a doubly linked symbol list.

Reads a ``tokenizers`` JSON file of the word-end kind: NFC, white space runs as one blank, lower case, a split into
letters, single digits and runs of the rest, byte symbols, and ``</w>`` on a word's last symbol. Words are cut and
hashed (64 bits) in numpy, and each distinct one is merged once per worker and kept in a bounded table. Added tokens
found in a text are ids of their own, matched before any normalising. Decoding joins the vocabulary strings with
blanks, as the library does for a file without a decoder. A text with code points newer than Python's tables is
normalised and cut by the library, and merged here.

Null texts are empty: no ids, an empty text. Rows that repeat are encoded one by one; a text of any length is encoded
whole; an empty table gives an empty table.
"""

import json
import unicodedata
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from avmatch.llm import words as W
from avmatch.llm.spans import NEWER, ending_after, gather, hash_spans, kinds
from avmatch.llm.worker import bounded, kept, small_batches

#: Merged words that a worker keeps; a full table starts afresh.
WORDS = 700_000
#: Text bytes handled at once.
RUN = 1 << 20


def byte_symbols() -> list[str]:
    """The visible character of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"] or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: Rank of a pair of ids (packed), and the id that each rank makes.
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.inner = [ids[c] for c in byte_symbols()]
        self.last = [ids[c + end] for c in byte_symbols()]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        strings = {i: s for s, i in ids.items()} | {i: s for s, i in self.added.items()}
        shown = [f"{strings.get(i, '')} ".encode() for i in range(max(strings) + 1)]
        self.string_bytes, self.string_first = np.frombuffer(b"".join(shown), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in shown])])
        self.split_added = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.added, key=len, reverse=True)) + ")").split if self.added else None
        self.kinds = kinds()
        self.path, self.bytes = path, {c: b for b, c in enumerate(byte_symbols())}
        self.clear()

    def clear(self) -> None:
        self.hashes, self.first, self.ids = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    @cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def newer(self, text: str) -> np.ndarray:
        """Ids of a text with code points newer than Python's tables."""
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return np.array([i for piece, _ in pieces for i in self.merge(bytes(self.bytes[c] for c in piece))], np.int32)

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token. Queue entries hold a rank and the place of the pair's left symbol."""
        sym = [self.inner[b] for b in data]
        sym[-1] = self.last[data[-1]]
        n, rank_of, made = len(sym), self.ranks.get, self.made
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        queue = [rank << 32 | k for k in range(n - 1) if (rank := rank_of(sym[k] << 32 | sym[k + 1])) is not None]
        heapify(queue)
        while queue:
            top = heappop(queue)
            k = top & 0xFFFFFFFF
            m, new = after[k], made[top >> 32]
            if sym[k] < 0 or m < 0 or (rank := rank_of(sym[k] << 32 | sym[m])) is None or made[rank] != new:
                continue  # stale: a neighbour has merged since
            sym[k], sym[m] = new, -1
            after[k] = m = after[m]
            if m >= 0:
                before[m] = k
                if (rank := rank_of(new << 32 | sym[m])) is not None:
                    heappush(queue, rank << 32 | k)
            p = before[k]
            if p >= 0 and (rank := rank_of(sym[p] << 32 | new)) is not None:
                heappush(queue, rank << 32 | p)
        return [s for s in sym if s >= 0]

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = [self.merge(w.encode()) for w in words]
        if len(self.hashes) + len(words) > WORDS:
            self.clear()
        size = np.concatenate([np.diff(self.first), [len(f) for f in found]])
        ids = np.concatenate([self.ids, np.array(list(chain.from_iterable(found)), np.int32)])
        hashes = np.concatenate([self.hashes, hashes])
        order = np.argsort(hashes)
        first = np.concatenate([[0], np.cumsum(size)])
        self.ids = gather(ids, first[order], size[order])
        self.hashes, self.first = hashes[order], np.concatenate([[0], np.cumsum(size[order])])

    def encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each), for texts without added tokens or newer code points."""
        texts = [t.lower() if t.isascii() else unicodedata.normalize("NFC", t).replace("\u03a3", "\u03c3").lower() for t in texts]  # no final-sigma rule
        cp = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        kind = self.kinds[cp]
        starts, ends = word_spans(cp, kind, at[:-1][np.diff(at) > 0])
        distinct, where, inverse = np.unique(hash_spans(cp, starts, ends), return_index=True, return_inverse=True)
        new = np.ones(len(distinct), bool)
        if len(self.hashes):
            new = self.hashes[np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)] != distinct
        if len(self.hashes) + int(new.sum()) > WORDS:
            new[:] = True
        if new.any():
            some = np.flatnonzero(new)
            self.learn(distinct[some], [cp[a:b].tobytes().decode("utf-32-le") for a, b in zip(starts[where[some]].tolist(), ends[where[some]].tolist(), strict=True)])
        place = np.searchsorted(self.hashes, distinct)[inverse]
        size = self.first[place + 1] - self.first[place] if len(place) else np.zeros(0, np.int64)
        ids = gather(self.ids, self.first[place], size) if len(place) else np.zeros(0, np.int32)
        return ids, np.diff(np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, at)])

    def is_newer(self, text: str) -> bool:
        return not text.isascii() and bool((self.kinds[np.frombuffer(text.encode("utf-32-le"), np.uint32)] == NEWER).any())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As encode_plain, for any texts: added tokens in a text are ids of their own."""
        odd = [any(s in t for s in self.added) for t in texts]
        newer = [self.is_newer(t) for t in texts]
        if not any(odd) and not any(newer):
            return self.encode_plain(texts)
        cut = [self.split_added(t) if k else [t] for k, t in zip(odd, texts, strict=True)]
        flat, n = self.encode_plain(["" if k else part for parts, k in zip(cut, newer, strict=True) for part in parts[::2]])
        pieces = iter(np.split(flat, np.cumsum(n)[:-1]))
        out = []
        for parts, k in zip(cut, newer, strict=True):
            ids = [np.array([self.added[x]], np.int32) if at % 2 else next(pieces) if not k else (next(pieces), self.newer(x))[1] for at, x in enumerate(parts)]
            out.append(np.concatenate(ids))
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def decode(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes of the decoded texts end to end, their offsets) for runs of n ids each."""
        size = self.string_first[ids + 1] - self.string_first[ids]
        shown = gather(self.string_bytes, self.string_first[ids], size)
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum(n)]
        shown = np.delete(shown, ends[n > 0] - 1)  # a text's last blank
        return shown, np.concatenate([[0], ends - np.cumsum(n > 0)])


def word_spans(cp: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words in texts that lie end to end and begin at edges: runs of letters, single numbers, runs
    of others; an apostrophe that starts a run of others takes one of the endings s, t, re, ve, m, ll, d."""
    n = len(cp)
    start = np.zeros(n, bool)
    start[edges] = True
    first = np.append(start, True)
    start[1:] |= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    lone = np.flatnonzero((cp == 39) & start)
    if len(lone):
        size = ending_after(cp, first, lone)
        lone, size = lone[size > 0], size[size > 0]
        start[lone + 1] = False
        after = lone + size + 1
        start[after[after < n]] = True
    at = np.flatnonzero(start)
    ends = np.append(at[1:], n) if len(at) else at
    solid = kind[at] != 3
    return at[solid], ends[solid]


def encoder(path: str) -> Encoder:
    """The worker's encoder of a file, with its table of merged pieces; it outlives a task."""
    return kept(("encoder", path), lambda: Encoder(path))


def encode_rows(batches, path: str) -> Iterator[pa.RecordBatch]:
    code = encoder(path)
    for batch in batches:
        names = [c for c in batch.schema.names if c != "text"]
        _, offsets = W.column_bytes(batch.column("text"))
        for lo, hi in W.row_chunks(offsets, RUN):
            ids, n = code.encode([t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()])
            shown, cuts = code.decode(ids, n)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids.astype(np.int32)))
            decoded = pa.StringArray.from_buffers(hi - lo, pa.py_buffer(cuts.astype(np.int32).tobytes()), pa.py_buffer(shown.tobytes()))
            rest = [batch.column(c).slice(lo, hi - lo) for c in names]
            yield pa.RecordBatch.from_arrays([*rest, lists, decoded], [*names, "ids", "decoded"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs with its column text replaced by ids (array of int) and decoded (the text that the ids stand for)."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    small_batches(docs.sparkSession)
    return docs.mapInArrow(lambda b: bounded(encode_rows(b, path), keep=True), f"{fields}, ids array<int>, decoded string")
