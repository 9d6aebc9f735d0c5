"""Vectorised words of Arrow text columns: numpy over the column's own buffers, no Python string per word.

A word is a run of bytes outside 0x20 and 0x09-0x0D; A-Z is lower-cased. Null text counts as empty.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multiplier that tells places and lengths apart.
BASE = 0x9E3779B97F4A7C15
#: Bytes handled at once; bounds the working set, since each byte needs a few 8-byte cells.
CHUNK = 1 << 20


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def space_table() -> np.ndarray:
    table = np.zeros(256, bool)
    table[9:14] = table[32] = True
    return table


LOWER, SPACE = lower_table(), space_table()
#: Masks of the first 0 to 8 bytes of a little-endian cell.
LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each row the index of its first word (one more than rows)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty(len(data), bool)
    before[0], before[1:] = False, solid[:-1]
    before &= ~edge[:-1]
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = False, solid[1:]
    after &= ~edge[1:]
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_runs(starts: np.ndarray, ends: np.ndarray, width: int, piece: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """A 64-bit hash of each run of symbols. piece(at, left): `left` symbols (`width` at most) from each place, packed.

    Pieces are mixed with a key of their place before they are added up: a plain polynomial mod 2**64 would give some
    pairs of long regular words, such as a Thue-Morse word and its complement, one value.
    """
    size = ends - starts
    out = mix(piece(starts, np.minimum(size, width)))
    long = np.flatnonzero(size > width)
    if len(long):
        more = (size[long] - 1) // width
        total = np.cumsum(more)
        place = np.arange(1, int(total[-1]) + 1) - np.repeat(total - more, more)
        at = np.repeat(starts[long], more) + place * width
        left = np.minimum(np.repeat(ends[long], more) - at, width)
        out[long] += np.add.reduceat(mix(piece(at, left) ^ mix(place.astype(np.uint64) * np.uint64(BASE))), total - more)
    return mix(out + size.astype(np.uint64) * np.uint64(BASE))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, lower-cased unless told otherwise; eight bytes are read at once."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + CHUNK, "right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        padded = np.zeros(b - a + 8, np.uint8)
        padded[: b - a] = LOWER[data[a:b]] if lower else data[a:b]
        eights = np.ndarray(b - a + 1, "<u8", padded, strides=(1,))
        out[lo:hi] = hash_runs(starts[lo:hi] - a, ends[lo:hi] - a, 8, lambda at, left, eights=eights: eights[at] & LOW_BYTES[left])
        lo = hi
    return out


def row_chunks(offsets: np.ndarray, limit: int = 2 * CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes each, or one longer row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def hashed_rows(batch: pa.RecordBatch, text: str, limit: int = 2 * CHUNK) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(rows, word hashes, first word of each row and the end) over bounded runs of rows."""
    data, offsets = column_bytes(batch.column(text))
    for lo, hi in row_chunks(offsets, limit):
        part = data[offsets[lo] : offsets[hi]]
        starts, ends, first = spans(part, offsets[lo : hi + 1] - offsets[lo])
        yield slice(lo, hi), hash_words(part, starts, ends), first


def shingle_sets(words: np.ndarray, first: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct n-word shingle hashes of each row; a shorter row is one shingle, an empty row has none."""
    odd = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
    count = len(words) - n + 1
    windows = np.zeros(max(count, 0), np.uint64)
    for k in range(n):
        if count > 0:
            windows += words[k : k + count] * odd[k]
    windows = mix(windows)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            s = np.sort(windows[a : b - n + 1])
            keep = np.empty(len(s), bool)
            keep[0] = True
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            sets.append(s[keep])
        elif b > a:
            whole = np.sum(words[a:b] * odd[: b - a], dtype=np.uint64) + np.uint64(b - a)
            sets.append(mix(np.array([whole], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
