"""Spans of code points: classes, hashes and endings that split rules share."""

import unicodedata

import numpy as np

from avmatch.llm import words as W

#: Fixed value: Unicode white space.
SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


#: Masks of the first 0 to 3 code points of a piece.
LOW_POINTS = np.array([(1 << 21 * k) - 1 for k in range(4)], np.uint64)
NEWER = 4


def kinds() -> np.ndarray:
    """The split rule's class of each code point: 0 other, 1 letter, 2 number, 3 white space, ``NEWER`` unassigned here.

    The tokenizers library may know a newer Unicode than Python does, so texts with unassigned code points are its own.
    """
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L" or kind[0] == "N":
            table[c] = 1 if kind[0] == "L" else 2
        elif kind == "Cn":
            table[c] = NEWER
    table[SPACES] = 3
    return table


def ending_after(cp: np.ndarray, first: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Length of the ending (s, t, re, ve, m, ll or d, else 0) right behind apostrophes, within their text. first: where
    texts begin, and the end."""
    ahead = np.concatenate([cp, np.zeros(2, cp.dtype)])
    inside = np.concatenate([~first[: len(cp)], [False, False]])
    one, two = ahead[at + 1], ahead[at + 2]
    single = inside[at + 1] & np.isin(one, [ord(c) for c in "stmd"])
    pair = (((one == 114) | (one == 118)) & (two == 101)) | ((one == 108) & (two == 108))
    return np.where(single, 1, np.where(inside[at + 1] & inside[at + 2] & pair, 2, 0))


def gather(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[first : first + size], end to end."""
    total = np.cumsum(size)
    return flat[np.arange(total[-1] if len(total) else 0) + np.repeat(first - (total - size), size)]


def hash_spans(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points; three, of 21 bits each, are a piece."""
    three = np.zeros(len(cp) + 1, np.uint64)
    three[:-1] = cp
    three[:-2] |= three[1:-1] << np.uint64(21)
    three[:-3] |= three[2:-1] << np.uint64(42)  # what is above 21 bits there falls out
    return W.hash_runs(starts, ends, 3, lambda at, left: three[at] & LOW_POINTS[left])
