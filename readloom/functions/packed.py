"""Bases at two bits each, for whole batches of strings at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bases of one word, and of what is known on either side of a k-mer.
WORD = 32
_CODE = np.full(256, 4, np.uint8)
for _i, _b in enumerate(b"ACGT"):
    _CODE[_b] = _CODE[_b + 32] = _i


def code_of(letters: np.ndarray) -> np.ndarray:
    """0 to 3 for A, C, G, T in either case, 4 for other bytes."""
    return _CODE[letters]


class Packed:
    """Strings of bases, one after another with WORD empty places before and after each.

    codes: 0 to 3, and 4 for anything but A, C, G, T. word[i]: the 32 bases from place i on, the first in the highest
    bits, other letters and empty places as A. begin, size: where each string stands.
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        n = len(sizes)
        self.size = sizes
        self.begin = WORD + np.cumsum(sizes + WORD) - (sizes + WORD)
        self.of = np.repeat(np.arange(n), sizes)
        place = np.repeat(self.begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(codes))
        self.codes = np.zeros(WORD + len(codes) + WORD * n + WORD, np.uint8)
        self.codes[place] = codes
        self.odd = np.concatenate([[0], np.cumsum(self.codes > 3)])
        word = (self.codes & 3).astype(np.uint64)
        for half in (1, 2, 4, 8, 16):
            later = np.zeros_like(word)
            later[:-half] = word[half:]
            word = (word << np.uint64(2 * half)) | later
        self.word = word

    @classmethod
    def of_strings(cls, column: pa.Array, both: bool = False) -> Packed:
        """The strings of a column; with both, their reverse complements after them."""
        column = column.cast(pa.large_string())
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        codes = _CODE[np.frombuffer(column.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]]
        sizes = np.diff(at)
        if both:
            back = codes[::-1]
            codes = np.concatenate([codes, np.where(back < 4, 3 - back, back)])
            sizes = np.concatenate([sizes, sizes[::-1]])
        return cls(codes, sizes)

    def keys(self, at: np.ndarray, k: int) -> np.ndarray:
        """The k-mers at places, k up to 31."""
        return (self.word[at] >> np.uint64(2 * (WORD - k))).astype(np.int64)

    def plain(self, at: np.ndarray, k: int | np.ndarray) -> np.ndarray:
        """Whether the k places from each one on hold nothing but A, C, G, T (and empty places)."""
        return self.odd[np.minimum(at + k, len(self.codes))] == self.odd[at]

    def one_odd(self, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of the k-mers at places hold just one other letter, each four times, and the keys with any base there."""
        which = np.flatnonzero(self.odd[at + k] - self.odd[at] == 1)
        place = np.searchsorted(self.odd, self.odd[at[which]] + 1) - 1 - at[which]
        keys = self.keys(at[which], k)[:, None] ^ (np.arange(4)[None, :] << (2 * (k - 1 - place))[:, None])
        return np.repeat(which, 4), keys.ravel()


def minimizers(p: Packed, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k-mers that are least, by a hash, of some w neighbouring ones, and the string each is in. Equal
    ones all count, so what is chosen depends on the w k-mers alone, and strings that share w + k - 1 bases share one."""
    many = np.maximum(p.size - k + 1, 0)
    of = np.repeat(np.arange(len(many)), many)
    first = np.cumsum(many) - many
    at = np.repeat(p.begin - first, many) + np.arange(len(of))
    if len(of) < w:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = p.keys(at, k).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rank = (x ^ (x >> np.uint64(31))) >> np.uint64(1)
    good = p.plain(at, k)
    rank[~good] = np.iinfo(np.int64).max
    rank = rank.astype(np.int64)
    least = np.lib.stride_tricks.sliding_window_view(rank, w).min(axis=1)
    least[of[w - 1 :] != of[: len(of) - w + 1]] = -1  # a window over two strings is none
    best = np.full(len(of) + w - 1, -1, np.int64)
    best[w - 1 : w - 1 + len(least)] = least
    chosen = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(best, w).max(axis=1) == rank) & good)
    return at[chosen], of[chosen]
