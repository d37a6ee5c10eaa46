"""Sorting suffixes by hash-compared mergesort.

Prefix polynomial hashes give the hash of any substring in one step; a binary search over lengths
finds how far two suffixes agree, so a comparison takes a logarithmic number of hash tests. All
comparisons of a merge level are made side by side in arrays. Adjacent suffixes reported as equal
are compared byte by byte at the end.
"""

from __future__ import annotations

import numpy as np

from hopscan.llm.textbytes import _BASE, _BYTE, mix, powers

_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_inverse = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """Powers of the base's inverse, at least n of them."""
    global _inverse
    if len(_inverse) < n:
        out = np.full(1 << (n - 1).bit_length(), _INVERSE)
        out[0] = 1
        _inverse = np.multiply.accumulate(out)
    return _inverse


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hash sums of all prefixes."""
    out = np.zeros(len(data) + 1, np.uint64)
    value = _BYTE[data]
    value *= powers(max(1, len(data)))[: len(data)]
    np.cumsum(value, out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Hashes of substrings, which do not depend on where they stand."""
    return (sums[at + length] - sums[at]) * inverse_powers(len(sums))[at]


class Suffixes:
    """Suffixes of a buffer, compared over at most ``most`` bytes; the buffer is padded by as many."""

    def __init__(self, data: np.ndarray, most: int) -> None:
        self.most = most
        self.data = np.concatenate([data, np.zeros(most + 1, np.uint8)])
        self.sums = prefix_hashes(self.data)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bytes on which the suffixes at x and y agree, up to ``most``."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.most, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) // 2
            same = substring_hashes(self.sums, x, mid) == substring_hashes(self.sums, y, mid)
            low = np.where(open_ & same, mid, low)
            high = np.where(open_ & ~same, mid - 1, high)

    def below(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at x sorts before that at y (or is equal, where asked)."""
        n = self.common(x, y)
        equal = n >= self.most
        a, b = self.data[x + np.minimum(n, self.most - 1)], self.data[y + np.minimum(n, self.most - 1)]
        return np.where(equal, or_equal, a < b)

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes at ``starts`` within each group; ``group`` is sorted."""
        order = np.arange(len(starts))
        if not len(order):
            return order
        first = np.flatnonzero(np.diff(group, prepend=group[:1] - 1))
        size = np.diff(np.append(first, len(group)))
        begin, total = np.repeat(first, size), np.repeat(size, size)
        local = np.arange(len(starts)) - begin
        run = 1
        while run < size.max():
            part = np.flatnonzero(total > run)  # groups that are one run already rest
            run_start = local[part] // run * run
            is_right = run_start // run % 2 == 1
            other = np.where(is_right, run_start - run, run_start + run)
            low = np.minimum(other, total[part])
            high = np.minimum(other + run, total[part])
            base = low.copy()
            me = starts[order[part]]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) // 2
                them = starts[order[begin[part[open_]] + mid]]
                goes_first = self.below(them, me[open_], is_right[open_])
                low[open_] = np.where(goes_first, mid + 1, low[open_])
                high[open_] = np.where(goes_first, high[open_], mid)
            place = np.minimum(run_start, other) + (local[part] - run_start) + (low - base)
            new = order.copy()
            new[begin[part] + place] = order[part]
            order = new
            run *= 2
        return order

    def runs(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sorted order and a run number for each place: one run for suffixes equal over ``most`` bytes."""
        order = self.sort(starts, group)
        s = starts[order]
        same = np.zeros(len(s), bool)
        if len(s) > 1:
            near = np.flatnonzero((self.common(s[:-1], s[1:]) >= self.most) & (group[1:] == group[:-1]))
            span = np.arange(self.most)
            for i in range(0, len(near), 1 << 14):
                some = near[i : i + (1 << 14)]
                equal = (self.data[s[some][:, None] + span] == self.data[s[some + 1][:, None] + span]).all(axis=1)
                same[some + 1] = equal
        return order, np.cumsum(~same) - 1


def rolling_hashes(sums: np.ndarray, length: int) -> np.ndarray:
    """Mixed hashes of all substrings of one length, in place order."""
    out = sums[length:] - sums[:-length]
    out *= inverse_powers(len(sums))[: len(out)]
    return mix(out)


def window_hashes(sums: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    return mix(substring_hashes(sums, at, length))
