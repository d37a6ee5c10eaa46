"""Nucleotide strings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgtNn", "TGCAtgcaNn"))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts, a row per place and a column per text, and the texts' lengths."""
    raw = np.array([t.encode() for t in texts], dtype=bytes)
    width = max(raw.dtype.itemsize, 1)
    return np.ascontiguousarray(raw.view(np.uint8).reshape(len(raw), width).T), np.char.str_len(raw)


def trimmed_lengths(quals: list[str], cutoff: int, offset: int) -> np.ndarray:
    """Bases kept of each quality string after 3' quality trimming by running sums; see ``front_cut``."""
    codes, size = _codes(quals)
    kept, total, best = size.copy(), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
    live = np.flatnonzero(size)
    for back in range(1, len(codes) + 1):
        total[live] += cutoff + offset - codes[size[live] - back, live].astype(np.int64)
        live = live[total[live] >= 0]
        better = live[total[live] > best[live]]
        best[better], kept[better] = total[better], size[better] - back
        live = live[size[live] > back]
        if not len(live):
            break
    return kept


#: A cell of the alignment holds (score, -edits, cut-off bases of the anchor) as one number.
_SCORE, _EDIT = 1 << 20, 1 << 10
_GAP = 2 * _SCORE + _EDIT


#: No way leads to a cell of this value.
_NOWHERE = -(1 << 30)


def _aligned(
    codes: np.ndarray, size: np.ndarray, anchor: str, first: np.ndarray, last: np.ndarray, min_overlap: int, error_rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """Score and end (bases up to and including it) of the best match of a 5' ``anchor`` in each read; 0, 0 without.

    The anchor may stand anywhere and may be cut off by the read's start. ``error_rate`` edits
    per aligned anchor base are allowed, ``min_overlap`` bases must be aligned. A matching base
    counts 1, another base -1, a base more or less -2; the best score wins, then fewer edits,
    then the earliest end. Matches are known to end between ``first`` and ``last``.

    One anchor base of all reads is computed at a time, on a band of the alignment: what scores as much
    as a match with e edits has 3e/2 edits at most, so it stays that near the diagonals of these ends.
    """
    m, reads = len(anchor), codes.shape[1]
    most = int(error_rate * m)
    margin = 1 + 3 * most // 2
    # Cell (b, r) of anchor base j stands for low[r] + b + j bases of read r.
    low, band = first - m - margin, int((last - first).max()) + 2 * margin + 1
    at = low + np.arange(band + m)[:, None]
    outside = (at < 0) | (at >= len(codes))
    letters = codes[np.where(outside, 0, at), np.arange(reads)]
    letters[outside] = 0
    cell = np.where(at[:band] < 0, _NOWHERE, 0).astype(np.int32)
    for j, letter in enumerate(anchor.encode(), 1):
        new = cell + np.where(letters[j - 1: j - 1 + band] == letter, np.int32(_SCORE), np.int32(-_SCORE - _EDIT))
        np.maximum(new[:-1], cell[1:] - _GAP, out=new[:-1])
        here = at[j: j + band]
        if here[0].min() <= 0:  # before the first base, the first j anchor bases may be cut off, free of charge
            new[here < 0] = _NOWHERE
            new[here == 0] = j
        for b in range(1, band):
            np.maximum(new[b], new[b - 1] - _GAP, out=new[b])
        cell = new
    end = at[m: m + band]
    cut = cell & (_EDIT - 1)
    edits = ((cut - cell) >> 10) & (_EDIT - 1)
    aligned = m - cut
    rank = (cell - cut) >> 10
    good = (aligned >= min_overlap) & (edits <= np.floor(error_rate * aligned)) & (rank >= 0) & (end > 0) & (end <= size)
    rank = np.where(good, rank, -1)
    pick, every = rank.argmax(axis=0), np.arange(reads)
    best = rank[pick, every]
    return np.where(best >= 0, (best + _EDIT // 2) >> 10, 0), np.where(best >= 0, end[pick, every], 0)


def _end_edits(codes: np.ndarray, anchor: str) -> np.ndarray:
    """Fewest edits with which the anchor, maybe cut off by the read's start, ends at each place of each read.

    Bit-parallel edit distances: a word per read holds a whole column, so a base costs a dozen
    word operations on all reads.
    """
    masks = np.zeros(256, dtype=np.uint64)
    for j, letter in enumerate(anchor.encode()):
        masks[letter] |= np.uint64(1 << j)
    one, top = np.uint64(1), np.uint64(len(anchor) - 1)
    plus, minus, count = (np.zeros(codes.shape[1], np.uint64) for _ in range(3))
    edits = np.empty(codes.shape, np.int8)
    for i, letters in enumerate(codes):
        equal = masks[letters]
        down = equal | minus
        across = (((equal & plus) + plus) ^ plus) | equal
        up, low = minus | ~(across | plus), plus & across
        count += ((up >> top) & one) - ((low >> top) & one)
        edits[i] = count
        up, low = up << one, low << one
        plus, minus = low | ~(down | up), up & down
    return edits


def _allowed(width: int, m: int, min_overlap: int, error_rate: float) -> np.ndarray:
    """Edits that a match ending after 1, 2, .. bases may have at most; -1: none ends there.

    With e edits, i bases hold i + e anchor bases at most.
    """
    bases = np.arange(1, width + 1)
    edits = np.full(width, int(error_rate * m))
    for _ in range(int(error_rate * m)):
        edits = np.floor(error_rate * np.minimum(m, bases + edits)).astype(np.int64)
    return np.where(np.minimum(m, bases + edits) >= min_overlap, edits, -1)


def anchor_matches(
    seqs: list[str], anchor: str, min_overlap: int, error_rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """Score and end of the best match of a 5' anchor in each read; see ``_aligned``.

    A whole anchor without edits has the best possible score and is found as text. Edit distances
    give the ends of the others: an end without edits scores its bases, one with e edits 2e less than
    its bases at most. Only where such a bound could be the better one, reads are aligned.
    """
    if not len(seqs):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    m = len(anchor)
    whole = np.array([s.find(anchor) for s in seqs], dtype=np.int64)
    score = np.where(whole >= 0, m, 0)
    end = np.where(whole >= 0, whole + m, 0)
    rest = np.flatnonzero(whole < 0)
    if not len(rest):
        return score, end
    codes, size = _codes([seqs[i] for i in rest])
    bases = np.arange(1, len(codes) + 1, dtype=np.int32)[:, None]
    if m <= 64:
        edits = _end_edits(codes, anchor)
        possible = (edits <= _allowed(len(codes), m, min_overlap, error_rate)[:, None]) & (bases <= size)
        seen = possible.any(axis=0)
        rest, codes, size, edits, possible = rest[seen], codes[:, seen], size[seen], edits[:, seen], possible[:, seen]
        exact = np.where(possible & (edits == 0) & (bases >= min_overlap), bases, 0).max(axis=0, initial=0)
        bound = np.where(possible & (edits > 0), np.minimum(m, bases) - 2 * edits.astype(np.int32), 0).max(axis=0, initial=0)
        score[rest], end[rest] = exact, exact
        unsure = np.flatnonzero(bound > exact)
        first = possible[:, unsure].argmax(axis=0) + 1
        last = len(codes) - possible[::-1, unsure].argmax(axis=0)
    else:
        unsure = np.flatnonzero(size)
        first, last = np.ones(len(unsure), np.int64), size[unsure]
    order = np.argsort(last - first, kind="stable")  # reads of like bands together
    for part in _in_slices(len(order), 4000):
        of = order[part]
        k = unsure[of]
        score[rest[k]], end[rest[k]] = _aligned(codes[:, k], size[k], anchor, first[of], last[of], min_overlap, error_rate)
    return score, end


def _in_slices(n: int, rows: int = 5000):
    return (slice(lo, min(lo + rows, n)) for lo in range(0, n, rows))


def adapter_starts(seqs: list[str], adapter: str, min_overlap: int, error_rate: float) -> np.ndarray:
    """Bases kept before a 3' ``adapter``, which may be cut off by the read's end; all without one.

    The mirror image of ``anchor_matches``.
    """
    _, end = anchor_matches([s[::-1] for s in seqs], adapter[::-1], min_overlap, error_rate)
    return np.array([len(s) for s in seqs], dtype=np.int64) - end


def adapter_cut(seq: Column, adapter: str, min_overlap: int, error_rate: float) -> Column:
    """``adapter_starts`` of a column of reads, in Arrow batches."""

    @F.pandas_udf("int")
    def kept(seqs: pd.Series) -> pd.Series:
        texts = seqs.fillna("").tolist()
        out = np.zeros(len(texts), dtype=np.int32)
        for part in _in_slices(len(texts)):
            out[part] = adapter_starts(texts[part], adapter, min_overlap, error_rate)
        return pd.Series(out)

    return kept(seq)


def junction_fronts(
    reads: list[str], fronts: dict[str, str], min_overlap: int, error_rate: float
) -> tuple[np.ndarray, np.ndarray]:
    """Label of the best front anchor of each read, and bases up to its end."""
    n = len(reads)
    label, score, cut = np.full(n, "unknown", dtype=object), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for name, anchor in fronts.items():
        s, e = anchor_matches(reads, anchor, min_overlap, error_rate)
        better = (e > 0) & ((cut == 0) | (s > score))
        label[better], score[better], cut[better] = name, s[better], e[better]
    return label, cut


def junction_rests(
    mates: list[str], labels: np.ndarray, backs: dict[str, str], min_overlap: int, error_rate: float
) -> np.ndarray:
    """Bases of each mate to keep before the back adapter of its label."""
    keep = np.array([len(m) for m in mates], dtype=np.int64)
    for name, adapter in backs.items():
        rows = np.flatnonzero(labels == name)
        if len(rows):
            keep[rows] = adapter_starts([mates[i] for i in rows], adapter, min_overlap, error_rate)
    return keep


def _trimmed(seqs: pd.Series, quals: pd.Series, cutoff: int, offset: int) -> tuple[list[str], np.ndarray]:
    """Reads without their low-quality tails, and the bases kept of their qualities."""
    kept = trimmed_lengths(quals.fillna("").tolist(), cutoff, offset)
    return [s[:k] for s, k in zip(seqs.fillna("").tolist(), kept.tolist(), strict=True)], kept


def front_cut(
    seq: Column, qual: Column, fronts: dict[str, str], min_overlap: int, error_rate: float,
    cutoff: int = 15, offset: int = 33,
) -> Column:
    """Struct (junction, cut, size) of a first mate: its label, bases up to the junction's end, bases without the tail.

    The low-quality tail goes first. Walk from the 3' end adding (cutoff - quality); stop once the sum turns
    negative; cut where the sum was largest. Neither this walk nor the search has a Spark function, so both
    run in one pass of Arrow batches.
    """

    @F.pandas_udf("junction string, cut int, size int")
    def found(seqs: pd.Series, quals: pd.Series) -> pd.DataFrame:
        label, cut, size = np.full(len(seqs), "", dtype=object), np.zeros(len(seqs), np.int32), np.zeros(len(seqs), np.int32)
        for part in _in_slices(len(seqs)):
            reads, size[part] = _trimmed(seqs.iloc[part], quals.iloc[part], cutoff, offset)
            label[part], cut[part] = junction_fronts(reads, fronts, min_overlap, error_rate)
        return pd.DataFrame({"junction": label, "cut": cut, "size": size})

    return found(seq, qual)


def back_cut(
    seq: Column, qual: Column, label: Column, backs: dict[str, str], min_overlap: int, error_rate: float,
    cutoff: int = 15, offset: int = 33,
) -> Column:
    """Bases of a second mate to keep: without its low-quality tail and before the back adapter of its label."""

    @F.pandas_udf("int")
    def kept(seqs: pd.Series, quals: pd.Series, labels: pd.Series) -> pd.Series:
        out = np.zeros(len(seqs), np.int32)
        for part in _in_slices(len(seqs)):
            mates, _ = _trimmed(seqs.iloc[part], quals.iloc[part], cutoff, offset)
            out[part] = junction_rests(mates, labels.iloc[part].to_numpy(), backs, min_overlap, error_rate)
        return pd.Series(out)

    return kept(seq, qual, label)
