"""Removal of word windows that stand in a document with a smaller id, by fixed-block anchors.

A word goes if a window of WINDOW words over it also starts in a document of smaller doc_id. The
documents are the reference, cut into blocks of BLOCK = (WINDOW + 1) / 2 words that do not overlap;
any window holds exactly one whole block of its document.

1. Index: tasks fold the blocks into sorted hashes with the smallest doc_id; shards by hash become
   sorted arrays in the shared folder.
2. Probe: every rolling window of BLOCK words of every document is looked up there. A block met in a
   larger document is a hit; tasks fold the hits into distinct hashes.
3. Extend: a block that is hit is extended on both sides to the windows of WINDOW words around it;
   these go, with the smallest doc_id, to arrays by the window's hash.
4. Every document looks its windows up; those of a smaller document are covered, and overlapping
   ones join to the maximal repeats.

Text never moves, and no hit is paired with another: a group of n copies costs n times its words,
whatever n. A block or window of a third of all rows is one entry per task and flush. Blocks are
only a filter; windows are told apart by 96 bits of hash.

Null texts are empty. A null doc_id is neither smaller nor larger than another: such rows stay whole
and remove nothing. Rows with one doc_id do not cut each other. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopscan.llm.store import Shards, new_folder, shard_bits, text_bytes, tidy, write_shards
from hopscan.llm.textbytes import EXACT, mix, pack, pack_counts, slices, unpack, unpack_counts, word_hashes

WINDOW = 13
SHARD_BYTES = 64 << 20
#: Entries that a task holds before it sends them on.
FLUSH = 1 << 20
_RNG = np.random.default_rng(9973)
_PLACES = _RNG.integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
ENTRIES = "shard int, keys binary, docs binary, checks binary"
NONE = np.iinfo(np.int64).max


def windows(words: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in place order."""
    out = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        out += words[k : k + len(out)] * _PLACES[which, k]
    return mix(out)


def inside(rows: np.ndarray, size: int, n: int) -> np.ndarray:
    """Whether each of n windows lies within one row; rows: word offsets of the rows."""
    out = np.ones(n, bool)
    for end in rows[1:-1]:
        out[max(0, end - size + 1) : end] = False
    return out


def _least(keys: np.ndarray, docs: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry for each (key, check), sorted, with its smallest doc."""
    order = np.lexsort((docs, checks, keys))
    keys, docs, checks = keys[order], docs[order], checks[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1])
    return keys[first], docs[first], checks[first]


class Entries:
    """Entries of a task, folded now and then; sent on when FLUSH distinct ones are held."""

    def __init__(self, shards: Shards) -> None:
        self.shards, self.parts, self.size = shards, [], 0

    def add(self, keys: np.ndarray, docs: np.ndarray, checks: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, docs, np.zeros(len(keys), np.uint32) if checks is None else checks))
        self.size += len(keys)
        if self.size > 2 * FLUSH:
            folded = self._folded()
            self.parts, self.size = [folded], len(folded[0])
            if self.size > FLUSH:
                yield from self.rest()

    def _folded(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return _least(*(np.concatenate(x) for x in zip(*self.parts, strict=True)))

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            keys, docs, checks = self._folded()
            for shard, p in self.shards.cut(keys):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "keys": [pack(keys[p])], "docs": [pack_counts(docs[p].view(np.uint64))],
                    "checks": [checks[p].tobytes()]})
        self.parts, self.size = [], 0


def _joined(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [(unpack(k), unpack_counts(d).view(np.int64), np.frombuffer(c, np.uint32))
             for k, d, c in zip(pdf["keys"], pdf["docs"], pdf["checks"], strict=True)]
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint32))
    return _least(*(np.concatenate(x) for x in zip(none, *parts, strict=True)))


def _with_doc(pdf: pd.DataFrame) -> bytes:
    keys, docs, _ = _joined(pdf)
    return keys.tobytes() + docs.tobytes()


def _keys_only(pdf: pd.DataFrame) -> bytes:
    return _joined(pdf)[0].tobytes()


def _checked(pdf: pd.DataFrame) -> bytes:
    keys, docs, checks = _joined(pdf)
    return keys.tobytes() + docs.tobytes() + checks.tobytes()


def _looked_up(shards: Shards, keys: np.ndarray, width: int, found: Callable[[slice, np.ndarray, np.ndarray, int], None]) -> None:
    """Calls ``found(part, places, raw, n)`` for each shard that sorted distinct keys fall into.

    The shard holds n sorted hashes first, of ``width`` bytes an entry; places are those of the first hash not below the key.
    """
    for shard, part in shards.cut(keys):
        raw = shards.raw(shard)
        n = len(raw) // width
        if n:
            found(part, np.searchsorted(raw[: 8 * n].view(np.uint64), keys[part]), raw, n)


def smallest_doc(shards: Shards, keys: np.ndarray) -> np.ndarray:
    """Smallest doc_id of any block hashes; NONE where a block is not indexed."""
    known, back = np.unique(keys, return_inverse=True)
    out = np.full(len(known), NONE, np.int64)

    def found(part: slice, at: np.ndarray, raw: np.ndarray, n: int) -> None:
        held, docs = raw[: 8 * n].view(np.uint64), raw[8 * n : 16 * n].view(np.int64)
        at = np.minimum(at, n - 1)
        out[part] = np.where(held[at] == known[part], docs[at], NONE)

    _looked_up(shards, known, 16, found)
    return out[back]


def is_held(shards: Shards, keys: np.ndarray) -> np.ndarray:
    known, back = np.unique(keys, return_inverse=True)
    out = np.zeros(len(known), bool)

    def found(part: slice, at: np.ndarray, raw: np.ndarray, n: int) -> None:
        out[part] = raw[: 8 * n].view(np.uint64)[np.minimum(at, n - 1)] == known[part]

    _looked_up(shards, known, 8, found)
    return out[back]


def smallest_of_window(shards: Shards, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Smallest doc_id of windows told apart by hash and check; NONE where a window is not held."""
    order = np.argsort(keys, kind="stable")
    key, check = keys[order], checks[order]
    out = np.full(len(keys), NONE, np.int64)

    def found(part: slice, at: np.ndarray, raw: np.ndarray, n: int) -> None:
        held, docs, other = raw[: 8 * n].view(np.uint64), raw[8 * n : 16 * n].view(np.int64), raw[16 * n : 20 * n].view(np.uint32)
        got, left = out[part], np.arange(len(at))
        while len(left):  # entries of one hash stand side by side
            left = left[at[left] < n]
            left = left[held[at[left]] == key[part][left]]
            same = other[at[left]] == check[part][left]
            got[left[same]] = docs[at[left[same]]]
            left = left[~same]
            at[left] += 1

    _looked_up(shards, key, 20, found)
    back = np.empty_like(out)
    back[order] = out
    return back


@dataclass(frozen=True)
class Repeats:
    """Windows of the reference around blocks that larger documents hold, by hash."""

    windows: Shards
    size: int

    def covered(self, words: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which words of a run of texts go; ids: doc_id of each row."""
        change = np.zeros(len(words) + 1, np.int64)
        keys = windows(words, self.size)
        at = np.flatnonzero(inside(rows, self.size, len(keys)))
        if len(at):
            doc = ids[np.searchsorted(rows, at, side="right") - 1]
            checks = (windows(words, self.size, 1)[at] >> np.uint64(32)).astype(np.uint32)
            cut = at[smallest_of_window(self.windows, keys[at], checks) < doc]
            np.add.at(change, cut, 1)
            np.add.at(change, cut + self.size, -1)
        return np.cumsum(change[:-1]) > 0


def find_repeats(docs: DataFrame, size: int = WINDOW) -> Repeats:
    """Index the windows of ``size`` words that may stand in two documents; runs three passes over the texts."""
    if not 3 <= size <= _PLACES.shape[1]:
        raise ValueError(f"windows have 3 to {_PLACES.shape[1]} words")
    block = (size + 1) // 2
    spark, n_bytes = docs.sparkSession, text_bytes(docs)
    bits = shard_bits(n_bytes, SHARD_BYTES)
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def passed(step: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple], out: Shards) -> Callable:
        """A task that sends on what ``step(words, rows, ids)`` finds in each run of texts."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            entries = Entries(out)
            for batch in batches:
                ids = batch.column(0).to_numpy()
                for first, end, data, at in slices(batch.column(1)):
                    words, rows = word_hashes(data, at, EXACT)
                    yield from entries.add(*step(words, rows, ids[first:end]))
            yield from entries.rest()

        return tidy(run)

    def blocks(words: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, hashes and rows of the blocks."""
        keys = windows(words, block)
        number = (np.diff(rows)) // block
        row = np.repeat(np.arange(len(number)), number)
        at = (np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)) * block + rows[row]
        return at, keys[at], row

    def reference(words: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple:
        _, keys, row = blocks(words, rows)
        return keys, ids[row]

    def folder(name: str) -> Shards:
        return Shards(new_folder(spark, name), bits)

    index = folder("blocks")
    write_shards(texts.mapInArrow(passed(reference, index), ENTRIES), index.folder, bits, _with_doc)

    def probe(words: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple:
        keys = windows(words, block)
        at = np.flatnonzero(inside(rows, block, len(keys)))
        doc = ids[np.searchsorted(rows, at, side="right") - 1]
        hit = np.unique(keys[at][smallest_doc(index, keys[at]) < doc])
        return hit, np.zeros(len(hit), np.int64)

    hits = folder("hits")
    write_shards(texts.mapInArrow(passed(probe, hits), ENTRIES), hits.folder, bits, _keys_only)

    def extend(words: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple:
        at, keys, row = blocks(words, rows)
        which = is_held(hits, keys)
        at, row = at[which], row[which]
        starts = (at[:, None] - np.arange(size - block + 1)).ravel()
        row = np.repeat(row, size - block + 1)
        fits = (starts >= rows[row]) & (starts + size <= rows[row + 1])
        starts, row = starts[fits], row[fits]
        checks = (windows(words, size, 1)[starts] >> np.uint64(32)).astype(np.uint32)
        return windows(words, size)[starts], ids[row], checks

    around = folder("windows")
    write_shards(texts.mapInArrow(passed(extend, around), ENTRIES), around.folder, bits, _checked)
    return Repeats(around, size)


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
SPANS = "array<struct<first: long, n_words: long>>"


def deduplicate(docs: DataFrame, size: int = WINDOW, with_repeats: bool = False) -> DataFrame:
    """Figures of every row; on request the kept words as text (``kept``) and the maximal repeats (``repeats``)."""
    found = find_repeats(docs, size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = np.where(known, batch.column(0).fill_null(0).to_numpy(), np.iinfo(np.int64).min)
            for first, end, data, at in slices(batch.column(1)):
                hashes, rows = word_hashes(data, at, EXACT)
                gone = found.covered(hashes, rows, ids[first:end])
                kept, spans = [], []
                for a, b, x, y in zip(at[:-1], at[1:], rows[:-1], rows[1:], strict=True):
                    words, cut = data[a:b].tobytes().split(), gone[x:y]
                    kept.append(b" ".join([w for w, g in zip(words, cut, strict=True) if not g] if cut.any() else words))
                    if with_repeats:
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], cut, [False]]).astype(np.int8)))
                        spans.append([{"first": i, "n_words": j - i} for i, j in edges.reshape(-1, 2).tolist()])
                totals = np.concatenate([[0], np.cumsum(gone)])
                out = {
                    "doc_id": batch.column(0).slice(first, end - first), "n_words": pa.array(np.diff(rows), pa.int64()),
                    "n_removed": pa.array(np.diff(totals[rows]), pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
                if with_repeats:
                    out["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
                    out["repeats"] = pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("n_words", pa.int64())])))
                yield pa.RecordBatch.from_pydict(out)

    schema = OUT + (f", kept string, repeats {SPANS}" if with_repeats else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), schema)
