"""Removal of byte strings that stand in a document with a smaller id, by suffix sorting.

A byte goes if a string of LENGTH bytes over it also starts in a document of smaller doc_id. Every
such string holds an anchor: of its substrings of KMER bytes the one with the smallest hash, the
leftmost of equals; the strings of one anchor are neighbours and form its context.

1. Tasks fold their anchors into sorted hashes; anchors of two documents or more are kept.
2. Contexts of these anchors go to shards by anchor, once per task and distinct context. A shard
   takes the smallest doc_id of each context. Where an anchor has several contexts, the suffixes
   at all their strings' starts are sorted (hash-compared mergesort, equal neighbours verified byte by byte) and each
   run of equal strings takes its smallest doc_id.
3. Tasks read their texts again, look contexts and strings up in the mapped arrays and cut.

Anchors of more than HOT occurrences are dealt string by string instead, by the string's hash, so no
group of a frequent anchor meets in one task. Text never moves; what is shuffled are hashes, and
contexts of shared anchors. Context and string keys are 64-bit hashes.

Null texts are empty. A null doc_id is neither smaller nor larger than another: such rows stay whole
and remove nothing. Rows with one doc_id do not cut each other. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from hopscan.llm.kneser_ney import PARTIAL, _bits, _cut, _partials, _summed
from hopscan.llm.store import Shards, new_folder, text_bytes, tidy, write_shards
from hopscan.llm.suffix_sort import Suffixes, prefix_hashes, rolling_hashes, substring_hashes, window_hashes
from hopscan.llm.textbytes import Tally, mix, pack, slices, unpack

LENGTH, KMER = 50, 32
WINDOW = LENGTH - KMER + 1
#: Bytes of the longest context; shorter ones are padded.
WIDTH = LENGTH + WINDOW - 1
HOT = 200_000
SHARD_BYTES = 8 << 20
FLUSH = 16 << 20
SLICE = 1 << 19
_LOW, _SALT = np.uint64(0xFFFFFFFF), np.uint64(0xA5A5A5A55A5A5A5A)


@dataclass
class Anchors:
    """Anchors of a run of texts: k-mer hash, row, first and last string start, and hash of the context."""

    sums: np.ndarray
    kmer: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    context: np.ndarray


def anchors(data: np.ndarray, at: np.ndarray) -> Anchors | None:
    n = len(data)
    if n < LENGTH:
        return None
    sums = prefix_hashes(data)
    kmers = rolling_hashes(sums, KMER)
    least = kmers & ~_LOW
    least |= np.arange(len(kmers), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOW:
        least = np.minimum(least[: len(least) - (WINDOW - width)], least[WINDOW - width :])
    valid = np.ones(len(least), bool)
    for end in at[1:-1]:
        valid[max(0, end - LENGTH + 1) : end] = False
    starts = np.flatnonzero(valid)
    if not len(starts):
        return None
    place = (least[starts] & _LOW).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    begin = np.flatnonzero(new)
    first, last = starts[begin], starts[np.append(begin[1:], len(starts)) - 1]
    anchor = place[begin]
    size = last - first + LENGTH
    shape = ((size << 8) | (anchor - first)).astype(np.uint64)
    context = mix(substring_hashes(sums, first, size) ^ mix(shape))
    # Mixed again: smallest hashes would all fall into the first shards.
    return Anchors(sums, mix(kmers[anchor] ^ _SALT), np.searchsorted(at, first, side="right") - 1, first, last, context)


@dataclass
class Lookup:
    """Sorted keys with a value each, mapped by shard."""

    shards: Shards
    bits: int
    kind: np.dtype
    #: Kinds of entries in the folder, and which of them this is.
    kinds: int = 1
    which: int = 0

    def __call__(self, keys: np.ndarray, absent: int) -> np.ndarray:
        """Values of sorted distinct keys."""
        out = np.full(len(keys), absent, np.int64)
        for shard, part in _cut(keys, self.bits):
            raw = self.shards.raw(shard * self.kinds + self.which)
            n = len(raw) // (8 + self.kind.itemsize)
            if n:
                known, value = raw[: 8 * n].view(np.uint64), raw[8 * n : (8 + self.kind.itemsize) * n].view(self.kind)
                place = np.minimum(np.searchsorted(known, keys[part]), n - 1)
                out[part] = np.where(known[place] == keys[part], value[place], absent)
        return out

    def of(self, keys: np.ndarray, absent: int) -> np.ndarray:
        """Values of any keys."""
        known, back = np.unique(keys, return_inverse=True)
        return self(known, absent)[back]


def _gather(data: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rows of WIDTH bytes: the spans of some sizes, padded with zeros."""
    out, span = np.zeros((len(first), WIDTH), np.uint8), np.arange(WIDTH)
    for i in range(0, len(first), 1 << 14):
        at = np.minimum(first[i : i + (1 << 14), None] + span, len(data) - 1)
        out[i : i + (1 << 14)] = np.where(span < size[i : i + (1 << 14), None], data[at], 0)
    return out


def shared_anchors(texts: DataFrame, bits: int) -> Lookup:
    """Anchors that stand in two documents or more, with their number of documents (2 per run of texts at most)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, _, data, at in slices(batch.column(1), SLICE):
                found = anchors(data, at)
                if found is None:
                    continue
                order = np.lexsort((found.row, found.kmer))
                key, row = found.kmer[order], found.row[order]
                begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                ends = np.append(begin[1:], len(key)) - 1
                tally.add(key[begin], np.where(row[ends] != row[begin], 2, 1))
        yield from _partials(tally, bits)

    def keep(pdf: pd.DataFrame) -> bytes:
        keys, n = _summed(pdf)
        some = n > 1
        return keys[some].tobytes() + np.minimum(n[some], 1 << 31).astype(np.uint32).tobytes()

    shards = write_shards(texts.mapInArrow(tidy(count), PARTIAL), new_folder(texts.sparkSession, "anchors"), bits, keep)
    return Lookup(shards, bits, np.dtype(np.uint32))


CONTEXTS = "shard int, anchor binary, context binary, doc binary, n binary, size binary, bytes binary"


def _distinct(rows: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows (anchor, context, doc, n, size, bytes) with one row per context: smallest doc, all occurrences."""
    anchor, context, doc, n, size, data = (np.concatenate([r[i] for r in rows]) for i in range(6))
    order = np.lexsort((doc, context, anchor))
    a, c = anchor[order], context[order]
    first = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (c[1:] != c[:-1])]))
    one = order[first]
    return anchor[one], context[one], doc[one], np.add.reduceat(n[order], first), size[one], data[one]


def _strings(found: Anchors, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all strings of some anchors, and the anchor's place for each."""
    count = found.last[which] - found.first[which] + 1
    owner = np.repeat(which, count)
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + found.first[owner], owner


def _contexts(texts: DataFrame, shared: Lookup, bits: int, most: int) -> DataFrame:
    """Contexts of shared anchors, once per task; strings of anchors of more than ``most`` occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[np.ndarray, ...]] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            if not sum(len(r[0]) for r in rows):
                return
            anchor, context, doc, n, size, data = _distinct(rows)
            for shard, p in _cut(anchor, bits):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "anchor": [pack(anchor[p])], "context": [context[p].tobytes()],
                    "doc": [doc[p].tobytes()], "n": [n[p].tobytes()], "size": [size[p].astype(np.uint16).tobytes()],
                    "bytes": [zstandard.compress(data[p].tobytes(), 3)]})

        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, _, data, at in slices(batch.column(1), SLICE):
                found = anchors(data, at)
                if found is None:
                    continue
                n = shared.of(found.kmer, 0)
                doc = ids[first + found.row]
                which = np.flatnonzero((n > 0) & (n <= most))
                size = found.last[which] - found.first[which] + LENGTH
                new = [(found.kmer[which], found.context[which], doc[which], np.ones(len(which), np.int64), size,
                        _gather(data, found.first[which], size))]
                hot = np.flatnonzero(n > most)
                if len(hot):
                    at_, owner = _strings(found, hot)
                    key = window_hashes(found.sums, at_, LENGTH)
                    size = np.full(len(at_), LENGTH)
                    new.append((key, key, doc[owner], np.ones(len(at_), np.int64), size, _gather(data, at_, size)))
                rows += new
                held += sum((WIDTH + 40) * len(r[0]) for r in new)
                if held > FLUSH:
                    yield from out()
                    rows, held = [], 0
        yield from out()

    return texts.mapInArrow(tidy(run), CONTEXTS)


#: What an entry of the final arrays is keyed by.
OF_CONTEXT, OF_STRING, MIXED = 0, 1, 2


def _resolved(pdf: pd.DataFrame, bits: int) -> pd.DataFrame:
    """Smallest doc_id of contexts and strings of one anchor shard, dealt by key."""
    anchor, context, doc, n, size, data = _distinct([
        (unpack(r.anchor), np.frombuffer(r.context, np.uint64), np.frombuffer(r.doc, np.int64), np.frombuffer(r.n, np.int64),
         np.frombuffer(r.size, np.uint16).astype(np.int64), np.frombuffer(zstandard.decompress(r.bytes), np.uint8).reshape(-1, WIDTH))
        for r in pdf.itertuples()])
    many = n > 1
    out = [(OF_CONTEXT, context[many], doc[many])]
    begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(anchor))))
    several = np.bincount(group)[group] > 1
    if several.any():
        count = size[several] - LENGTH + 1
        owner = np.repeat(np.flatnonzero(several), count)
        begins = np.repeat(np.arange(several.sum()) * WIDTH, count)
        starts = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begins
        suffixes = Suffixes(data[several].ravel(), LENGTH)
        # A string whose hash stands alone equals no other: only the others are sorted.
        _, back, times = np.unique(window_hashes(suffixes.sums, starts, LENGTH), return_inverse=True, return_counts=True)
        again = times[back] > 1
        starts, owner = starts[again], owner[again]
        order, run = suffixes.runs(starts, group[owner])
        docs = doc[owner[order]]
        first = np.flatnonzero(np.diff(run, prepend=-1))
        least = np.minimum.reduceat(docs, first)
        shared = np.diff(np.append(first, len(run))) > 1
        keys = window_hashes(suffixes.sums, starts[order[first[shared]]], LENGTH)
        out.append((OF_STRING, keys, least[shared]))
        mixed = np.unique(anchor[owner[order[first[shared]]]])
        out.append((MIXED, mixed, np.zeros(len(mixed), np.int64)))
    rows = []
    for kind, keys, docs in out:
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        for shard, p in _cut(keys, bits):
            rows.append((shard * 4 + kind, keys[p].tobytes(), docs[p].tobytes()))
    return pd.DataFrame(rows, columns=["shard", "keys", "docs"])


def _entries(pdf: pd.DataFrame) -> bytes:
    if not len(pdf):
        return b""
    keys = np.concatenate([np.frombuffer(k, np.uint64) for k in pdf["keys"]])
    docs = np.concatenate([np.frombuffer(d, np.int64) for d in pdf["docs"]])
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys[first].tobytes() + docs[first].tobytes()


@dataclass
class Index:
    """Mapped arrays that say where the smallest document of a string is."""

    shared: Lookup
    contexts: Lookup
    strings: Lookup
    mixed: Lookup
    hot: int

    def removed(self, data: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which bytes of a run of texts go; ids: doc_id of each row."""
        change = np.zeros(len(data) + 1, np.int64)
        found = anchors(data, at)
        if found is not None:
            none = np.iinfo(np.int64).max
            n = self.shared.of(found.kmer, 0)
            doc = ids[found.row]
            cold = np.flatnonzero((n > 0) & (n <= self.hot))
            before = self.contexts.of(found.context[cold], none) < doc[cold]
            whole = cold[before]
            np.add.at(change, found.first[whole], 1)
            np.add.at(change, found.last[whole] + LENGTH, -1)
            rest = cold[~before]
            rest = rest[self.mixed.of(found.kmer[rest], -1) >= 0]
            for which, table in ((rest, self.strings), (np.flatnonzero(n > self.hot), self.contexts)):
                starts, owner = _strings(found, which)
                cut = starts[table.of(window_hashes(found.sums, starts, LENGTH), none) < doc[owner]]
                np.add.at(change, cut, 1)
                np.add.at(change, cut + LENGTH, -1)
        return np.cumsum(change[:-1]) > 0


def build(docs: DataFrame, hot: int = HOT) -> Index:
    """Index of all strings that stand in two documents or more."""
    spark, n = docs.sparkSession, text_bytes(docs)
    bits = _bits(n, SHARD_BYTES)
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = shared_anchors(texts, bits)
    partial = _contexts(texts, shared, bits, hot).groupBy("shard").applyInPandas(
        lambda pdf: _resolved(pdf, bits), "shard int, keys binary, docs binary")
    shards = write_shards(partial, new_folder(spark, "strings"), bits + 2, _entries)
    of = lambda kind: Lookup(shards, bits, np.dtype(np.int64), 4, kind)
    return Index(shared, of(OF_CONTEXT), of(OF_STRING), of(MIXED), hot)


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def deduplicate(docs: DataFrame, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """Figures of every row and, on request, the bytes that stay."""
    index = build(docs, hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            ids = np.where(known, batch.column(0).fill_null(0).to_numpy(), np.iinfo(np.int64).min)
            for first, end, data, at in slices(batch.column(1), SLICE):
                gone = index.removed(data, at, ids[first:end])
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = at[:-1][at[:-1] < at[1:]]
                begins[inner] |= gone[inner]
                totals = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(begins)])
                kept = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                out = {
                    "doc_id": batch.column(0).slice(first, end - first), "n_bytes": pa.array(np.diff(at), pa.int64()),
                    "n_removed": pa.array(np.diff(totals[0][at]), pa.int64()), "n_spans": pa.array(np.diff(totals[1][at]), pa.int64()),
                    "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
                if with_text:
                    out["kept"] = pa.array(kept, pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), OUT + (", kept binary" if with_text else ""))
