"""Language identification by prediction by partial matching over bytes.

Each language has a context tree of its bytes: in a context of up to three bytes a byte seen there
gets its share, and an escape (as likely as the number of distinct bytes seen there) leads to the
next shorter context without the bytes already ruled out, down to equal shares of what is left of
the 256 bytes. The trees are frozen, so the code length of every byte in every context is exact and
tabulated once per worker; a text's length under a language is the sum over all its bytes.

Trees are learned from ``rows_per_language`` rows of each language on average, chosen by the hash
of doc_id (whole texts; the bound keeps trees small); every text is scored whole.

Null text, or text without a letter: ``und`` with score 0, as with nothing learned. Equal lengths: the
first language by code point. A null doc_id counts as the empty text. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hopscan.llm.kneser_ney import held_out
from hopscan.llm.store import bound_batches, tidy
from hopscan.llm.textbytes import Tally, pack, pack_counts, slices, unpack, unpack_counts

ROWS_PER_LANGUAGE = 500
ORDER = 3
#: Bits that tell a byte or the start of a text apart in a packed context.
WIDTH = 9
START = 256
#: Bytes scored side by side.
SLICE = 1 << 18
UNKNOWN = "und"


def _sequence(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The byte and its ORDER predecessors, nearest first, with START before a row's first byte."""
    begins = at[:-1][at[:-1] < at[1:]]
    out = [data.astype(np.int32)]
    for _ in range(ORDER):
        before = np.empty_like(out[0])
        before[1:] = out[-1][:-1]
        before[begins] = START
        out.append(before)
    return out


@dataclass(frozen=True)
class Trees:
    """Counts of (context, byte) by language: languages, then sorted packed keys and counts of each."""

    languages: tuple[str, ...]
    keys: tuple[bytes, ...]
    counts: tuple[bytes, ...]


def limits(shares: dict[str, float]) -> Column:
    """By language, the largest 64-bit hash that is drawn for a share of its rows, however small."""
    most = {lang: min((1 << 63) - 1, int(Fraction(share) * (1 << 64)) - (1 << 63)) for lang, share in shares.items()}
    return F.create_map(*(x for lang, m in most.items() for x in (F.lit(lang), F.lit(m).cast("long"))))


def fit(train: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Trees:
    """Count the trees; what the driver gets is bounded by the sample."""
    bound_batches(train.sparkSession)
    known = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    shares = {r.lang: min(1.0, rows_per_language / r["count"]) for r in known.groupBy("lang").count().collect()}
    if not shares:
        return Trees((), (), ())
    sample = known.filter(F.xxhash64("doc_id") <= limits(shares)[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for lang in set(langs):
                texts = batch.column(1).filter(pa.array(langs == lang))
                tally = tallies.setdefault(lang, Tally())
                for _, _, data, at in slices(texts, SLICE):
                    key = np.zeros(len(data), np.uint64)
                    for x in reversed(_sequence(data, at)):
                        key = key << np.uint64(WIDTH) | x.astype(np.uint64)
                    tally.add(key)
        for lang, tally in tallies.items():
            k, n = tally.merge()
            yield pa.RecordBatch.from_pydict({"lang": [lang], "keys": [pack(k)], "counts": [pack_counts(n)]})

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        tally = Tally()
        for k, n in zip(pdf["keys"], pdf["counts"], strict=True):
            tally.add(unpack(k), unpack_counts(n))
        k, n = tally.merge()
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "keys": [pack(k)], "counts": [pack_counts(n)]})

    schema = "lang string, keys binary, counts binary"
    rows = (sample.select("lang", "text").mapInArrow(tidy(count), schema).groupBy("lang").applyInPandas(total, schema)
            .orderBy("lang").collect())
    if missed := sorted(set(shares) - {r.lang for r in rows}):
        raise ValueError(f"no row was drawn of {missed}, though there are some")
    rows = [r for r in rows if len(r["keys"])]
    return Trees(*(tuple(bytes(r[c]) if c != "lang" else r[c] for r in rows) for c in ("lang", "keys", "counts")))


@dataclass
class Tables:
    """Code lengths of every byte class in every context, for all languages side by side."""

    classes: np.ndarray
    row_of: np.ndarray
    bits: np.ndarray
    n_classes: int
    n_contexts: int

    def lengths(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of each row's text under each language."""
        out = np.zeros((len(at) - 1, self.bits.shape[1]))
        full = at[:-1] < at[1:]
        if full.any():
            seq = [self.classes[x] for x in _sequence(data, at)]
            place = np.zeros(len(data), np.int64)
            for x in reversed(seq[1:]):
                place = place * self.n_contexts + x
            flat = self.row_of[place].astype(np.int64) * self.n_classes + seq[0]
            out[full] = np.add.reduceat(self.bits[flat], at[:-1][full], axis=0, dtype=np.float64)
        return out


def _dense(contexts: np.ndarray, symbols: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct contexts in order and their counts by symbol."""
    known, row = np.unique(contexts, return_inverse=True)
    table = np.zeros((len(known), size))
    np.add.at(table, (row, symbols), n)
    return known, table


def _lengths(counts: list[np.ndarray], parents: list[np.ndarray], order: int, known: int) -> np.ndarray:
    """Bits of each symbol class in the contexts of one order; the last class is any byte never seen."""
    rows = np.arange(len(counts[order]))
    p = np.zeros_like(counts[order])
    out = np.zeros(p.shape, bool)
    escape = np.ones((len(rows), 1))
    for k in range(order, -1, -1):
        left = np.where(out, 0, counts[k][rows])
        n, distinct = left.sum(axis=1, keepdims=True), (left > 0).sum(axis=1, keepdims=True)
        whole = np.maximum(n + distinct, 1)
        p += escape * left / whole
        escape = np.where(distinct > 0, escape * distinct / whole, escape)
        out |= counts[k][rows] > 0
        rows = parents[k][rows]
    remain = 256 - out.sum(axis=1, keepdims=True)
    return -np.log2(np.where(out, p, escape / np.maximum(remain, 1)))


@lru_cache(maxsize=1)
def tables(trees: Trees) -> Tables:
    """Tabulate frozen trees; size follows the contexts of the sample."""
    grams = [(unpack(k), unpack_counts(n).astype(np.float64)) for k, n in zip(trees.keys, trees.counts, strict=True)]
    mask = np.uint64((1 << WIDTH) - 1)
    parts = [[((k >> np.uint64(WIDTH * i)) & mask).astype(np.int64) for i in range(ORDER + 1)] for k, _ in grams]
    seen = np.unique(np.concatenate([x for p in parts for x in p]))
    seen = seen[seen < START]
    classes = np.full(START + 1, len(seen), np.int64)
    classes[seen] = np.arange(len(seen))
    classes[START] = len(seen) + 1
    size, width = len(seen) + 1, len(seen) + 2
    by_language, contexts = [], [[] for _ in range(ORDER + 1)]
    for p, (_, n) in zip(parts, grams, strict=True):
        symbol, before = classes[p[0]], [classes[x] for x in p[1:]]
        known, counts = [], []
        for k in range(ORDER + 1):
            code = np.zeros(len(n), np.int64)
            for x in reversed(before[:k]):
                code = code * width + x
            c, table = _dense(code, symbol, n, size)
            known.append(c)
            counts.append(table)
            contexts[k].append(c)
        parents = [np.zeros(1, np.int64)] + [
            np.searchsorted(known[k - 1], known[k] % width ** (k - 1)) for k in range(1, ORDER + 1)]
        by_language.append((known, [_lengths(counts, parents, k, len(seen)) for k in range(ORDER + 1)]))
    union = [np.unique(np.concatenate(c)) for c in contexts]
    first = np.cumsum([0, *(len(u) for u in union)])
    bits = np.zeros((first[-1], size, len(grams)), np.float32)
    for i, (known, lengths) in enumerate(by_language):
        for k in range(ORDER + 1):
            for j in range(k, -1, -1):  # a context that this language lacks has the lengths of the next shorter one
                code = union[k] % width**j
                at = np.minimum(np.searchsorted(known[j], code), len(known[j]) - 1)
                hit = known[j][at] == code
                todo = np.ones(len(code), bool) if j == k else missing
                use = todo & hit
                bits[first[k] + np.flatnonzero(use), :, i] = lengths[j][at[use]]
                missing = todo & ~hit
    row_of = np.zeros(width**ORDER, np.int32)
    for k in range(ORDER + 1):
        view = row_of.reshape(-1, width**k)
        view[:, union[k]] = first[k] + np.arange(len(union[k]))
    return Tables(classes, row_of, bits.reshape(-1, len(grams)), size, width)


#: A text that no tree codes shorter than its raw bytes is in none of the languages.
RAW_BITS = 8.0


def _judged(text: pa.Array, letters: np.ndarray, trees: Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language, score and bits per byte of each text of a batch."""
    lang = np.full(len(text), UNKNOWN, dtype=object)
    score, rate = np.zeros(len(text)), np.zeros(len(text))
    if trees.languages:
        names = np.array(trees.languages, dtype=object)
        for first, end, data, at in slices(text, SLICE):
            bits = tables(trees).lengths(data, at)
            best = bits.argmin(axis=1)
            least = bits[np.arange(len(bits)), best]
            lang[first:end] = names[best]
            score[first:end] = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
            rate[first:end] = least / np.maximum(np.diff(at), 1)
    lang[~letters], score[~letters] = UNKNOWN, 0.0
    return lang, score, rate


def _letters() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("__letters")


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """Language, score and bits per byte of every text, beside doc_id and held_out."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, rate = _judged(batch.column(2), batch.column(3).to_numpy(zero_copy_only=False), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(rate)],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "text", _letters())
    return rows.mapInArrow(tidy(run), "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")


def keep_known(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows whose text has letters and is coded shorter than its raw bytes; all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    place = docs.columns.index("text")
    rows = docs.select("*", _letters())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, letters = batch.columns
            lang, _, rate = _judged(columns[place], letters.to_numpy(zero_copy_only=False), shared.value)
            mask = pa.array((lang != UNKNOWN) & (rate < RAW_BITS), pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(mask) for c in columns], batch.schema.names[:-1])

    return rows.mapInArrow(tidy(run), docs.schema)


def identify(docs: DataFrame, parts: int = 5) -> DataFrame:
    """Languages of all documents, learned from those outside the held-out part."""
    out = held_out(F.col("doc_id"), parts)
    trees = fit(docs.filter(~out))
    return predict(docs.select("doc_id", "text", out.alias("held_out")), trees)


def known_language(docs: DataFrame, parts: int = 5) -> DataFrame:
    """The rows in one of the languages of the documents outside the held-out part."""
    return keep_known(docs, fit(docs.filter(~held_out(F.col("doc_id"), parts))))
