"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from mapped arrays.

Counting: each task folds its texts into sorted distinct hashes with counts and sends them, cut by
hash range, to the shards; a shard is one sorted hash array. Words come first; a word's rank over
all shards is its id. A bigram's hash is an invertible mix of its two ids, so bigrams of a frequent
word spread over all shards. Scoring: workers map the arrays from the shared folder and look up the
sorted distinct hashes of some texts at a time. Memory of a task follows its distinct keys.

Null and empty texts are one end token. A null doc_id counts as the empty text in the split.
Repeated rows count as often as they stand. Without training rows every token has probability 1.
Word ids have 32 bits; a larger vocabulary raises an error. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from hopscan.llm.store import Shards, new_folder, shard_bits as _bits, shard_heads, text_bytes, tidy, write_shards
from hopscan.llm.textbytes import Tally, mix, pack, pack_counts, slices, unmix, unpack, unpack_counts, word_hashes

#: Hashes of the end and the start of a text; a word has these with the chance of any collision.
END, START = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543211)
PARTIAL = "shard int, keys binary, counts binary"
WORD_SHARD_BYTES, PAIR_SHARD_BYTES = 64 << 20, 8 << 20


def held_out(doc_id: Column, parts: int) -> Column:
    """True for the rows left out of learning: one in ``parts`` by the CRC of the id."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts == 0


def _cut(keys: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Slices of sorted keys by their upper bits."""
    if not len(keys):
        return
    shard = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(keys)], strict=True):
        yield int(shard[a]), slice(a, b)


def _partials(tally: Tally, bits: int) -> Iterator[pa.RecordBatch]:
    keys, counts = tally.merge()
    for shard, part in _cut(keys, bits):
        yield pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "keys": [pack(keys[part])], "counts": [pack_counts(counts[part])]})


def _summed(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    tally = Tally()
    for k, c in zip(pdf["keys"], pdf["counts"], strict=True):
        tally.add(unpack(k), unpack_counts(c))
    return tally.merge()


def sequences(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous, token) hashes of every token with its row; a row's last token is the end."""
    words, rows = word_hashes(data, at)
    n_rows = len(at) - 1
    ends = rows[1:] + np.arange(n_rows)
    tokens = np.empty(len(words) + n_rows, np.uint64)
    is_end = np.zeros(len(tokens), bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = END, words
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    first = np.concatenate([[0], ends[:-1] + 1])
    before[first] = START
    return before, tokens, np.repeat(np.arange(n_rows), np.diff(rows) + 1)


def _word_file(pdf: pd.DataFrame) -> bytes:
    """A shard of the vocabulary: n, sum of counts, hashes, counts."""
    keys, counts = _summed(pdf)
    return np.concatenate([np.array([len(keys), counts.sum()], np.uint64), keys, counts]).tobytes()


def _pair_file(pdf: pd.DataFrame) -> bytes:
    """A shard of bigrams: sizes and counts of counts, hashes seen once, other hashes, their counts."""
    keys, counts = _summed(pdf)
    many = counts > 1
    head = [int((~many).sum()), int(many.sum()), *(int((counts == i).sum()) for i in (1, 2, 3, 4))]
    return np.array(head, np.uint64).tobytes() + keys[~many].tobytes() + keys[many].tobytes() + counts[many].tobytes()


def _pair_arrays(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n1, n2 = (int(x) for x in raw[:16].view(np.uint64))
    a, b = 48 + 8 * n1, 48 + 8 * (n1 + n2)
    return raw[48:a].view(np.uint64), raw[a:b].view(np.uint64), raw[b : b + 8 * n2].view(np.uint64)


@dataclass
class Vocabulary:
    """Mapped word arrays with the first id of each shard: 8 bytes for 64 MB of text."""

    shards: Shards
    first: np.ndarray

    def arrays(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        raw = self.shards.raw(shard)
        n = int(raw[:8].view(np.uint64)[0])
        return raw[16 : 16 + 8 * n].view(np.uint64), raw[16 + 8 * n : 16 + 16 * n].view(np.uint64)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id (or -1) and count of sorted distinct hashes."""
        ids, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.uint64)
        for shard, part in self.shards.cut(keys):
            words, n = self.arrays(shard)
            if len(words):
                at = np.minimum(np.searchsorted(words, keys[part]), len(words) - 1)
                hit = words[at] == keys[part]
                ids[part] = np.where(hit, at + self.first[shard], -1)
                counts[part] = np.where(hit, n[at], 0)
        return ids, counts

    def shard_of(self, ids: np.ndarray) -> np.ndarray:
        """Shard of each id; empty shards have none."""
        return np.searchsorted(self.first, ids, side="right") - 1


@dataclass
class Model:
    """Folders of a counted model and its totals."""

    words: Vocabulary
    pairs: Shards
    contexts: Shards
    n_tokens: int
    n_types: int
    discounts: tuple[float, float, float]
    low_discounts: tuple[float, float, float]
    n_pairs: int
    low_mass: float


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts, kept within 0 and the count."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    d1, d2 = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), top - 0.05) for d, top in ((d1, 1.0), (d2, 2.0), (d3, 3.0)))


def _by_class(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(c, 3).astype(np.int64)]


def fit(train: DataFrame) -> Model:
    """Count a model over all texts of ``train``; its arrays stay in the shared folder."""
    spark, n_bytes = train.sparkSession, text_bytes(train)
    texts = train.select("text")
    bits, pair_bits = _bits(n_bytes, WORD_SHARD_BYTES), _bits(n_bytes, PAIR_SHARD_BYTES)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, _, data, at in slices(batch.column(0)):
                tally.add(word_hashes(data, at)[0])
            ends = np.array([batch.num_rows], np.uint64)
            if batch.num_rows:
                tally.add(np.array([END]), ends)
                tally.add(np.array([START]), ends)
        yield from _partials(tally, bits)

    shards = write_shards(texts.mapInArrow(tidy(words), PARTIAL), new_folder(spark, "words"), bits, _word_file)
    heads = shard_heads(spark, shards, 2)
    total = int(heads[:, 0].sum())
    if total >= 1 << 32:
        raise ValueError("the vocabulary needs more than 32 bits")
    vocabulary = Vocabulary(shards, np.cumsum(heads[:, 0]) - heads[:, 0])
    n_tokens = int(heads[:, 1].sum())
    known = spark.range(1).mapInPandas(
        lambda batches: (b.assign(n=int(vocabulary.lookup(np.array([START]))[1][0])) for b in batches), "id long, n long")
    starts = int(known.head().n)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for _, _, data, at in slices(batch.column(0)):
                before, tokens, _ = sequences(data, at)
                known, place = np.unique(np.concatenate([before, tokens]), return_inverse=True)
                ids = vocabulary.lookup(known)[0].astype(np.uint64)[place]
                tally.add(mix(ids[: len(tokens)] << np.uint64(32) | ids[len(tokens) :]))
        yield from _partials(tally, pair_bits)

    pair_shards = write_shards(texts.mapInArrow(tidy(pairs), PARTIAL), new_folder(spark, "pairs"), pair_bits, _pair_file)
    heads = shard_heads(spark, pair_shards, 6).sum(axis=0).tolist()
    contexts = _contexts(train, vocabulary, pair_shards)
    low = shard_heads(spark, contexts, 6).sum(axis=0).tolist()
    low_d = discounts(*low[1:5])
    low_mass = sum(d * n for d, n in zip(low_d, (low[1], low[2], low[5]), strict=True))
    return Model(vocabulary, pair_shards, contexts, n_tokens=n_tokens - starts, n_types=total - (starts > 0),
                 discounts=discounts(*heads[2:6]), low_discounts=low_d, n_pairs=low[0], low_mass=low_mass)


def _contexts(train: DataFrame, v: Vocabulary, pairs: Shards) -> Shards:
    """By word id: bigrams it begins by count class, and distinct words before it."""
    spark = train.sparkSession

    def statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column(0).to_pylist():
                once, many, counts = _pair_arrays(pairs.raw(number))
                both = unmix(np.concatenate([once, many]))
                kind = np.concatenate([np.ones(len(once), np.uint64), np.minimum(counts, np.uint64(3))])
                # A key is id * 4 + what is counted: 0 words before it, 1-3 bigrams it begins, by class.
                tally = Tally()
                tally.add((both >> np.uint64(32)) << np.uint64(2) | kind)
                tally.add((both & np.uint64(0xFFFFFFFF)) << np.uint64(2))
                keys, n = tally.merge()
                place = v.shard_of((keys >> np.uint64(2)).astype(np.int64))
                edges = np.flatnonzero(np.diff(place, prepend=-1))
                for a, b in zip(edges, [*edges[1:], len(keys)], strict=True) if len(keys) else ():
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array([place[a]], pa.int32()), "keys": [pack(keys[a:b])], "counts": [pack_counts(n[a:b])],
                        "n_words": pa.array([len(v.arrays(int(place[a]))[0])], pa.int64()),
                        "first": pa.array([int(v.first[place[a]])], pa.int64())})

    def context_file(pdf: pd.DataFrame) -> bytes:
        keys, n = _summed(pdf)
        table = np.zeros((4, int(pdf["n_words"].max()) if len(pdf) else 0), np.uint32)
        if len(pdf):
            table[(keys & np.uint64(3)).astype(np.int64), (keys >> np.uint64(2)).astype(np.int64) - int(pdf["first"].iloc[0])] = n
        before = table[0]
        head = [int(before.sum()), *(int((before == i).sum()) for i in (1, 2, 3, 4)), int((before > 2).sum())]
        return np.array(head, np.uint64).tobytes() + table.tobytes()

    numbers = spark.range(0, 1 << pairs.bits, 1, 1 << min(pairs.bits, 12))
    return write_shards(numbers.mapInArrow(tidy(statistics), f"{PARTIAL}, n_words long, first long"),
                        new_folder(spark, "contexts"), v.shards.bits, context_file)


class Scorer:
    """Lookups of one worker in the mapped model."""

    def __init__(self, model: Model) -> None:
        self.m = model

    def context(self, ids: np.ndarray) -> np.ndarray:
        """The four context counts of sorted word ids; zeros for unknown words."""
        out = np.zeros((4, len(ids)), np.float64)
        known = np.flatnonzero(ids >= 0)
        place = self.m.words.shard_of(ids[known])
        for shard in np.unique(place):
            raw = self.m.contexts.raw(int(shard))
            n = (len(raw) - 48) // 16
            table = raw[48 : 48 + 16 * n].view(np.uint32).reshape(4, n)
            rows = known[place == shard]
            if n:
                out[:, rows] = table[:, ids[rows] - self.m.words.first[shard]]
        return out

    def pair_counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct bigram hashes."""
        out = np.zeros(len(keys), np.float64)
        for shard, part in self.m.pairs.cut(keys):
            once, many, counts = _pair_arrays(self.m.pairs.raw(shard))
            for hashes, value in ((once, None), (many, counts)):
                if len(hashes):
                    at = np.minimum(np.searchsorted(hashes, keys[part]), len(hashes) - 1)
                    hit = hashes[at] == keys[part]
                    out[part][hit] = 1 if value is None else value[at[hit]]
        return out

    def rows(self, data: np.ndarray, at: np.ndarray) -> dict[str, np.ndarray]:
        """Figures of each text of a run of whole texts."""
        m = self.m
        before, tokens, row = sequences(data, at)
        known, place = np.unique(np.concatenate([before, tokens]), return_inverse=True)
        ids, counts = m.words.lookup(known)
        stats = self.context(ids)
        n, v, w = len(tokens), place[: len(tokens)], place[len(tokens) :]
        counts = counts.astype(np.float64)
        low = np.maximum(stats[0] - _by_class(stats[0], m.low_discounts), 0)
        low = (low + m.low_mass / (m.n_types + 1)) / m.n_pairs if m.n_pairs else np.full(len(known), 1 / (m.n_types + 1))
        both = (ids[v] >= 0) & (ids[w] >= 0)
        keys = mix(ids[v].astype(np.uint64) << np.uint64(32) | ids[w].astype(np.uint64))
        c = np.zeros(n)
        if both.any():
            distinct, back = np.unique(keys[both], return_inverse=True)
            c[both] = self.pair_counts(distinct)[back]
        mass = sum(d * stats[i + 1] for i, d in enumerate(m.discounts))
        seen = stats[1:].sum(axis=0) > 0
        total = np.where(seen, counts, 1.0)
        back_off = np.where(seen, mass / total, 1.0)
        p = np.maximum(c - _by_class(c, m.discounts), 0) / total[v] + back_off[v] * low[w]
        base = np.log10((counts[w] + 0.1) / (m.n_tokens + 0.1 * (m.n_types + 1)))
        n_rows = len(at) - 1
        return {
            "n_tokens": np.bincount(row, minlength=n_rows),
            "n_known": np.bincount(row, weights=counts[w] > 0, minlength=n_rows).astype(np.int64),
            "base_score": np.bincount(row, weights=base, minlength=n_rows),
            "score": np.bincount(row, weights=np.log10(p), minlength=n_rows),
        }


SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(docs: DataFrame, model: Model, keys: str) -> DataFrame:
    """Score every text. ``keys``: the other columns of ``docs`` to carry, as a schema string."""
    names = [k.split()[0] for k in keys.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            for first, end, data, at in slices(text):
                got = scorer.rows(data, at)
                out = {k: batch.column(batch.schema.get_field_index(k)).slice(first, end - first) for k in names}
                out |= {"n_tokens": pa.array(got["n_tokens"], pa.int64()), "n_known": pa.array(got["n_known"], pa.int64()),
                        "train_tokens": pa.array(np.full(end - first, model.n_tokens), pa.int64()),
                        "base_score": pa.array(got["base_score"]), "score": pa.array(got["score"]),
                        "perplexity": pa.array(10 ** (-got["score"] / got["n_tokens"]))}
                yield pa.RecordBatch.from_pydict(out)

    return docs.select(*names, "text").mapInArrow(tidy(run), f"{keys}, {SCORES}")


def language_model_scores(docs: DataFrame, parts: int = 10) -> DataFrame:
    """Scores of all documents by a model of those outside the held-out part."""
    model = fit(docs.filter(~held_out(F.col("doc_id"), parts)))
    tagged = docs.select("doc_id", held_out(F.col("doc_id"), parts).alias("held_out"), "text")
    return score(tagged, model, "doc_id long, held_out boolean")
