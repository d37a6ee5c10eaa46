"""Grouping of spelling variants: words one edit apart, found through reduced alphabets.

Vocabulary: each task counts the words of its texts and sends distinct words with their counts.

Near words: letters are hashed to a few symbols, so words one edit apart have reduced words at most
one edit apart. Every word gets the full one-edit neighbourhood of its reduced word (itself and all
deletions, replacements and insertions of a symbol) as hashes; those that are reduced words of the
vocabulary, looked up in sorted arrays of the shared folder, are joined with the words that reduce
to them, and each such pair is verified on the original strings.

Where more than CROWD words share a reduced word, they wait for the next larger alphabet (8, 32,
then 128 symbols, which tell all letters apart), and with them the words that have such a reduced word in
their neighbourhood. A word is settled as a partner once, in the first alphabet where its reduced word
is not crowded; in the last one every word has a reduced word of its own. So no group of words is
paired with itself and no link is lost, whatever the letters.

Then each word takes its most frequent near word as its form, if that is FACTOR times as frequent,
and forms are followed by doubling. Frequencies grow along the way, so there are no cycles.

Null texts have no words. Null ids count as the empty text where ids matter. Further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopscan.llm.store import Shards, bound_batches, checkpointed, new_folder, shard_bits, tidy, write_shards
from hopscan.llm.textbytes import mix, pack, unpack

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT, FACTOR = 7, 2, 10
ALPHABETS, CROWD = (8, 32, 128), 64
#: Words that a task counts before it sends them on.
HELD = 500_000
SHARD_WORDS = 1 << 20
_RNG = np.random.default_rng(4711)
_SYMBOLS = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)

#: Changes a word before it counts: gets doc_id and the lower-cased word.
Change = Callable[[str, str], str]


def planted(doc_id: str, word: str) -> str:
    """Where 31 divides the CRC of ``doc_id:word``, the code point at its remainder by the length goes."""
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def vocabulary(docs: DataFrame, change: Change | None = None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least some code points that occur often enough; only A-Z are lower-cased."""
    bound_batches(docs.sparkSession)
    # A change may shorten words, so shorter ones never reach the length; longer ones are looked at again after it.
    pattern = re.compile(f"[{LETTERS}]{{{least_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = Counter(pattern.findall(text.encode().lower().decode()))  # bytes lower-case A-Z only
                for word, n in words.items():
                    word = word if change is None else change(doc, word)
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    texts = docs.filter("text IS NOT NULL").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), "text")
    counted = texts.mapInArrow(tidy(count), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def symbols(codes: np.ndarray, size: int) -> np.ndarray:
    """Symbol of each letter in an alphabet: a hash, or the letter itself where there are enough symbols."""
    if size >= 128:
        return np.where(codes >= 0xC0, codes - 0xC0 + 32, codes & 31).astype(np.int64)
    return (mix(codes.astype(np.uint64)) >> np.uint64(40)).astype(np.int64) % size


def reduced(words: list[str], size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: places of the words, and their symbols as rows."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    return {n: (np.array(at), symbols(np.frombuffer("".join(words[i] for i in at).encode("utf-32-le"), np.uint32), size).reshape(-1, n))
            for n, at in by_length.items()}


def key_of(rows: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols."""
    out = np.zeros(len(rows), np.uint64)
    for i in range(rows.shape[1]):
        out = out * _BASE + _SYMBOLS[rows[:, i]]
    return mix(out ^ np.uint64(rows.shape[1]))


def neighbourhood(rows: np.ndarray, size: int) -> np.ndarray:
    """Hashes of a reduced word of each row and of all words one edit from it; a row may hold a hash twice."""
    count, n = rows.shape
    value = _SYMBOLS[rows]
    head, tail = np.zeros((count, n + 1), np.uint64), np.zeros((count, n + 1), np.uint64)
    power = _BASE ** np.arange(n + 2, dtype=np.uint64)
    for i in range(n):
        head[:, i + 1] = head[:, i] * _BASE + value[:, i]
        tail[:, n - 1 - i] = value[:, n - 1 - i] * power[i] + tail[:, n - i]
    letters = _SYMBOLS[:size]
    one = np.uint64(1)
    out = [mix(head[:, n:] ^ np.uint64(n))]
    for i in range(n):
        out.append(mix((head[:, i] * power[n - 1 - i] + tail[:, i + 1])[:, None] ^ np.uint64(n - one)))
        out.append(mix(((head[:, i] * _BASE)[:, None] + letters) * power[n - 1 - i] + tail[:, i + 1, None] ^ np.uint64(n)))
    for i in range(n + 1):
        out.append(mix(((head[:, i] * _BASE)[:, None] + letters) * power[n - i] + tail[:, i, None] ^ np.uint64(n + one)))
    return np.concatenate(out, axis=1)


def _keyed(words: DataFrame, size: int) -> DataFrame:
    """``words`` with the hash of their reduced word as ``key``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            keys = np.zeros(len(texts), np.uint64)
            for at, rows in reduced(texts, size).values():
                keys[at] = key_of(rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys.view(np.int64))], ["word", "n", "key"])

    return words.select("word", "n").mapInArrow(tidy(run), "word string, n long, key long")


def _key_arrays(keys: DataFrame, bits: int) -> Shards:
    """Sorted arrays of the distinct keys of (key, crowded), crowded ones marked."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, crowded = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy(zero_copy_only=False)
            order = np.argsort(key)
            key, crowded = key[order], crowded[order]
            for shard, p in Shards("", bits).cut(key):
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([shard], pa.int32()), "keys": [pack(key[p])], "crowded": [crowded[p].astype(np.uint8).tobytes()]})

    def join(pdf: pd.DataFrame) -> bytes:
        key = np.concatenate([np.zeros(0, np.uint64), *(unpack(k) for k in pdf["keys"])])
        crowded = np.concatenate([np.zeros(0, np.uint8), *(np.frombuffer(c, np.uint8) for c in pdf["crowded"])])
        order = np.argsort(key)
        return key[order].tobytes() + crowded[order].tobytes()

    partials = keys.select("key", "crowded").mapInArrow(tidy(fold), "shard int, keys binary, crowded binary")
    return write_shards(partials, new_folder(keys.sparkSession, "reduced"), bits, join)


def _probed(words: DataFrame, arrays: Shards, size: int) -> DataFrame:
    """(word, n, keys, crowded): the keys of the arrays in each word's neighbourhood, and whether a crowded one is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, (1 << 19) // (40 * size))
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                texts = part.column(0).to_pylist()
                found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
                crowded = np.zeros(len(texts), bool)
                for at, rows in reduced(texts, size).values():
                    near = neighbourhood(rows, size)
                    owner = np.repeat(at, near.shape[1])
                    keys = near.ravel()
                    order = np.argsort(keys)
                    keys, owner = keys[order], owner[order]
                    hits, owners = [], []
                    for shard, p in arrays.cut(keys):
                        raw = arrays.raw(shard)
                        n = len(raw) // 9
                        if n:
                            held = raw[: 8 * n].view(np.uint64)
                            place = np.minimum(np.searchsorted(held, keys[p]), n - 1)
                            hit = held[place] == keys[p]
                            full = raw[8 * n :][place] > 0
                            crowded[owner[p][hit & full]] = True
                            hits.append(keys[p][hit & ~full])
                            owners.append(owner[p][hit & ~full])
                    if any(map(len, hits)):
                        hit, own = np.concatenate(hits), np.concatenate(owners)
                        order = np.lexsort((hit, own))
                        hit, own = hit[order], own[order]
                        new = np.ones(len(own), bool)
                        new[1:] = (own[1:] != own[:-1]) | (hit[1:] != hit[:-1])
                        hit, own = hit[new], own[new]
                        edges = np.flatnonzero(np.diff(own, prepend=-1))
                        for a, b in zip(edges, [*edges[1:], len(own)], strict=True):
                            found[own[a]] = hit[a:b].view(np.int64)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1),
                    pa.ListArray.from_arrays(np.cumsum([0, *(len(x) for x in found)]).astype(np.int32), np.concatenate(found)),
                    pa.array(crowded)], ["word", "n", "keys", "crowded"])

    return words.select("word", "n").mapInArrow(tidy(run), "word string, n long, keys array<long>, crowded boolean")


def near_words(words: DataFrame, alphabets: tuple[int, ...] = ALPHABETS, crowd: int = CROWD) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of (word, n) that one edit separates; words are distinct, of the letters above, A-Z lower-cased."""
    if alphabets[-1] < 128:
        raise ValueError("the last alphabet tells all letters apart with 128 symbols")
    asked = partners = words
    links = None
    for size in alphabets:
        last = size == alphabets[-1]
        keyed = checkpointed(_keyed(partners, size))
        crowds = keyed.groupBy("key").agg(F.count("*").alias("k"))
        crowds = checkpointed(crowds.select("key", (F.lit(not last) & (F.col("k") > crowd)).alias("crowded")))
        if crowds.isEmpty():
            break
        arrays = _key_arrays(crowds, shard_bits(crowds.count(), SHARD_WORDS))
        probed = checkpointed(_probed(asked, arrays, size))
        full = crowds.filter("crowded").select("key")
        settled = keyed.join(full, "key", "left_anti").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
        pairs = probed.select("word", "n", F.explode("keys").alias("key")).join(settled, "key")
        pairs = pairs.filter((F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)).select("word", "n", "near", "near_n")
        links = pairs if links is None else links.unionByName(pairs)
        if full.isEmpty():
            break
        partners = checkpointed(keyed.join(full, "key", "left_semi").select("word", "n"))
        asked = probed.filter("crowded").select("word", "n")
    if links is None:
        links = words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    return links


def variants(words: DataFrame, factor: int = FACTOR, alphabets: tuple[int, ...] = ALPHABETS, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n)."""
    words = checkpointed(words.select("word", "n"))
    links = near_words(words, alphabets, crowd)
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    best = checkpointed(best.select("word", "n_near", F.col("b.near").alias("near"), (-F.col("b.m")).alias("near_n")))
    joined = words.join(best, "word", "left")
    is_form = F.col("near_n") >= factor * F.col("n")
    table = checkpointed(joined.select(
        "word", F.when(is_form, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near_n")).alias("form_n")))
    # Each round goes twice as far along the forms; a way has at most log(n) / log(factor) steps.
    ways = checkpointed(table.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = checkpointed(ways.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        ways = step.select("word", "root")
        if step.filter("moved").isEmpty():
            break
    return table.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
