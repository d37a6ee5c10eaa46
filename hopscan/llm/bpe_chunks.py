"""Encoding by content-defined chunks: shared chunks are encoded once, joins are repaired.

A rolling hash of the last bytes cuts texts into chunks, so equal passages get equal chunks wherever
they stand. Texts travel once, ordered by their smallest chunk hash, which puts copies and near
copies side by side; hot groups of copies spread over neighbouring range partitions. A task keeps
the encodings of the chunks it has met, up to a memory bound, and encodes each of them once.

Exactness: the pre-tokenizer never joins a non-space character with white space that follows it,
so encoding is independent on both sides of such a place. Of a chunk only the part between its
first and last such place is taken from its encoding; the rests on both sides of a join, as far as
they reach over chunks, are encoded again as one text, which widens until both neighbours agree.

Null texts are empty. Repeated rows give repeated results. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hopscan.llm.encoder import Encoder, encoder, vocabulary_path
from hopscan.llm.store import text_bytes, tidy
from hopscan.llm.suffix_sort import prefix_hashes, rolling_hashes
from hopscan.llm.textbytes import buffers

WINDOW, CHUNK_BITS, LEAST = 32, 10, 256
PART_BYTES = 32 << 20
CACHE_BYTES = 48 << 20
#: ASCII white space after a character that is white space for no library.
_SAFE = re.compile(r"(?<=\S)(?=[ \t\n\r\f\v])")


def chunk_ends(data: np.ndarray) -> list[int]:
    """Chunk ends of one text, as byte positions between characters, the last one included."""
    n = len(data)
    if n <= WINDOW + LEAST:
        return [n] if n else []
    rolled = rolling_hashes(prefix_hashes(data), WINDOW)
    places = np.flatnonzero(rolled >> np.uint64(64 - CHUNK_BITS) == 0) + WINDOW
    ends, last = [], 0
    for p in places.tolist():
        if p - last >= LEAST and p < n and data[p] & 0xC0 != 0x80:
            ends.append(p)
            last = p
    return [*ends, n]


def digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


@dataclass
class Piece:
    """A chunk's encoding: text before the first safe place, ids up to the last one, text after it."""

    head: str
    middle: np.ndarray | None
    tail: str
    size: int


def encode_chunk(chunk: str, enc: Encoder) -> Piece:
    first = _SAFE.search(chunk)
    if first is None:
        return Piece(chunk, None, "", 2 * len(chunk) + 200)
    a, b = first.start(), _last_safe(chunk)
    ids = enc.encode(chunk[a:b]) if b > a else np.zeros(0, np.uint32)
    return Piece(chunk[:a], ids, chunk[b:], 4 * len(ids) + 2 * (a + len(chunk) - b) + 300)


def _last_safe(chunk: str) -> int:
    """The last safe place of a chunk that has one, looked for near its end first."""
    for begin in (max(0, len(chunk) - 64), 0):
        places = [m.start() for m in _SAFE.finditer(chunk, begin)]
        if places:
            break
    return places[-1]


class ChunkEncoder:
    """Encodes texts from remembered chunks."""

    def __init__(self, enc: Encoder, bound: int = CACHE_BYTES) -> None:
        self.enc, self.bound, self.used = enc, bound, 0
        self.known: OrderedDict[bytes, Piece] = OrderedDict()
        self.met = self.reused = 0

    def piece(self, raw: bytes) -> Piece:
        key = digest(raw)
        self.met += 1
        got = self.known.get(key)
        if got is not None:
            self.reused += 1
            self.known.move_to_end(key)
            return got
        got = encode_chunk(raw.decode(), self.enc)
        self.known[key] = got
        self.used += got.size
        while self.used > self.bound and len(self.known) > 1:
            self.used -= self.known.popitem(last=False)[1].size
        return got

    def encode(self, data: np.ndarray) -> np.ndarray:
        """Ids of the whole text."""
        parts, open_text, start = [], [], 0
        for end in chunk_ends(data):
            p = self.piece(data[start:end].tobytes())
            start = end
            open_text.append(p.head)
            if p.middle is not None:
                parts += [self.enc.encode("".join(open_text)), p.middle]
                open_text = [p.tail]
        parts.append(self.enc.encode("".join(open_text)))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def route(docs: DataFrame, n: int) -> DataFrame:
    """Texts ordered by their smallest chunk hash, in n ranges; copies become neighbours."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = buffers(batch.column(1))
            near = []
            for a, b in zip(at[:-1], at[1:], strict=True):
                ends = [0, *chunk_ends(data[a:b])]
                least = min((digest(data[a + x : a + y].tobytes()) for x, y in zip(ends, ends[1:])), default=b"")
                # The other half of the digest: the smallest hash itself falls with a text's length.
                near.append(least[8:])
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "text": batch.column(1), "near": pa.array(near, pa.binary())})

    out = docs.select("doc_id", "text").mapInArrow(tidy(keyed), "doc_id long, text string, near binary")
    # The row number deals equal rows out to several ranges.
    return out.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(n, "near", "doc_id", "row").drop("row").sortWithinPartitions("near", "doc_id")


OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document; on request the ids."""
    path = path or vocabulary_path()
    n = max(1, -(-text_bytes(docs) // PART_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkEncoder(encoder(path))
        for batch in batches:
            data, at = buffers(batch.column(1))
            rows: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
            for a, b in zip(at[:-1], at[1:], strict=True):
                ids = chunks.encode(data[a:b])
                raw = ids.astype("<u4").tobytes()
                text = chunks.enc.decode_bytes(ids).decode("utf-8", "replace")
                rows["n_tokens"].append(len(ids))
                rows["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                rows["decoded_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                rows["ids"].append(raw if with_ids else None)
            out = {"doc_id": batch.column(0), "n_tokens": pa.array(rows["n_tokens"], pa.int64()),
                   "ids_sha256": pa.array(rows["ids_sha256"], pa.string()),
                   "decoded_sha256": pa.array(rows["decoded_sha256"], pa.string())}
            if with_ids:
                out["ids"] = pa.array(rows["ids"], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return route(keys, int(n)).mapInArrow(tidy(run), OUT + (", ids binary" if with_ids else ""))
