"""Token files in document order and a minimal perfect hash index over them.

A shard file holds records in ascending (doc_id, hash of text) order, null ids first. A record is
a 16-byte head (doc_id, number of ids, flags) and the raw ids as little-endian integers of the width
the vocabulary needs; the end id closes it. Spark's text sink writes the records as they are with
the end id as its separator, so a lost executor costs its tasks only and no driver sees an id.

The index maps (doc_id, copy number) to (shard, offset, count): keys are dealt to buckets of bounded
size by hash; in a bucket, levels of bit arrays give each key a rank of its own (a key settles at
the first level where no other key shares its place), and arrays in rank order store fingerprint,
shard, offset and count. A lookup reads one bit per level, compares the fingerprint and opens the
mapped file at the offset. Absent keys are refused but for a chance of 2**-32.

Null texts hold the end id only. Repeated ids are numbered in file order. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hopscan.llm.encoder import encoder, vocabulary_path
from hopscan.llm.store import checkpointed, mapped, new_folder, text_bytes, tidy
from hopscan.llm.textbytes import mix

SHARD_TEXT_BYTES = 32 << 20
BUCKET_KEYS = 50_000
HEAD = np.dtype([("doc_id", "<i8"), ("n", "<u4"), ("flags", "<u4")])
LEVELS, ROOM = 40, 1.5


def _width(size: int) -> np.dtype:
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int = 2) -> np.dtype:
    """Encode and write all documents in order; returns the width of an id."""
    n = max(1, -(-int(text_bytes(docs)) // SHARD_TEXT_BYTES))
    width = _width(max(encoder(path).size, end_id + 1))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = enc.encode(text.as_py() or "")
                head = np.array([(doc_id or 0, len(ids), doc_id is None)], HEAD)
                out.append(head.tobytes() + ids.astype(width).tobytes())
            yield pa.RecordBatch.from_pydict({"record": pa.array(out, pa.binary())})

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    # The row number deals equal rows out to several files.
    keyed = keyed.withColumn("row", F.monotonically_increasing_id())
    (keyed.repartitionByRange(n, "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie", "row")
     .select("doc_id", "text").mapInArrow(tidy(records), "record binary")
     .select(F.col("record").cast("string").alias("value"))
     .write.option("lineSep", np.array([end_id], width).tobytes().decode("latin-1")).text(folder))
    return width


def _parsed(raw: np.ndarray, width: np.dtype) -> pd.DataFrame:
    """Heads of one file in order: id, whether null, copy number here, offset of the ids, count, start."""
    at, rows, start = 0, [], 0
    while at < len(raw):
        head = raw[at : at + HEAD.itemsize].view(HEAD)[0]
        n = int(head["n"]) + 1
        rows.append((int(head["doc_id"]), bool(head["flags"]), at + HEAD.itemsize, n, start))
        at += HEAD.itemsize + n * width.itemsize
        start += n
    pdf = pd.DataFrame(rows, columns=["doc_id", "missing", "offset", "n", "start"])
    pdf["copy"] = pdf.groupby(["doc_id", "missing"]).cumcount()
    return pdf


def shard_paths(spark: SparkSession, folder: str) -> list[str]:
    """Shard files in document order; one short row each."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return sorted(r.path for r in files.filter("length > 0").select("path").collect())


def key_hash(doc_id: np.ndarray, missing: np.ndarray, copy: np.ndarray) -> np.ndarray:
    """64-bit hash of (doc_id, copy); different keys differ, as every step is a bijection of the id."""
    salt = mix(copy.astype(np.uint64) * np.uint64(2) + missing.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    return mix(mix(doc_id.astype(np.int64).view(np.uint64)) ^ salt)


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(size)).astype(np.int64)


def build_levels(hashes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Bit arrays of a minimal perfect hash of distinct hashes, and each key's rank."""
    left, levels, found = np.arange(len(hashes)), [], np.zeros(len(hashes), np.int64)
    base = 0
    while len(left):
        if len(levels) == LEVELS:
            raise ValueError("keys of an index bucket are not distinct")
        size = max(8, int(ROOM * len(left)))
        place = _places(hashes[left], len(levels), size)
        bits = np.bincount(place, minlength=size) == 1
        settled = bits[place]
        found[left[settled]] = base + (np.cumsum(bits) - 1)[place[settled]]
        base += int(bits.sum())
        levels.append(bits)
        left = left[~settled]
    return levels, found


def ranks(hashes: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Rank of each key, -1 where no level has it."""
    out, base, left = np.full(len(hashes), -1, np.int64), 0, np.arange(len(hashes))
    for level, bits in enumerate(levels):
        place = _places(hashes[left], level, len(bits))
        hit = bits[place]
        out[left[hit]] = base + (np.cumsum(bits) - 1)[place[hit]]
        base += int(bits.sum())
        left = left[~hit]
    return out


INDEX = "bucket long, sizes binary, bits binary, prints binary, shards binary, offsets binary, counts binary, starts binary"


def _index_row(pdf: pd.DataFrame) -> pd.DataFrame:
    hashes = key_hash(*(pdf[c].to_numpy() for c in ("doc_id", "missing", "copy")))
    levels, rank = build_levels(hashes)
    order = np.argsort(rank)
    of = lambda c, kind: pdf[c].to_numpy()[order].astype(kind).tobytes()
    return pd.DataFrame({
        "bucket": [pdf["bucket"].iloc[0]], "sizes": [np.array([len(b) for b in levels], np.int64).tobytes()],
        "bits": [np.packbits(np.concatenate(levels)).tobytes()],
        "prints": [(hashes[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes()],
        "shards": [of("shard", np.int32)], "offsets": [of("offset", np.int64)],
        "counts": [of("n", np.int64)], "starts": [of("start", np.int64)],
    })


def _levels(row: pd.Series) -> list[np.ndarray]:
    sizes = np.frombuffer(row["sizes"], np.int64)
    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return np.split(bits[: sizes.sum()], np.cumsum(sizes)[:-1])


@dataclass
class TokenFiles:
    """Written files and their stored index. ``paths`` and ``first`` have one entry per shard."""

    paths: list[str]
    first: list[int]
    width: np.dtype
    index: str
    n_buckets: int

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Place of each key (doc_id, copy): shard, offset, n and the ids before it; null if absent."""
        n_buckets, first = self.n_buckets, np.array([*self.first, 0], np.int64)
        index = keys.sparkSession.read.parquet(self.index)

        def find(keys: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            out = pd.DataFrame({"doc_id": keys["doc_id"].astype("Int64"), "copy": keys["copy"]})
            doc_id = keys["doc_id"].fillna(0).to_numpy().astype(np.int64)
            hashes = key_hash(doc_id, keys["doc_id"].isna().to_numpy(), keys["copy"].to_numpy())
            if len(rows):
                row = rows.iloc[0]
                rank = ranks(hashes, _levels(row))
                ok = rank >= 0
                prints = np.frombuffer(row["prints"], np.uint32)
                ok[ok] = prints[rank[ok]] == (hashes[ok] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                rank = np.where(ok, rank, 0)
                shard = np.frombuffer(row["shards"], np.int32)[rank]
                values = {"shard": shard, "offset": np.frombuffer(row["offsets"], np.int64)[rank],
                          "n": np.frombuffer(row["counts"], np.int64)[rank],
                          "start": np.frombuffer(row["starts"], np.int64)[rank] + first[shard]}
            else:
                ok, values = np.zeros(len(keys), bool), {c: np.zeros(len(keys), np.int64) for c in ("shard", "offset", "n", "start")}
            for name, value in values.items():
                out[name] = pd.array(value.astype(np.int64), "Int64")
                out.loc[~ok, name] = pd.NA
            return out

        named = keys.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("copy").cast("long").alias("copy"))
        dealt = named.withColumn("bucket", _bucket(n_buckets))
        return dealt.groupBy("bucket").cogroup(index.groupBy("bucket")).applyInPandas(
            find, "doc_id long, copy long, shard long, offset long, n long, start long")

    def read(self, places: DataFrame) -> DataFrame:
        """Crc and count of the ids at each place, read from the mapped files."""
        paths, width = self.paths, self.width

        def ids(pdf: pd.DataFrame) -> pd.DataFrame:
            raw = mapped(paths[int(pdf["shard"].iloc[0])])
            crc = [zlib.crc32(raw[o : o + n * width.itemsize].view(width).astype("<u4").tobytes())
                   for o, n in zip(pdf["offset"], pdf["n"], strict=True)]
            return pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "start": pdf["start"], "n_tokens": pdf["n"],
                                 "ids_crc32": crc})

        return places.filter("shard IS NOT NULL").groupBy("shard").applyInPandas(
            ids, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _bucket(n: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col("doc_id"), F.col("copy")), F.lit(n))


def write_token_files(docs: DataFrame, path: str | None = None, end_id: int = 2) -> TokenFiles:
    """Write the files of all documents and their index into the shared folder."""
    spark, path = docs.sparkSession, path or vocabulary_path()
    folder, index = new_folder(spark, "tokens"), new_folder(spark, "index")
    width = write_shards(docs, folder, path, end_id)
    paths = shard_paths(spark, folder)

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, p in zip(batch["shard"], batch["path"], strict=True):
                pdf = _parsed(mapped(p), width)
                yield pdf.assign(shard=shard)

    listed = spark.createDataFrame(list(enumerate(paths)), "shard int, path string")
    parsed = (listed.repartition(max(1, len(paths)), "shard")
              .mapInPandas(heads, "doc_id long, missing boolean, offset long, n long, start long, copy long, shard int"))
    entries = parsed.select(
        F.when(~F.col("missing"), F.col("doc_id")).alias("doc_id"), "missing", "offset", "n", "start", "copy", "shard")
    entries = checkpointed(entries)
    ends = entries.groupBy("shard").agg(
        F.sum("n").alias("tokens"), F.count("*").alias("docs"),
        F.min_by(F.struct("doc_id", "missing"), "offset").alias("head"),
        F.max_by(F.struct("doc_id", "missing", "copy"), "offset").alias("tail")).orderBy("shard").collect()
    first, total, carry, n_docs = [], 0, {}, 0
    last, copies = None, 0
    for e in ends:  # one row per shard: copies of one id may reach over shards
        first.append(total)
        total += e.tokens
        n_docs += e.docs
        head, tail = (e.head.doc_id, e.head.missing), (e.tail.doc_id, e.tail.missing)
        before = copies if head == last else 0
        if before:
            carry[e.shard] = before
        copies = e.tail.copy + 1 + (before if head == tail else 0)
        last = tail
    n_buckets = max(1, -(-n_docs // BUCKET_KEYS))
    if carry:
        more = spark.createDataFrame([(int(s), int(c)) for s, c in carry.items()], "shard int, more long")
        heads_of = entries.groupBy("shard").agg(F.min_by(F.struct("doc_id", "missing"), "offset").alias("head"))
        entries = (entries.join(heads_of, "shard").join(more, "shard", "left")
                   .withColumn("copy", F.col("copy") + F.when(
                       F.col("head.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("head.missing") == F.col("missing")),
                       F.coalesce("more", F.lit(0))).otherwise(0)))
    dealt = entries.withColumn("bucket", _bucket(n_buckets)).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    dealt.groupBy("bucket").applyInPandas(_index_row, INDEX).write.parquet(index)
    return TokenFiles(paths, first, width, index, n_buckets)


def token_file_rows(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Every document's place, count and checksum, found by key and read back from the files."""
    files = write_token_files(docs, path)
    keys = (docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count()
            .select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("copy")))
    return files.read(files.lookup(keys))
