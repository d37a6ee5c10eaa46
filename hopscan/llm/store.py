"""Tables and raw array files in the shared folder."""

from __future__ import annotations

import ctypes
import gc
import math
import os
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from hopscan.session import checkpointed, shared_folder

__all__ = [
    "Shards", "bound_batches", "checkpointed", "mapped", "new_folder", "release", "shard_bits", "text_bytes", "tidy",
    "write_arrays", "write_shards",
]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Hand rows to Python a few megabytes at a time, so that long texts do not add up in a worker.

    A bound that the user has set stays, whatever it is. Results are lazy, so the bound must hold when
    they are used: it stays for the session.
    """
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(4 << 20))


def release() -> None:
    """Give freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for a worker that lives on after the task: freed memory goes back to the system at its end."""

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{name}/{uuid.uuid4().hex}"


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts, which sizes shards."""
    bound_batches(docs.sparkSession)
    return docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0


def write_arrays(df: DataFrame, folder: str) -> None:
    """Write one raw file per row of (shard, data): the bytes of data and a line feed.

    The text sink copies the bytes as they are, on any file system and with Spark's own commit.
    """
    df.select("shard", F.col("data").cast("string").alias("value")).write.partitionBy("shard").text(folder)


def mapped(path: str) -> np.ndarray:
    """The bytes of a raw file: memory-mapped from a mounted folder, else read through Arrow."""
    where = urlparse(path)
    if where.scheme in ("", "file"):
        return np.memmap(where.path, dtype=np.uint8, mode="r")
    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path)
    with store.open_input_file(inner) as f:
        return np.frombuffer(f.readall(), dtype=np.uint8)


def shard_bits(n_bytes: int, shard_bytes: int) -> int:
    """Bits of the hash that number the shards, for shards of about some bytes."""
    return max(0, math.ceil(math.log2(max(1, n_bytes / shard_bytes))))


#: Arrays of this worker by folder and shard, the last used at the end, and the bytes of those not memory-mapped.
_OPEN: OrderedDict[tuple[str, int], np.ndarray] = OrderedDict()
OPEN_FILES, OPEN_BYTES = 8192, 256 << 20


def _only_file(folder: str) -> str:
    """The one array file of a shard's folder; an error where it is missing."""
    where = urlparse(folder)
    if where.scheme in ("", "file"):
        found = [f"{where.path}/{name}" for name in os.listdir(where.path) if name.startswith("part-")]
    else:
        from pyarrow import fs

        store, inner = fs.FileSystem.from_uri(folder)
        base = folder[: len(folder) - len(inner)] if folder.endswith(inner) else f"{where.scheme}://"
        found = [base + f.path for f in store.get_file_info(fs.FileSelector(inner)) if f.base_name.startswith("part-")]
    if len(found) != 1:
        raise FileNotFoundError(f"{folder} holds {len(found)} array files instead of one")
    return found[0]


@dataclass(frozen=True)
class Shards:
    """A folder with one raw array file for each of 2 ** bits shards.

    Only the folder travels in tasks: a worker finds the file of a shard when it needs it and keeps the
    last used ones open. A shard without its file is an error, as ``write_shards`` writes every one.
    """

    folder: str
    bits: int

    def raw(self, shard: int) -> np.ndarray:
        """The bytes of a shard, without the sink's line feed."""
        key = (self.folder, shard)
        if key not in _OPEN:
            _OPEN[key] = mapped(_only_file(f"{self.folder}/shard={shard}"))[:-1]
            held = sum(len(v) for v in _OPEN.values() if not isinstance(v, np.memmap))
            while len(_OPEN) > 1 and (len(_OPEN) > OPEN_FILES or held > OPEN_BYTES):
                gone = _OPEN.popitem(last=False)[1]
                held -= 0 if isinstance(gone, np.memmap) else len(gone)
        _OPEN.move_to_end(key)
        return _OPEN[key]

    def cut(self, keys: np.ndarray) -> Iterator[tuple[int, slice]]:
        """Slices of sorted keys by their upper bits."""
        if len(keys):
            shard = (keys >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(keys), np.int64)
            edges = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(keys)], strict=True):
                yield int(shard[a]), slice(a, b)


def shard_heads(spark: SparkSession, shards: Shards, n: int) -> np.ndarray:
    """The first n numbers of every shard, read by tasks: one short row per shard."""

    def heads(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            yield batch.assign(head=[shards.raw(int(s))[: 8 * n].tobytes() for s in batch["id"]])

    rows = spark.range(1 << shards.bits).mapInPandas(heads, "id long, head binary").collect()
    out = np.zeros((1 << shards.bits, n), np.int64)
    for r in rows:
        out[r["id"]] = np.frombuffer(r["head"], np.int64)
    return out


def write_shards(partials: DataFrame, folder: str, bits: int, join: Callable) -> Shards:
    """Write every shard: ``join`` makes the bytes of one from its rows of ``partials``, none of them for an empty shard.

    The first column of ``partials`` is the shard; rows of nulls stand for every shard, so that each gets a file.
    """
    blanks = partials.sparkSession.range(1 << bits).select(
        F.col("id").cast("int").alias(partials.columns[0]), *(F.lit(None).cast(kind).alias(c) for c, kind in partials.dtypes[1:]))
    first = partials.columns[1]

    def merged(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        data = join(pdf[pdf[first].notna()])
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "data": [data]})

    write_arrays(partials.unionByName(blanks).groupBy("shard").applyInPandas(merged, "shard int, data binary"), folder)
    return Shards(folder, bits)
