"""Running insertion-site counts over read-pair files as they arrive."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from hopscan.config import PairFilter
from hopscan.operators.reads import filter_read_pairs
from hopscan.operators.sites import site_count

LIBRARY_FRAGMENT = ("Sample", "Timepoint", "Fragment")


def pair_stream(
    spark: SparkSession, folder: str, schema: T.StructType, spec: PairFilter | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Read pairs that arrive as Parquet files, filtered."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    pairs = reader.parquet(folder)
    return pairs if spec is None else filter_read_pairs(pairs, spec)


def incremental_site_count(
    spark: SparkSession, folder: str, schema: T.StructType, checkpoint: str, output: str,
    spec: PairFilter | None = None, by: Sequence[str] = LIBRARY_FRAGMENT,
    files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Process what has arrived: one Parquet folder of partial counts per batch under ``output``.

    Counts add up, so a batch needs no state of earlier ones and writes its own sites only; a
    batch that is repeated after a failure replaces its folder. Call again with the same
    ``checkpoint`` and ``output`` to add later files.
    """

    def store(batch: DataFrame, number: int) -> None:
        site_count(batch, by).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        pair_stream(spark, folder, schema, spec, files_per_trigger).writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def running_site_counts(
    spark: SparkSession, output: str, by: Sequence[str] = LIBRARY_FRAGMENT
) -> DataFrame:
    """The counts of all batches so far, from merged folders where there are some."""
    paths = [f.path for f in live_folders(spark, output)]
    if not paths:
        raise ValueError(f"no batch has been written to {output}")
    return _added(spark.read.parquet(*paths), by)


def _added(partial: DataFrame, by: Sequence[str]) -> DataFrame:
    return partial.groupBy(*by, "Chr", "Coordinate").agg(
        F.sum("plus").alias("plus"), F.sum("minus").alias("minus")
    )


@dataclass(frozen=True)
class Folder:
    """Counts of the batches from ``first`` to ``last``; level 0 is one batch, each level merges FAN of the one below."""

    level: int
    first: int
    last: int
    path: str


#: Folders of one level that are merged into one of the next.
FAN = 8


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [x.getPath().getName() for x in store.listStatus(where)] if store.exists(where) else []


def _finished(spark: SparkSession, folder: str) -> bool:
    return "_SUCCESS" in _listed(spark, folder)


def _manifest(spark: SparkSession, output: str) -> tuple[int, list[Folder]]:
    """Newest finished manifest: its version (-1 without one) and the folders it names."""
    versions = sorted((int(n.split("=")[1]) for n in _listed(spark, f"{output}_manifest") if n.startswith("version=")), reverse=True)
    for version in versions:
        path = f"{output}_manifest/version={version}"
        if _finished(spark, path):
            rows = spark.read.schema("level int, first long, last long, path string").json(path).collect()
            return version, sorted((Folder(r["level"], r["first"], r["last"], r["path"]) for r in rows), key=lambda f: f.first)
    return -1, []


def live_folders(spark: SparkSession, output: str) -> list[Folder]:
    """The folders that hold every batch once: those of the newest manifest and the finished batches after it."""
    _, merged = _manifest(spark, output)
    covered = merged[-1].last if merged else -1
    numbers = sorted(int(n.split("=")[1]) for n in _listed(spark, output) if n.startswith("batch="))
    later = [Folder(0, n, n, f"{output}/batch={n}") for n in numbers if n > covered]
    return merged + [f for f in later if _finished(spark, f.path)]


def compact_site_counts(
    spark: SparkSession, output: str, by: Sequence[str] = LIBRARY_FRAGMENT, fan: int = FAN
) -> list[Folder]:
    """Merge batch folders in levels, so that their number grows with the logarithm of the batches; returns what is live.

    ``fan`` neighbouring folders of a level become one of the next, each batch being rewritten once a level. Merged folders
    are new ones; they count from the moment a manifest naming them is finished, which happens at the end. What a failed call
    leaves behind is in no manifest and is never read. The newest batch stays out, as a stream may still repeat it.
    One call at a time; readers may go on meanwhile, as nothing is deleted here.
    """
    version, _ = _manifest(spark, output)
    live = live_folders(spark, output)
    newest = max((f.last for f in live if f.level == 0), default=-1)
    open_ = [f for f in live if f.last < newest or f.level > 0]
    changed = False
    while True:
        runs = [open_[i : i + fan] for i in range(len(open_) - fan + 1)]
        run = next((r for r in runs if len({f.level for f in r}) == 1), None)
        if run is None:
            break
        path = f"{output}_merged/level={run[0].level + 1}/{run[0].first}-{run[-1].last}-{uuid.uuid4().hex}"
        _added(spark.read.parquet(*[f.path for f in run]), by).write.parquet(path)
        at = open_.index(run[0])
        open_[at : at + fan] = [Folder(run[0].level + 1, run[0].first, run[-1].last, path)]
        changed = True
    if changed:
        rows = [(f.level, f.first, f.last, f.path) for f in open_]
        spark.createDataFrame(rows, "level int, first long, last long, path string").coalesce(1).write.json(f"{output}_manifest/version={version + 1}")
    return live_folders(spark, output)
