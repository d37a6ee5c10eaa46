"""Session helpers: shared folders, stored tables, shipping the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders of the runs that are open, innermost last.
_RUNS: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder of the open run, else the one named by ``spark.checkpoint.dir``."""
    if _RUNS:
        return _RUNS[-1]
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def use_temporary_folder(spark: SparkSession) -> None:
    """Name a temporary folder where ``spark.checkpoint.dir`` is unset: for tests and one machine."""
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the tables of one run; it is deleted at the end.

    Results must be written elsewhere or used up inside, as they may read the run's tables.
    """
    path = f"{shared_folder(spark)}/runs/{uuid.uuid4().hex}"
    _RUNS.append(path)
    try:
        yield path
    finally:
        _RUNS.remove(path)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Store a table in the shared folder and read it back.

    Cuts the lineage, so a lost executor costs one stage of what follows, and gives the planner
    the real size of the table, so that small ones get broadcast.
    """
    path = f"{shared_folder(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files: for tables that are stored, so that nothing reads the shuffles again.

    Else they stay until the driver happens to collect its garbage.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def spread(df: DataFrame) -> DataFrame:
    """Even partitions for work that is heavy per row, whatever the size in bytes.

    Partitions sized by bytes would put many small rows with costly work into few tasks.
    """
    spark = df.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, shuffle))


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, for sessions started outside its folder."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="spark-"), "hopscan.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(top, "hopscan")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
