"""Wide tables and the release folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from pyspark.errors import AnalysisException

from hopscan.config import KEY
from hopscan.session import checkpointed

LABEL_SEPARATOR = "#"

# Release layout, target <- table name.
RELEASE_ALWAYS = {
    "insertion_level/raw_reads.tsv": "raw_reads",
    "insertion_level/LFC.tsv": "LFC",
    "insertion_level/baseMean.tsv": "baseMean",
    "insertion_level/normed_counts.tsv": "normed_counts",
    "insertion_level/annotations.tsv.gz": "annotations",
}
RELEASE_REPLICATES = {
    "insertion_level/imputed_raw_reads.tsv": "imputed_raw_reads",
    "insertion_level/padj.tsv": "padj",
    "insertion_level/insertion_level_statistics.tsv": "insertion_level_statistics",
    "insertion_level/imputation_statistics.tsv": "imputation_statistics",
}
RELEASE_TIME_POINTS = {
    "insertion_level/insertion_level_fitting_statistics.tsv": "insertion_level_fitting_statistics",
    "insertion_level/fitting_LFCs.tsv": "insertion_level_fitting_LFCs",
    "insertion_level/fitting_results.tsv": "insertion_level_fitting_results",
    "insertion_level/transformed_weights.tsv": "transformed_weights",
    "gene_level/LFC.tsv": "gene_LFC",
    "gene_level/gene_level_fitting_statistics.tsv": "gene_level_fitting_statistics",
    "gene_level/fitting_LFCs.tsv": "gene_level_fitting_LFCs",
    "gene_level/fitting_results.tsv": "gene_level_fitting_results",
}
# End of fixed values.


def wide_matrix(
    df: DataFrame, labels: Sequence[tuple[str, ...]], by: Sequence[str] = ("Sample", "Timepoint"),
    key: Sequence[str] = KEY, value: str = "Reads",
) -> DataFrame:
    """Long to wide over the given label combinations; an absent cell stays NULL."""
    cells = []
    for label in labels:
        cond = F.lit(True)
        for column, v in zip(by, label):
            cond = cond & (F.col(column) == v)
        cells.append(F.max(F.when(cond, F.col(value))).alias(LABEL_SEPARATOR.join(label)))
    return df.groupBy(*key).agg(*cells)


def write_table(df: DataFrame, path: str, gzip: bool = False) -> None:
    """Tab-separated folder with a header in every part."""
    writer = df.write.mode("overwrite").option("sep", "\t").option("header", True)
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if gzip:
        writer = writer.option("compression", "gzip")
    writer.csv(path)


def write_wide_matrix(
    df: DataFrame, path: str, labels: Sequence[tuple[str, ...]],
    by: Sequence[str] = ("Sample", "Timepoint"), key: Sequence[str] = KEY, value: str = "Reads",
) -> None:
    wide = wide_matrix(df, labels, by, key, value)
    write_table(wide.repartitionByRange(*key[:2]).sortWithinPartitions(*key), path)


def release_manifest(has_replicates: bool, has_time_points: bool) -> dict[str, str]:
    """Release files a project has, depending on its branch."""
    out = dict(RELEASE_ALWAYS)
    if has_replicates:
        out |= RELEASE_REPLICATES
    if has_time_points:
        out |= RELEASE_TIME_POINTS
    return out


def flat_columns(df: DataFrame) -> DataFrame:
    """Text files hold no arrays or structs: render them as JSON."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    return df.withColumns({c: F.to_json(c) for c in nested}) if nested else df


#: Where a release says what it holds; written last, so a folder without it is not finished.
MANIFEST = "manifest"


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (columns, row_count, digest) that tells tables apart by content, whatever the order of their rows.

    The digest adds up a 128-bit hash of every row's columns as text; a row that stands twice counts twice. It adds
    up map-side, so it costs one pass. Missing values count as empty text, as in the files.
    """
    cells = [F.replace(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit("\x1f"), F.lit("\x1f\x1f")) for c in df.columns]
    row = F.concat_ws("\x1f", *cells)
    halves = [F.sum(F.xxhash64(F.lit(seed), row).cast("decimal(38,0)")) for seed in (1, 2)]
    digest = F.concat_ws(":", *[F.coalesce(h, F.lit(0).cast("decimal(38,0)")).cast("string") for h in halves])
    return df.agg(F.lit(",".join(df.columns)).alias("columns"), F.count(F.lit(1)).alias("row_count"), digest.alias("digest"))


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """A release table as text columns."""
    return spark.read.option("sep", "\t").option("header", True).option("multiLine", True).csv(path)


def write_release(
    tables: dict[str, DataFrame], path: str, has_replicates: bool, has_time_points: bool
) -> list[str]:
    """Write every table of the manifest below ``path``; a missing one is an error.

    Each table is stored first, so what is written and what its fingerprint says are the same rows. The
    fingerprints are written when all tables are there; ``verify_release`` compares them with the files.
    """
    manifest = release_manifest(has_replicates, has_time_points)
    missing = sorted(set(manifest.values()) - set(tables))
    if missing:
        raise ValueError(f"release lacks tables: {missing}")
    found = None
    for target, name in manifest.items():
        stored = checkpointed(flat_columns(tables[name]))
        write_table(stored, f"{path}/{target}", gzip=target.endswith(".gz"))
        one = fingerprint(stored).withColumn("target", F.lit(target))
        found = one if found is None else found.unionByName(one)
    found.coalesce(1).write.mode("overwrite").json(f"{path}/{MANIFEST}")
    return sorted(manifest)


def verify_release(spark: SparkSession, path: str) -> DataFrame:
    """(target, row_count, intact) of every table of a release: whether its files hold what was written.

    A folder without a manifest is an unfinished release and an error.
    """
    manifest = spark.read.schema("columns string, row_count long, digest string, target string").json(f"{path}/{MANIFEST}")
    found = None
    for r in manifest.collect():  # one row a target, seventeen at most
        try:
            table = read_target(spark, f"{path}/{r['target']}")
        except AnalysisException:
            table = spark.createDataFrame([], "gone string")
        if not table.columns and r["columns"]:  # only an empty table has no header
            table = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in r["columns"].split(",")))
        now = fingerprint(table)
        intact = (F.col("columns") == r["columns"]) & (F.col("row_count") == r["row_count"]) & (F.col("digest") == r["digest"])
        one = now.select(F.lit(r["target"]).alias("target"), F.col("row_count"), intact.alias("intact"))
        found = one if found is None else found.unionByName(one)
    if found is None:
        raise ValueError(f"{path} has no release manifest")
    return found
