"""Delimited tables, Parquet read pairs and the two-header count matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from hopscan.config import KEY
from hopscan.functions.labels import FASTQ_NAME_PATTERN
from hopscan.schemas import READ_PAIR, REGION, SAMPLE_SHEET, struct
from hopscan.sources.sinks import LABEL_SEPARATOR

SEPARATORS = {"tsv": "\t", "bed": "\t", "txt": "\t", "csv": ","}


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | None = None, header: bool = True,
    null_value: str | None = None,
) -> DataFrame:
    """Text table by extension (tsv, bed, txt or csv, also gzipped). No type inference."""
    name = path.rstrip("/").removesuffix(".gz")
    kind = name.rsplit(".", 1)[-1].lower()
    if kind not in SEPARATORS:
        raise ValueError(f"unsupported file type: {path}")
    reader = spark.read.option("sep", SEPARATORS[kind]).option("header", header)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", True)
    return reader.csv(path)


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet; a row with a missing field or a wrong file name fails the query."""
    sheet = spark.read.option("sep", "\t").option("header", True).schema(SAMPLE_SHEET).csv(path)
    present = F.lit(True)
    for c in SAMPLE_SHEET.names:
        present = present & F.col(c).isNotNull()
    names = F.col("read1").rlike(FASTQ_NAME_PATTERN) & F.col("read2").rlike(FASTQ_NAME_PATTERN)
    message = F.concat(F.lit("bad sample sheet row: "), F.concat_ws(",", *SAMPLE_SHEET.names))
    # A filter is evaluated for every row, whichever columns are read later.
    return sheet.filter(F.when(present & names, True).otherwise(F.raise_error(message).cast("boolean")))


def sheet_values(sheet: DataFrame, column: str) -> DataFrame:
    """Distinct samples, timepoints or conditions."""
    return sheet.select(column).distinct()


def read_pairs_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Read pairs with the fixed schema; directory partitions (Sample, Timepoint, ...) are added."""
    base = spark.read.option("basePath", path)
    stored = base.parquet(path)
    extra = [f for f in stored.schema.fields if f.name not in READ_PAIR.names]
    schema = T.StructType([*READ_PAIR.fields, *[T.StructField(f.name, T.StringType()) for f in extra]])
    return base.schema(schema).parquet(path)


def write_pairs_parquet(
    pairs: DataFrame, path: str, partitions: Sequence[str] = ("Sample", "Timepoint", "Fragment")
) -> None:
    """Store read pairs by library and fragment, so that later scans prune partitions."""
    by = [p for p in partitions if p in pairs.columns]
    pairs.write.mode("overwrite").partitionBy(*by).parquet(path)


def read_count_matrix(spark: SparkSession, path: str, key: Sequence[str] = KEY) -> DataFrame:
    """Wide count table to long, keeping only filled cells.

    Understands two header rows (samples, timepoints), optionally followed by a row of index
    names, and one header row of ``sample#timepoint`` labels. Only the header reaches the driver.
    """
    head = [r.value.split("\t") for r in spark.read.text(path).take(2)]
    if not head:
        raise ValueError(f"empty count matrix: {path}")
    n = len(key)
    joined = head[0][n:]
    if joined and all(LABEL_SEPARATOR in c for c in joined):
        labels = [tuple(c.split(LABEL_SEPARATOR, 1)) for c in joined]
    else:
        labels = list(zip(head[0][n:], head[1][n:]))
    names = [*key, *[f"_v{i}" for i in range(len(labels))]]
    raw = (
        spark.read.option("sep", "\t").option("header", False)
        .schema(struct(*[(c, T.StringType()) for c in names])).csv(path)
    )
    # Header rows have no number in the coordinate column.
    rows = raw.withColumn("Coordinate", F.col("Coordinate").try_cast("bigint")).filter(
        F.col("Coordinate").isNotNull()
    )
    cells = F.array(
        *[F.struct(F.lit(s).alias("Sample"), F.lit(t).alias("Timepoint"),
                   F.col(f"_v{i}").try_cast("double").cast("bigint").alias("Reads"))
          for i, (s, t) in enumerate(labels)]
    )
    return rows.select(*key, F.inline(cells)).filter(F.col("Reads").isNotNull())


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Contig lengths from a sequence index file."""
    schema = struct(("Chr", T.StringType()), ("length", T.LongType()))
    return spark.read.option("sep", "\t").schema(schema).csv(path).select("Chr", "length")


def chrom_sizes_from_tiles(tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("Chr").agg(
        F.max(F.col("tile_start") + F.length("seq")).cast("bigint").alias("length")
    )


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    """Region table with a header; a dot is a missing value."""
    raw = read_delimited(spark, path, null_value=".")
    types = {f.name: f.dataType for f in REGION.fields}

    def column(c: str):
        name = c.lstrip("#").replace(" ", "_")
        value = F.col(f"`{c}`")
        if isinstance(types.get(name), T.LongType):
            value = value.try_cast("double").cast("bigint")
        return value.alias(name)

    return raw.select(*[column(c) for c in raw.columns])


def read_gene_tables(
    spark: SparkSession, viability: str, peptide: str, ids: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Viability calls (no header), peptide lengths, and ids with the name falling back to the id."""
    calls = read_delimited(
        spark, viability, struct(("systematic_id", T.StringType()), ("viability", T.StringType())),
        header=False,
    )
    lengths = read_delimited(spark, peptide).select(
        "Systematic_ID", F.col("Residues").try_cast("bigint").alias("Residues")
    )
    names = read_delimited(spark, ids)
    names = names.withColumn("gene_name", F.coalesce("gene_name", "gene_systematic_id"))
    return calls, lengths, names
