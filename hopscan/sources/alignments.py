"""Alignment text (SAM) to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hopscan.functions.labels import split_sample_name


def tag_map(optional: Column) -> Column:
    """Tab-separated optional fields ``TAG:TYPE:VALUE`` as a map from tag to value."""
    untyped = F.regexp_replace(optional, r"(^|\t)([A-Za-z][A-Za-z0-9]):[A-Za-z]:", "$1$2:")
    return F.str_to_map(untyped, F.lit("\t"), F.lit(":"))


def parse_alignments(lines: DataFrame, line: str = "line", order: str = "ord") -> DataFrame:
    """Tab-separated alignment lines to columns; header lines (``@``) are skipped.

    All other columns of ``lines`` are kept. Lines are skipped and split by one generator: a filter,
    and every later one on a field, would move below the split and compute a derived line once more.
    """
    f = F.col("_f")
    keep = [c for c in lines.columns if c not in (line, order)]
    fields = F.array(F.split(line, "\t", 12))  # eleven fixed fields, then all optional ones
    split = lines.select(*keep, order, F.explode(F.when(~F.startswith(F.col(line), F.lit("@")), fields)).alias("_f"))
    return split.select(
        *keep,
        f[0].alias("qname"), f[1].try_cast("int").alias("flag"), f[2].alias("rname"),
        f[3].try_cast("bigint").alias("pos"), f[4].try_cast("int").alias("mapq"),
        f[5].alias("cigar"), f[6].alias("rnext"), f[7].try_cast("bigint").alias("pnext"),
        f[8].try_cast("bigint").alias("tlen"), f[9].alias("seq"), f[10].alias("qual"),
        tag_map(F.get(f, F.lit(11))).alias("tags"), F.col(order),
    )


def read_alignments(spark: SparkSession, path: str, timepoints: Sequence[str] = ()) -> DataFrame:
    """Alignment files; ``ord`` follows file order: file, place of the split in it, line of the split.

    With ``timepoints`` the file names give Sample and Timepoint, so the reads of several libraries
    in one folder stay apart: pass both to ``assemble_pairs(by=...)``.
    """
    order = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
    )
    library = split_sample_name(F.col("_metadata.file_path"), timepoints) if timepoints else {}
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), order.alias("ord"), *[c.alias(n) for n, c in library.items()]
    )
    return parse_alignments(lines)


def reference_end(pos: Column, reference_length: Column) -> Column:
    """0-based end of a 1-based start."""
    return pos - 1 + reference_length


