"""Genome annotation (GFF3) and sequence (FASTA)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from hopscan.config import TRANSCRIPT_FEATURES
from hopscan.functions.labels import gff_attributes
from hopscan.operators.ordered import join_keys
from hopscan.schemas import GFF


def parse_gff(rows: DataFrame) -> DataFrame:
    """Adds the gene id and the transcript id found in the attributes."""
    return rows.withColumns(gff_attributes(F.col("Feature"), F.col("Attribute"), TRANSCRIPT_FEATURES))


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("sep", "\t").option("comment", "#").option("quote", "").schema(GFF).csv(path)
    return parse_gff(raw)


def gff_from_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The same from a column of lines."""
    f = F.split(F.col(line), "\t")
    rows = lines.filter(~F.startswith(F.col(line), F.lit("#"))).select(
        *[f[i].try_cast(field.dataType.simpleString()).alias(field.name)
          for i, field in enumerate(GFF.fields)]
    )
    return parse_gff(rows)


def _numbered_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sequence lines with their offset in their segment: what follows a header or a split's start.

    A split's lines arrive in order in one task, so only three numbers are carried along.
    """
    split, segment, offset = None, 0, 0
    for pdf in batches:
        out = []
        for line, file, start in zip(pdf["value"], pdf["file"], pdf["start"]):
            if (file, start) != split:
                split, segment, offset = (file, start), 0, 0
            if line.startswith(">"):
                segment, offset = segment + 1, 0
                out.append((file, start, segment, (line[1:].split() or [""])[0], 0, ""))
            else:
                bases = line.strip()
                out.append((file, start, segment, None, offset, bases))
                offset += len(bases)
        yield pd.DataFrame(out, columns=["file", "start", "segment", "name", "offset", "seq"])


def read_fasta_tiles(spark: SparkSession, path: str, width: int = 50_000) -> DataFrame:
    """(Chr, tile_start, tile_width, seq) from FASTA files with lines of any length.

    Each split numbers its own lines; the lengths of the segments, a table with a row per split
    and header, give every segment its contig and running offset. No contig is ever held whole.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    placed = lines.mapInPandas(
        _numbered_lines, "file string, start long, segment int, name string, offset long, seq string"
    )
    ends = placed.groupBy("file", "start", "segment").agg(
        F.max("name").alias("name"), F.sum(F.length("seq")).alias("bases")
    )
    in_file = W.partitionBy("file").orderBy("start", "segment")
    contigs = ends.withColumn("contig", F.count("name").over(in_file))
    in_contig = W.partitionBy("file", "contig").orderBy("start", "segment")
    bases = contigs.select(
        "file", "start", "segment", F.first("name").over(in_contig).alias("Chr"),
        (F.sum("bases").over(in_contig) - F.col("bases")).alias("base"),
    ).filter("Chr IS NOT NULL")
    pieces = join_keys(placed.filter(F.length("seq") > 0), bases, ["file", "start", "segment"]).select(
        "Chr", (F.col("base") + F.col("offset")).alias("tile_start"), "seq"
    )
    return fixed_tiles(pieces, width).select(
        "Chr", "tile_start", F.lit(width).cast("bigint").alias("tile_width"), "seq"
    )


def fixed_tiles(tiles: DataFrame, width: int) -> DataFrame:
    """Re-cut tiles to one common width, for ``target_sequence`` across contigs."""
    start, size = F.col("tile_start"), F.length("seq")
    first = F.floor(start / width)
    last = F.floor((start + size - 1) / width)
    cut = tiles.filter(size > 0).withColumn("t", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("t") * width, start)
    hi = F.least((F.col("t") + 1) * width, start + size)
    pieces = cut.select(
        "Chr", "t", lo.alias("lo"),
        F.substr("seq", (lo - start + 1).cast("int"), (hi - lo).cast("int")).alias("s"),
    )
    parts = F.array_sort(F.collect_list(F.struct("lo", "s")))
    return pieces.groupBy("Chr", "t").agg(parts.alias("p")).select(
        "Chr", (F.col("t") * width).cast("bigint").alias("tile_start"),
        F.array_join(F.transform("p", lambda p: p["s"]), "").alias("seq"),
    )
