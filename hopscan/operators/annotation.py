"""Insertions against genome regions and the genome sequence."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hopscan.config import BOUNDARY_DISTANCE, INTERGENIC, KEY, SITE, UNKNOWN_TARGET
from hopscan.functions import annotation as fa
from hopscan.operators.intervals import BIN_WIDTH, point_interval_join
from hopscan.operators.ordered import join_keys


def annotate_points(
    points: DataFrame, regions: DataFrame, bin_width: int = BIN_WIDTH
) -> DataFrame:
    """All regions an insertion touches (both ends included) with positions inside them.

    Region columns named like a point column get the suffix ``_Interval``.
    """
    shared = set(points.columns) | {"Start", "End"}
    renamed = regions.select(
        *[F.col(c).alias(f"{c}_Interval" if c in shared else c) for c in regions.columns]
    )
    hits = point_interval_join(
        points, renamed, "Coordinate", "Start_Interval", "End_Interval",
        region_chrom="Chr_Interval", width=bin_width,
    )
    x, kind, strand = F.col("Coordinate"), F.col("Type"), F.col("Strand_Interval")
    s, e = F.col("ParentalRegion_start"), F.col("ParentalRegion_end")
    size = F.col("ParentalRegion_length")
    return hits.withColumns(
        fa.region_distances(x, s, e, size)
        | fa.codon_distances(kind, strand, x, s, e, size)
        | fa.affected_residue(
            kind, F.col("Feature"), strand, x, F.col("Start_Interval"), F.col("End_Interval"),
            F.col("Accumulated_CDS_bases"),
        )
        | {"Insertion_direction": fa.insertion_direction(kind, F.col("Strand"), strand)}
    )


def boundary_dedup(ann: DataFrame, site: Sequence[str] = SITE) -> DataFrame:
    """Drop rows exactly on a codon boundary, then prefer genes where both kinds remain."""
    on_edge = (F.col("Distance_to_start_codon") == 0) | (F.col("Distance_to_stop_codon") == 0)
    rest = ann.filter(~F.coalesce(on_edge, F.lit(False)))
    group = W.partitionBy(*site)
    one_kind = F.min("Type").over(group) == F.max("Type").over(group)
    keep = F.coalesce(one_kind, F.lit(True)) | (F.col("Type") != INTERGENIC)
    return rest.withColumn("_keep", keep).filter("_keep").drop("_keep")


def in_gene_condition(min_stop: float) -> Column:
    return (F.col("Type") != INTERGENIC) & (F.col("Distance_to_stop_codon") > min_stop)


def in_gene_filter(
    df: DataFrame, min_stop: float, mode: str = "row", key: Sequence[str] = KEY
) -> DataFrame:
    """Rows inside a gene (``row``) or all rows of keys with such a row (``key``)."""
    inside = in_gene_condition(min_stop)
    if mode == "row":
        return df.filter(inside)
    if mode != "key":
        raise ValueError(f"mode must be 'row' or 'key', not {mode!r}")
    some = F.max(F.coalesce(inside, F.lit(False))).over(W.partitionBy(*key))
    return df.withColumn("_some", some).filter("_some").drop("_some")


def intergenic_core_filter(ann: DataFrame, min_distance: float = BOUNDARY_DISTANCE) -> DataFrame:
    """Intergenic rows far from both ends of their gap."""
    return ann.filter(
        (F.col("Type") == INTERGENIC)
        & (F.col("Distance_to_region_start") > min_distance)
        & (F.col("Distance_to_region_end") > min_distance)
    )


def union_annotations(tables: Sequence[DataFrame]) -> DataFrame:
    """Distinct union of the annotations of several samples."""
    return reduce(lambda a, b: a.unionByName(b), tables).distinct()


def target_sequence(points: DataFrame, tiles: DataFrame, tile_width: int, size: int = 4) -> DataFrame:
    """Adds ``Target``: the ``size`` bases ending at the coordinate, upper case.

    ``tiles`` is (Chr, tile_start, seq) with tiles of ``tile_width`` bases. A tile also gets the
    last bases of the tile before it, by an equi-join, so that every target lies in one tile.
    """
    numbered = tiles.select("Chr", F.floor(F.col("tile_start") / tile_width).alias("_tile"), "seq")
    tails = numbered.select(
        "Chr", (F.col("_tile") + 1).alias("_tile"), F.right(F.col("seq"), F.lit(size - 1)).alias("_tail")
    )
    extended = numbered.join(tails, ["Chr", "_tile"], "left").select(
        "Chr", "_tile",
        F.concat(F.coalesce("_tail", F.lit("")), F.col("seq")).alias("_seq"),
        F.length(F.coalesce("_tail", F.lit(""))).alias("_extra"),
    )
    placed = points.withColumn("_tile", F.floor((F.col("Coordinate") - 1) / tile_width))
    hit = join_keys(placed, extended, ["Chr", "_tile"], "left")
    offset = F.col("Coordinate") - size - F.col("_tile") * tile_width + F.col("_extra")
    bases = F.when(
        offset >= 0, F.substr(F.col("_seq"), (offset + 1).cast("int"), F.lit(size))
    )
    target = F.when(F.length(bases) == size, F.upper(bases)).otherwise(F.lit(UNKNOWN_TARGET))
    return hit.select(*points.columns, target.alias("Target"))
