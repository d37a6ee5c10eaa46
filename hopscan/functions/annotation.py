"""Position of an insertion inside its region."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hopscan.config import INTERGENIC, NON_CODING


def _by_strand(kind: Column, strand: Column, plus: Column, minus: Column) -> Column:
    return F.when(kind != INTERGENIC, F.when(strand == "+", plus).otherwise(minus))


def region_distances(coordinate: Column, start: Column, end: Column, length: Column) -> dict[str, Column]:
    to_start, to_end = coordinate - start, end - coordinate
    return {
        "Distance_to_region_start": to_start,
        "Distance_to_region_end": to_end,
        "Fraction_to_region_start": to_start / length,
        "Fraction_to_region_end": to_end / length,
    }


def codon_distances(
    kind: Column, strand: Column, coordinate: Column, start: Column, end: Column, length: Column
) -> dict[str, Column]:
    """Strand-aware distance and fraction to start and stop codon; NULL between genes."""
    to_start, to_end = coordinate - start, end - coordinate
    return {
        "Distance_to_start_codon": _by_strand(kind, strand, to_start, to_end).cast("double"),
        "Distance_to_stop_codon": _by_strand(kind, strand, to_end, to_start).cast("double"),
        "Fraction_to_start_codon": _by_strand(kind, strand, to_start / length, to_end / length),
        "Fraction_to_stop_codon": _by_strand(kind, strand, to_end / length, to_start / length),
    }


def affected_residue(
    kind: Column, feature: Column, strand: Column, coordinate: Column,
    start: Column, end: Column, accumulated: Column,
) -> dict[str, Column]:
    """First amino acid changed and the reading frame; only coding rows have them."""
    inside = F.when(
        feature == "CDS", F.when(strand == "+", coordinate - start).otherwise(end - coordinate)
    ).otherwise(F.lit(0))
    bases = F.coalesce(accumulated.cast("bigint"), F.lit(0)) + inside
    coding = ~kind.isin(INTERGENIC, NON_CODING)
    return {
        "Residue_affected": F.when(coding, F.floor(bases / 3) + 1).cast("double"),
        "Residue_frame": F.when(coding, F.pmod(bases, F.lit(3))).cast("double"),
    }


def insertion_direction(kind: Column, strand: Column, region_strand: Column) -> Column:
    same = F.when(strand == region_strand, "Forward").otherwise("Reverse")
    return F.when(kind != INTERGENIC, same)
