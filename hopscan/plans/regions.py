"""Genome annotation to region tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hopscan.config import CODING, CODING_EXPAND, INTERGENIC
from hopscan.operators import intervals as iv, regions as rg
from hopscan.session import checkpointed


def attribute_tables(
    ids: DataFrame, viability: DataFrame, essentiality: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three lookups of gene attributes, one row per id; a missing name is the id."""
    names = ids.groupBy(F.col("gene_systematic_id").alias("Systematic_ID")).agg(
        F.max(F.coalesce("gene_name", "gene_systematic_id")).alias("Name")
    )
    calls = viability.groupBy(F.col("systematic_id").alias("Systematic_ID")).agg(
        F.max("viability").alias("FYPOviability")
    )
    library = essentiality.groupBy("Systematic_ID").agg(
        F.max(F.trim("DeletionLibrary_essentiality")).alias("DeletionLibrary_essentiality")
    )
    return names, calls, library


def build_regions(
    gff: DataFrame, sizes: DataFrame, peptide: DataFrame, ids: DataFrame,
    viability: DataFrame, essentiality: DataFrame, expand: int = CODING_EXPAND,
) -> dict[str, DataFrame]:
    """Primary transcripts, gaps between them, non-coding genes, overlaps, and combinations."""
    lookups = attribute_tables(ids, viability, essentiality)
    # Annotation text is read several times below; its parsed rows are small.
    gff = checkpointed(gff)
    features = rg.accumulated_cds(rg.coding_features(gff))
    chosen = rg.primary_transcript(features, peptide).select("Transcript")
    primary = checkpointed(
        rg.transcript_boundary_filter(features).join(chosen, "Transcript", "left_semi")
    )

    gaps = iv.flank_lookup(iv.interval_complement(primary, sizes), primary).withColumns(
        {"Length": F.col("End") - F.col("Start"), "Type": F.lit(INTERGENIC)}
    )

    def finish(df: DataFrame) -> DataFrame:
        return rg.parental_span(rg.gene_attributes(df, *lookups))

    primary, gaps = checkpointed(finish(primary)), finish(gaps)
    non_coding = finish(rg.non_coding_features(gff))
    overlapped = rg.gene_attributes(
        iv.interval_self_overlap(rg.spans(primary)).withColumn("Type", F.lit(CODING)),
        *lookups, separator=",",
    )
    return {
        "primary": primary,
        "intergenic": gaps,
        "non_coding": non_coding,
        "genome": rg.union_regions(primary, gaps),
        "overlapped": overlapped,
        "non_coding_clear": iv.interval_subtract(
            non_coding, rg.spans(primary), expand, ("Systematic_ID", "Transcript", "Feature")
        ),
    }
