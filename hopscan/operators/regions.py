"""Genome features to region tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hopscan.config import CODING, NON_CODING, NON_CODING_FEATURES
from hopscan.functions.labels import bed_coordinates


def coding_features(gff: DataFrame) -> DataFrame:
    """CDS and intron rows of genes that have an mRNA, in BED coordinates."""
    genes = gff.filter(F.col("Feature") == "mRNA").select("Systematic_ID").distinct()
    rows = gff.filter(F.col("Feature").isin("CDS", "intron")).join(genes, "Systematic_ID", "left_semi")
    return _to_bed(rows, CODING)


def non_coding_features(gff: DataFrame, features: Sequence[str] = NON_CODING_FEATURES) -> DataFrame:
    return _to_bed(gff.filter(F.col("Feature").isin(*features)), NON_CODING)


def _to_bed(gff: DataFrame, kind: str) -> DataFrame:
    bed = bed_coordinates(F.col("Start"), F.col("End"))
    return gff.select(
        "Chr", bed["Start"].alias("Start"), bed["End"].alias("End"), "Transcript",
        bed["Length"].alias("Length"), "Strand", "Feature", "Systematic_ID",
        F.lit(kind).alias("Type"),
    )


_TRANSCRIPT = ("Systematic_ID", "Transcript")


def transcript_boundary_filter(features: DataFrame) -> DataFrame:
    """Features between the first and the last CDS of their transcript."""
    group = W.partitionBy(*_TRANSCRIPT)
    cds = F.col("Feature") == "CDS"
    first = F.min(F.when(cds, F.col("Start"))).over(group)
    last = F.max(F.when(cds, F.col("End"))).over(group)
    return (
        features.withColumns({"_first": first, "_last": last})
        .filter((F.col("Start") >= F.col("_first")) & (F.col("End") <= F.col("_last")))
        .drop("_first", "_last")
    )


def accumulated_cds(features: DataFrame) -> DataFrame:
    """Coding bases of the transcript before each feature, in reading direction."""
    reading = F.when(F.col("Strand") == "+", F.col("Start")).otherwise(-F.col("Start"))
    before = (
        W.partitionBy(*_TRANSCRIPT).orderBy(reading).rowsBetween(W.unboundedPreceding, -1)
    )
    bases = F.when(F.col("Feature") == "CDS", F.col("Length")).otherwise(0)
    return features.withColumn(
        "Accumulated_CDS_bases", F.coalesce(F.sum(bases).over(before), F.lit(0)).cast("bigint")
    )


def primary_transcript(features: DataFrame, peptide: DataFrame) -> DataFrame:
    """One transcript per gene whose coding length fits the known peptide, ``.1`` preferred."""
    length = F.sum(F.when(F.col("Feature") == "CDS", F.col("Length")).otherwise(0))
    totals = features.groupBy(*_TRANSCRIPT).agg(length.cast("bigint").alias("CDS_length"))
    fits = F.floor(F.col("CDS_length") / 3) - 1 == F.col("Residues")
    candidates = totals.join(peptide, "Systematic_ID").filter(fits & (F.col("CDS_length") > 0))
    preferred = F.struct(~F.endswith(F.col("Transcript"), F.lit(".1")), F.col("Transcript"))
    return candidates.groupBy("Systematic_ID").agg(
        F.min_by(F.struct("Transcript", "CDS_length"), preferred).alias("_t")
    ).select("Systematic_ID", "_t.Transcript", "_t.CDS_length")


def parental_span(regions: DataFrame) -> DataFrame:
    """Adds the span of all rows of an id on its contig."""
    group = W.partitionBy("Chr", "Systematic_ID")
    start, end = F.min("Start").over(group), F.max("End").over(group)
    return regions.withColumns(
        {"ParentalRegion_start": start, "ParentalRegion_end": end}
    ).withColumn(
        "ParentalRegion_length", F.col("ParentalRegion_end") - F.col("ParentalRegion_start")
    )


def region_type_counts(regions: DataFrame) -> DataFrame:
    return regions.groupBy("Type").agg(F.count(F.lit(1)).alias("regions"))


def union_regions(primary: DataFrame, intergenic: DataFrame) -> DataFrame:
    """Genes and gaps in one table; columns only one side has are NULL on the other."""
    return primary.unionByName(intergenic, allowMissingColumns=True)


def spans(regions: DataFrame) -> DataFrame:
    """Distinct parental spans as intervals."""
    return regions.select(
        "Chr",
        F.col("ParentalRegion_start").alias("Start"),
        F.col("ParentalRegion_end").alias("End"),
        "Transcript", "Systematic_ID", "Strand",
    ).distinct()


def composite_ids(ids: Column, separator: str) -> Column:
    return F.split(ids, "[" + separator + "]")


def gene_attributes(
    regions: DataFrame, names: DataFrame, viability: DataFrame, essentiality: DataFrame,
    separator: str = "|", not_determined: str = "Not_determined",
) -> DataFrame:
    """Adds Name, FYPOviability and DeletionLibrary_essentiality by gene id.

    ``names`` (Systematic_ID, Name), ``viability`` (Systematic_ID, FYPOviability) and
    ``essentiality`` (Systematic_ID, DeletionLibrary_essentiality) hold one value per id. Ids
    joined by ``separator`` are looked up part by part; an unknown part keeps its own id, or
    ``not_determined`` for essentiality. A plain unknown id gets NULL.
    """
    cols = ["Name", "FYPOviability", "DeletionLibrary_essentiality"]
    tagged = [
        t.select("Systematic_ID", *[
            F.col(c) if c in t.columns else F.lit(None).cast("string").alias(c) for c in cols
        ])
        for t in (names, viability, essentiality)
    ]
    known = (
        tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
        .groupBy(F.col("Systematic_ID").alias("_part"))
        .agg(*[F.max(c).alias(c) for c in cols])
    )
    ids = regions.select("Systematic_ID").distinct()
    parts = ids.select(
        "Systematic_ID", F.posexplode(composite_ids(F.col("Systematic_ID"), separator)).alias("_pos", "_part"),
        F.contains(F.col("Systematic_ID"), F.lit(separator)).alias("_many"),
    )
    defaults = {"Name": F.col("_part"), "FYPOviability": F.col("_part"),
                "DeletionLibrary_essentiality": F.lit(not_determined)}

    def joined(c: str) -> Column:
        value = F.when(F.col("_many"), F.coalesce(F.col(c), defaults[c])).otherwise(F.col(c))
        items = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(F.col("_pos"), value.alias("v")))))
        text = F.array_join(F.transform(items, lambda i: i["v"]), separator)
        return F.when(F.size(items) > 0, text).alias(c)

    lookup = parts.join(known, "_part", "left").groupBy("Systematic_ID").agg(
        *[joined(c) for c in cols]
    )
    return regions.join(lookup, "Systematic_ID", "left").select(*regions.columns, *cols)
