"""One-row and per-sample summaries of the processing steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hopscan.config import INTERGENIC, KEY, PairFilter
from hopscan.functions.statistics import half_even, safe_ratio
from hopscan.operators.reads import pair_condition, valid_condition, with_coordinate
from hopscan.operators.sites import count_where


def total(c: Column | str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def percent(a: Column, b: Column) -> Column:
    return safe_ratio(a, b) * 100.0


def filter_retention(
    pairs: DataFrame, spec: PairFilter = PairFilter(), by: Sequence[str] = ("Sample", "Timepoint")
) -> DataFrame:
    """Pairs before and after filtering per library and fragment, and over both fragments.

    Counting the predicate needs one pass; the filtered table is not read again.
    """
    kept = F.coalesce(pair_condition(spec), F.lit(False))
    aggs = []
    for fragment in ("PBL", "PBR"):
        mine = F.col("Fragment") == fragment
        low = fragment.lower()
        aggs += [
            count_where(mine).alias(f"original_read_pairs_{low}"),
            count_where(mine & kept).alias(f"filtered_read_pairs_{low}"),
        ]
    return _with_rates(pairs.groupBy(*by).agg(*aggs))


def retention_of(table: DataFrame, by: Sequence[str] = ("Sample", "Timepoint")) -> DataFrame:
    """``filter_retention`` from a ``site_table``."""
    aggs = []
    for fragment in ("PBL", "PBR"):
        mine = F.col("Fragment") == fragment
        low = fragment.lower()
        aggs += [
            total(F.when(mine, F.col("pairs"))).alias(f"original_read_pairs_{low}"),
            total(F.when(mine, F.col("kept"))).alias(f"filtered_read_pairs_{low}"),
        ]
    return _with_rates(table.groupBy(*by).agg(*aggs))


def _with_rates(out: DataFrame) -> DataFrame:
    for low in ("pbl", "pbr"):
        o, f = F.col(f"original_read_pairs_{low}"), F.col(f"filtered_read_pairs_{low}")
        out = out.withColumn(f"removed_read_pairs_{low}", o - f)
        out = out.withColumn(f"retention_rate_{low}", safe_ratio(f, o))
    return add_totals(out)


def add_totals(df: DataFrame) -> DataFrame:
    """Both fragments together and the overall retention, 4 decimals."""

    def both(stem: str) -> Column:
        cols = [F.coalesce(F.col(f"{stem}_{low}"), F.lit(0)) for low in ("pbl", "pbr")]
        return (cols[0] + cols[1]).cast("bigint")

    o, f = both("original_read_pairs"), both("filtered_read_pairs")
    return df.withColumns(
        {
            "total_original_pairs": o,
            "total_filtered_pairs": f,
            "overall_retention_rate": half_even(safe_ratio(f, o), 4),
        }
    )


def site_stats(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Valid and invalid rows, distinct sites and strand totals."""
    valid = F.coalesce(valid_condition(), F.lit(False))
    rows = with_coordinate(pairs).withColumn("_valid", valid)
    place = F.when(F.col("_valid"), F.col("Coordinate"))
    sites = (
        rows.withColumn("_chr", F.when(F.col("_valid"), F.col("Chr")))
        .withColumn("_at", place)
        .groupBy(*by, "_chr", "_at")
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            count_where(F.col("_valid")).alias("_ok"),
            count_where(F.col("_valid") & (F.col("Strand") == "+")).alias("_plus"),
            count_where(F.col("_valid") & (F.col("Strand") == "-")).alias("_minus"),
        )
    )
    return _site_totals(sites, by)


def site_stats_of(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``site_stats`` of the kept pairs of a ``site_table``."""
    sites = table.groupBy(*by, "Chr", "Coordinate").agg(
        total("kept").alias("_rows"), total(F.col("plus") + F.col("minus")).alias("_ok"),
        total("plus").alias("_plus"), total("minus").alias("_minus"),
    )
    return _site_totals(sites, by)


def _site_totals(sites: DataFrame, by: Sequence[str]) -> DataFrame:
    out = sites.groupBy(*by).agg(
        total("_rows").alias("total_rows"),
        total("_ok").alias("valid_rows"),
        count_where(F.col("_ok") > 0).alias("unique_sites"),
        total("_plus").alias("plus_reads"),
        total("_minus").alias("minus_reads"),
    )
    return out.withColumns(
        {
            "invalid_rows": F.col("total_rows") - F.col("valid_rows"),
            "validity_rate": percent(F.col("valid_rows"), F.col("total_rows")),
        }
    )


def merge_summary(merged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Read totals by transposon end, and sites at which both strands carry reads."""
    place = merged.groupBy(*by, "Chr", "Coordinate").agg(
        total("PBL").alias("_pbl"), total("PBR").alias("_pbr"),
        F.count(F.lit(1)).alias("_rows"),
        count_where((F.col("PBL") > 0) & (F.col("PBR") > 0)).alias("_pairs"),
    )
    out = place.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sites"),
        total("_rows").alias("rows"),
        total("_pbl").alias("pbl_reads"),
        total("_pbr").alias("pbr_reads"),
        total("_pairs").alias("paired_rows"),
    )
    reads = F.col("pbl_reads") + F.col("pbr_reads")
    return out.withColumns(
        {
            "total_reads": reads,
            "pbl_share": percent(F.col("pbl_reads"), reads),
            "pbr_share": percent(F.col("pbr_reads"), reads),
        }
    )


def concat_summary(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Insertions, contigs, read totals and the share of each target sequence.

    ``counts`` has a key with ``Target`` and the columns PBL, PBR and Reads.
    """
    keys = counts.groupBy(*by, *KEY).agg(
        total("PBL").alias("_pbl"), total("PBR").alias("_pbr"), total("Reads").alias("_reads")
    )
    contigs = keys.groupBy(*by, "Target", "Chr").agg(
        F.count(F.lit(1)).alias("_ins"), total("_pbl").alias("_pbl"),
        total("_pbr").alias("_pbr"), total("_reads").alias("_reads"),
    )
    out = contigs.groupBy(*by).agg(
        total("_ins").alias("insertions"),
        F.count_distinct("Chr").alias("chromosomes"),
        F.count_distinct("Target").alias("targets"),
        total("_pbl").alias("pbl_reads"),
        total("_pbr").alias("pbr_reads"),
        total("_reads").alias("total_reads"),
        total(F.when(F.col("Target") == "TTAA", F.col("_ins"))).alias("ttaa_insertions"),
    )
    return out.withColumn("ttaa_share", percent(F.col("ttaa_insertions"), F.col("insertions")))


def target_distribution(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct insertions per target sequence."""
    return counts.select(*by, *KEY).distinct().groupBy(*by, "Target").agg(
        F.count(F.lit(1)).alias("insertions")
    )


def annotation_summary(ann: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts of an annotation table by kind and direction, and distinct genes."""
    coding = F.col("Type") != INTERGENIC
    per_gene = ann.groupBy(*by, "Systematic_ID").agg(
        F.count(F.lit(1)).alias("_n"),
        count_where(coding).alias("_coding"),
        count_where(~coding).alias("_inter"),
        count_where(F.col("Insertion_direction") == "Forward").alias("_fwd"),
        count_where(F.col("Insertion_direction") == "Reverse").alias("_rev"),
    )
    out = per_gene.groupBy(*by).agg(
        total("_n").alias("annotated_insertions"),
        total("_coding").alias("coding_insertions"),
        total("_inter").alias("intergenic_insertions"),
        count_where((F.col("_coding") > 0) & F.col("Systematic_ID").isNotNull()).alias("unique_genes"),
        total("_fwd").alias("forward_insertions"),
        total("_rev").alias("reverse_insertions"),
    )
    return out.withColumn(
        "coding_percentage", percent(F.col("coding_insertions"), F.col("annotated_insertions"))
    )


def hard_filter_summary(
    counts: DataFrame, initial: str, cutoff: float, key: Sequence[str] = KEY
) -> DataFrame:
    """Insertions before and after the hard filter, per sample and overall (Sample = ALL)."""
    start = F.max(F.when(F.col("Timepoint") == initial, F.col("Reads")))
    per_key = counts.groupBy(*key, "Sample").agg(start.alias("_start"))
    per_sample = per_key.groupBy("Sample").agg(
        F.count(F.lit(1)).alias("_total"), count_where(F.col("_start") >= cutoff).alias("_kept")
    )
    out = per_sample.rollup("Sample").agg(
        total("_total").alias("total_insertions"), total("_kept").alias("retained_insertions")
    )
    t, k = F.col("total_insertions"), F.col("retained_insertions")
    return out.select(
        F.coalesce("Sample", F.lit("ALL")).alias("Sample"), t, k,
        (t - k).alias("removed_insertions"), percent(k, t).alias("retention_rate"),
    )


def cutoff_retention(
    counts: DataFrame, initial: str, cutoff: float, key: Sequence[str] = KEY
) -> DataFrame:
    """Rows and reads of the initial timepoint kept by a cutoff, per sample."""
    per_sample = counts.filter(F.col("Timepoint") == initial).groupBy("Sample").agg(
        F.count(F.lit(1)).alias("original_rows"),
        total("Reads").alias("original_counts"),
        count_where(F.col("Reads") >= cutoff).alias("rows_kept"),
        total(F.when(F.col("Reads") >= cutoff, F.col("Reads"))).alias("count_kept"),
    )
    return per_sample.withColumns(
        {
            "percentage_rows_kept": percent(F.col("rows_kept"), F.col("original_rows")),
            "percentage_count_kept": percent(F.col("count_kept"), F.col("original_counts")),
        }
    )


def control_summary(complete: DataFrame, controls: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Complete insertions, how many of them are controls, and the share."""
    marked = complete.select(*key, F.lit(0).alias("_c")).unionByName(
        controls.select(*key, F.lit(1).alias("_c"))
    )
    per_key = marked.groupBy(*key).agg(
        F.max("_c").alias("_control"), F.min("_c").alias("_complete")
    )
    out = per_key.agg(
        count_where(F.col("_complete") == 0).alias("complete_insertions"),
        count_where(F.col("_control") == 1).alias("control_insertions"),
    )
    return out.withColumn(
        "control_rate", percent(F.col("control_insertions"), F.col("complete_insertions"))
    )


def gene_summary(genes: DataFrame) -> DataFrame:
    """Genes in a gene table, by viability and library call. One row per gene is counted once."""
    per_gene = genes.select(
        "Systematic_ID", "Name", "FYPOviability", "DeletionLibrary_essentiality"
    ).distinct()
    v, e = F.col("FYPOviability"), F.col("DeletionLibrary_essentiality")
    return per_gene.agg(
        F.count(F.lit(1)).alias("genes"),
        count_where(v == "inviable").alias("inviable"),
        count_where(v == "viable").alias("viable"),
        count_where(e == "E").alias("library_essential"),
        count_where(e == "V").alias("library_dispensable"),
    )
