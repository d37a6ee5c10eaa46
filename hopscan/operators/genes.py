"""Gene-level scores and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hopscan.config import KEY, NOT_DETERMINED, VIABILITY_ORDER
from hopscan.functions.statistics import clip_neg_log10, half_even, r2_weight, safe_ratio
from hopscan.operators.ordered import join_keys
from hopscan.operators.sites import count_where

GENE = ("Systematic_ID", "Name", "FYPOviability", "DeletionLibrary_essentiality")


def r2_weights(fits: DataFrame, timepoints: Sequence[str], key: Sequence[str] = KEY) -> DataFrame:
    """Fit quality as a weight, repeated for every timepoint."""
    labels = F.array(*[F.lit(t) for t in timepoints])
    return fits.select(*key, F.explode(labels).alias("Timepoint"), r2_weight(F.col("R2")).alias("weight"))


def join_lfc_weights(lfc: DataFrame, weights: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Scores with the transformed weight of the same insertion and timepoint."""
    w = weights.select(*key, "Timepoint", clip_neg_log10(F.col("weight")).alias("Weights"))
    return lfc.join(w, [*key, "Timepoint"], "inner")


def join_annotations(df: DataFrame, ann: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Every annotation row of the key (several are allowed); rows without weight go."""
    return df.join(ann, list(key), "left").filter(F.col("Weights").isNotNull())


def normalize_weights(df: DataFrame, by: Sequence[str] = ("Systematic_ID", "Timepoint")) -> DataFrame:
    """Weight share inside a gene and timepoint.

    Sums combine map-side and join back, so a gene holding much of the table is never one task.
    """
    sums = df.groupBy(*by).agg(F.sum("Weights").alias("_sum"))
    out = join_keys(df, sums, list(by))
    return out.withColumn("Normalized_weights", F.col("Weights") / F.col("_sum")).drop("_sum")


def gene_lfc(
    weighted: DataFrame, digits: int | None = 3, by: Sequence[str] = ()
) -> DataFrame:
    """Weighted mean score per gene and timepoint, within ``by`` (a sample, say).

    Genes lacking an id, a name or a viability call are left out; a missing library call is
    kept as ``Not_determined``.
    """
    rows = weighted.filter(
        F.col("Systematic_ID").isNotNull() & F.col("Name").isNotNull()
        & F.col("FYPOviability").isNotNull() & F.col("LFC").isNotNull()
    ).withColumn(
        "DeletionLibrary_essentiality",
        F.coalesce("DeletionLibrary_essentiality", F.lit(NOT_DETERMINED)),
    )
    mean = F.sum(F.col("Weights") * F.col("LFC")) / F.sum("Weights")
    value = mean if digits is None else half_even(mean, digits)
    return rows.groupBy(*by, *GENE, "Timepoint").agg(value.alias("LFC"))


def covered_genes(scores: DataFrame, ann: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Genes with at least one scored insertion."""
    hit = ann.join(scores.select(*key), list(key), "left_semi")
    return hit.filter(F.col("Systematic_ID").isNotNull()).select("Systematic_ID").distinct()


def coverage_by_viability(covered: DataFrame, viability: DataFrame) -> DataFrame:
    """Covered and uncovered genes per viability call, in display order."""
    marks = covered.select(F.col("Systematic_ID").alias("systematic_id"), F.lit(True).alias("_hit"))
    rows = viability.join(marks.distinct(), "systematic_id", "left")
    per = rows.groupBy("viability").agg(
        F.count(F.lit(1)).alias("total"), count_where(F.col("_hit").isNotNull()).alias("covered")
    )
    order = F.array(*[F.lit(v) for v in VIABILITY_ORDER])
    pos = F.array_position(order, F.col("viability"))
    return per.select(
        "viability", "total", "covered",
        (F.col("total") - F.col("covered")).alias("not_covered"),
        (safe_ratio(F.col("covered"), F.col("total")) * 100).alias("coverage_pct"),
        F.when(pos > 0, pos).otherwise(len(VIABILITY_ORDER) + 1).cast("bigint").alias("display_order"),
    ).orderBy("display_order", "viability")
