"""Controls, imputation, normalisation and the score without replicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hopscan.config import BOUNDARY_DISTANCE, IMPUTE_STOP_DISTANCE, KEY
from hopscan.functions.alignment import flip_strand
from hopscan.functions.statistics import half_even, ma_values, normalized_count
from hopscan.operators.annotation import in_gene_filter, intergenic_core_filter
from hopscan.operators.ordered import exact_quantile
from hopscan.operators.sites import LIBRARY, complete_cases, count_where, library_count, semi_keys


def select_controls(
    counts: DataFrame, ann: DataFrame, min_distance: float = BOUNDARY_DISTANCE,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Neutral insertions: complete, deep inside a gap, one per distinct annotation.

    Annotations that agree in every value outside the key count once, for the first key in
    key order, so the two strands of an intergenic site give one control.
    """
    complete = complete_cases(counts, key=key).select(*key).distinct()
    core = semi_keys(intergenic_core_filter(ann, min_distance), complete, key=key)
    values = [c for c in core.columns if c not in key]
    first = core.groupBy(*values).agg(F.min(F.struct(*key)).alias("_key"))
    return first.select("_key.*", *values)


def control_medians(counts: DataFrame, controls: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Exact median of the control reads per library, and the smallest of them."""
    rows = semi_keys(counts, controls, key=key)
    medians = exact_quantile(rows, LIBRARY, "Reads", {"median": 0.5})
    # One row per library: the whole-table window below is over that small table.
    return medians.withColumn("min_median", F.min("median").over(W.partitionBy(F.lit(1))))


def baseline(value: Column, initial: str, key: Sequence[str]) -> Column:
    """The initial timepoint's value of the same insertion and sample, as a window."""
    return F.max(F.when(F.col("Timepoint") == initial, value)).over(
        W.partitionBy(*key, "Sample")
    )


def baseline_join(
    counts: DataFrame, initial: str, key: Sequence[str] = KEY, value: str = "Reads",
    name: str = "initial",
) -> DataFrame:
    """Attach the initial timepoint's value to every timepoint; no self-join."""
    return counts.withColumn(name, baseline(F.col(value), initial, key))


def ma_scores(
    counts: DataFrame, controls: DataFrame, initial: str, key: Sequence[str] = KEY,
    digits: int | None = 3,
) -> DataFrame:
    """Log2 fold change against the initial timepoint after control-median scaling.

    Positive means depleted. ``digits=None`` keeps full precision.
    """
    # One row per library goes to the counts. By sizes alone, counts of a few MB would go to the one task of the
    # medians, and every later step with them.
    medians = F.broadcast(control_medians(counts, controls, key))
    scaled = counts.join(medians, list(LIBRARY)).withColumn(
        "_n", normalized_count(F.col("Reads"), F.col("min_median"), F.col("median"))
    )
    scored = scaled.withColumn("baseMean", baseline(F.col("_n"), initial, key))
    m = ma_values(F.col("_n"), F.col("baseMean"))
    r = (lambda c: c) if digits is None else (lambda c: half_even(c, digits))
    return scored.select(
        *key, *LIBRARY, r(F.col("baseMean")).alias("baseMean"),
        r(m["LFC"]).alias("LFC"), r(m["A"]).alias("A"), r(F.col("_n")).alias("normed"),
    )


def fill_opposite_strand(
    counts: DataFrame, inside: DataFrame, key: Sequence[str] = KEY
) -> DataFrame:
    """In-gene rows with samples missing for a key copied from the other strand of its site.

    Every count row is offered to its own key and to the flipped one, so one aggregation
    replaces a key grid and a self-join. ``imputed`` tells copied rows.
    """
    genes = semi_keys(counts, inside, key=key)
    offers = F.array(
        F.struct(F.col("Strand").alias("Strand"), F.lit(False).alias("_copy")),
        F.struct(flip_strand(F.col("Strand")).alias("Strand"), F.lit(True).alias("_copy")),
    )
    rest_key = [k for k in key if k != "Strand"]
    offered = genes.select(*rest_key, *LIBRARY, "Reads", F.inline(offers))
    own = F.max(F.when(~F.col("_copy"), F.col("Reads")))
    other = F.max(F.when(F.col("_copy"), F.col("Reads")))
    filled = offered.groupBy(*key, *LIBRARY).agg(own.alias("_own"), other.alias("_other"))
    # A key that only exists as a flipped copy was never in the table.
    real = F.count("_own").over(W.partitionBy(*key)) > 0
    return (
        filled.withColumn("_real", real).filter("_real")
        .select(
            *key, *LIBRARY, F.coalesce("_own", "_other").alias("Reads"),
            F.col("_own").isNull().alias("imputed"),
        )
    )


def in_gene_keys(ann: DataFrame, min_stop: float, key: Sequence[str] = KEY) -> DataFrame:
    return in_gene_filter(ann, min_stop).select(*key).distinct()


def impute_opposite_strand(
    counts: DataFrame, ann: DataFrame, min_stop: float = IMPUTE_STOP_DISTANCE,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Complete insertions after opposite-strand filling of in-gene ones, and the complete rest."""
    inside = in_gene_keys(ann, min_stop, key)
    filled = fill_opposite_strand(counts, inside, key)
    rest = semi_keys(counts, inside, anti=True, key=key).withColumn("imputed", F.lit(False))
    every = filled.unionByName(rest.select(*filled.columns))
    return complete_cases(every, cells=library_count(counts), key=key)


def imputation_stats(imputed: DataFrame, first_timepoint: str, key: Sequence[str] = KEY) -> DataFrame:
    """Per retained insertion the number of samples that were filled."""
    at_first = F.col("imputed") & (F.col("Timepoint") == first_timepoint)
    return imputed.groupBy(*key).agg(count_where(at_first).alias("num_of_imputed_insertions"))


def imputation_summary(
    counts: DataFrame, ann: DataFrame, min_stop: float = IMPUTE_STOP_DISTANCE,
    key: Sequence[str] = KEY,
) -> DataFrame:
    """Counters before and after imputation, one row."""
    inside = in_gene_keys(ann, min_stop, key)
    cells = library_count(counts)
    filled = fill_opposite_strand(counts, inside, key)
    after = filled.groupBy(*key).agg(
        F.count("Reads").alias("_cells"),
        F.count_distinct(F.when(F.col("imputed"), F.col("Sample"))).alias("_copied"),
    )
    before = counts.groupBy(*key).agg(F.count("Reads").alias("_before"))
    rows = before.join(after, list(key), "left")
    # A key is in-gene exactly when the filled table has it.
    gene, full = F.col("_cells").isNotNull(), F.col("_before") == cells
    out = rows.withColumns({"_g": gene, "_full": full}).agg(
        F.count(F.lit(1)).alias("total_insertions"),
        count_where(F.col("_g")).alias("in_gene_insertions"),
        count_where(~F.col("_g")).alias("intergenic_insertions"),
        count_where(F.col("_full")).alias("complete_insertions_before"),
        count_where(F.col("_full") & F.col("_g")).alias("complete_in_gene_before"),
        count_where(F.col("_full") & ~F.col("_g")).alias("complete_intergenic"),
        count_where(F.col("_cells") == cells).alias("complete_in_gene_after"),
        F.coalesce(F.sum("_copied"), F.lit(0)).cast("bigint").alias("complementarity_used"),
    )
    return out.withColumn(
        "imputed_insertions", F.col("complete_in_gene_after") - F.col("complete_in_gene_before")
    )


def size_factors(counts: DataFrame, controls: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Median-of-ratios size factor per library, over controls seen in every library."""
    rows = semi_keys(counts, controls, key=key)
    group = W.partitionBy(*key)
    logged = F.ln(F.when(F.col("Reads") > 0, F.col("Reads")))
    ratios = (
        rows.withColumns({"_min": F.min("Reads").over(group), "_log": logged})
        .withColumn("_mean", F.avg("_log").over(group))
        .filter(F.col("_min") > 0)
        .withColumn("_ratio", F.col("_log") - F.col("_mean"))
    )
    medians = exact_quantile(ratios, LIBRARY, "_ratio", {"_m": 0.5})
    return medians.select(*LIBRARY, F.exp("_m").alias("size_factor"))


def dispersion_moments(
    counts: DataFrame, factors: DataFrame, key: Sequence[str] = KEY
) -> DataFrame:
    """Mean, variance and method-of-moments dispersion of the normalised counts per insertion."""
    scaled = counts.join(F.broadcast(factors), list(LIBRARY)).withColumn(  # one row per library
        "_n", F.col("Reads") / F.col("size_factor")
    )
    stats = scaled.groupBy(*key).agg(
        F.avg("_n").alias("base_mean"),
        F.var_samp("_n").alias("base_var"),
        F.avg(1 / F.col("size_factor")).alias("_inv"),
    )
    m, v = F.col("base_mean"), F.col("base_var")
    disp = F.when(m > 0, (v - F.col("_inv") * m) / (m * m)).otherwise(F.lit(0.0))
    return stats.select(*key, m, v, F.coalesce(disp, F.lit(0.0)).alias("dispersion"))
