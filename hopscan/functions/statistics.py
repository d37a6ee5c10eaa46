"""Numeric helpers shared by the scoring and quality-control operators."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Clipping limits.
CLIP_LOW, CLIP_HIGH = 1e-6, 1 - 1e-6
# End of fixed values.


def clip(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def clip_neg_log10(weight: Column) -> Column:
    """Weight from a p-like value; a missing value counts as 1 and is clipped, not dropped."""
    return -F.log10(clip(F.coalesce(weight.cast("double"), F.lit(1.0)), CLIP_LOW, CLIP_HIGH))


def r2_weight(r2: Column) -> Column:
    """1 - clipped fit quality; NULL stays NULL."""
    return F.when(r2.isNotNull(), F.lit(1.0) - clip(r2, CLIP_LOW, CLIP_HIGH))


def normalized_count(count: Column, min_median: Column, median: Column) -> Column:
    return count * min_median / median


def ma_values(now: Column, initial: Column) -> dict[str, Column]:
    """Log ratio (positive for depletion) and mean log intensity of two normalised counts."""
    return {
        "LFC": -F.log2((now + 1) / (initial + 1)),
        "A": F.log2((now + 1) * (initial + 1)) * 0.5,
    }


def gini_array(values: Column) -> Column:
    """Gini coefficient of an array column (bounded arrays only; see ``operators.ordered.gini``)."""
    xs = F.array_sort(F.transform(values, lambda v: v.cast("double")))
    n = F.size(xs).cast("double")
    total = F.aggregate(xs, F.lit(0.0), lambda acc, v: acc + v)
    ranked = F.aggregate(
        F.transform(xs, lambda v, i: v * (i + 1)), F.lit(0.0), lambda acc, v: acc + v
    )
    return gini_from_sums(n, total, ranked)


def gini_from_sums(n: Column, total: Column, ranked: Column) -> Column:
    """From the count, the sum and the sum of rank x value."""
    raw = 2 * ranked / (n * total) - (n + 1) / n
    return F.when((n == 0) | (total == 0), F.lit(0.0)).otherwise(clip(raw, 0.0, 1.0))


def safe_ratio(a: Column, b: Column, default: float | None = 0.0) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(default).cast("double"))


def half_even(c: Column, digits: int) -> Column:
    """Round ties to the even digit, as tables of this domain are written."""
    return F.bround(c.cast("double"), digits)
