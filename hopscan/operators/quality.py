"""Library-level quality control."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from hopscan.config import KEY
from hopscan.functions import alignment as al
from hopscan.operators.ordered import exact_quantile, join_keys
from hopscan.operators.sites import LIBRARY, count_where
from hopscan.session import checkpointed


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def pair_correlation(
    df: DataFrame, x: str, y: str, by: Sequence[str] = (), log: bool = True
) -> DataFrame:
    """Correlation and regression line of two columns per group, in one aggregation."""
    a, b = _finite(F.col(x).cast("double")), _finite(F.col(y).cast("double"))
    rows = df.select(*by, a.alias("_x"), b.alias("_y"))
    if log:
        rows = rows.filter((F.col("_x") > 0) & (F.col("_y") > 0))
        rows = rows.select(*by, F.log10("_x").alias("_x"), F.log10("_y").alias("_y"))
    else:
        rows = rows.filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    stats = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("points"),
        F.corr("_x", "_y").alias("pearson"),
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.regr_syy("_y", "_x").alias("_syy"),
        F.regr_sxy("_y", "_x").alias("_sxy"),
    )
    left = F.greatest(F.col("_syy") - F.col("slope") * F.col("_sxy"), F.lit(0.0))
    return stats.select(
        *by, "points", _finite(F.col("pearson")).alias("pearson"),
        _finite(F.col("pearson") * F.col("pearson")).alias("r_squared"),
        _finite(F.col("slope")).alias("slope"), _finite(F.col("intercept")).alias("intercept"),
        _finite(F.sqrt(left / F.col("points"))).alias("rmse"),
    )


def strand_pairs(
    counts: DataFrame, key: Sequence[str] = KEY, value: str = "Reads"
) -> DataFrame:
    """Reads of both strands of a site side by side; only sites where both are present."""
    site = [k for k in key if k != "Strand"]
    v = F.col(value)
    return (
        counts.groupBy(*site, *LIBRARY)
        .agg(
            F.max(F.when(F.col("Strand") == "+", v)).alias("plus"),
            F.max(F.when(F.col("Strand") == "-", v)).alias("minus"),
        )
        .filter(F.col("plus").isNotNull() & F.col("minus").isNotNull())
    )


def orientation_correlation(
    counts: DataFrame, key: Sequence[str] = KEY, value: str = "Reads"
) -> DataFrame:
    """Agreement of the two strands per library, over sites with reads on both."""
    return pair_correlation(strand_pairs(counts, key, value), "plus", "minus", LIBRARY)


def _histogram(values: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """Equal-width histogram per group over the group's own range, last bin closed."""
    distinct = values.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    limits = distinct.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    flat = F.col("_lo") == F.col("_hi")
    limits = limits.select(
        *by,
        F.when(flat, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(flat, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
    )
    joined = join_keys(distinct, limits, list(by))
    width = F.col("_hi") - F.col("_lo")
    at = F.least(F.floor((F.col(value) - F.col("_lo")) / width * bins), F.lit(bins - 1))
    counted = joined.withColumn("bin", at.cast("bigint")).groupBy(*by, "bin").agg(
        F.sum("_n").cast("bigint").alias("frequency"),
        F.min("_lo").alias("_lo"), F.min("_hi").alias("_hi"),
    )
    step = (F.col("_hi") - F.col("_lo")) / bins
    return counted.select(
        *by, "bin", (F.col("_lo") + step * F.col("bin")).alias("lower"),
        (F.col("_lo") + step * (F.col("bin") + 1)).alias("upper"), "frequency",
    )


def log_histogram(
    df: DataFrame, cols: Sequence[str], bins: int = 50, by: Sequence[str] = ()
) -> DataFrame:
    """Histogram of log10 of the positive values of each column (empty bins are absent)."""
    if not 5 <= bins <= 200:
        raise ValueError("bins must be between 5 and 200")
    long = df.select(*by, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(by), list(cols), "column", "value"
    )
    logs = long.filter(F.col("value") > 0).withColumn("value", F.log10("value"))
    return _histogram(logs, [*by, "column"], "value", bins)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _numeric_long(df: DataFrame) -> DataFrame:
    cols = numeric_columns(df)
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], cols, "column", "value"
    )


def column_profile(df: DataFrame) -> DataFrame:
    """Moments, range, median and missing values of every numeric column."""
    long = _numeric_long(df)
    stats = long.groupBy("column").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("sd"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        count_where(F.col("value").isNull()).alias("missing"),
    )
    return stats.join(exact_quantile(long, ["column"], "value", {"median": 0.5}), "column", "left")


def column_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """Equal-width histogram of every numeric column (empty bins are absent)."""
    long = _numeric_long(df).filter(F.col("value").isNotNull())
    return _histogram(long, ["column"], "value", bins)


def flagstat(aln: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Alignment lines by flag class."""
    f = F.col("flag")

    def has(bits: int) -> Column:
        return al.has_bits(f, bits)

    primary = al.lacks_bits(f, al.SECONDARY | al.SUPPLEMENTARY)
    mapped = al.lacks_bits(f, al.UNMAPPED)
    paired = primary & has(al.PAIRED)
    both = paired & mapped & al.lacks_bits(f, al.MATE_UNMAPPED)
    other = ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("rname"))
    classes = {
        "total": F.lit(True),
        "primary": primary,
        "secondary": has(al.SECONDARY),
        "supplementary": has(al.SUPPLEMENTARY) & al.lacks_bits(f, al.SECONDARY),
        "duplicates": has(al.DUPLICATE),
        "mapped": mapped,
        "primary_mapped": primary & mapped,
        "paired": paired,
        "read1": paired & has(al.READ1),
        "read2": paired & has(al.READ2),
        "properly_paired": paired & mapped & has(al.PROPER),
        "both_mapped": both,
        "singletons": paired & mapped & has(al.MATE_UNMAPPED),
        "mate_other_contig": both & other,
    }
    return aln.groupBy(*by).agg(*[count_where(c).alias(n) for n, c in classes.items()])


def idxstats(aln: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mapped and unmapped lines per contig."""
    unmapped = al.has_bits(F.col("flag"), al.UNMAPPED)
    return aln.groupBy(*by, F.col("rname").alias("Chr")).agg(
        count_where(~unmapped).alias("mapped"), count_where(unmapped).alias("unmapped")
    )


def template_lengths(aln: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Absolute template length once per pair: primary, mapped, second of the pair, not 0."""
    f = F.col("flag")
    wanted = al.PAIRED | al.READ2
    barred = al.UNMAPPED | al.MATE_UNMAPPED | al.SECONDARY | al.SUPPLEMENTARY | al.DUPLICATE
    once = f.bitwiseAND(F.lit(wanted | barred)) == wanted
    return aln.filter(once & (F.col("tlen") != 0)).select(*by, F.abs("tlen").alias("size"))


def insert_size_metrics(aln: DataFrame, by: Sequence[str] = LIBRARY) -> DataFrame:
    """Median, median absolute deviation, mean, sd and range of template lengths.

    Eager: the histogram, one row per length, comes from one scan and is stored; the rest reads that table.
    """
    by = list(by)
    sizes = checkpointed(insert_size_histogram(aln, by))
    size, pairs = F.col("size"), F.col("pairs")
    plain = sizes.groupBy(*by).agg(
        F.sum(pairs).alias("_pairs"), (F.sum(size.cast("double") * pairs) / F.sum(pairs)).alias("mean"),
        F.min("size").alias("min"), F.max("size").alias("max"),
    )
    plain = join_keys(plain, exact_quantile(sizes, by, "size", {"median": 0.5}, "pairs"), by)
    away = join_keys(sizes, plain, by).withColumn("_d", F.abs(size - F.col("median")))
    squares = F.sum(pairs * F.pow(size - F.col("mean"), F.lit(2.0)))
    out = away.groupBy(*by).agg(
        F.sum(pairs).alias("pairs"), F.min("mean").alias("mean"),
        F.when(F.sum(pairs) > 1, F.sqrt(squares / (F.sum(pairs) - 1))).alias("sd"),
        *[F.min(c).alias(c) for c in ("min", "max", "median")],
    )
    return join_keys(out, exact_quantile(away, by, "_d", {"mad": 0.5}, "pairs"), by)


def insert_size_histogram(aln: DataFrame, by: Sequence[str] = LIBRARY) -> DataFrame:
    return template_lengths(aln, by).groupBy(*by, "size").agg(F.count(F.lit(1)).alias("pairs"))


def expand_sample_files(
    sheet: DataFrame, fragments: Sequence[str] = ("PBL", "PBR"), present: DataFrame | None = None
) -> DataFrame:
    """Expected library x fragment parts, or only the missing ones if ``present`` is given."""
    keys = ["Sample", "Timepoint", "Condition"]
    parts = F.explode(F.array(*[F.lit(f) for f in fragments])).alias("Fragment")
    expected = sheet.select(*keys, parts).distinct()
    if present is None:
        return expected
    on = [c for c in [*keys, "Fragment"] if c in present.columns]
    if not on:
        raise ValueError(f"the parts at hand have none of the columns {[*keys, 'Fragment']}")
    return expected.join(present.select(*on), on, "left_anti")


def qc_rollup(
    tables: Sequence[DataFrame], keys: Sequence[str] = (*LIBRARY, "Fragment"),
    name_suffix: str | None = None,
) -> DataFrame:
    """One row per library with every metric; a metric missing for a library is NULL.

    ``name_suffix`` is a pattern removed from Sample first, so that both reads of a pair meet.
    """
    out: DataFrame | None = None
    for t in tables:
        if name_suffix:
            t = t.withColumn("Sample", F.regexp_replace("Sample", name_suffix, ""))
        on = [k for k in keys if k in t.columns]
        if not on:
            raise ValueError(f"a table with the columns {t.columns} has none of the keys {list(keys)}")
        out = t if out is None else out.join(t, on, "full_outer")
    if out is None:
        raise ValueError("qc_rollup needs at least one table")
    return out


