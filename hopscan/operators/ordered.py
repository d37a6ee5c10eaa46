"""Ordered work (ranks, quantiles, running values) that survives one huge group.

A plain window puts a whole group into one task. Here the group is first cut into value
buckets by a monotone function of the value, so bucket totals (a small table) carry the
order between buckets and the only full sorts happen inside a bucket. Ties are collapsed
before the first shuffle, so a value shared by most rows costs one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hopscan.functions.statistics import gini_from_sums

COORDINATE_BUCKET = 100_000
_ZERO = 1 << 20


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys and keeps one copy of the key columns."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    if not cond:
        raise ValueError("join_keys needs at least one key")
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def value_bucket(value: Column) -> Column:
    """Monotone bucket of any number: 64 buckets per power of two, mirrored for negatives."""
    v = value.cast("double")
    size = F.floor(F.log2(F.abs(v)) * 64) + _ZERO
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, size).when(v < 0, -size)


def cumulative_counts(df: DataFrame, by: Sequence[str], value: str, rows: str | None = None) -> DataFrame:
    """Distinct (by, value) with ``n`` rows, ``below`` rows smaller in the group and ``total``.

    ``rows`` names a column that says for how many rows a row stands.
    """
    by = list(by)
    distinct = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, value)
        .agg((F.sum(rows) if rows else F.count(F.lit(1))).alias("n"))
        .withColumn("_bucket", value_bucket(F.col(value)))
    )
    per_bucket = distinct.groupBy(*by, "_bucket").agg(F.sum("n").alias("_bn"))
    group = W.partitionBy(*by)
    earlier = group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *by, "_bucket",
        F.coalesce(F.sum("_bn").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_bn").over(group).alias("total"),
    )
    inside = (
        W.partitionBy(*by, "_bucket").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    )
    joined = join_keys(distinct, offsets, [*by, "_bucket"])
    return joined.select(
        *by, value, "n",
        (F.col("_before") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("below"),
        "total", "_bucket",
    )


def exact_quantile(
    df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float], rows: str | None = None
) -> DataFrame:
    """Exact interpolated quantiles per group, one named column each; ``rows`` as in ``cumulative_counts``."""
    ranked = cumulative_counts(df, by, value, rows)
    v = F.col(value).cast("double")
    aggs: list[Column] = []
    for name, q in quantiles.items():
        h = (F.col("total") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            covers = (F.col("below") <= at) & (at < F.col("below") + F.col("n"))
            aggs.append(F.max(F.when(covers, v)).alias(f"_{side}_{name}"))
    out = ranked.groupBy(*by).agg(F.max("total").alias("_total"), *aggs)
    cols: list[Column] = []
    for name, q in quantiles.items():
        h = (F.col("_total") - 1) * F.lit(float(q))
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        cols.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    return out.select(*by, *cols)


def rank_sum(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """First and last 1-based rank of every distinct value, and the sum of its ranks."""
    c = cumulative_counts(df, by, value)
    n, below = F.col("n"), F.col("below")
    return c.select(
        *by, value, "n",
        (below + 1).alias("first_rank"),
        (below + n).alias("last_rank"),
        (n * below + n * (n + 1) / 2).cast("double").alias("ranks"),
    )


def gini(df: DataFrame, by: Sequence[str], value: str, name: str = "gini") -> DataFrame:
    """Gini coefficient of ``value`` per group."""
    r = rank_sum(df, by, value)
    v = F.col(value).cast("double")
    return (
        r.groupBy(*by)
        .agg(
            F.sum("n").cast("double").alias("_n"),
            F.sum(v * F.col("n")).alias("_total"),
            F.sum(v * F.col("ranks")).alias("_ranked"),
        )
        .select(*by, gini_from_sums(F.col("_n"), F.col("_total"), F.col("_ranked")).alias(name))
    )


def previous_value(
    df: DataFrame, by: Sequence[str], value: str, width: int = COORDINATE_BUCKET
) -> DataFrame:
    """Distinct (by, value) with the next smaller value of the group as ``previous``."""
    by = list(by)
    points = df.select(*by, value).distinct().withColumn("_bucket", F.floor(F.col(value) / width))
    edges = points.groupBy(*by, "_bucket").agg(F.max(value).alias("_edge"))
    edges = edges.select(
        *by, "_bucket",
        F.lag("_edge").over(W.partitionBy(*by).orderBy("_bucket")).alias("_prev_edge"),
    )
    inside = W.partitionBy(*by, "_bucket").orderBy(value)
    return join_keys(points, edges, [*by, "_bucket"]).select(
        *by, value, F.coalesce(F.lag(value).over(inside), F.col("_prev_edge")).alias("previous")
    )


def gap_lag(df: DataFrame, by: Sequence[str], value: str, width: int = COORDINATE_BUCKET) -> DataFrame:
    """Difference of every distinct coordinate to the previous one; NULL for the first."""
    p = previous_value(df, by, value, width)
    return p.select(*by, value, (F.col(value) - F.col("previous")).alias("gap"))


def running_max(
    df: DataFrame, by: Sequence[str], order: str, value: str, name: str,
    ties: Sequence[str] = (), width: int = COORDINATE_BUCKET,
) -> DataFrame:
    """Largest ``value`` of all earlier rows of the group (ordered by ``order`` then ``ties``)."""
    by = list(by)
    rows = df.withColumn("_bucket", F.floor(F.col(order) / width))
    tops = rows.groupBy(*by, "_bucket").agg(F.max(value).alias("_top"))
    earlier = W.partitionBy(*by).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    tops = tops.select(*by, "_bucket", F.max("_top").over(earlier).alias("_before"))
    inside = (
        W.partitionBy(*by, "_bucket").orderBy(order, *ties)
        .rowsBetween(W.unboundedPreceding, -1)
    )
    out = join_keys(rows, tops, [*by, "_bucket"])
    return out.withColumn(
        name, F.greatest(F.max(value).over(inside), F.col("_before"))
    ).drop("_bucket", "_before")


#: Buckets that one window of a scan over buckets sees, and the levels of such scans.
FAN, LEVELS = 1024, 3


def last_before(buckets: DataFrame, by: Sequence[str], value: str, levels: int = LEVELS) -> DataFrame:
    """(by, _bucket, before): the last value of all earlier buckets, by a scan in levels.

    FAN neighbouring buckets are scanned by themselves and give one bucket of the next level, whose result
    comes back to them; no window sees more than FAN buckets, with ``by`` or without, up to FAN ** (levels + 1) of them.
    """
    keys = [*by, "_bucket"]
    inside = W.partitionBy(*by, "_up").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    rows = buckets.select(*keys, value, F.floor(F.col("_bucket") / FAN).alias("_up"))
    own = rows.select(*keys, "_up", F.last(value, ignorenulls=True).over(inside).alias("before"))
    if not levels:
        return own.select(*keys, "before")
    tops = rows.groupBy(*by, "_up").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col("_bucket"))).alias(value))
    above = last_before(tops.withColumnRenamed("_up", "_bucket"), by, value, levels - 1).withColumnsRenamed({"_bucket": "_up", "before": "_above"})
    return join_keys(own, above, [*by, "_up"]).select(*keys, F.coalesce("before", "_above").alias("before"))


def carry_forward(
    df: DataFrame, column: str, order: str, by: Sequence[str] = (), width: int = COORDINATE_BUCKET, ties: Sequence[str] = ()
) -> DataFrame:
    """Fill NULLs with the last value seen in ``order`` (a number) and then ``ties``, across bucket borders too."""
    by = list(by)
    rows = df.withColumn("_bucket", F.floor(F.col(order) / width))
    last = rows.groupBy(*by, "_bucket").agg(
        F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(order, *ties))).alias("_last")
    )
    last = last_before(last, by, "_last").withColumnRenamed("before", "_carried")
    inside = (
        W.partitionBy(*by, "_bucket").orderBy(order, *ties).rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    out = join_keys(rows, last, [*by, "_bucket"])
    return out.withColumn(
        column, F.coalesce(F.last(column, ignorenulls=True).over(inside), F.col("_carried"))
    ).drop("_bucket", "_carried")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order``. Combines map-side, so hot keys are cheap."""
    whole = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*keys).agg(F.min_by(whole, F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def bh_adjust(df: DataFrame, p: str, by: Sequence[str] = (), name: str = "padj") -> DataFrame:
    """Benjamini-Hochberg adjusted p-values inside each group; NULL p stays NULL, uncounted."""
    by = list(by)
    c = cumulative_counts(df, by, p)
    c = c.withColumn("_q", F.col(p) * F.col("total") / (F.col("below") + F.col("n")))
    per_bucket = c.groupBy(*by, "_bucket").agg(F.min("_q").alias("_bq"))
    later = W.partitionBy(*by).orderBy(F.desc("_bucket")).rowsBetween(W.unboundedPreceding, -1)
    per_bucket = per_bucket.select(*by, "_bucket", F.min("_bq").over(later).alias("_later"))
    inside = (
        W.partitionBy(*by, "_bucket").orderBy(F.desc(p))
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    adjusted = join_keys(c, per_bucket, [*by, "_bucket"]).select(
        *by, F.col(p).alias("_p"),
        F.least(F.lit(1.0), F.min("_q").over(inside), F.col("_later")).alias("_adj"),
    )
    # p = 1 is often shared by most rows and always adjusts to 1: those rows, and NULLs, get
    # spread keys below zero that match nothing instead of meeting in one task.
    spread = -1.0 - F.pmod(F.xxhash64(*df.columns), F.lit(4096)).cast("double")
    rows = df.withColumn("_p", F.when(F.col(p) < 1, F.col(p).cast("double")).otherwise(spread))
    out = join_keys(rows, adjusted, [*by, "_p"], "left")
    value = F.when(F.col(p) >= 1, F.lit(1.0)).otherwise(F.col("_adj"))
    return out.withColumn(name, F.when(F.col(p).isNotNull(), value)).drop("_p", "_adj")


def chromosome_rank(chrom: Column, order: Sequence[str]) -> Column:
    """Position in the declared order; undeclared contigs come last."""
    pos = F.array_position(F.array(*[F.lit(c) for c in order]), chrom)
    return F.when(pos > 0, pos).otherwise(F.lit(len(order) + 1)).cast("bigint")


def ordered_output(df: DataFrame, chrom_order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Range-partitioned global order: declared chromosome order, then ``columns``."""
    return df.orderBy(chromosome_rank(F.col("Chr"), chrom_order), "Chr", *columns)


def top_depleted(df: DataFrame, score: str, n: int, ties: Sequence[str]) -> DataFrame:
    """The ``n`` rows with the highest score (a report, so the limit is the feature)."""
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(n)


def sample_head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order, for inspection."""
    return df.orderBy(*order).limit(n)
