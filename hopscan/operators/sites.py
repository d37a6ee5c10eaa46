"""Insertion-site counts, the long count table and its set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from hopscan.config import KEY
from hopscan.operators.reads import valid_condition, valid_insertion_rows, with_coordinate

LIBRARY = ("Sample", "Timepoint")


def count_where(cond: Column) -> Column:
    """Row count of a condition as a fixed-width sum, so that it combines map-side."""
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")


def site_count(
    pairs: DataFrame, by: Sequence[str] = ("Sample", "Timepoint", "Fragment")
) -> DataFrame:
    """Reads per insertion site, ``plus`` and ``minus`` strand."""
    rows = with_coordinate(valid_insertion_rows(pairs))
    return rows.groupBy(*by, "Chr", "Coordinate").agg(
        count_where(F.col("Strand") == "+").alias("plus"),
        count_where(F.col("Strand") == "-").alias("minus"),
    )


def _crossed_rows(wide: DataFrame, by: Sequence[str]) -> DataFrame:
    """Both strand rows of a site. The PBL end is read from the opposite strand."""

    def row(strand: str, pbl: str, pbr: str) -> Column:
        return F.struct(
            F.lit(strand).alias("Strand"), F.col(pbl).alias("PBL"), F.col(pbr).alias("PBR")
        )

    rows = F.array(row("+", "PBL_minus", "PBR_plus"), row("-", "PBL_plus", "PBR_minus"))
    return wide.select(*by, "Chr", "Coordinate", F.inline(rows)).withColumn(
        "Reads", F.col("PBL") + F.col("PBR")
    )


def merge_fragments(sites: DataFrame, by: Sequence[str] = LIBRARY) -> DataFrame:
    """PBL and PBR site counts side by side, absent = 0; one aggregation instead of a join."""

    def total(fragment: str, strand: str) -> Column:
        kept = F.when(F.col("Fragment") == fragment, F.col(strand)).otherwise(0)
        return F.sum(kept).cast("bigint").alias(f"{fragment}_{strand}")

    wide = sites.groupBy(*by, "Chr", "Coordinate").agg(
        *[total(f, s) for f in ("PBL", "PBR") for s in ("plus", "minus")]
    )
    return _crossed_rows(wide, by)


def count_insertions(pairs: DataFrame, by: Sequence[str] = LIBRARY) -> DataFrame:
    """``site_count`` and ``merge_fragments`` in one shuffle, straight from read pairs."""
    rows = with_coordinate(valid_insertion_rows(pairs))

    def total(fragment: str, strand: str, name: str) -> Column:
        cond = (F.col("Fragment") == fragment) & (F.col("Strand") == strand)
        return count_where(cond).alias(f"{fragment}_{name}")

    wide = rows.filter(F.col("Fragment").isin("PBL", "PBR")).groupBy(*by, "Chr", "Coordinate").agg(
        *[total(f, s, n) for f in ("PBL", "PBR") for s, n in (("+", "plus"), ("-", "minus"))]
    )
    return _crossed_rows(wide, by)


def site_table(
    pairs: DataFrame, kept: Column, by: Sequence[str] = LIBRARY
) -> DataFrame:
    """Pairs per library, fragment and site, counted once for all quality figures.

    ``kept`` says which pairs pass the filter. Pairs that do not, or have no valid site, stand at
    the NULL site; counting combines map-side, so that site is no burden.
    """
    passed = F.coalesce(kept, F.lit(False))
    valid = passed & F.coalesce(valid_condition(), F.lit(False))
    rows = with_coordinate(pairs).select(
        *by, "Fragment", passed.alias("_kept"), valid.alias("_valid"), "Strand",
        F.when(valid, F.col("Chr")).alias("Chr"), F.when(valid, F.col("Coordinate")).alias("Coordinate"),
    )
    return rows.groupBy(*by, "Fragment", "Chr", "Coordinate").agg(
        F.count(F.lit(1)).alias("pairs"), count_where(F.col("_kept")).alias("kept"),
        count_where(F.col("_valid") & (F.col("Strand") == "+")).alias("plus"),
        count_where(F.col("_valid") & (F.col("Strand") == "-")).alias("minus"),
    )


def insertions_of(table: DataFrame, by: Sequence[str] = LIBRARY) -> DataFrame:
    """``count_insertions`` from a ``site_table``."""

    def total(fragment: str, strand: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("Fragment") == fragment, F.col(strand))), F.lit(0)).alias(f"{fragment}_{strand}")

    at_site = table.filter(F.col("Chr").isNotNull() & F.col("Fragment").isin("PBL", "PBR"))
    wide = at_site.groupBy(*by, "Chr", "Coordinate").agg(
        *[total(f, s) for f in ("PBL", "PBR") for s in ("plus", "minus")]
    )
    return _crossed_rows(wide, by)


def union_strands(plus: DataFrame, minus: DataFrame) -> DataFrame:
    """Stack the two strand halves."""
    return plus.unionByName(minus)


def concat_timepoints(
    merged: DataFrame, timepoints: Sequence[str], value: str = "Reads",
    key: Sequence[str] = ("Chr", "Coordinate", "Strand"), by: Sequence[str] = ("Sample",),
) -> DataFrame:
    """Every site of a sample gets every timepoint, 0 where it was not seen.

    One aggregation per site fills a small fixed list of timepoints; no join with a key list.
    """
    keys = [*by, *key]
    v = F.col(value)
    cells = [
        F.coalesce(F.sum(F.when(F.col("Timepoint") == tp, v)), F.lit(0)).cast("bigint")
        for tp in timepoints
    ]
    wide = merged.groupBy(*keys).agg(*[c.alias(f"_t{i}") for i, c in enumerate(cells)])
    rows = F.array(
        *[F.struct(F.lit(tp).alias("Timepoint"), F.col(f"_t{i}").alias(value))
          for i, tp in enumerate(timepoints)]
    )
    return wide.select(*keys, F.inline(rows))


def merge_similar_timepoints(
    counts: DataFrame, similar: Sequence[str], merged: str, drop: Sequence[str] = (),
    key: Sequence[str] = KEY, value: str = "Reads",
) -> DataFrame:
    """Sum the ``similar`` timepoints into ``merged``; unmerged labels in ``drop`` disappear."""
    tp = F.col("Timepoint")
    dropped = [d for d in drop if d != merged]
    gone = tp.isin(*dropped) & ~tp.isin(*similar) if dropped else F.lit(False)
    label = F.when(tp.isin(*similar), F.lit(merged)).otherwise(tp)
    kept_apart = [s for s in similar if s != merged and s not in drop]
    rows = counts.filter(~gone)
    if kept_apart:
        # A summed timepoint that is not dropped stays as a column of its own too.
        labels = F.when(
            tp.isin(*kept_apart), F.array(F.lit(merged), tp)
        ).otherwise(F.array(label))
        rows = rows.withColumn("Timepoint", F.explode(labels))
    else:
        rows = rows.withColumn("Timepoint", label)
    return rows.groupBy(*key, "Sample", "Timepoint").agg(
        F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias(value)
    )


def concat_samples(tables: Sequence[DataFrame]) -> DataFrame:
    """Long tables of several samples; a site missing in a sample simply has no row."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def hard_filter(
    counts: DataFrame, initial: str, cutoff: float, key: Sequence[str] = KEY,
    timepoints: Sequence[str] | None = None, value: str = "Reads",
) -> DataFrame:
    """Keep (insertion, sample) groups with at least ``cutoff`` reads at the initial timepoint."""
    if timepoints is not None and initial not in timepoints:
        raise ValueError(f"unknown initial timepoint {initial!r}; known: {list(timepoints)}")
    group = W.partitionBy(*key, "Sample")
    start = F.max(F.when(F.col("Timepoint") == initial, F.col(value))).over(group)
    return counts.withColumn("_start", start).filter(F.col("_start") >= cutoff).drop("_start")


def library_count(counts: DataFrame) -> Column:
    """Number of (sample, timepoint) libraries, as a scalar subquery."""
    return counts.select(*LIBRARY).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()


def complete_cases(
    counts: DataFrame, cells: Column | int | None = None, key: Sequence[str] = KEY,
    value: str = "Reads",
) -> DataFrame:
    """Keep insertions with a value in every library."""
    if cells is None:
        cells = library_count(counts)
    elif isinstance(cells, int):
        cells = F.lit(cells)
    group = W.partitionBy(*key)
    return (
        counts.withColumn("_cells", F.count(value).over(group))
        .filter(F.col("_cells") == cells)
        .drop("_cells")
    )


def semi_keys(
    df: DataFrame, keys: DataFrame, anti: bool = False, key: Sequence[str] = KEY
) -> DataFrame:
    """Rows whose key is (not) in ``keys``."""
    return df.join(keys.select(*key), list(key), "left_anti" if anti else "left_semi")


def key_intersection(a: DataFrame, b: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return a.select(*key).intersect(b.select(*key))


def key_difference(a: DataFrame, b: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    return a.select(*key).distinct().join(b.select(*key), list(key), "left_anti")


def positive_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter((F.col(a) > 0) & (F.col(b) > 0))


def replicate_sum(
    counts: DataFrame, initial: str, final: str, key: Sequence[str] = KEY, value: str = "Reads"
) -> DataFrame:
    """Reads of an insertion summed over samples, at the initial and the final timepoint."""

    def at(tp: str) -> Column:
        return F.coalesce(
            F.sum(F.when(F.col("Timepoint") == tp, F.col(value))), F.lit(0)
        ).cast("bigint")

    return counts.groupBy(*key).agg(
        at(initial).alias("reads_initial"), at(final).alias("reads_final")
    )


def to_long(
    wide: DataFrame, keys: Sequence[str], label: str = "Timepoint", value: str = "Reads",
    columns: Sequence[str] | None = None, keep_null: bool = False,
) -> DataFrame:
    """Wide to long; NULL cells vanish unless asked for."""
    columns = list(columns) if columns else [c for c in wide.columns if c not in keys]
    out = wide.unpivot(list(keys), columns, label, value)
    return out if keep_null else out.filter(F.col(value).isNotNull())


def to_wide(
    long: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str], value: str
) -> DataFrame:
    """Long to wide with the given labels as columns; no extra job to find them."""
    cells = [
        F.max(F.when(F.col(label) == lab, F.col(value))).alias(str(lab)) for lab in labels
    ]
    return long.groupBy(*keys).agg(*cells)
