"""Insertion density, gaps, depth and strand statistics per gene."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from hopscan.config import GENE_STOP_DISTANCE, KEY
from hopscan.functions.statistics import gini_from_sums, half_even, safe_ratio
from hopscan.operators.annotation import in_gene_filter
from hopscan.operators.ordered import (
    cumulative_counts, exact_quantile, join_keys, previous_value,
)
from hopscan.operators.sites import count_where, replicate_sum
from hopscan.operators.summaries import total
from hopscan.session import checkpointed

ID = "Systematic_ID"
ATTRIBUTES = (
    "Name", "Chr_Interval", "ParentalRegion_start", "ParentalRegion_end",
    "ParentalRegion_length", "Strand_Interval", "FYPOviability",
)
# Limits of the summary counters.
DENSITY_DROP, HIGH_GINI, STRONG_BIAS, HIGH_PAIRED = -0.5, 0.5, 0.2, 0.5
# End of fixed values.
#: What is said of a gene's values.
WHENS = ("initial", "final")
STATISTICS = ("count", "min", "max", "sum", "mean", "median", "sd", "gini")
#: Bases of a gene that one segment summary covers.
SEGMENT = 2048


def _rounder(digits: bool) -> Callable[[Column, int], Column]:
    return half_even if digits else (lambda c, _n: c.cast("double"))


def in_gene_insertions(
    counts: DataFrame, ann: DataFrame, initial: str, final: str,
    min_stop: float = GENE_STOP_DISTANCE, key: Sequence[str] = KEY,
) -> DataFrame:
    """In-gene annotation rows with their summed reads: the input of the gene statistics."""
    sums = replicate_sum(counts, initial, final, key)
    rows = in_gene_filter(ann, min_stop).filter(F.col(ID).isNotNull())
    return rows.join(sums, list(key), "inner")


def _sites(rows: DataFrame) -> DataFrame:
    """Gene x coordinate totals: distinct counts become plain sums one level up."""
    fwd = F.col("Insertion_direction") == "Forward"
    return rows.groupBy(ID, "Coordinate").agg(
        F.count(F.lit(1)).alias("n"),
        count_where(F.col("reads_initial") > 0).alias("seen_initial"),
        count_where(F.col("reads_final") > 0).alias("seen_final"),
        count_where(fwd).alias("fwd"),
        count_where(F.col("Insertion_direction") == "Reverse").alias("rev"),
        count_where(~F.coalesce(fwd, F.lit(False))).alias("not_fwd"),
        F.max("ParentalRegion_length").alias("len"),
    )


def gene_density(rows: DataFrame, rounded: bool = True) -> DataFrame:
    """Insertions, detected sites and densities per kilobase at both timepoints."""
    return _with_density(_sites(rows).groupBy(ID).agg(
        total("n").alias("total_insertions"),
        count_where(F.col("seen_initial") > 0).alias("unique_sites_initial"),
        count_where(F.col("seen_final") > 0).alias("unique_sites_final"),
        F.max("len").alias("gene_length"),
    ), rounded)


def _with_density(g: DataFrame, rounded: bool) -> DataFrame:
    r = _rounder(rounded)
    i, f, size = F.col("unique_sites_initial"), F.col("unique_sites_final"), F.col("gene_length")
    di = F.when(size > 0, i / size * 1000).otherwise(0.0)
    df = F.when(size > 0, f / size * 1000).otherwise(0.0)
    return g.withColumns(
        {
            "insertion_density_per_kb_initial": r(di, 3),
            "insertion_density_per_kb_final": r(df, 3),
            "insertion_density_change": r(df - di, 3),
            "insertion_density_log2fc": r(F.log2((f + 1) / (i + 1)), 3),
        }
    )


def gap_rows(rows: DataFrame) -> DataFrame:
    """Every uncovered stretch of a gene between its ends and its insertion sites."""
    ends = rows.groupBy(ID).agg(
        F.min("ParentalRegion_start").alias("_s"), F.min("ParentalRegion_end").alias("_e"),
        F.min("ParentalRegion_length").alias("_len"),
    )
    marks = rows.select(ID, "Coordinate").distinct().unionByName(
        ends.select(ID, F.explode(F.array("_s", "_e")).alias("Coordinate"))
    )
    steps = previous_value(marks, [ID], "Coordinate").withColumn(
        "gap", F.col("Coordinate") - F.col("previous") - 1
    )
    return join_keys(steps.filter(F.col("gap") > 0), ends.select(ID, "_len"), [ID]).select(
        ID, "Coordinate", "gap", half_even(F.col("gap") / F.col("_len"), 3).alias("gap_fraction")
    )


def _value_stats(long: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Moments, range, median and Gini of (id, stat, v) rows, one column set per stat.

    Everything comes from one table of distinct values with their ranks.
    """
    ranked = cumulative_counts(long, [ID, "stat"], "v")
    n, v, below = F.col("n"), F.col("v"), F.col("below")
    h = (F.col("total") - 1) * F.lit(0.5)

    def at(position: Column) -> Column:
        return F.max(F.when((below <= position) & (position < below + n), v))

    per = ranked.groupBy(ID, "stat").agg(
        F.sum("n").cast("bigint").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.sum(v * n).alias("sum"), F.sum(v * v * n).alias("squares"),
        F.sum(v * (n * below + n * (n + 1) / 2)).alias("ranked"),
        ((at(F.floor(h)) + at(F.ceil(h))) / 2).alias("median"),
    )
    size, mean = F.col("count"), F.col("sum") / F.col("count")
    spread = F.sqrt(F.greatest(F.col("squares") / size - mean * mean, F.lit(0.0)))
    per = per.withColumns({
        "mean": mean,
        "sd": F.when(F.col("min") == F.col("max"), F.lit(0.0)).otherwise(spread),
        "gini": gini_from_sums(size.cast("double"), F.col("sum"), F.col("ranked")),
    })
    return per.groupBy(ID).agg(
        *[F.max(F.when(F.col("stat") == s, F.col(c))).alias(f"_{s}_{c}") for s in labels for c in STATISTICS]
    )


def _long(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    cells = [F.struct(F.lit(s).alias("stat"), F.col(c).cast("double").alias("v")) for s, c in columns.items()]
    return rows.select(ID, F.inline(F.array(*cells)))


def _gap_columns(g: dict[str, Column], f: dict[str, Column], rounded: bool) -> list[Column]:
    """Report columns from the statistics of gaps and of their shares; a gene without a gap gets zeros."""
    r = _rounder(rounded)
    columns = {
        "num_gaps": g["count"],
        "largest_gap": g["max"].cast("bigint"), "largest_gap_fraction": f["max"],
        "smallest_gap": g["min"].cast("bigint"), "smallest_gap_fraction": f["min"],
        "mean_gap_length": r(g["mean"], 2), "mean_gap_length_fraction": r(f["mean"], 2),
        "median_gap_length": r(g["median"], 2), "median_gap_length_fraction": r(f["median"], 2),
        "gap_length_sd": r(g["sd"], 2), "gap_length_sd_fraction": r(f["sd"], 2),
    }
    return [*[F.coalesce(c, F.lit(0)).alias(n) for n, c in columns.items()], r(f["gini"], 3).alias("gini_coefficient_of_location")]


def gene_gaps(rows: DataFrame, rounded: bool = True, lists: bool = False) -> DataFrame:
    """Gap statistics per gene; genes without a gap get zeros and no Gini coefficient.

    ``lists`` adds all gaps as comma lists in coordinate order; such a list is at most as long
    as the gene has bases, and ``gap_rows`` has the same content as rows.
    """
    gaps = gap_rows(rows)
    stats = _value_stats(_long(gaps, {"gap": "gap", "share": "gap_fraction"}), ("gap", "share"))
    g = {c: F.col(f"_gap_{c}") for c in STATISTICS}
    f = {c: F.col(f"_share_{c}") for c in STATISTICS}
    out = rows.select(ID).distinct().join(stats, ID, "left").select(ID, *_gap_columns(g, f, rounded))
    if lists:
        out = out.join(_gap_lists(gaps), ID, "left").fillna("", ["all_gap_lengths", "all_gap_lengths_fraction"])
    return out


def _gap_lists(gaps: DataFrame) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("Coordinate", "gap", "gap_fraction")))
    return gaps.groupBy(ID).agg(items.alias("_l")).select(
        ID,
        F.array_join(F.transform("_l", lambda x: x["gap"].cast("string")), ",").alias("all_gap_lengths"),
        F.array_join(F.transform("_l", lambda x: x["gap_fraction"].cast("string")), ",")
        .alias("all_gap_lengths_fraction"),
    )


def gene_reads(rows: DataFrame, rounded: bool = True) -> DataFrame:
    """Depth per gene at both timepoints and how unevenly it is spread."""
    s = _value_stats(_long(rows, {w: f"reads_{w}" for w in WHENS}), WHENS)
    return s.select(ID, *_read_columns(rounded))


def _read_columns(rounded: bool) -> list[Column]:
    r, whens = _rounder(rounded), WHENS
    i, f = (F.col(f"_{w}_sum").cast("bigint") for w in whens)
    return [
        i.alias("total_reads_initial"), f.alias("total_reads_final"),
        *[r(F.col(f"_{w}_mean"), 2).alias(f"mean_reads_per_insertion_{w}") for w in whens],
        r(F.log2((f + 1) / (i + 1)), 3).alias("total_reads_log2fc"),
        *[r(F.col(f"_{w}_gini"), 3).alias(f"gini_coefficient_of_depth_{w}") for w in whens],
    ]


def gene_strand(rows: DataFrame, rounded: bool = True) -> DataFrame:
    """Direction counts, their bias, and sites hit in both directions."""
    g = _sites(rows).groupBy(ID).agg(
        total("fwd").alias("forward_insertions"),
        total("rev").alias("reverse_insertions"),
        total("n").alias("_n"),
        F.count(F.lit(1)).alias("_sites"),
        count_where((F.col("fwd") > 0) & (F.col("not_fwd") > 0)).alias("paired_sites"),
    )
    return g.select(ID, *_strand_columns(rounded))


def _strand_columns(rounded: bool) -> list[Column]:
    r = _rounder(rounded)
    fwd = safe_ratio(F.col("forward_insertions"), F.col("_n"))
    rev = safe_ratio(F.col("reverse_insertions"), F.col("_n"))
    return [
        F.col("forward_insertions"), F.col("reverse_insertions"),
        r(fwd, 3).alias("forward_preference"),
        r(rev, 3).alias("reverse_preference"),
        r(F.abs(fwd - 0.5), 3).alias("strand_bias"),
        F.col("paired_sites"),
        r(safe_ratio(F.col("paired_sites"), F.col("_sites")), 3).alias("paired_sites_fraction"),
    ]


def _counted(values: Column) -> Column:
    """Sorted values of one segment as (v, n) pairs of distinct ones; a segment's list is short."""
    distinct = F.array_sort(F.array_distinct(values))
    return F.transform(distinct, lambda v: F.struct(v.alias("v"), F.size(F.filter(values, lambda x: x == v)).cast("long").alias("n")))


def gene_segments(rows: DataFrame) -> DataFrame:
    """Mergeable summaries of SEGMENT bases of a gene: first and last site, counts, inner gaps and depths with how often each occurs.

    Two segments merge by adding counts and the gap between the last site of one and the first of the next.
    Both groupings are over bounded stretches: a site, then at most SEGMENT sites.
    """
    fwd = F.col("Insertion_direction") == "Forward"
    attributes = F.struct(*ATTRIBUTES)
    sites = rows.groupBy(ID, "Coordinate").agg(
        F.count(F.lit(1)).alias("n"), count_where(F.col("reads_initial") > 0).alias("seen_initial"), count_where(F.col("reads_final") > 0).alias("seen_final"),
        count_where(fwd).alias("fwd"), count_where(F.col("Insertion_direction") == "Reverse").alias("rev"), count_where(~F.coalesce(fwd, F.lit(False))).alias("not_fwd"),
        F.max("ParentalRegion_length").alias("len"), F.min("ParentalRegion_length").alias("min_len"), F.min("ParentalRegion_start").alias("s"),
        F.min("ParentalRegion_end").alias("e"), F.min(attributes).alias("a"),
        *[F.collect_list(F.col(f"reads_{w}").cast("double")).alias(w) for w in WHENS])
    place = F.array_sort(F.collect_list("Coordinate"))
    segments = sites.groupBy(ID, F.floor(F.col("Coordinate") / SEGMENT).alias("segment")).agg(
        place.alias("at"), total("n").alias("n"), count_where(F.col("seen_initial") > 0).alias("seen_initial"), count_where(F.col("seen_final") > 0).alias("seen_final"),
        total("fwd").alias("fwd"), total("rev").alias("rev"), F.count(F.lit(1)).alias("sites"), count_where((F.col("fwd") > 0) & (F.col("not_fwd") > 0)).alias("paired"),
        F.max("len").alias("len"), F.min("min_len").alias("min_len"), F.min("s").alias("s"), F.min("e").alias("e"), F.min("a").alias("a"),
        *[F.flatten(F.collect_list(w)).alias(w) for w in WHENS])
    gaps = F.filter(F.zip_with(F.slice("at", 2, F.size("at")), F.slice("at", 1, F.greatest(F.size("at") - 1, F.lit(0))),
                               lambda b, a: (b - a - 1).cast("double")), lambda g: g > 0)
    return segments.select(
        ID, "segment", F.element_at("at", 1).alias("first"), F.element_at("at", -1).alias("last"), "n", "seen_initial", "seen_final", "fwd", "rev", "sites",
        "paired", "len", "min_len", "s", "e", "a", _counted(gaps).alias("gap"), *[_counted(F.col(w)).alias(w) for w in WHENS])


def _distribution(values: Column) -> Column:
    """STATISTICS of a sorted array of (v, n) pairs."""
    zero = F.struct(F.lit(0).cast("long").alias("count"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares"), F.lit(0.0).alias("ranked"))

    def add(a: Column, x: Column) -> Column:
        v, n, below = x["v"], x["n"].cast("double"), a["count"].cast("double")
        return F.struct((a["count"] + x["n"]).alias("count"), (a["sum"] + v * n).alias("sum"), (a["squares"] + v * v * n).alias("squares"),
                        (a["ranked"] + v * (n * below + n * (n + 1) / 2)).alias("ranked"))

    def at(position: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("double").alias("v"))
        seek = lambda a, x: F.struct((a["below"] + x["n"]).alias("below"), F.when(
            (a["below"] <= position) & (position < a["below"] + x["n"]), x["v"]).otherwise(a["v"]).alias("v"))
        return F.aggregate(values, start, seek)["v"]

    sums = F.aggregate(values, zero, add)
    return F.struct(sums.alias("s"), F.get(values, F.lit(0))["v"].alias("min"), F.element_at(values, -1)["v"].alias("max"),
                    ((at(F.floor((sums["count"] - 1) / 2)) + at(F.ceil((sums["count"] - 1) / 2))) / 2).alias("median"))


def _with_distributions(df: DataFrame, arrays: dict[str, Column]) -> DataFrame:
    """Adds ``_<name>_<statistic>`` columns of sorted (v, n) arrays."""
    df = df.withColumns({f"_d_{name}": F.when(F.size(values) > 0, _distribution(values)) for name, values in arrays.items()})
    out = {}
    for name in arrays:
        d = F.col(f"_d_{name}")
        size, mean = d["s"]["count"], d["s"]["sum"] / d["s"]["count"]
        spread = F.sqrt(F.greatest(d["s"]["squares"] / size - mean * mean, F.lit(0.0)))
        figures = {"count": size, "min": d["min"], "max": d["max"], "sum": d["s"]["sum"], "mean": mean, "median": d["median"],
                   "sd": F.when(d["min"] == d["max"], F.lit(0.0)).otherwise(spread), "gini": gini_from_sums(size.cast("double"), d["s"]["sum"], d["s"]["ranked"])}
        out |= {f"_{name}_{c}": figures[c] for c in STATISTICS}
    return df.withColumns(out).drop(*[f"_d_{name}" for name in arrays])


def _of_kind(kind: str, pairs: str) -> Column:
    return F.transform(pairs, lambda x: F.struct(F.lit(kind).alias("kind"), x["v"].alias("v"), x["n"].alias("n")))


def gene_density_report(
    counts: DataFrame, ann: DataFrame, initial: str, final: str,
    min_stop: float = GENE_STOP_DISTANCE, key: Sequence[str] = KEY, rounded: bool = True,
    lists: bool = False,
) -> DataFrame:
    """One row per gene: attributes, density, gaps, depth and strand statistics.

    The insertions are scanned once, into stored segment summaries; everything comes from merging those. Of a
    gene's gaps and depths only distinct values with their numbers meet: with gaps adding up to the gene's
    length and depths to its reads, their number grows with the root of those.
    """
    rows = in_gene_insertions(counts, ann, initial, final, min_stop, key)
    if lists:
        rows = checkpointed(rows)
    segments = checkpointed(gene_segments(rows))
    kinds = {"gap": "gap", **{w: w for w in WHENS}}
    pairs = segments.select(ID, F.inline(F.concat(*[_of_kind(k, c) for k, c in kinds.items()])))
    pair = F.struct("v", F.col("n").alias("n"))
    values = pairs.groupBy(ID, "kind", "v").agg(F.sum("n").alias("n")).groupBy(ID).agg(
        *[F.array_sort(F.collect_list(F.when(F.col("kind") == k, pair))).alias(f"_v_{k}") for k in kinds])
    ends = F.array_sort(F.collect_list(F.struct("first", "last")))
    genes = segments.groupBy(ID).agg(
        ends.alias("_ends"), total("n").alias("total_insertions"), total("seen_initial").alias("unique_sites_initial"), total("seen_final").alias("unique_sites_final"),
        F.max("len").alias("gene_length"), F.min("min_len").alias("_len"), F.min("s").alias("_s"), F.min("e").alias("_e"), F.min("a").alias("_a"),
        total("fwd").alias("forward_insertions"), total("rev").alias("reverse_insertions"), total("n").alias("_n"), total("sites").alias("_sites"),
        total("paired").alias("paired_sites")).join(values, ID)
    # The gene's ends stand among the sites: between segments, and around them, their gaps are still to be added.
    marks = F.array_sort(F.concat("_ends", F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("first"), F.col(c).alias("last"))) for c in ("_s", "_e")]))))
    genes = genes.withColumn("_marks", marks)
    return _report_columns(genes, rows, rounded, lists)


def _report_columns(genes: DataFrame, rows: DataFrame, rounded: bool, lists: bool) -> DataFrame:
    between = F.filter(F.zip_with(F.slice("_marks", 2, F.size("_marks")), F.slice("_marks", 1, F.greatest(F.size("_marks") - 1, F.lit(0))),
                                  lambda b, a: (b["first"] - a["last"] - 1).cast("double")), lambda g: g > 0)
    one = F.transform(between, lambda g: F.struct(g.alias("v"), F.lit(1).cast("long").alias("n")))
    genes = genes.withColumn("_v_gap", F.array_sort(F.concat("_v_gap", one)))
    share = F.array_sort(F.transform("_v_gap", lambda x: F.struct(half_even(x["v"] / F.col("_len"), 3).alias("v"), x["n"].alias("n"))))
    genes = genes.withColumn("_v_share", F.filter(share, lambda x: x["v"].isNotNull()))
    genes = _with_distributions(genes, {c: F.col(f"_v_{c}") for c in ("gap", "share", *WHENS)})
    g, f = ({c: F.col(f"_{k}_{c}") for c in STATISTICS} for k in ("gap", "share"))
    out = _with_density(genes, rounded).select(
        ID, F.col("_a.Name").alias("Name"), F.col("_a.Chr_Interval").alias("Chr"), F.col("_a.ParentalRegion_start").alias("Start"),
        F.col("_a.ParentalRegion_end").alias("End"), F.col("_a.ParentalRegion_length").alias("Length"), F.col("_a.Strand_Interval").alias("Strand"),
        F.col("_a.FYPOviability").alias("FYPOviability"), "total_insertions", "unique_sites_initial", "unique_sites_final", "gene_length",
        *[f"insertion_density_{c}" for c in ("per_kb_initial", "per_kb_final", "change", "log2fc")],
        *_gap_columns(g, f, rounded), *_read_columns(rounded), *_strand_columns(rounded))
    if lists:
        out = out.join(_gap_lists(gap_rows(rows)), ID, "left").fillna("", ["all_gap_lengths", "all_gap_lengths_fraction"])
    return out


def density_summary(report: DataFrame) -> DataFrame:
    """Whole-table statistics over the gene report, one row."""
    plain = report.agg(
        F.count(F.lit(1)).alias("total_genes_analyzed"),
        total("total_insertions").alias("total_insertions_analyzed"),
        total("unique_sites_initial").alias("total_unique_sites_initial"),
        total("unique_sites_final").alias("total_unique_sites_final"),
        F.avg("total_insertions").alias("mean_insertions_per_gene"),
        F.avg("insertion_density_per_kb_initial").alias("mean_insertion_density_per_kb_initial"),
        F.avg("insertion_density_per_kb_final").alias("mean_insertion_density_per_kb_final"),
        F.avg("insertion_density_log2fc").alias("mean_insertion_density_log2fc"),
        count_where(F.col("insertion_density_log2fc") < DENSITY_DROP).alias("genes_with_density_drop"),
        F.avg("gini_coefficient_of_location").alias("mean_gini_coefficient_of_location"),
        count_where(F.col("gini_coefficient_of_location") > HIGH_GINI)
        .alias("genes_with_high_inequality_of_location"),
        F.avg("gini_coefficient_of_depth_initial").alias("mean_gini_coefficient_of_depth_initial"),
        count_where(F.col("gini_coefficient_of_depth_initial") > HIGH_GINI)
        .alias("genes_with_high_inequality_of_depth"),
        F.avg("strand_bias").alias("mean_strand_bias"),
        count_where(F.col("strand_bias") > STRONG_BIAS).alias("genes_with_strong_strand_bias"),
        F.avg("paired_sites_fraction").alias("mean_paired_sites_fraction"),
        count_where(F.col("paired_sites_fraction") > HIGH_PAIRED)
        .alias("genes_with_high_paired_sites_fraction"),
    ).withColumn("_one", F.lit(1))
    medians = {
        "median_insertions_per_gene": "total_insertions",
        "median_insertion_density_per_kb_initial": "insertion_density_per_kb_initial",
        "median_insertion_density_per_kb_final": "insertion_density_per_kb_final",
    }
    long = report.select(
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("stat"), F.col(c).cast("double").alias("v"))
                      for n, c in medians.items()])
        ).alias("s")
    ).select("s.stat", "s.v")
    med = exact_quantile(long, ["stat"], "v", {"m": 0.5}).groupBy(F.lit(1).alias("_one")).agg(
        *[F.max(F.when(F.col("stat") == n, F.col("m"))).alias(n) for n in medians]
    )
    return plain.join(med, "_one", "left").drop("_one")
