"""Interval joins and interval algebra on (Chr, Start, End), 0-based half-open.

Range predicates never stand alone: both sides are cut into fixed bins, so every join is an
equi-join on (Chr, bin) with the range test as residual and shuffles or broadcasts as Spark
sees fit. A pair that meets in several bins is kept in the bin of its later start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from hopscan.functions.labels import orientation_label
from hopscan.operators.ordered import keep_first, running_max

BIN_WIDTH = 10_000


def with_bins(df: DataFrame, start: str, end: str, width: int = BIN_WIDTH) -> DataFrame:
    """One row per bin an interval touches, both ends included."""
    first, last = F.floor(F.col(start) / width), F.floor(F.col(end) / width)
    return df.withColumn("_bin", F.explode(F.sequence(first, F.greatest(first, last))))


def point_interval_join(
    points: DataFrame, regions: DataFrame, point: str, start: str, end: str,
    chrom: str = "Chr", region_chrom: str = "Chr", width: int = BIN_WIDTH,
) -> DataFrame:
    """All (point, interval) matches, both interval ends included. Column names must differ."""
    left = points.withColumn("_bin", F.floor(F.col(point) / width))
    right = with_bins(regions, start, end, width).withColumnRenamed("_bin", "_rbin")
    hit = (
        (F.col(chrom) == F.col(region_chrom))
        & (F.col("_bin") == F.col("_rbin"))
        & (F.col(point) >= F.col(start))
        & (F.col(point) <= F.col(end))
    )
    return left.join(right, hit, "inner").drop("_bin", "_rbin")


def interval_complement(features: DataFrame, sizes: DataFrame) -> DataFrame:
    """Gaps between features on every contig, contigs without features included.

    ``sizes`` is (Chr, length).
    """
    spans = features.select("Chr", "Start", "End").distinct()
    seen = running_max(spans, ["Chr"], "Start", "End", "_prev", ties=["End"])
    prev = F.coalesce(F.col("_prev"), F.lit(0))
    inner = seen.filter(F.col("Start") > prev).select(
        "Chr", prev.cast("bigint").alias("Start"), F.col("Start").alias("End")
    )
    reach = spans.groupBy("Chr").agg(F.max("End").alias("_reach"))
    tail_start = F.coalesce(F.col("_reach"), F.lit(0)).cast("bigint")
    tails = (
        sizes.join(reach, "Chr", "left")
        .filter(tail_start < F.col("length"))
        .select("Chr", tail_start.alias("Start"), F.col("length").cast("bigint").alias("End"))
    )
    return inner.unionByName(tails)


def interval_self_overlap(spans: DataFrame, width: int = BIN_WIDTH) -> DataFrame:
    """Overlaps of spans of different transcripts; one row per overlap interval.

    ``spans`` has Chr, Start, End, Transcript, Systematic_ID, Strand. Self-hits are excluded
    before duplicates of an overlap interval are reduced to the first pair.
    """
    cols = ["Chr", "Start", "End", "Transcript", "Systematic_ID", "Strand"]
    binned = with_bins(spans.select(*cols).distinct(), "Start", "End", width)
    a = binned.select(*[F.col(c).alias(f"a_{c}") for c in [*cols, "_bin"]])
    b = binned.select(*[F.col(c).alias(f"b_{c}") for c in [*cols, "_bin"]])
    start = F.greatest("a_Start", "b_Start")
    earlier = F.struct("a_Start", "a_End", "a_Transcript") < F.struct(
        F.col("b_Start").alias("a_Start"), F.col("b_End").alias("a_End"),
        F.col("b_Transcript").alias("a_Transcript"),
    )
    pairs = a.join(
        b,
        (F.col("a_Chr") == F.col("b_Chr"))
        & (F.col("a__bin") == F.col("b__bin"))
        & (F.col("a_Start") < F.col("b_End"))
        & (F.col("b_Start") < F.col("a_End"))
        & (F.col("a_Transcript") != F.col("b_Transcript"))
        & earlier
        & (F.col("a__bin") == F.floor(start / width)),
    )

    def both(c: str):
        return F.concat_ws(",", f"a_{c}", f"b_{c}")

    found = pairs.select(
        F.col("a_Chr").alias("Chr"),
        start.alias("Start"),
        F.least("a_End", "b_End").alias("End"),
        both("Transcript").alias("Transcript"),
        both("Strand").alias("Strand"),
        F.lit("Overlapping genes").alias("Feature"),
        both("Systematic_ID").alias("Systematic_ID"),
        *[F.col(c) for c in ("a_Start", "a_End", "a_Transcript", "b_Start", "b_End", "b_Transcript")],
    )
    first = keep_first(
        found, ["Chr", "Start", "End"],
        ["a_Start", "a_End", "a_Transcript", "b_Start", "b_End", "b_Transcript"],
    )
    return first.select(
        "Chr", "Start", "End", "Transcript", "Strand", "Feature", "Systematic_ID",
        (F.col("End") - F.col("Start")).alias("Length"),
    )


def interval_subtract(
    a: DataFrame, b: DataFrame, expand: int = 200, keys: Sequence[str] = ("Systematic_ID",),
    width: int = BIN_WIDTH,
) -> DataFrame:
    """Parts of ``a`` not covered by ``b`` widened by ``expand`` bases on each side.

    (Chr, Start, End, *keys) identifies a row of ``a``; the columns of ``a`` are kept.
    """
    ident = ["Chr", "Start", "End", *keys]
    wide = b.select(
        F.col("Chr").alias("_c"),
        F.greatest(F.col("Start") - expand, F.lit(0)).alias("_s"),
        (F.col("End") + expand).alias("_e"),
    ).distinct()
    left = with_bins(a.select(*ident).distinct(), "Start", "End", width)
    right = with_bins(wide, "_s", "_e", width).withColumnRenamed("_bin", "_b")
    hits = left.join(
        right,
        (F.col("Chr") == F.col("_c"))
        & (F.col("_bin") == F.col("_b"))
        & (F.col("Start") < F.col("_e"))
        & (F.col("_s") < F.col("End"))
        & (F.col("_bin") == F.floor(F.greatest("Start", "_s") / width)),
    ).select(*ident, "_s", "_e")
    # An empty cover at its own start makes every row of ``a`` take part.
    none = a.select(*ident, F.col("Start").alias("_s"), F.col("Start").alias("_e")).distinct()
    order = W.partitionBy(*ident).orderBy("_s", "_e")
    reach = F.greatest(
        F.col("Start"),
        F.max("_e").over(order.rowsBetween(W.unboundedPreceding, -1)),
    )
    covers = hits.unionByName(none).withColumns(
        {"_from": reach, "_last": F.lead("_s").over(order).isNull()}
    )
    pieces = F.array(
        F.struct(F.col("_from").alias("s"), F.col("_s").alias("e")),
        F.struct(
            F.greatest("_from", "_e").alias("s"),
            F.when(F.col("_last"), F.col("End")).alias("e"),
        ),
    )
    cut = (
        covers.select(*ident, F.explode(pieces).alias("_p"))
        .filter(F.col("_p.s") < F.col("_p.e"))
        .select(*ident, F.col("_p.s").alias("_ns"), F.col("_p.e").alias("_ne"))
    )
    out = a.join(cut, ident)
    return out.select(
        *[
            F.col("_ns").alias("Start") if c == "Start"
            else F.col("_ne").alias("End") if c == "End"
            else F.col(c)
            for c in a.columns
        ]
    )


def flank_lookup(gaps: DataFrame, features: DataFrame) -> DataFrame:
    """Neighbours of a gap: ids and strands joined by ``|``, and the orientation of the two."""
    ids = ["Transcript", "Systematic_ID", "Strand"]
    order = ["Start", "End", "Transcript"]
    left = keep_first(features, ["Chr", "End"], order).select(
        "Chr", F.col("End").alias("Start"), *[F.col(c).alias(f"l_{c}") for c in ids]
    )
    right = keep_first(features, ["Chr", "Start"], order).select(
        "Chr", F.col("Start").alias("End"), *[F.col(c).alias(f"r_{c}") for c in ids]
    )
    sided = gaps.join(left, ["Chr", "Start"], "left").join(right, ["Chr", "End"], "left")
    for c in ids:
        for side in ("l", "r"):
            name = f"{side}_{c}"
            sided = sided.withColumn(name, F.coalesce(F.col(name), F.lit("Boundary")))
    label = orientation_label(F.col("l_Strand"), F.col("r_Strand"))
    return sided.select(
        *gaps.columns,
        *[F.concat_ws("|", f"l_{c}", f"r_{c}").alias(c) for c in ids],
        F.concat(label, F.lit("_Region")).alias("Feature"),
    )
