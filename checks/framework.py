"""Registry of checked queries and the inputs they share."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import BOUNDARY, CUTOFF, GENERATIONS, TIMEPOINTS, Source, with_views
from hopscan.config import SITE, RunConfig
from hopscan.operators import annotation as an, reads as rd, scoring as sc, sites as st
from hopscan.session import checkpointed, shared_folder
from hopscan.sources.alignments import parse_alignments
from hopscan.sources.genome import gff_from_lines

Query = Callable[["Inputs"], DataFrame]

CONFIG = RunConfig(
    timepoints=TIMEPOINTS, initial="YES0", final="YES4", cutoff=CUTOFF, generations=GENERATIONS,
    boundary_distance=BOUNDARY, key=SITE,
)


@dataclass(frozen=True)
class Check:
    query: Query
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query with the SQL that must give the same rows (None: rows only)."""

    def add(query: Query) -> Query:
        if name in CHECKS:
            raise ValueError(f"duplicate query {name}")
        CHECKS[name] = Check(query, with_views(sql) if sql else None)
        return query

    return add


def R(expr: str, digits: int = 6) -> str:
    """Rounded double in SQL; adding zero removes negative zero."""
    return f"(round(cast({expr} as double), {digits}) + cast(0 as double))"


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """The same on the Spark side, for every double column."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    if not doubles:
        return df
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) + F.lit(0.0) for c in doubles})


class Inputs(Source):
    """Views plus the intermediate tables built by the operators themselves."""

    @cached_property
    def reads(self) -> DataFrame:
        return self["v_reads"]

    @cached_property
    def filtered(self) -> DataFrame:
        return rd.filter_read_pairs(self.reads)

    @cached_property
    def sites(self) -> DataFrame:
        return st.site_count(self.filtered)

    @cached_property
    def merged(self) -> DataFrame:
        return st.count_insertions(self.filtered)

    @cached_property
    def counts(self) -> DataFrame:
        return st.concat_timepoints(self.merged, TIMEPOINTS)

    @cached_property
    def hard(self) -> DataFrame:
        return st.hard_filter(self.counts, "YES0", CUTOFF, SITE)

    @cached_property
    def series(self) -> DataFrame:
        """Log2 depletion of every insertion and sample, without normalisation."""
        start = sc.baseline(F.col("Reads"), "YES0", SITE)
        return self.hard.select(
            *SITE, "Sample", "Timepoint", F.log2((start.cast("double") + 1) / (F.col("Reads") + 1)).alias("LFC")
        )

    @cached_property
    def points(self) -> DataFrame:
        return self.merged.select(*SITE).distinct()

    @cached_property
    def regions(self) -> DataFrame:
        return self["v_regions"].withColumnRenamed("End_", "End")

    @cached_property
    def annotated(self) -> DataFrame:
        return an.annotate_points(self.points, self.regions)

    @cached_property
    def ann(self) -> DataFrame:
        return an.boundary_dedup(self.annotated)

    @cached_property
    def controls(self) -> DataFrame:
        return sc.select_controls(self.stored_hard, self.stored_ann, BOUNDARY, SITE)

    @cached_property
    def stored(self) -> Inputs:
        """Inputs whose insertions are a table: counts and annotation both come from it, not from the reads."""
        other = Inputs(self.spark, self.sf_dir)
        other.merged = checkpointed(self.merged)
        return other

    @cached_property
    def stored_hard(self) -> DataFrame:
        """The filtered counts as a table, as scoring runs find them."""
        return checkpointed(self.stored.hard)

    @cached_property
    def stored_ann(self) -> DataFrame:
        return checkpointed(self.stored.ann)

    @cached_property
    def alignments(self) -> DataFrame:
        return parse_alignments(self["v_sam"])

    @cached_property
    def gff(self) -> DataFrame:
        # Stored once: most region queries read it several times.
        return checkpointed(gff_from_lines(self["v_gff"]))

    @cached_property
    def scratch(self) -> str:
        """A new folder on shared storage for files this query derives."""
        return f"{shared_folder(self.spark)}/derived/{uuid.uuid4().hex}"


def spark_query(item: Check) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(item.query(Inputs(spark, sf_dir)))

    return run
