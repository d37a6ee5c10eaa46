"""Read pairs to the filtered long count table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hopscan.config import SITE, RunConfig
from hopscan.operators.annotation import target_sequence
from hopscan.operators.reads import filter_read_pairs
from hopscan.operators.sites import (
    concat_timepoints, count_insertions, hard_filter, merge_similar_timepoints,
)


def raw_counts(
    pairs: DataFrame, cfg: RunConfig, tiles: DataFrame | None = None, tile_width: int = 0
) -> DataFrame:
    """Every site of a sample with every timepoint, timepoints merged, target attached."""
    merged = count_insertions(filter_read_pairs(pairs, cfg.pair_filter))
    counts = concat_timepoints(merged, cfg.timepoints)
    if cfg.similar:
        counts = merge_similar_timepoints(
            counts, cfg.similar, cfg.merged_name, cfg.dropped, key=SITE
        )
    if tiles is not None:
        sites = target_sequence(counts.select(*SITE).distinct(), tiles, tile_width)
        counts = counts.join(sites, list(SITE))
    key = [k for k in cfg.key if k in counts.columns]
    return counts.select(*key, "Sample", "Timepoint", F.col("Reads"))


def reads_to_counts(
    pairs: DataFrame, cfg: RunConfig, tiles: DataFrame | None = None, tile_width: int = 0
) -> DataFrame:
    """Filter, extract, merge ends, fill timepoints and keep insertions seen well at the start.

    Two shuffles: reads by (library, site), then the small site table by (sample, site), whose
    partitioning also serves the hard filter.
    """
    counts = raw_counts(pairs, cfg, tiles, tile_width)
    key = [k for k in cfg.key if k in counts.columns]
    return hard_filter(counts, cfg.initial, cfg.cutoff, key, cfg.timepoints)
