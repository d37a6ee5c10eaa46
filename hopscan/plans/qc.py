"""All library-level quality figures of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hopscan.config import SITE, RunConfig
from hopscan.operators import quality as ql, summaries as sm
from hopscan.operators.reads import pair_condition
from hopscan.operators.sites import LIBRARY, insertions_of, site_table
from hopscan.session import checkpointed


def qc_report(
    pairs: DataFrame, counts: DataFrame, cfg: RunConfig, aln: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Retention, site, merge and correlation figures per library, and their roll-up.

    ``counts`` is the unfiltered long table; ``aln`` adds alignment figures and needs the
    library columns.
    """
    key = [k for k in cfg.key if k in counts.columns] or list(SITE)
    # The reads are scanned once, when this is called: all their figures come from stored site counts.
    sites = checkpointed(site_table(pairs, pair_condition(cfg.pair_filter)))
    merged = insertions_of(sites)
    tables = {
        "retention": sm.retention_of(sites),
        "sites": sm.site_stats_of(sites, LIBRARY),
        "merge": sm.merge_summary(merged, LIBRARY),
        "ends": ql.pair_correlation(merged, "PBL", "PBR", LIBRARY),
        "orientation": ql.orientation_correlation(counts, key),
        "cutoff": sm.cutoff_retention(counts, cfg.initial, cfg.cutoff, key),
        "histogram": ql.log_histogram(counts, ["Reads"], by=LIBRARY),
    }
    per_library = [
        tables["retention"],
        tables["sites"],
        tables["merge"].select(*LIBRARY, "total_reads", "pbl_share", "pbr_share"),
        tables["ends"].select(*LIBRARY, *[_named(c, "ends") for c in ("points", "pearson")]),
        tables["orientation"].select(
            *LIBRARY, *[_named(c, "orientation") for c in ("points", "pearson")]
        ),
    ]
    if aln is not None:
        tables["flags"] = ql.flagstat(aln, LIBRARY)
        tables["insert_size"] = ql.insert_size_metrics(aln, LIBRARY)
        per_library += [tables["flags"], tables["insert_size"]]
    return tables | {"rollup": ql.qc_rollup(per_library, LIBRARY)}


def _named(column: str, prefix: str) -> Column:
    return F.col(column).alias(f"{prefix}_{column}")
