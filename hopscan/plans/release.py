"""What the scoring plans return, as the tables of a release."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from hopscan.config import RunConfig
from hopscan.operators import curves as cv, genes as gn, replicates as rp
from hopscan.session import checkpointed
from hopscan.sources.sinks import wide_matrix, write_release

Labels = Sequence[tuple[str, str]]


def fit_tables(report: DataFrame, level: str, ids: Sequence[str]) -> dict[str, DataFrame]:
    """A fit report as three tables: parameters and shape, fitted scores, and the summary of all."""
    return {
        f"{level}_fitting_statistics": report.drop("points"),
        f"{level}_fitting_LFCs": cv.fitted_values(report, ids),
        f"{level}_fitting_results": cv.fit_summary(report),
    }


def release_tables(
    results: dict[str, DataFrame], counts: DataFrame, ann: DataFrame, cfg: RunConfig, labels: Labels
) -> dict[str, DataFrame]:
    """Tables by release name from the results of ``score_no_replicates`` or ``score_replicates``.

    ``labels`` are the (sample, timepoint) columns of wide tables. Which branch it was shows in the results.
    """
    key, scores = cfg.key, results["scores"]
    replicates = "imputed" in results
    by_statistic = rp.split_statistics(scores, key)
    out = {
        "raw_reads": wide_matrix(counts, labels, key=key), "annotations": ann,
        "LFC": by_statistic["LFC"], "baseMean": by_statistic["baseMean"],
    }
    if replicates:
        imputed = results["imputed"].drop("imputed")
        out |= {
            "normed_counts": wide_matrix(results["normalized_counts"], labels, key=key, value="normed"),
            "imputed_raw_reads": wide_matrix(imputed, labels, key=key), "padj": by_statistic["padj"],
            "insertion_level_statistics": scores, "imputation_statistics": results["imputation_statistics"],
        }
    else:
        out["normed_counts"] = wide_matrix(scores, labels, key=key, value="normed")
    if "fits" in results:
        ids = [*key] if replicates else [*key, "Sample"]
        genes = [c for c in results["genes"].columns if c in ("Sample", *gn.GENE)]
        # Without replicates the fits are a table already.
        fits = checkpointed(results["fits"]) if replicates else results["fits"]
        out |= fit_tables(fits, "insertion_level", ids)
        out |= fit_tables(checkpointed(results["gene_fits"]), "gene_level", genes)
        weights = scores.select(*key, "Timepoint", F.coalesce("padj", F.lit(1.0)).alias("weight")) if replicates else results["weights"]
        out |= {"transformed_weights": weights, "gene_LFC": results["genes"]}
    return out


def release(
    results: dict[str, DataFrame], counts: DataFrame, ann: DataFrame, cfg: RunConfig, labels: Labels, path: str
) -> list[str]:
    """Write the release of a scoring run; the targets depend on its branch and on whether curves were fitted."""
    tables = release_tables(results, counts, ann, cfg, labels)
    return write_release(tables, path, has_replicates="imputed" in results, has_time_points="fits" in results)
