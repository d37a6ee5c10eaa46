"""Counts and annotation to insertion and gene scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hopscan.config import GENE_STOP_DISTANCE, RunConfig
from hopscan.operators import curves as cv, genes as gn, replicates as rp, scoring as sc
from hopscan.operators.scoring import in_gene_keys
from hopscan.operators.sites import complete_cases, semi_keys
from hopscan.session import checkpointed


def weighted_gene_scores(
    lfc: DataFrame, weights: DataFrame, ann: DataFrame, key: tuple[str, ...],
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Gene scores of insertions with an in-gene annotation; all their annotations count."""
    inside = in_gene_keys(ann, GENE_STOP_DISTANCE, key)
    joined = gn.join_lfc_weights(semi_keys(lfc, inside, key=key), weights, (*key, *by))
    return gn.gene_lfc(gn.join_annotations(joined, ann, key), by=by)


def fit_genes(genes: DataFrame, cfg: RunConfig) -> DataFrame:
    ids = [c for c in genes.columns if c in ("Sample", *gn.GENE)]
    return cv.fit_report(cv.curve_table(genes, ids, cfg.generations), cfg.generations)


def score_no_replicates(counts: DataFrame, ann: DataFrame, cfg: RunConfig) -> dict[str, DataFrame]:
    """Median scaling, one curve per insertion and sample, fit quality as weight, gene curves."""
    key = cfg.key
    # Both tables are small next to the reads they come from and are used several times.
    counts, ann = checkpointed(counts), checkpointed(ann)
    # Scores, fits and genes all need them: computed once.
    controls = checkpointed(sc.select_controls(counts, ann, cfg.boundary_distance, key))
    scores = checkpointed(sc.ma_scores(counts, controls, cfg.initial, key))
    out = {"controls": controls, "scores": scores}
    if not cfg.generations:
        return out
    ids = (*key, "Sample")
    # Fits feed the report, the weights and the gene table: compute them once.
    fits = checkpointed(cv.fit_report(cv.curve_table(scores, ids, cfg.generations), cfg.generations))
    weights = gn.r2_weights(fits, cfg.timepoints, ids)
    genes = weighted_gene_scores(scores, weights, ann, key, ("Sample",))
    return out | {
        "fits": fits, "weights": weights, "genes": genes, "gene_fits": fit_genes(genes, cfg),
    }


def score_replicates(counts: DataFrame, ann: DataFrame, cfg: RunConfig) -> dict[str, DataFrame]:
    """Opposite-strand filling, the replicate model, adjusted p as weight, gene curves."""
    key = cfg.key
    counts, ann = checkpointed(counts), checkpointed(ann)
    imputed = checkpointed(sc.impute_opposite_strand(counts, ann, key=key))
    full = imputed.drop("imputed")
    controls = checkpointed(sc.select_controls(full, ann, cfg.boundary_distance, key))
    # Weights, fits, genes and reports all start from the scores: stored once.
    scores = checkpointed(rp.replicate_scores(full, controls, cfg.initial, key=key, details=True))
    # An insertion left out of the adjustment weighs as one with p = 1.
    weights = scores.select(*key, "Timepoint", F.coalesce("padj", F.lit(1.0)).alias("weight"))
    lfc = scores.select(*key, "Timepoint", "LFC")
    genes = checkpointed(weighted_gene_scores(lfc, weights, ann, key))
    out = {
        "imputed": imputed, "imputation_statistics": sc.imputation_stats(imputed, cfg.initial, key),
        "controls": controls, "scores": scores, "genes": genes,
        "normalized_counts": rp.normalized_counts(full, sc.size_factors(complete_cases(full, key=key), controls, key)),
    }
    if not cfg.generations:
        return out
    fits = cv.fit_report(cv.curve_table(lfc, key, cfg.generations), cfg.generations)
    return out | {"fits": fits, "gene_fits": fit_genes(genes, cfg)}
