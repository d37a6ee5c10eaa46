"""Depletion scores with biological replicates: negative-binomial model per insertion.

The per-insertion work runs in Arrow batches over a table with one row per insertion and one
column per library. What insertions share (size factors, the dispersion trend, the prior
width) comes from aggregations; only those few numbers reach the driver. Two checkpoints keep
a lost executor from repeating the whole chain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hopscan.config import KEY
from hopscan.functions.statistics import half_even
from hopscan.operators import nbinom as nb
from hopscan.operators.ordered import bh_adjust, cumulative_counts, exact_quantile, join_keys
from hopscan.operators.scoring import size_factors
from hopscan.operators.sites import LIBRARY, complete_cases
from hopscan.session import checkpointed, spread as spread_rows

# Constants of the dispersion trend, the prior and the outlier rule.
NORMAL_Q75 = 0.6744897501960817
TREND_RATIO_LOW, TREND_RATIO_HIGH = 1e-4, 15.0
MIN_PRIOR_VAR = 0.25
OUTLIER_SD = 2.0
COOKS_QUANTILE = 0.99
REPLACE_TRIM = 0.2
# Filtering by mean count before adjustment: level, cut-offs, top quantile, rejections that count.
FILTER_LEVEL, FILTER_CUTOFFS, FILTER_TOP, FEW_REJECTIONS = 0.05, 50, 0.95, 10
SCORE_DIGITS = {"baseMean": 3, "LFC": 3, "lfcSE": 3, "stat": 3, "pvalue": 6, "padj": 6}
# End of fixed values.


@dataclass(frozen=True)
class Libraries:
    """The libraries of a run: one entry per (sample, timepoint)."""

    samples: tuple[str, ...]
    labels: tuple[str, ...]
    sizes: tuple[float, ...]
    conditions: tuple[str, ...]

    @property
    def groups(self) -> np.ndarray:
        return np.array([self.conditions.index(t) for t in self.labels])

    @property
    def columns(self) -> list[str]:
        return [f"k_{i}" for i in range(len(self.labels))]


def collect_libraries(factors: DataFrame, initial: str) -> Libraries:
    """Size factors of all libraries (a handful of rows) with the initial condition first."""
    rows = sorted((r["Timepoint"], r["Sample"], r["size_factor"]) for r in factors.collect())
    conditions = sorted({t for t, _, _ in rows} - {initial})
    if initial not in {t for t, _, _ in rows}:
        raise ValueError(f"unknown initial timepoint {initial!r}")
    return Libraries(
        tuple(s for _, s, _ in rows), tuple(t for t, _, _ in rows),
        tuple(float(f) for _, _, f in rows), (initial, *conditions),
    )


def count_table(counts: DataFrame, libs: Libraries, key: Sequence[str] = KEY) -> DataFrame:
    """One row per insertion, one column per library."""
    cells = [
        F.max(F.when((F.col("Sample") == s) & (F.col("Timepoint") == t), F.col("Reads")))
        .cast("double").alias(c)
        for s, t, c in zip(libs.samples, libs.labels, libs.columns)
    ]
    return counts.groupBy(*key).agg(*cells)


def gene_wise(table: DataFrame, libs: Libraries) -> DataFrame:
    """Adds the mean normalised count and the dispersion fitted to each insertion alone."""
    size, groups, names = np.array(libs.sizes), libs.groups, libs.columns
    n_groups = len(libs.conditions)
    schema = T.StructType(
        [*table.schema.fields, T.StructField("baseMean", T.DoubleType()),
         T.StructField("disp_own", T.DoubleType())]
    )

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts = pdf[names].to_numpy(dtype=float)
            pdf["baseMean"] = (counts / size).mean(axis=1)
            out = np.full(len(counts), np.nan)
            seen = counts.sum(axis=1) > 0
            if seen.any():
                out[seen] = _own_dispersion(counts[seen], size, groups, n_groups)
            pdf["disp_own"] = out
            yield pdf

    raw = spread_rows(table).mapInPandas(fit, schema)
    return raw.withColumn("disp_own", F.when(~F.isnan("disp_own"), F.col("disp_own")))


def _own_dispersion(counts, size, groups, n_groups):
    means = nb.group_means(counts / size, groups, n_groups)[:, groups]
    mu = np.maximum(size * means, nb.MIN_MU)
    start = nb.moment_dispersion(counts, size, groups, n_groups)
    return nb.best_dispersion(counts, mu, groups, n_groups, start)


@dataclass(frozen=True)
class Trend:
    """Dispersion as a0 + a1 / mean. ``kind`` says how it was found: ``parametric``, ``mean`` (a
    coefficient reached its bound) or ``mean, not converged``."""

    a0: float
    a1: float
    kind: str


#: Cells of the trend's grid for each doubling of mean and dispersion.
GRID = 16
#: Rows within this distance of a median's cell are looked at one by one.
RESIDUAL_CELLS, RESIDUAL_RANGE = 1 << 16, 32.0


def trend_cells(fits: DataFrame) -> DataFrame:
    """Insertions by cell of (mean, dispersion): how many, and sums of dispersion and of one over the mean.

    Sums add up, whatever the order; their number is bounded by the range of the two figures, not by the insertions.
    """
    cell = lambda c: F.floor(F.log2(c) * GRID)
    return _trendable(fits).groupBy(cell(F.col("baseMean")).alias("cell_mean"), cell(F.col("disp_own")).alias("cell_disp")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(1 / F.col("baseMean")).alias("x"), F.sum("disp_own").alias("y"))


def _trendable(fits: DataFrame) -> DataFrame:
    return fits.filter((F.col("disp_own") >= 100 * nb.MIN_DISP) & (F.col("baseMean") > 0))


def grid_trend(n: np.ndarray, x: np.ndarray, y: np.ndarray, rounds: int = 20) -> Trend:
    """All rounds of the regression over the cells' means: gamma regression by scoring within a0, a1 >= 0.

    Cells far off the trend of a round are left out of the later ones.
    """
    mean, x, y = float(y.sum() / n.sum()), x / n, y / n
    a0, a1 = 0.1, 1.0
    use = np.ones(len(n), bool)
    for _ in range(rounds):
        old = (a0, a1)
        for _ in range(rounds):
            w = n[use] / (a0 + a1 * x[use]) ** 2
            step = _line(w.sum(), w @ x[use], w @ x[use] ** 2, w @ y[use], w @ (x[use] * y[use])) if use.any() else None
            if step is None or min(step) <= 0:
                return Trend(mean, 0.0, "mean")
            moved = max(abs(step[0] - a0) / a0, abs(step[1] - a1) / a1)
            a0, a1 = step
            if moved < 1e-8:
                break
        else:
            return Trend(mean, 0.0, "mean, not converged")
        if math.log(a0 / old[0]) ** 2 + math.log(a1 / old[1]) ** 2 < 1e-6:
            return Trend(a0, a1, "parametric")
        ratio = y / (a0 + a1 * x)
        use &= (ratio >= TREND_RATIO_LOW) & (ratio < TREND_RATIO_HIGH)
    return Trend(mean, 0.0, "mean, not converged")


def dispersion_trend(fits: DataFrame, rounds: int = 20) -> Trend:
    """The trend of dispersions over means.

    One pass sums the insertions up in a grid, from which all rounds of the regression run; steps over
    the insertions themselves then end exactly where such a step, with the insertions far off the trend left
    out, gives the trend itself. If a coefficient ends at its bound, or ``rounds`` steps or rounds do not settle, the
    trend is the mean dispersion, and ``kind`` tells.
    """
    cells = trend_cells(fits).toPandas()
    if not len(cells):
        return Trend(nb.MIN_DISP, 0.0, "mean")
    n, x_sum, y_sum = (cells[c].to_numpy(dtype=float) for c in ("n", "x", "y"))
    mean, start = float(y_sum.sum() / n.sum()), grid_trend(n, x_sum, y_sum, rounds)
    if start.kind != "parametric":
        return start
    x, y, use = 1 / F.col("baseMean"), F.col("disp_own"), _trendable(fits)
    a0, a1 = start.a0, start.a1
    for _ in range(rounds):
        ratio = y / (F.lit(a0) + F.lit(a1) * x)
        step = _trend_step(use.filter((ratio >= TREND_RATIO_LOW) & (ratio < TREND_RATIO_HIGH)), x, y, a0, a1)
        if step is None or min(step) <= 0:
            return Trend(mean, 0.0, "mean")
        moved = max(abs(step[0] - a0) / a0, abs(step[1] - a1) / a1)
        a0, a1 = step
        if moved < 1e-6:
            return Trend(a0, a1, "parametric")
    return Trend(mean, 0.0, "mean, not converged")


def _trend_step(use: DataFrame, x: Column, y: Column, a0: float, a1: float) -> tuple[float, float] | None:
    """Weighted least squares within a0, a1 >= 0; None without a line through the data."""
    w = 1 / F.pow(F.lit(a0) + F.lit(a1) * x, F.lit(2.0))
    s = use.agg(
        F.sum(w).alias("w"), F.sum(w * x).alias("wx"), F.sum(w * x * x).alias("wxx"),
        F.sum(w * y).alias("wy"), F.sum(w * x * y).alias("wxy"),
    ).first()
    return None if s["w"] is None else _line(*(s[c] for c in ("w", "wx", "wxx", "wy", "wxy")))


def _line(w: float, wx: float, wxx: float, wy: float, wxy: float) -> tuple[float, float] | None:
    """Least squares from its sums; at a bound where the free solution leaves it."""
    det = w * wxx - wx**2
    if det <= 0:
        return None
    b0, b1 = (wxx * wy - wx * wxy) / det, (w * wxy - wx * wy) / det
    if b1 <= 0:
        return wy / w, 0.0
    if b0 <= 0:
        return 0.0, wxy / wxx
    return b0, b1


def exact_median(rows: DataFrame, value: str) -> float | None:
    """Median of one column of moderate numbers, such as logarithms: cells are counted, then the middle ones sorted."""
    top = RESIDUAL_CELLS - 1
    place = F.floor((F.col(value) + RESIDUAL_RANGE) * (RESIDUAL_CELLS / 2 / RESIDUAL_RANGE))
    celled = rows.filter(F.col(value).isNotNull()).select(F.col(value).alias("v"), F.greatest(F.lit(0), F.least(F.lit(top), place)).alias("c"))
    counts = celled.groupBy("c").count().toPandas().sort_values("c")
    if not len(counts):
        return None
    end = counts["count"].cumsum().to_numpy()
    middle = [(end[-1] - 1) // 2, end[-1] // 2]
    at = np.searchsorted(end, middle, side="right")
    low, high = (int(counts["c"].iloc[i]) for i in at)
    before = int(end[at[0]] - counts["count"].iloc[at[0]])
    left = celled.filter(F.col("c").between(low, high)).select("v")
    size = int(end[at[1]]) - before
    share = [(m - before) / max(1, size - 1) for m in middle]
    found = left.agg(F.percentile("v", F.array(*[F.lit(float(q)) for q in share])).alias("q")).first()["q"]
    return (found[0] + found[1]) / 2


def prior_spread(fits: DataFrame, trend: Trend, libs: Libraries) -> tuple[float, float]:
    """Observed spread around the trend (squared) and the variance of the dispersion prior."""
    expected = F.lit(trend.a0) + F.lit(trend.a1) / F.col("baseMean")
    rows = fits.filter(F.col("disp_own") >= 100 * nb.MIN_DISP).select((F.ln("disp_own") - F.ln(expected)).alias("r"))
    middle = exact_median(rows, "r")
    if middle is None:
        return MIN_PRIOR_VAR, MIN_PRIOR_VAR
    mad = exact_median(rows.select(F.abs(F.col("r") - middle).alias("d")), "d") / NORMAL_Q75
    free = len(libs.labels) - len(libs.conditions)
    return mad**2, max(mad**2 - nb.trigamma(free / 2), MIN_PRIOR_VAR)


def shrunken_scores(
    fits: DataFrame, libs: Libraries, trend: Trend, spread: tuple[float, float],
    min_replicates: int, key: Sequence[str] = KEY,
) -> DataFrame:
    """Final dispersion, log2 fold change against the initial condition, Wald test, outliers.

    Long by timepoint. Libraries with a large influence are replaced by a trimmed mean where a
    condition has ``min_replicates``; elsewhere an influential library makes the p-value NULL.
    """
    size, groups, names = np.array(libs.sizes), libs.groups, libs.columns
    conditions = libs.conditions
    n_groups, n = len(conditions), len(groups)
    per_group = np.bincount(groups, minlength=n_groups)[groups]
    cutoff = nb.f_quantile(COOKS_QUANTILE, n_groups, n - n_groups)
    replaceable, usable = per_group >= min_replicates, per_group >= 3
    sq_spread, prior_var = spread

    def estimate(counts: np.ndarray, own: np.ndarray, mean: np.ndarray):
        expected = np.log(trend.a0 + trend.a1 / mean)
        means = nb.group_means(counts / size, groups, n_groups)[:, groups]
        mu = np.maximum(size * means, nb.MIN_MU)
        shrunk = nb.best_dispersion(
            counts, mu, groups, n_groups, np.exp(expected), expected, prior_var
        )
        far = np.log(own) > expected + OUTLIER_SD * math.sqrt(sq_spread)
        disp = np.where(far, own, shrunk)
        beta = nb.group_coefficients(counts, size, disp, groups, n_groups)
        return disp, beta

    def score(counts: np.ndarray, own: np.ndarray, mean: np.ndarray):
        disp, beta = estimate(counts, own, mean)
        cooks = nb.cooks_distance(counts, size, beta, disp, groups, n_groups)
        cooks = np.nan_to_num(cooks, nan=0.0)
        hit = (cooks > cutoff) & replaceable
        rows = hit.any(axis=1)
        if rows.any():
            normed = np.sort(counts[rows] / size, axis=1)
            cut = int(n * REPLACE_TRIM)
            fill = normed[:, cut: n - cut].mean(axis=1)[:, None] * size
            new = np.where(hit[rows], np.trunc(fill), counts[rows])
            own2 = _own_dispersion(new, size, groups, n_groups)
            mean2 = np.maximum((new / size).mean(axis=1), 1e-12)
            disp[rows], beta[rows] = estimate(new, own2, mean2)
        info = nb.information(beta, size, disp, groups, n_groups)
        lfc = beta[:, 1:] - beta[:, :1]
        se = np.sqrt(1 / info[:, 1:] + 1 / info[:, :1])
        stat = lfc / se
        p = nb.normal_two_sided(stat)
        watched = np.where(usable & ~replaceable, cooks, 0.0)
        worst = watched.argmax(axis=1)
        above = (counts > np.take_along_axis(counts, worst[:, None], 1)).sum(axis=1)
        p[(watched.max(axis=1) > cutoff) & (above < 3)] = np.nan
        return disp, cooks.max(axis=1), lfc / math.log(2), se / math.log(2), stat, p

    kept = [f for f in fits.schema.fields if f.name in key]
    stats = ("LFC", "lfcSE", "stat", "pvalue")
    tps = conditions[1:]
    doubles = ["baseMean", "dispersion", "cooks", *[f"{s}_{i}" for s in stats for i in range(len(tps))]]
    schema = T.StructType([*kept, *[T.StructField(d, T.DoubleType()) for d in doubles]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf[[f.name for f in kept] + ["baseMean"]].copy()
            for d in doubles[1:]:
                out[d] = np.nan
            ok = pdf["disp_own"].notna().to_numpy()
            if ok.any():
                sub = pdf[ok]
                disp, cooks, lfc, se, stat, p = score(
                    sub[names].to_numpy(dtype=float), sub["disp_own"].to_numpy(dtype=float),
                    sub["baseMean"].to_numpy(dtype=float),
                )
                out.loc[ok, "dispersion"], out.loc[ok, "cooks"] = disp, cooks
                # Depletion counts as positive.
                for s, v in zip(stats, (-lfc, se, -stat, p)):
                    for i in range(len(tps)):
                        out.loc[ok, f"{s}_{i}"] = v[:, i]
            yield out

    wide = spread_rows(fits).mapInPandas(run, schema)

    def known(name: str) -> Column:
        return F.when(~F.isnan(name), F.col(name))

    start = F.struct(
        F.lit(conditions[0]).alias("Timepoint"), F.lit(0.0).alias("LFC"),
        F.lit(None).cast("double").alias("lfcSE"), F.lit(None).cast("double").alias("stat"),
        F.lit(1.0).alias("pvalue"),
    )
    rest = [
        F.struct(F.lit(t).alias("Timepoint"), *[known(f"{s}_{i}").alias(s) for s in stats])
        for i, t in enumerate(tps)
    ]
    return wide.select(*key, "baseMean", known("dispersion").alias("dispersion"), known("cooks").alias("cooks"),
                       F.inline(F.array(start, *rest)))


def _smoothed(x: np.ndarray, y: np.ndarray, share: float = 0.2, rounds: int = 3) -> np.ndarray:
    """Robust locally linear smoothing of a short curve with tricube weights."""
    n = len(x)
    near = max(2, math.ceil(share * n))
    away = np.abs(x[:, None] - x[None, :])
    reach = np.maximum(np.sort(away, axis=1)[:, near - 1], 1e-12)
    local = np.clip(1 - np.clip(away / reach[:, None], 0, 1) ** 3, 0, 1) ** 3
    trust = np.ones(n)
    for _ in range(rounds + 1):
        w = local * trust
        sw, swx, swy = w.sum(1), w @ x, w @ y
        swxx, swxy = w @ (x * x), w @ (x * y)
        det = sw * swxx - swx**2
        slope = np.where(det > 1e-12, (sw * swxy - swx * swy) / np.where(det > 1e-12, det, 1), 0.0)
        fit = (swy - slope * swx) / np.maximum(sw, 1e-300) + slope * x
        rest = y - fit
        scale = np.median(np.abs(rest))
        trust = np.clip(1 - (rest / (6 * scale)) ** 2, 0, 1) ** 2 if scale > 0 else np.ones(n)
    return fit


def choose_cutoff(shares: np.ndarray, rejected: np.ndarray) -> int:
    """Place of the cut-off: the first with about as many rejections as the smoothed curve's top.

    With ten rejections or fewer at every cut-off nothing is filtered (place 0).
    """
    if rejected.max(initial=0) <= FEW_REJECTIONS:
        return 0
    smooth = _smoothed(shares, rejected.astype(float))
    some = rejected > 0
    threshold = smooth.max() - math.sqrt(np.mean((rejected[some] - smooth[some]) ** 2))
    above = np.flatnonzero(rejected > threshold)
    return int(above[0]) if len(above) else 0


def rejections(scores: DataFrame, cutoffs: Sequence[float], level: float, by: Sequence[str]) -> DataFrame:
    """Adjusted p-values below ``level`` for each group and cut-off of the mean.

    Only p-values below the level can pass, so only those are repeated by cut-off; the tests of
    a cut-off are counted by one aggregation.
    """
    means = F.array(*[F.lit(float(c)) for c in cutoffs])
    tested = scores.filter(F.col("pvalue").isNotNull())
    levels = tested.withColumn("_level", F.size(F.filter(means, lambda c: c <= F.col("baseMean"))))
    totals = (
        levels.groupBy(*by, "_level").count()
        .withColumn("cutoff", F.explode(F.sequence(F.lit(0), F.col("_level") - 1)))
        .groupBy(*by, "cutoff").agg(F.sum("count").alias("tests"))
    )
    low = levels.filter((F.col("pvalue") < level) & (F.col("_level") > 0)).select(
        *by, "pvalue", F.explode(F.sequence(F.lit(0), F.col("_level") - 1)).alias("cutoff")
    )
    ranked = join_keys(cumulative_counts(low, [*by, "cutoff"], "pvalue").drop("total"), totals, [*by, "cutoff"])
    rank = F.col("below") + F.col("n")
    passed = F.max(F.when(F.col("pvalue") * F.col("tests") / rank < level, rank))
    found = ranked.groupBy(*by, "cutoff").agg(F.coalesce(passed, F.lit(0)).alias("rejected"))
    return join_keys(totals, found, [*by, "cutoff"], "left").withColumn(
        "rejected", F.coalesce("rejected", F.lit(0))
    )


def filtered_adjust(
    scores: DataFrame, level: float = FILTER_LEVEL, by: Sequence[str] = ("Timepoint",), means: DataFrame | None = None
) -> DataFrame:
    """Adjusted p-values after leaving out insertions of low mean, per group.

    Cut-offs are quantiles of ``baseMean`` over ``means``, one row an insertion, by default those of one group; the
    one that ``choose_cutoff`` takes holds. Insertions below it have a NULL adjusted p-value. The driver gets one row
    per group and cut-off.
    """
    by = list(by)
    if means is None:
        some = scores.select(*by).first()
        same = F.lit(True)
        for c in by if some is not None else ():
            same = same & F.col(c).eqNullSafe(F.lit(some[c]))
        means = scores.filter(same)
    means = means.select(F.lit(1).alias("g"), "baseMean")
    lower = means.agg(F.avg((F.col("baseMean") == 0).cast("double"))).first()[0]
    if lower is None:
        return bh_adjust(scores, "pvalue", by)
    upper = FILTER_TOP if lower < FILTER_TOP else 1.0
    shares = np.linspace(lower, upper, FILTER_CUTOFFS)
    row = exact_quantile(means, ["g"], "baseMean", {f"q{i}": float(q) for i, q in enumerate(shares)}).first()
    cutoffs = [float(row[f"q{i}"]) for i in range(len(shares))]
    counts: dict[tuple, np.ndarray] = {}
    for r in rejections(scores, cutoffs, level, by).collect():
        counts.setdefault(tuple(r[c] for c in by), np.zeros(len(cutoffs)))[r["cutoff"]] = r["rejected"]
    least = F.lit(cutoffs[0])
    for group, rejected in counts.items():
        here = F.lit(True)
        for c, v in zip(by, group, strict=True):
            here = here & F.col(c).eqNullSafe(F.lit(v))
        least = F.when(here, F.lit(cutoffs[choose_cutoff(shares, rejected)])).otherwise(least)
    kept = scores.withColumn("_p", F.when(F.col("baseMean") >= least, F.col("pvalue")))
    return bh_adjust(kept, "_p", by).drop("_p")


def replicate_scores(
    counts: DataFrame, controls: DataFrame, initial: str, min_replicates: int = 7,
    key: Sequence[str] = KEY, rounded: bool = True, details: bool = False,
) -> DataFrame:
    """Score, standard error, test and adjusted p-value per insertion and timepoint.

    Runs jobs when called: fits and scores are stored once. The initial timepoint has LFC 0 and
    p and adjusted p 1; the others are adjusted per timepoint after filtering by mean count.
    ``trend`` says how the dispersion trend was found. ``details`` adds the final ``dispersion`` and the
    largest of an insertion's Cook's distances, ``cooks``.
    """
    complete = complete_cases(counts, key=key)
    libs = collect_libraries(size_factors(complete, controls, key), initial)
    fits = checkpointed(gene_wise(count_table(complete, libs, key), libs))
    trend = dispersion_trend(fits)
    spread = prior_spread(fits, trend, libs)
    scores = checkpointed(shrunken_scores(fits, libs, trend, spread, min_replicates, key))
    later = filtered_adjust(scores.filter(F.col("Timepoint") != initial), means=fits)
    start = scores.filter(F.col("Timepoint") == initial).withColumn("padj", F.lit(1.0))
    digits = SCORE_DIGITS if rounded else {}
    return later.unionByName(start).select(
        *key, "Timepoint",
        *[half_even(F.col(c), digits[c]).alias(c) if c in digits else F.col(c)
          for c in SCORE_DIGITS],
        F.lit(trend.kind).alias("trend"), *(["dispersion", "cooks"] if details else []),
    )


def normalized_counts(counts: DataFrame, factors: DataFrame, digits: int = 3) -> DataFrame:
    """Counts divided by their library's size factor."""
    scaled = half_even(F.col("Reads") / F.col("size_factor"), digits)
    # One row per library goes to the counts, never the counts to the few tasks of the factors.
    return counts.join(F.broadcast(factors), list(LIBRARY)).withColumn("normed", scaled).drop("size_factor")


def split_statistics(scores: DataFrame, key: Sequence[str] = KEY) -> dict[str, DataFrame]:
    """One long table per statistic."""
    present = [c for c in scores.columns if c in SCORE_DIGITS]
    by = [c for c in scores.columns if c in (*key, "Sample", "Timepoint")]
    return {
        c: scores.select(*by, half_even(F.col(c), SCORE_DIGITS[c]).alias("value")) for c in present
    }
