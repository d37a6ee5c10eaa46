"""Controls, imputation, scores, weights, density, curves and the replicate model."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from hopscan.config import INTERGENIC, SITE
from hopscan.functions import curve as fc, statistics as fs
from hopscan.operators import curves as cv, density as dn, genes as gn, nbinom as nb, replicates as rp, scoring as sc

COUNTS = "Chr string, Coordinate long, Strand string, Sample string, Timepoint string, Reads long"
TIMES = {"t0": 0.0, "t1": 2.352, "t2": 5.588, "t3": 9.104, "t4": 12.48}


def test_controls_one_strand_per_site_and_complete(spark):
    c = spark.createDataFrame(
        [("I", x, s, "A", t, 5) for x, s in ((10, "-"), (10, "+"), (30, "+")) for t in ("t0", "t1")] + [("I", 50, "+", "A", "t0", 9)], COUNTS)
    ann = spark.createDataFrame(
        [("I", x, s, INTERGENIC, float(x), float(100 - x)) for x, s in ((10, "-"), (10, "+"), (30, "+"), (50, "+"))],
        "Chr string, Coordinate long, Strand string, Type string, Distance_to_region_start double, Distance_to_region_end double")
    assert rows(sc.select_controls(c, ann, 5, SITE).select(*SITE)) == [("I", 10, "+"), ("I", 30, "+")]


def test_ma_sign_is_positive_for_depletion(spark):
    c = spark.createDataFrame([("I", 1, "+", "A", "t0", 100), ("I", 1, "+", "A", "t1", 10), ("I", 2, "+", "A", "t0", 50), ("I", 2, "+", "A", "t1", 50)], COUNTS)
    controls = spark.createDataFrame([("I", 2, "+")], "Chr string, Coordinate long, Strand string")
    got = {(r["Coordinate"], r["Timepoint"]): r["LFC"] for r in sc.ma_scores(c, controls, "t0", SITE).collect()}
    assert got[(1, "t0")] == 0 and got[(2, "t1")] == 0 and got[(1, "t1")] == round(math.log2(101 / 11), 3)


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.0625,), (0.1875,)], "x double")
    assert [r[0] for r in df.select(fs.half_even(F.col("x"), 3)).collect()] == [0.062, 0.188]


def test_impute_only_absent_in_gene_samples(spark):
    ann = spark.createDataFrame([("I", x, s, t, d) for x, s, t, d in
                                 ((1, "+", "Coding gene", 9.0), (1, "-", "Coding gene", 9.0), (2, "+", "Coding gene", 3.0), (2, "-", "Coding gene", 3.0), (3, "+", INTERGENIC, None))],
                                "Chr string, Coordinate long, Strand string, Type string, Distance_to_stop_codon double")
    data = [(1, "+", "A", 5), (1, "-", "A", 7), (1, "-", "B", 8), (2, "+", "A", 1), (2, "-", "B", 1), (3, "+", "A", 2), (3, "+", "B", 2)]
    c = spark.createDataFrame([("I", x, s, smp, t, v) for x, s, smp, v in data for t in ("t0", "t1")], COUNTS)
    out = sc.impute_opposite_strand(c, ann, key=SITE).filter(F.col("Timepoint") == "t0")
    assert rows(out.select("Coordinate", "Strand", "Sample", "Reads", "imputed")) == [
        (1, "+", "A", 5, False), (1, "+", "B", 8, True), (1, "-", "A", 7, False), (1, "-", "B", 8, False), (3, "+", "A", 2, False), (3, "+", "B", 2, False)]
    s = sc.imputation_summary(c, ann, key=SITE).first()
    assert (s["total_insertions"], s["in_gene_insertions"], s["complete_in_gene_before"], s["complete_in_gene_after"], s["complementarity_used"], s["imputed_insertions"]) == (5, 2, 1, 2, 1, 1)


def test_weights(spark):
    df = spark.createDataFrame([(None,), (0.0,), (1.0,), (0.01,)], "w double")
    got = [r[0] for r in df.select(fs.clip_neg_log10(F.col("w"))).collect()]
    assert got[0] == pytest.approx(4.34e-7, rel=1e-2) and got[1] == 6.0 and got[0] == got[2] and got[3] == pytest.approx(2.0)
    assert df.select(fs.r2_weight(F.col("w"))).first()[0] is None


def test_gene_lfc_drops_nameless_and_fills_essentiality(spark):
    w = spark.createDataFrame(
        [("g", "n", "viable", None, "t0", 1.0, 3.0), ("g", "n", "viable", None, "t0", 5.0, 1.0), ("h", None, "viable", "E", "t0", 1.0, 1.0), ("i", "x", None, "E", "t0", 1.0, 1.0)],
        "Systematic_ID string, Name string, FYPOviability string, DeletionLibrary_essentiality string, Timepoint string, LFC double, Weights double")
    assert rows(gn.gene_lfc(w)) == [("g", "n", "viable", "Not_determined", "t0", 2.0)]
    sums = gn.normalize_weights(w).groupBy("Systematic_ID", "Timepoint").agg(F.sum("Normalized_weights").alias("s"))
    assert all(r["s"] == pytest.approx(1) for r in sums.collect())


def test_gene_statistics_small_example(spark):
    data = [("g", 110, "Forward", 10, 0), ("g", 110, "Reverse", 5, 1), ("g", 150, "Forward", 5, 4)]
    df = spark.createDataFrame([(*d, 100, 200, 100) for d in data],
                               "Systematic_ID string, Coordinate long, Insertion_direction string, reads_initial long, reads_final long, "
                               "ParentalRegion_start long, ParentalRegion_end long, ParentalRegion_length long")
    d = dn.gene_density(df).first()
    assert (d["total_insertions"], d["unique_sites_initial"], d["unique_sites_final"], d["insertion_density_per_kb_initial"]) == (3, 2, 2, 20.0)
    g = dn.gene_gaps(df, lists=True).first()
    assert (g["num_gaps"], g["largest_gap"], g["smallest_gap"], g["median_gap_length"], g["all_gap_lengths"]) == (3, 49, 9, 39.0, "9,39,49")
    assert g["gap_length_sd"] == round(float(np.std([9, 39, 49])), 2)
    r = dn.gene_reads(df).first()
    assert (r["total_reads_initial"], r["total_reads_final"], r["mean_reads_per_insertion_initial"]) == (20, 5, 6.67)
    s = dn.gene_strand(df).first()
    assert (s["forward_insertions"], s["reverse_insertions"], s["paired_sites"], s["paired_sites_fraction"]) == (2, 1, 1, 0.5)


def test_gene_without_gap(spark):
    df = spark.createDataFrame([("g", 101, "Forward", 1, 1, 100, 102, 2)],
                               "Systematic_ID string, Coordinate long, Insertion_direction string, reads_initial long, reads_final long, "
                               "ParentalRegion_start long, ParentalRegion_end long, ParentalRegion_length long")
    g = dn.gene_gaps(df).first()
    assert (g["num_gaps"], g["largest_gap"], g["mean_gap_length"], g["gini_coefficient_of_location"]) == (0, 0, 0.0, None)


# --- curves ----------------------------------------------------------------------------------

def gompertz(x, a, r, d):
    return a * np.exp(-np.exp(r * math.e / a * (d - x) + 1))


def long_series(spark, params):
    x = np.array(list(TIMES.values()))
    data = [(i, t, float(v)) for i, (a, r, d) in enumerate(params) for t, v in zip(TIMES, gompertz(x, a, r, d))]
    return spark.createDataFrame(data, "id long, Timepoint string, LFC double")


def test_fit_recovers_noiseless_curves_and_keeps_constraints(spark):
    params = [(3.0, 0.4, 1.0), (6.0, 0.7, 2.0), (1.0, 0.12, 0.5), (5.0, 0.6, 3.0)]
    fits = cv.fit_curves(cv.curve_table(long_series(spark, params), ["id"], TIMES), TIMES)
    t_last = TIMES["t4"]
    checks = fits.select("id", "A", "DR", "DL", "objective", "Status",
                         fc.span_slack(F.col("A"), F.col("DR"), F.col("DL"), t_last).alias("c1"),
                         fc.smooth_slack(F.col("A"), F.col("DR"), F.col("DL")).alias("c2"))
    for r in checks.collect():
        a, s, d = params[r["id"]]
        assert r["Status"] == "Success" and r["c1"] > -1e-6 and r["c2"] > -1e-6
        assert r["objective"] <= fc.DL_PENALTY * d + 1e-6  # never worse than the true curve
        assert r["A"] == pytest.approx(a, rel=0.05)


def test_fit_is_not_worse_than_its_grid(spark):
    rng = np.random.default_rng(0)
    data = [(i, t, float(v)) for i in range(60) for t, v in zip(TIMES, rng.normal(0, 2, 5))]
    curves = cv.curve_table(spark.createDataFrame(data, "id long, Timepoint string, LFC double"), ["id"], TIMES)
    grid = dict(rows(cv.fit_grid(curves, TIMES).select("id", "objective")))
    for r in cv.fit_curves(curves, TIMES).collect():
        assert r["objective"] <= grid[r["id"]] + 1e-6


def test_fit_states_and_metrics(spark):
    data = [(0, t, 0.0) for t in TIMES] + [(1, t, None if t == "t2" else 1.0) for t in TIMES] + [(2, t, float(i)) for i, t in enumerate(TIMES)]
    curves = cv.curve_table(spark.createDataFrame(data, "id long, Timepoint string, LFC double"), ["id"], TIMES)
    got = {r["id"]: r for r in cv.fit_report(curves, TIMES).collect()}
    assert got[1]["Status"] == "Fitting error" and got[1]["A"] is None and got[1]["R2"] is None
    assert got[0]["normalized_RMSE"] is None and got[2]["R2"] > 0.9
    assert [p["observed"] for p in got[2]["points"]] == [0.0, 1.0, 2.0, 3.0, 4.0]
    p = got[2]["points"][4]
    assert p["residual"] == pytest.approx(p["observed"] - p["fitted"], abs=1e-9)
    s = cv.fit_summary(cv.fit_report(curves, TIMES)).first()
    assert (s["total_datasets"], s["successful_fits"]) == (3, 2)
    with pytest.raises(ValueError):
        cv.ordered_times({"a": 0, "b": 1})


def test_missing_weight_has_its_fixed_value(spark):
    df = spark.createDataFrame([(0, "t0", 1.0, None), (0, "t1", 1.0, 0.5)], "id long, Timepoint string, LFC double, w double")
    r = cv.curve_table(df, ["id"], TIMES, weight="w").first()
    assert (r["w_0"], r["w_1"], r["w_2"]) == (0.01, 0.5, 0.01)


def test_area_matches_trapezoid(spark):
    df = spark.createDataFrame([(3.0, 0.4, 1.0)], "A double, DR double, DL double")
    x = np.linspace(0, 12.48, 1000)
    got = df.select(cv.curve_area(F.col("A"), F.col("DR"), F.col("DL"), 0.0, 12.48)).first()[0]
    assert got == pytest.approx(np.trapezoid(gompertz(x, 3.0, 0.4, 1.0), x), rel=1e-12)


# --- replicate model -------------------------------------------------------------------------

def test_special_functions():
    x = np.array([1e-3, 0.5, 1, 3.3, 8, 100, 1e6])
    assert nb.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-12)
    assert nb.f_quantile(0.99, 5, 10) == pytest.approx(5.6363, abs=1e-4)
    assert nb.trigamma(1.0) == pytest.approx(math.pi ** 2 / 6)
    assert nb.normal_two_sided(np.array([[1.959963984540054]]))[0, 0] == pytest.approx(0.05)


def test_group_coefficients_solve_the_score_equation():
    rng = np.random.default_rng(2)
    groups = np.array([0, 0, 0, 1, 1, 1])
    size = np.array([1, 1.2, 0.8, 1, 0.9, 1.1])
    counts = rng.poisson(50 * size, (20, 6)).astype(float)
    disp = np.full(20, 0.1)
    q = np.exp(nb.group_coefficients(counts, size, disp, groups, 2))
    for g in (0, 1):
        k, s = counts[:, groups == g], size[groups == g]
        score = ((k - s * q[:, [g]]) / (1 + disp[:, None] * s * q[:, [g]])).sum(axis=1)
        assert np.abs(score).max() < 1e-6


def test_dispersion_is_a_maximum():
    rng = np.random.default_rng(5)
    groups = np.repeat([0, 1, 2], 4)
    mu = np.full((30, 12), 80.0)
    counts = rng.negative_binomial(5, 5 / (5 + mu)).astype(float)
    best = nb.best_dispersion(counts, mu, groups, 3, np.full(30, 0.1))
    top = nb.profile_loglik(np.log(best), counts, mu, groups, 3)
    for factor in (0.5, 0.9, 0.99, 1.01, 1.1, 2):
        assert (nb.profile_loglik(np.log(best * factor), counts, mu, groups, 3) <= top + 1e-8).all()
    assert np.median(best) == pytest.approx(0.2, abs=0.1)


def test_replicate_scores_find_depletion(spark):
    rng = np.random.default_rng(7)
    data, tps = [], ("t0", "t1", "t2")
    for i in range(120):
        drop = 4.0 if i < 12 else 1.0
        for sample in "ABC":
            for j, t in enumerate(tps):
                mu = 200 / drop ** j
                data.append(("I", i, "+", sample, t, int(rng.negative_binomial(20, 20 / (20 + mu)))))
    c = spark.createDataFrame(pd.DataFrame(data, columns=[*SITE, "Sample", "Timepoint", "Reads"]))
    controls = spark.createDataFrame([("I", i, "+") for i in range(60, 120)], "Chr string, Coordinate long, Strand string")
    out = rp.replicate_scores(c, controls, "t0", key=SITE).toPandas()
    first = out[out["Timepoint"] == "t0"]
    assert (first["LFC"] == 0).all() and (first["padj"] == 1).all() and first["lfcSE"].isna().all()
    last = out[out["Timepoint"] == "t2"].set_index("Coordinate").sort_index()
    assert last.loc[:11, "LFC"].mean() == pytest.approx(4.0, abs=0.5)
    assert (last.loc[:11, "padj"] < 1e-3).all() and (last.loc[12:, "padj"] < 0.05).mean() < 0.1
    assert (out["stat"].dropna() * out["LFC"][out["stat"].notna()] >= 0).all()


def _adjusted(p):
    """Benjamini-Hochberg by its definition."""
    order = np.argsort(p)
    q = p[order] * len(p) / np.arange(1, len(p) + 1)
    out = np.empty(len(p))
    out[order] = np.minimum(1, np.minimum.accumulate(q[::-1])[::-1])
    return out


def test_filtering_by_mean_before_adjustment(spark):
    rng = np.random.default_rng(3)
    mean = np.concatenate([rng.uniform(0.1, 5, 300), rng.uniform(5, 500, 300)])
    p = np.concatenate([rng.uniform(0, 1, 300), rng.uniform(0, 1, 300) ** 4])
    p[7] = np.nan
    data = [("t1", int(i), float(m), None if np.isnan(v) else float(v)) for i, (m, v) in enumerate(zip(mean, p))]
    df = spark.createDataFrame(data, "Timepoint string, i int, baseMean double, pvalue double")
    shares = np.linspace(0, 0.95, 50)
    cutoffs = np.quantile(mean, shares)
    rejected = np.array([(_adjusted(p[(mean >= c) & ~np.isnan(p)]) < 0.05).sum() for c in cutoffs])
    counted = {r["cutoff"]: r["rejected"] for r in rp.rejections(df, cutoffs, 0.05, ["Timepoint"]).collect()}
    assert [counted[i] for i in range(50)] == rejected.tolist()
    place = rp.choose_cutoff(shares, rejected)
    assert place > 0 and rejected[place] > rejected[0]
    use = (mean >= cutoffs[place]) & ~np.isnan(p)
    want = dict(zip(np.flatnonzero(use), _adjusted(p[use])))
    got = {r["i"]: r["padj"] for r in rp.filtered_adjust(df).collect()}
    assert all((got[i] is None) == (i not in want) for i in range(len(p)))
    assert all(abs(got[i] - v) < 1e-9 for i, v in want.items())
    assert rp.choose_cutoff(shares, np.minimum(rejected, 10)) == 0


def test_trend_keeps_its_bounds(spark):
    rng = np.random.default_rng(5)
    mean = rng.uniform(1, 1000, 3000)
    noise = rng.gamma(8, 1 / 8, 3000)
    falling = spark.createDataFrame([(float(m), float((0.1 + 2 / m) * e)) for m, e in zip(mean, noise)], "baseMean double, disp_own double")
    t = rp.dispersion_trend(falling)
    assert t.kind == "parametric" and abs(t.a0 - 0.1) < 0.01 and abs(t.a1 - 2) < 0.3
    rising = [(float(m), float((0.1 + m / 1000) * e)) for m, e in zip(mean, noise)]
    t = rp.dispersion_trend(spark.createDataFrame(rising, "baseMean double, disp_own double"))
    assert (t.kind, t.a1) == ("mean", 0.0) and abs(t.a0 - np.mean([d for _, d in rising])) < 1e-9
    assert rp.dispersion_trend(falling, rounds=1).kind == "mean, not converged"


def test_unsettled_rows_are_reported(spark):
    counts = np.array([[5.0, 7.0, 90.0, 80.0], [0.0, 0.0, 3.0, 1.0]])
    groups, size, disp = np.array([0, 0, 1, 1]), np.ones(4), np.array([0.1, 0.5])
    alone = np.vstack([nb.group_coefficients(counts[[i]], size, disp[[i]], groups, 2) for i in (0, 1)])
    assert (nb.group_coefficients(counts, size, disp, groups, 2) == alone).all()
    steps, nb.STEPS = nb.STEPS, 1
    try:
        assert np.isnan(nb.group_coefficients(counts, size, disp, groups, 2)).any()
    finally:
        nb.STEPS = steps


def test_unsettled_curves_fail(spark):
    times = {"a": 0.0, "b": 2.0, "c": 4.0, "d": 8.0, "e": 12.5}
    cols = ", ".join(f"y_{i} double, w_{i} double" for i in range(5))
    row = tuple(v for y in (0.0, 0.2, 1.5, 4.0, 4.6) for v in (y, 1.0))
    df = spark.createDataFrame([row], cols)
    assert [r["Status"] for r in cv.fit_curves(df, times).collect()] == [cv.OK]
    short = cv.fit_curves(df, times, steps=1).collect()[0]
    assert short["Status"] == cv.FAILED and short["A"] is None


def test_curves_along_a_flat_valley_settle(spark):
    times = {"a": 0.0, "b": 2.352, "c": 5.588, "d": 9.104, "e": 12.48}
    cols = ", ".join(f"y_{i} double, w_{i} double" for i in range(5))
    series = ([0.0, 0.584962500721, 1.321928094887, 0.584962500721, 3.906890595609],
              [0.0, 0.652076696580, 0.289506617195, 0.652076696580, 3.459431618637],
              [0.0, 0.0, 0.241008099504, 0.700439718141, 3.700439718141])
    df = spark.createDataFrame([tuple(v for y in row for v in (y, 1.0)) for row in series], cols)
    assert [r["Status"] for r in cv.fit_curves(df, times).collect()] == [cv.OK] * len(series)


def test_no_curve_is_left_unsettled_or_worse_than_the_grid(spark):
    """Curves whose best shape lies in a bent valley, and curves whose plateaus take many rounds to find."""
    times = {"a": 0.0, "b": 2.352, "c": 5.588, "d": 9.104, "e": 12.48}
    counts = ([232, 230, 214, 118, 8], [289, 271, 151, 154, 3], [729, 892, 618, 359, 14],
              [825, 171, 775, 15, 918], [458, 65, 548, 4, 446], [126, 0, 157, 0, 146], [145, 0, 167, 0, 50])
    data = [(i, t, math.log2((c[0] + 1) / (n + 1))) for i, c in enumerate(counts) for t, n in zip(times, c)]
    curves = cv.curve_table(spark.createDataFrame(data, "id long, Timepoint string, LFC double"), ["id"], times)
    grid = dict(rows(cv.fit_grid(curves, times).select("id", "objective")))
    for r in cv.fit_curves(curves, times).collect():
        assert r["Status"] == cv.OK and r["objective"] <= grid[r["id"]] + 1e-6


def test_exact_plateaus_have_the_least_loss():
    rng = np.random.default_rng(4)
    g, y, w = rng.random((300, 5)), rng.normal(0, 3, (300, 5)), rng.choice([0.01, 1.0, 2.5], (300, 5))
    g[:5], g[5:40, 2] = 0.0, 0.0
    top = np.where(np.arange(300) % 3 == 0, 0.5, 12.48)
    a, loss = cv._exact_plateau(g, y, w, top)

    def at(p):
        z = np.abs(w * (y - p[:, None] * g))
        return np.where(z <= 1, z * z, 2 * z - 1).sum(axis=1)

    low, high = np.full(300, cv.A_LOW), top
    for _ in range(200):  # thirds: the loss is convex
        p, q = (2 * low + high) / 3, (low + 2 * high) / 3
        left = at(p) <= at(q)
        low, high = np.where(left, low, p), np.where(left, q, high)
    assert (a >= cv.A_LOW).all() and (a <= top).all()
    assert np.abs(loss - at(a)).max() < 1e-9 and np.abs(loss - at((low + high) / 2)).max() < 1e-9


def _optimum(mean, disp):
    """The trend by plain rounds over all points."""
    a0, a1, x = 0.1, 1.0, 1 / mean
    for _ in range(200):
        ratio = disp / (a0 + a1 * x)
        use = (ratio >= rp.TREND_RATIO_LOW) & (ratio < rp.TREND_RATIO_HIGH)
        w = 1 / (a0 + a1 * x[use]) ** 2
        a = np.array([[w.sum(), w @ x[use]], [w @ x[use], w @ x[use] ** 2]])
        a0, a1 = np.linalg.solve(a, [w @ disp[use], w @ (x[use] * disp[use])])
    return a0, a1


def test_trend_of_a_grid_ends_at_the_optimum_of_all_points(spark):
    rng = np.random.default_rng(9)
    mean = np.exp(rng.uniform(0, 9, 20_000))
    disp = (0.05 + 3 / mean) * rng.gamma(2, 1 / 2, len(mean))
    disp[:200] *= 100  # far off
    fits = spark.createDataFrame(pd.DataFrame({"baseMean": mean, "disp_own": disp}))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("trend", "")
    try:
        t = rp.dispersion_trend(fits)
        n_jobs = len(jobs.getJobIdsForGroup("trend"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    keep = disp >= 100 * nb.MIN_DISP
    a0, a1 = _optimum(mean[keep], disp[keep])
    assert t.kind == "parametric" and t.a0 == pytest.approx(a0, rel=1e-6) and t.a1 == pytest.approx(a1, rel=1e-6)
    assert n_jobs < 15
    assert rp.trend_cells(fits.unionByName(fits)).count() == rp.trend_cells(fits).count()


def test_exact_median(spark):
    rng = np.random.default_rng(1)
    for v in (rng.normal(size=1001), rng.normal(size=1000) * 20, np.zeros(7), np.array([-50.0, 40.0]), np.repeat([1.0, 2.0], 500)):
        df = spark.createDataFrame(pd.DataFrame({"v": v})).repartition(3)
        assert rp.exact_median(df, "v") == pytest.approx(np.median(v), abs=1e-12)
    assert rp.exact_median(spark.createDataFrame([], "v double"), "v") is None


def test_replicate_scores_show_dispersion_and_distance(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        for sample in "ABC":
            for j, t in enumerate(("t0", "t1")):
                n = int(rng.negative_binomial(10, 10 / 210))
                rows.append(("I", i, "+", sample, t, n * (40 if (i, sample, t) == (5, "B", "t1") else 1)))
    c = spark.createDataFrame(pd.DataFrame(rows, columns=[*SITE, "Sample", "Timepoint", "Reads"]))
    controls = c.select(*SITE).distinct()
    out = rp.replicate_scores(c, controls, "t0", key=SITE, details=True).filter("Timepoint = 't1'").toPandas().set_index("Coordinate")
    assert (out["dispersion"] > 0).all() and out["cooks"].idxmax() == 5 and np.isnan(out.loc[5, "pvalue"])
    plain = rp.replicate_scores(c, controls, "t0", key=SITE)
    assert not {"dispersion", "cooks"} & set(plain.columns)


def test_medians_go_to_the_counts(spark):
    """Stored counts of a few MB must not go to the one task that has the medians."""
    from hopscan.session import checkpointed

    key = ("Chr", "Coordinate", "Strand")
    counts = checkpointed(spark.range(40_000).selectExpr(
        "'I' as Chr", "id div 10 as Coordinate", "'+' as Strand", "concat('S', id div 5 % 2) as Sample",
        "concat('T', id % 5) as Timepoint", "id % 97 + 1 as Reads"))
    scores = sc.ma_scores(counts, checkpointed(counts.select(*key).distinct()), "T0", key)
    assert scores.count() == 40_000
    # The medians' own size is unknown beforehand, so which side goes to the other must not hang on it.
    assert "rightHint=(strategy=broadcast)" in scores._jdf.queryExecution().optimizedPlan().toString()


def test_arrays_of_a_fit_do_not_grow_with_its_rows():
    import tracemalloc

    x = np.array([0.0, 2.352, 5.588, 9.104, 12.48])
    y = np.random.default_rng(3).random((2000, 5)) * 8
    tracemalloc.start()
    try:
        cv._fit_batch(x, y, np.ones_like(y), steps=2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 40e6


def test_arrays_of_an_area_do_not_grow_with_its_rows(monkeypatch):
    import tracemalloc

    monkeypatch.setattr(cv.F, "pandas_udf", lambda _: lambda f: f)  # the function itself, on series
    rng = np.random.default_rng(3)
    a, dr, dl = (pd.Series(rng.random(10_000) * top + 0.1) for top in (8, 1, 4))
    a[7] = np.nan
    tracemalloc.start()
    try:
        areas = cv.curve_area(a, dr, dl, 0.0, 12.48)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert areas.isna().sum() == 1 and pd.isna(areas[7])
    alone = cv.curve_area(a[9_999:], dr[9_999:], dl[9_999:], 0.0, 12.48)
    assert abs(areas[9_999] - alone.iloc[0]) < 1e-12
    assert most < 40e6
