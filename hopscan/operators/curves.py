"""Depletion-curve fitting: grid seeds, batched constrained fits, metrics and residuals.

Curve tables are wide by timepoint: identifier columns, then ``y_0 .. y_{T-1}`` and
``w_0 .. w_{T-1}`` in time order. Rows are independent.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from hopscan.functions import curve as fc
from hopscan.functions.statistics import half_even
from hopscan.operators.sites import count_where
from hopscan.session import spread

# Parameter bounds and the weight of a missing weight.
A_LOW, DL_LOW = -1.0, -1e-6
DR_LOW = -1.0
MISSING_WEIGHT = 0.01
# End of fixed values.

#: Rows whose grid of shapes, and rows whose curve, a task holds at once: some MB for each array.
GRID_ROWS, AREA_ROWS = 256, 512
OK, FAILED, ERROR = "Success", "Optimization failed", "Fitting error"
#: Stencil steps at most, and the stencil size (of the unit square) at which a fit has settled.
STEPS, SETTLED = 1000, 1e-8
#: Better neighbours in a row after which the stencil grows, and its first and largest size.
GAINS, WIDEST = 8, 0.06
#: The second search also tries multiples of the way its last steps went, which follows curved valleys.
AHEAD, AHEAD_STEPS = np.array([1.0, 4.0, 16.0]), 3
PARAMETERS = ("A", "DR", "DL")
METRICS = (
    "t10", "t50", "t90", "t_window", "t_inflection", "y_inflection", "auc", "AIC", "BIC",
    "R2", "RMSE", "normalized_RMSE",
)


def ordered_times(times: dict[str, float]) -> list[tuple[str, float]]:
    """Timepoints by their number. At least three are needed."""
    if len(times) < 3:
        raise ValueError("curve fitting needs at least three time points")
    return sorted(times.items(), key=lambda kv: kv[1])


def curve_table(
    series: DataFrame, ids: Sequence[str], times: dict[str, float], value: str = "LFC",
    weight: str | None = None,
) -> DataFrame:
    """One row per dataset with its values and weights in time order."""

    def at(label: str, c: str) -> Column:
        return F.max(F.when(F.col("Timepoint") == label, F.col(c).cast("double")))

    cells = []
    order = ordered_times(times)
    for i, (label, _) in enumerate(order):
        cells.append(at(label, value).alias(f"y_{i}"))
        if weight:
            cells.append(F.coalesce(at(label, weight), F.lit(MISSING_WEIGHT)).alias(f"w_{i}"))
    out = series.groupBy(*ids).agg(*cells)
    if not weight:
        out = out.withColumns({f"w_{i}": F.lit(1.0) for i in range(len(order))})
    return out


def default_grid(
    t_last: float,
    plateaus: Sequence[float] = (-0.5, 0.25, 0.5, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0),
    spans: Sequence[float] = (6.5, 8.0, 10.0, 12.0, 14.0),
    delays: Sequence[float] = (0.0, 1.0, 2.0, 3.0, 4.0, 6.0, 8.0),
) -> list[tuple[float, float, float]]:
    """Feasible (A, DR, DL) combinations; a span is plateau over slope."""
    return [
        (a, a / s, d)
        for a in plateaus for s in spans for d in delays
        if A_LOW <= a <= t_last and d <= t_last and s <= t_last + fc.SPAN_SLACK - d
    ]


def fit_grid(
    curves: DataFrame, times: dict[str, float], grid: Sequence[tuple[float, float, float]] | None = None,
    digits: int = 6,
) -> DataFrame:
    """Best grid point of every dataset by the penalised loss, rounded so that ties are stable.

    The grid is a literal inside the row expression: no join and no exploded rows.
    """
    order = ordered_times(times)
    grid = grid or default_grid(order[-1][1])
    text = json.dumps([{"A": a, "DR": r, "DL": d} for a, r, d in grid])
    points_type = "array<struct<A:double,DR:double,DL:double>>"
    points = [(F.lit(x), F.col(f"y_{i}"), F.col(f"w_{i}")) for i, (_, x) in enumerate(order)]

    def scored(g: Column) -> Column:
        loss = fc.fit_objective(points, g["A"], g["DR"], g["DL"])
        return F.struct(F.round(loss, digits).alias("objective"), g["A"].alias("A"),
                        g["DR"].alias("DR"), g["DL"].alias("DL"))

    best = F.array_min(F.transform(F.from_json(F.lit(text), points_type), scored))
    ids = [c for c in curves.columns if not _is_cell(c)]
    return curves.withColumn("_best", best).select(*ids, "_best.*")


def _is_cell(name: str) -> bool:
    head, _, tail = name.partition("_")
    return head in ("y", "w") and tail.isdigit()


def _min_span() -> float:
    """Smallest plateau/slope ratio the smoothness constraint allows (root by bisection)."""

    def slack(alpha: float) -> float:
        return math.e * (
            math.exp(alpha - math.exp(alpha)) + math.exp(-alpha - math.exp(-alpha))
        ) - fc.SLOPE_SHARE

    low, high = 1e-6, 3.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if slack(mid) > 0 else (low, mid)
    return math.e / low


MIN_SPAN = _min_span()


def _shape(x: np.ndarray, span: np.ndarray, delay: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Unit-plateau curve; leading axes of the parameters, last axis is time."""
    u = (sign * math.e / span)[..., None] * (delay[..., None] - x) + 1
    return np.exp(-np.exp(np.clip(u, -fc.EXPONENT_LIMIT, fc.EXPONENT_LIMIT)))


def _plateau(
    g: np.ndarray, y: np.ndarray, w: np.ndarray, top: np.ndarray, rounds: int
) -> tuple[np.ndarray, np.ndarray]:
    """Best plateau of a fixed shape under the robust loss, and that loss.

    The loss is convex in the plateau: reweighted least squares, then clipping to the bounds.
    """
    ww = w * w
    gy, gg = ww * g * y, ww * g * g
    den = gg.sum(axis=-1)
    a = gy.sum(axis=-1) / np.where(den > 0, den, 1.0)
    for _ in range(rounds - 1):
        r = np.abs(w * (y - a[..., None] * g))
        if r.max(initial=0.0) <= 1:
            break
        omega = 1 / np.maximum(r, 1.0)
        den = (omega * gg).sum(axis=-1)
        a = (omega * gy).sum(axis=-1) / np.where(den > 0, den, 1.0)
    a = np.clip(a, A_LOW, top)
    z = np.abs(w * (y - a[..., None] * g))
    return a, np.sum(np.where(z <= 1, z * z, 2 * z - 1), axis=-1)


def _exact_plateau(g: np.ndarray, y: np.ndarray, w: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same without rounds: the slope of the loss is linear between the ends of its quadratic pieces."""
    wg, wy = np.broadcast_arrays(w * g, w * y)
    top = np.broadcast_to(top, wg.shape[:-1])[..., None]
    still = wg == 0
    ends = [np.where(still, A_LOW, (wy + side) / np.where(still, 1.0, wg)) for side in (-1, 1)]
    at = np.concatenate([*ends, np.full(top.shape, A_LOW), top], axis=-1)
    at = np.sort(np.clip(at, A_LOW, top), axis=-1)
    slope = np.sum(wg[..., None, :] * np.clip(wg[..., None, :] * at[..., None] - wy[..., None, :], -1, 1), axis=-1)
    left = np.maximum((slope <= 0).sum(axis=-1) - 1, 0)
    right = np.minimum((slope < 0).sum(axis=-1), at.shape[-1] - 1)
    left, right = (f(left, right)[..., None] for f in (np.minimum, np.maximum))
    (a, b), (p, q) = ([np.take_along_axis(v, k, -1)[..., 0] for k in (left, right)] for v in (at, slope))
    rise = np.where(q > p, q - p, 1.0)
    a = np.clip(np.where(q > p, a - p * (b - a) / rise, 0.0), a, b)
    z = np.abs(wg * a[..., None] - wy)
    return a, np.sum(np.where(z <= 1, z * z, 2 * z - 1), axis=-1)


def _fit_batch(
    x: np.ndarray, y: np.ndarray, w: np.ndarray, seeds: int = 3, steps: int = STEPS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A, DR, DL, loss, last stencil size) for rows of ``y``.

    With span = |A|/|DR| both constraints become bounds on (delay, span), and the plateau is
    a convex inner problem. So: score a coarse grid of shapes for all rows at once, then
    refine the best few by a shrinking stencil in the unit square of (delay, span). Rows that do
    not settle, or that a shape of the default grid fits better, are searched again with exact plateaus.
    """
    t_last = float(x[-1])
    reach = min(t_last, t_last + fc.SPAN_SLACK - MIN_SPAN)

    def unpack(d: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        delay = DL_LOW + d * (reach - DL_LOW)
        return delay, MIN_SPAN + u * (t_last + fc.SPAN_SLACK - delay - MIN_SPAN)

    def top(span: np.ndarray, sign: np.ndarray) -> np.ndarray:
        return np.where(sign > 0, t_last, np.minimum(t_last, -DR_LOW * span))

    gd, gu, gs = (
        v.ravel() for v in np.meshgrid(
            np.linspace(0, 1, 13), np.array([0, 0.06, 0.15, 0.3, 0.45, 0.6, 0.8, 1.0]),
            np.array([1.0, -1.0]), indexing="ij",
        )
    )
    delay, span = unpack(gd, gu)
    shapes = _shape(x, span, delay, gs)
    limit = top(span, gs)
    penalty = fc.DL_PENALTY * np.abs(delay)
    n = len(y)
    start = np.empty((n, seeds), dtype=np.int64)
    for lo in range(0, n, GRID_ROWS):
        part = slice(lo, min(lo + GRID_ROWS, n))
        _, loss = _plateau(
            shapes[None], y[part, None, :], w[part, None, :], limit[None], rounds=4
        )
        start[part] = np.argpartition(loss + penalty, seeds, axis=1)[:, :seeds]

    def evaluate(d_, u_, s_, y_, w_, rounds):
        delay_, span_ = unpack(d_, u_)
        solved = _plateau if rounds else _exact_plateau
        a_, loss_ = solved(_shape(x, span_, delay_, s_), y_, w_, top(span_, s_), *([rounds] if rounds else []))
        return a_, loss_ + fc.DL_PENALTY * np.abs(delay_)

    parts = []
    for lo in range(0, n, 512):
        part = slice(lo, min(lo + 512, n))
        k = start[part]
        yb, wb = y[part, None, :], w[part, None, :]
        d, u, s = gd[k], gu[k], gs[k]
        # All seeds a few steps, then only the best one to convergence.
        d, u, best, step = _descend(d, u, s, yb, wb, evaluate, np.full(d.shape, WIDEST), 14)
        pick = np.argmin(best, axis=1)[:, None]
        d, u, s, step = (np.take_along_axis(v, pick, 1) for v in (d, u, s, step))
        d, u, best, step = _descend(d, u, s, yb, wb, evaluate, step, steps)
        d, u, s = d[:, 0], u[:, 0], s[:, 0]
        a, loss = evaluate(d, u, s, y[part], w[part], 40)
        parts.append(np.column_stack([d, u, s, a, loss, step[:, 0]]))
    found = np.concatenate(parts) if parts else np.empty((0, 6))

    gd, gu = _default_shapes(t_last, reach)
    gs = np.ones(len(gd))
    for lo in range(0, n if len(gd) else 0, GRID_ROWS):
        part = found[lo: lo + GRID_ROWS]
        yb, wb = (v[lo: lo + GRID_ROWS, None, :] for v in (y, w))
        _, loss = evaluate(gd[None], gu[None], gs[None], yb, wb, None)
        again = np.flatnonzero((part[:, 5] >= SETTLED) | (part[:, 4] > loss.min(axis=1) + 1e-9))
        if len(again) == 0:
            continue
        k = np.argmin(loss[again], axis=1)
        d, u, s = (np.column_stack([part[again, i], v[k]]) for i, v in enumerate((gd, gu, gs)))
        d, u, best, step = _descend(
            d, u, s, yb[again], wb[again], evaluate, np.full(d.shape, WIDEST), steps, rounds=None, ahead=AHEAD)
        pick = np.argmin(best, axis=1)[:, None]
        d, u, s, step = (np.take_along_axis(v, pick, 1)[:, 0] for v in (d, u, s, step))
        a, loss = evaluate(d, u, s, yb[again, 0], wb[again, 0], None)
        part[again] = np.column_stack([d, u, s, a, loss, step])
    d, u, s, a, loss, step = found.T
    delay, span = unpack(d, u)
    return a, s * a / span, delay, loss, step


def _default_shapes(t_last: float, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Shapes of ``default_grid`` in the unit square of (delay, span)."""
    shapes = {(delay, round(a / rate, 9)) for a, rate, delay in default_grid(t_last)}
    room = [(d, s, t_last + fc.SPAN_SLACK - d - MIN_SPAN) for d, s in sorted(shapes) if d <= reach]
    inside = [((d - DL_LOW) / (reach - DL_LOW), (s - MIN_SPAN) / r) for d, s, r in room if MIN_SPAN <= s and r > 0]
    return tuple(np.clip(np.array(inside).reshape(-1, 2), 0, 1).T)


_MOVES = np.array(
    [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) != (0, 0)], dtype=float
)


def _descend(d, u, s, y, w, evaluate, step, steps: int, small: float = SETTLED, rounds: int | None = 4, ahead: np.ndarray = np.empty(0)):
    """Stencil search in the unit square; the step shrinks where no neighbour is better and grows after GAINS that were.

    Growing is what crosses a long flat valley, along which small steps would gain a little each without an end.
    Where it bends, the points ``ahead`` do: multiples of the way of the last AHEAD_STEPS steps.
    """
    shape = d.shape
    y, w = (np.broadcast_to(v, (*shape, v.shape[-1])).reshape(-1, v.shape[-1]) for v in (y, w))
    d, u, step = d.ravel().copy(), u.ravel().copy(), step.ravel().copy()
    s = np.broadcast_to(s, shape).ravel()
    _, best = evaluate(d, u, s, y, w, rounds)
    gains = np.zeros(d.shape, np.int64)
    was, way = np.array([d, u]), np.zeros((2, len(d)))
    for i in range(steps):
        live = np.flatnonzero(step >= small)
        if len(live) == 0:
            break
        cd, cu = (
            np.clip(v[live, None] + np.hstack([step[live, None] * moves, go[live, None] * ahead]), 0, 1)
            for v, moves, go in zip((d, u), _MOVES.T, way)
        )
        cs = np.broadcast_to(s[live, None], cd.shape)
        _, loss = evaluate(cd, cu, cs, y[live, None, :], w[live, None, :], rounds)
        k = np.argmin(loss, axis=1)
        row = np.arange(len(live))
        better = loss[row, k] < best[live] - 1e-12
        hit = live[better]
        d[hit], u[hit] = cd[row, k][better], cu[row, k][better]
        best[hit] = loss[row, k][better]
        step[live[~better]] *= 0.4
        gains[hit] += 1
        gains[live[~better]] = 0
        long = hit[gains[hit] == GAINS]
        step[long] = np.minimum(step[long] / 0.4, WIDEST)
        gains[long] = 0
        if (i + 1) % AHEAD_STEPS == 0:
            was, way = np.array([d, u]), np.array([d, u]) - was
    return tuple(v.reshape(shape) for v in (d, u, best, step))


def _feasible(x: np.ndarray, a: np.ndarray, rate: np.ndarray, delay: np.ndarray) -> np.ndarray:
    """Whether span and slope keep their bounds, up to rounding."""
    flat = (a == 0) | (rate == 0)  # no rise: any span will do
    span = np.where(flat, MIN_SPAN, np.abs(a) / np.where(flat, 1.0, np.abs(rate)))
    return (x[-1] + fc.SPAN_SLACK - span - delay >= -1e-6) & (span >= MIN_SPAN - 1e-6)


def fit_curves(
    curves: DataFrame, times: dict[str, float], batch_rows: int = 2_000, steps: int = STEPS
) -> DataFrame:
    """Constrained robust Gompertz fit of every row, in Arrow batches on evenly spread rows.

    Adds A, DR, DL, ``objective`` and ``Status``. A row with a missing value cannot be fitted
    (``Fitting error``). A row whose search has not settled after ``steps`` steps, or whose
    result breaks a constraint, is ``Optimization failed`` and has no parameters.
    """
    order = ordered_times(times)
    x = np.array([v for _, v in order])
    ys, ws = ([f"{p}_{i}" for i in range(len(x))] for p in ("y", "w"))
    new = [T.StructField(c, T.DoubleType()) for c in (*PARAMETERS, "objective")]
    schema = T.StructType([*curves.schema.fields, *new, T.StructField("Status", T.StringType())])

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for lo in range(0, len(pdf), batch_rows):
                part = pdf.iloc[lo: lo + batch_rows].copy()
                y = part[ys].to_numpy(dtype=float)
                w = part[ws].to_numpy(dtype=float)
                usable = np.isfinite(y).all(axis=1) & np.isfinite(w).all(axis=1)
                result = np.full((len(part), 4), np.nan)
                status = np.where(usable, FAILED, ERROR).astype(object)
                if usable.any() and x[-1] + fc.SPAN_SLACK > MIN_SPAN:
                    *found, step = _fit_batch(x, y[usable], w[usable], steps=steps)
                    result[usable] = np.column_stack(found)
                    settled = np.zeros(len(part), dtype=bool)
                    settled[usable] = (step < SETTLED) & _feasible(x, *found[:3])
                    status[settled & np.isfinite(result).all(axis=1)] = OK
                for i, c in enumerate((*PARAMETERS, "objective")):
                    part[c] = pd.array(result[:, i], dtype="float64")
                part["Status"] = status
                yield part

    raw = spread(curves).mapInPandas(fit, schema)
    clean = {c: F.when(F.col("Status") == OK, F.col(c)) for c in (*PARAMETERS, "objective")}
    return raw.withColumns(clean)


def curve_area(A: Column, DR: Column, DL: Column, start: float, stop: float, points: int = 1000) -> Column:
    """Area under the curve by the trapezoid rule, a whole Arrow batch at a time."""
    x = np.linspace(start, stop, points)

    @F.pandas_udf("double")
    def area(a: pd.Series, r: pd.Series, d: pd.Series) -> pd.Series:
        out = np.full(len(a), np.nan)
        av, rv, dv = (s.to_numpy(dtype=float) for s in (a, r, d))
        good = np.isfinite(av) & np.isfinite(rv) & np.isfinite(dv)
        for lo in range(0, len(av), AREA_ROWS):
            idx = np.flatnonzero(good[lo: lo + AREA_ROWS]) + lo
            if len(idx) == 0:
                continue
            safe = np.where(av[idx] == 0, 1.0, av[idx])
            u = (rv[idx] * math.e / safe)[:, None] * (dv[idx][:, None] - x) + 1
            u = np.clip(u, -fc.EXPONENT_LIMIT, fc.EXPONENT_LIMIT)
            curve = av[idx][:, None] * np.exp(-np.exp(u))
            out[idx] = np.trapezoid(curve, x, axis=1)
        return pd.Series(out).where(np.isfinite(out), None)

    return area(A, DR, DL)


def _finite(c: Column) -> Column:
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def fit_metrics(fits: DataFrame, times: dict[str, float], rounded: bool = True) -> DataFrame:
    """Quality and shape of each fitted curve; NULL where a value is undefined or not fitted.

    Residual metrics use the parameters at full precision; rounding comes last.
    """
    order = ordered_times(times)
    n = float(len(order))
    A, DR, DL = F.col("A"), F.col("DR"), F.col("DL")
    ys = [F.col(f"y_{i}") for i in range(len(order))]
    mean = sum(ys[1:], ys[0]) / n
    res = [y - fc.gompertz_eval(F.lit(x), A, DR, DL) for y, (_, x) in zip(ys, order)]
    ss_res = sum((r * r for r in res[1:]), res[0] * res[0])
    dev = [(y - mean) * (y - mean) for y in ys]
    ss_tot = sum(dev[1:], dev[0])
    staged = fits.withColumns({"_res": ss_res, "_tot": ss_tot, "_range": F.greatest(*ys) - F.least(*ys)})
    res_, tot, spread = F.col("_res"), F.col("_tot"), F.col("_range")
    fitted = A.isNotNull()
    rmse = F.sqrt(res_ / n)
    log_var = F.when(res_ > 0, F.ln(res_ / n))
    sloped = (DR != 0)
    t10, t50, t90 = (F.when(sloped, fc.time_at(p, A, DR, DL)) for p in (0.1, 0.5, 0.9))
    values = {
        "t10": t10, "t50": t50, "t90": t90, "t_window": t90 - t10,
        "t_inflection": F.when(sloped, DL + F.abs(A) / (F.abs(DR) * math.e)),
        "y_inflection": A / math.e,
        "auc": curve_area(A, DR, DL, order[0][1], order[-1][1]),
        "AIC": n * log_var + 6,
        "BIC": n * log_var + 3 * math.log(n),
        "R2": F.when(tot > 0, 1 - res_ / tot).otherwise(F.lit(0.0)),
        "RMSE": rmse,
        "normalized_RMSE": F.when(spread > 0, rmse / spread),
    }
    digits = {"R2": 6, "normalized_RMSE": 6}
    out = {
        c: F.when(fitted, half_even(_finite(v), digits.get(c, 3)) if rounded else _finite(v))
        for c, v in values.items()
    }
    return staged.withColumns(out).drop("_res", "_tot", "_range")


def fit_residuals(fits: DataFrame, times: dict[str, float], digits: int = 3) -> DataFrame:
    """Adds ``points``: observed, fitted and residual value of every timepoint."""
    A, DR, DL = F.col("A"), F.col("DR"), F.col("DL")

    def point(i: int, label: str, x: float) -> Column:
        seen = half_even(F.col(f"y_{i}"), digits)
        fitted = half_even(fc.gompertz_eval(F.lit(x), A, DR, DL), digits)
        return F.struct(
            F.lit(label).alias("timepoint"), seen.alias("observed"), fitted.alias("fitted"),
            half_even(seen - fitted, digits).alias("residual"),
        )

    return fits.withColumn(
        "points", F.array(*[point(i, lab, x) for i, (lab, x) in enumerate(ordered_times(times))])
    )


def fit_report(curves: DataFrame, times: dict[str, float]) -> DataFrame:
    """Fit, metrics and residuals with tables' rounding: one row per dataset."""
    order = ordered_times(times)
    ids = [c for c in curves.columns if not _is_cell(c)]
    fits = fit_residuals(fit_metrics(fit_curves(curves, times), times), times)
    text = ",".join(str(float(x)) for _, x in order)
    return fits.select(
        *ids, "Status", F.lit(text).alias("time_points"),
        *[half_even(F.col(p), 3).alias(p) for p in PARAMETERS], *METRICS, "points",
    )


def fitted_values(report: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Long table of the fitted scores."""
    return report.select(*ids, F.inline("points")).select(
        *ids, F.col("timepoint").alias("Timepoint"), F.col("fitted").alias("LFC")
    )


def fit_summary(fits: DataFrame) -> DataFrame:
    """Success rate and means over successful fits, one row."""
    good = F.col("Status") == OK
    cols = ("R2", "RMSE", "A", "DR", "t10", "t50", "t90", "t_window", "t_inflection",
            "y_inflection", "auc", "AIC", "BIC")
    out = fits.agg(
        F.count(F.lit(1)).alias("total_datasets"),
        count_where(good).alias("successful_fits"),
        *[F.avg(F.when(good, F.col(c))).alias(f"mean_{c}") for c in cols],
    )
    rate = F.when(F.col("total_datasets") > 0, F.col("successful_fits") / F.col("total_datasets") * 100)
    return out.withColumn("success_rate", F.coalesce(rate, F.lit(0.0)))
