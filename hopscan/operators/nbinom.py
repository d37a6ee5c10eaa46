"""Batched negative-binomial pieces for one-way designs (numpy, one row per insertion).

A design with one condition per timepoint splits into independent groups, so coefficients are
group means and the information matrix is diagonal in them. All functions work on arrays with
one row per insertion and one column per library.
"""

from __future__ import annotations

import math

import numpy as np

# Limits of the dispersion and mean estimates.
MIN_DISP, MAX_DISP, MIN_MU = 1e-8, 10.0, 0.5
MIN_COOKS_DISP = 0.04
STEPS = 100
BETA_LIMIT = 30.0
# End of fixed values.

_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive arguments, by the Stirling series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    z = x.copy()
    for _ in range(8):
        small = z < 8
        if not small.any():
            break
        shift = np.where(small, shift + np.log(z), shift)
        z = np.where(small, z + 1, z)
    inv = 1 / z
    series = np.zeros_like(z)
    for c in reversed(_STIRLING):
        series = series * inv * inv + c
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series * inv - shift


def group_sums(values: np.ndarray, groups: np.ndarray, n_groups: int) -> np.ndarray:
    return np.stack([values[:, groups == g].sum(axis=1) for g in range(n_groups)], axis=1)


def group_means(values: np.ndarray, groups: np.ndarray, n_groups: int) -> np.ndarray:
    return np.stack([values[:, groups == g].mean(axis=1) for g in range(n_groups)], axis=1)


def moment_dispersion(counts: np.ndarray, size: np.ndarray, groups: np.ndarray, n_groups: int) -> np.ndarray:
    """Starting dispersion: the smaller of a rough and a method-of-moments estimate."""
    normed = counts / size
    n = counts.shape[1]
    fit = np.maximum(group_means(normed, groups, n_groups)[:, groups], 1.0)
    rough = np.maximum((((normed - fit) ** 2 - fit) / ((n - n_groups) * fit**2)).sum(axis=1), 0)
    mean = normed.mean(axis=1)
    var = normed.var(axis=1, ddof=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        moments = np.nan_to_num((var - np.mean(1 / size) * mean) / mean**2, nan=0.0, posinf=0.0)
    return np.clip(np.minimum(rough, moments), MIN_DISP, max(MAX_DISP, n))


def profile_loglik(
    log_disp: np.ndarray, counts: np.ndarray, mu: np.ndarray, groups: np.ndarray, n_groups: int,
    prior_mean: np.ndarray | None = None, prior_var: float | None = None,
) -> np.ndarray:
    """Adjusted profile log-likelihood of a dispersion, optionally with a log-normal prior."""
    disp = np.exp(log_disp)[:, None]
    r = 1 / disp
    ll = (
        log_gamma(counts + r) - log_gamma(r)
        - (counts + r) * np.log1p(disp * mu) + counts * (np.log(mu) + log_disp[:, None])
    ).sum(axis=1)
    weights = group_sums(mu / (1 + mu * disp), groups, n_groups)
    ll -= 0.5 * np.log(weights).sum(axis=1)
    if prior_mean is not None:
        ll -= (log_disp - prior_mean) ** 2 / (2 * prior_var)
    return ll


def best_dispersion(
    counts: np.ndarray, mu: np.ndarray, groups: np.ndarray, n_groups: int, start: np.ndarray,
    prior_mean: np.ndarray | None = None, prior_var: float | None = None,
) -> np.ndarray:
    """Maximise the profile likelihood over the log dispersion of every row at once.

    A coarse scan brackets the maximum (the start value is one of its points), golden-section
    steps narrow it.
    """
    n = counts.shape[1]
    low, high = math.log(MIN_DISP), math.log(max(MAX_DISP, n))

    def value(v: np.ndarray) -> np.ndarray:
        return profile_loglik(v, counts, mu, groups, n_groups, prior_mean, prior_var)

    grid = np.linspace(low, high, 25)
    scores = np.stack([value(np.full(len(counts), g)) for g in grid], axis=1)
    k = scores.argmax(axis=1)
    a, b = grid[np.maximum(k - 1, 0)], grid[np.minimum(k + 1, len(grid) - 1)]
    s = np.log(start)
    near = value(s) > scores.max(axis=1)
    width = grid[1] - grid[0]
    a = np.where(near, np.maximum(s - width, low), a)
    b = np.where(near, np.minimum(s + width, high), b)
    ratio = (math.sqrt(5) - 1) / 2
    c, d = b - ratio * (b - a), a + ratio * (b - a)
    fc, fd = value(c), value(d)
    for _ in range(32):
        left = fc > fd
        a, b = np.where(left, a, c), np.where(left, d, b)
        nc, nd = b - ratio * (b - a), a + ratio * (b - a)
        probe = np.where(left, nc, nd)
        f = value(probe)
        fc, fd = np.where(left, f, fd), np.where(left, fc, f)
        c, d = nc, nd
    return np.exp((a + b) / 2)


def group_coefficients(
    counts: np.ndarray, size: np.ndarray, disp: np.ndarray, groups: np.ndarray, n_groups: int
) -> np.ndarray:
    """Log mean per group by reweighted least squares, means bounded below while iterating.

    A row rests once it has settled, so its result does not depend on the rows beside it. A row
    that has not after ``STEPS`` steps becomes NaN, and its scores NULL.
    """
    beta = np.log(np.maximum(group_means(counts / size, groups, n_groups), 0.1))
    open_ = np.arange(len(counts))
    for _ in range(STEPS):
        c, d = counts[open_], disp[open_, None]
        mu = np.maximum(size * np.exp(beta[open_][:, groups]), MIN_MU)
        w = mu / (1 + mu * d)
        z = np.log(mu / size) + (c - mu) / mu
        new = group_sums(w * z, groups, n_groups) / group_sums(w, groups, n_groups)
        new = np.clip(new, -BETA_LIMIT, BETA_LIMIT)
        moved = np.abs(new - beta[open_]).max(axis=1)
        beta[open_] = new
        open_ = open_[~(moved < 1e-10)]
        if not len(open_):
            return beta
    beta[open_] = np.nan
    return beta


def information(
    beta: np.ndarray, size: np.ndarray, disp: np.ndarray, groups: np.ndarray, n_groups: int
) -> np.ndarray:
    """Fisher information of the group coefficients (diagonal)."""
    mu = size * np.exp(beta[:, groups])
    return group_sums(mu / (1 + mu * disp[:, None]), groups, n_groups)


def _trim(n: int) -> tuple[float, float]:
    """Trimmed share and variance scale for a group of ``n`` replicates."""
    if n < 4:
        return 1 / 3, 2.04
    if n < 24:
        return 1 / 4, 1.86
    return 1 / 8, 1.51


def _trimmed_mean(values: np.ndarray, share: float) -> np.ndarray:
    cut = int(values.shape[1] * share)
    inner = np.sort(values, axis=1)[:, cut: values.shape[1] - cut]
    return inner.mean(axis=1)


def cooks_distance(
    counts: np.ndarray, size: np.ndarray, beta: np.ndarray, disp: np.ndarray,
    groups: np.ndarray, n_groups: int,
) -> np.ndarray:
    """Influence of each library on the fit, with a dispersion robust to single outliers."""
    normed = counts / size
    worst = np.zeros(len(counts))
    for g in range(n_groups):
        part = normed[:, groups == g]
        n = part.shape[1]
        if n < 3:
            continue
        share, scale = _trim(n)
        centre = _trimmed_mean(part, share)[:, None]
        worst = np.maximum(worst, scale * _trimmed_mean((part - centre) ** 2, share))
    mean = normed.mean(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        robust = np.nan_to_num((worst - mean) / mean**2, nan=0.0, posinf=0.0)
    robust = np.maximum(robust, MIN_COOKS_DISP)[:, None]
    mu = np.maximum(size * np.exp(beta[:, groups]), MIN_MU)
    w = mu / (1 + mu * disp[:, None])
    leverage = w / group_sums(w, groups, n_groups)[:, groups]
    variance = mu + robust * mu**2
    with np.errstate(divide="ignore", invalid="ignore"):
        return (counts - mu) ** 2 / variance / n_groups * leverage / (1 - leverage) ** 2


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    """Two-sided tail of the standard normal distribution."""
    flat = np.abs(z).ravel() / math.sqrt(2)
    return np.fromiter((math.erfc(v) for v in flat), dtype=float, count=flat.size).reshape(z.shape)


def trigamma(x: float) -> float:
    total = 0.0
    while x < 10:
        total += 1 / (x * x)
        x += 1
    i = 1 / (x * x)
    return total + 1 / x + i / 2 + i / x * (1 / 6 - i * (1 / 30 - i * (1 / 42 - i / 30)))


def _beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(1 - x, b, a)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    f, c, d = 1.0, 1.0, 0.0
    for i in range(500):
        m = i // 2
        if i == 0:
            num = 1.0
        elif i % 2 == 0:
            num = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            num = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / max(1 + num * d, 1e-300) if 1 + num * d > 0 else 1 / (1 + num * d)
        c = 1 + num / c
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def f_quantile(p: float, d1: float, d2: float) -> float:
    """Quantile of the F distribution by bisection."""
    low, high = 0.0, 1.0
    while _beta_share(d1 * high / (d1 * high + d2), d1 / 2, d2 / 2) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        below = _beta_share(d1 * mid / (d1 * mid + d2), d1 / 2, d2 / 2) < p
        low, high = (mid, high) if below else (low, mid)
    return (low + high) / 2
