"""Gompertz depletion curve as column expressions.

``A`` is the plateau, ``DR`` the largest slope, ``DL`` the delay before depletion starts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Curve constants.
EXPONENT_LIMIT = 700.0
DL_PENALTY = 6e-3
SLOPE_SHARE = 1.8
SPAN_SLACK = 3.0
# End of fixed values.


def _exponent(x: Column, A: Column, DR: Column, DL: Column) -> Column:
    u = DR * math.e / A * (DL - x) + 1
    return F.least(F.greatest(u, F.lit(-EXPONENT_LIMIT)), F.lit(EXPONENT_LIMIT))


def gompertz_eval(x: Column, A: Column, DR: Column, DL: Column) -> Column:
    curve = A * F.exp(-F.exp(_exponent(x, A, DR, DL)))
    return F.when(A == 0, F.lit(0.0)).otherwise(curve)


def gompertz_slope(x: Column, A: Column, DR: Column, DL: Column) -> Column:
    u = _exponent(x, A, DR, DL)
    return F.when(A != 0, DR * math.e * F.exp(u - F.exp(u)))


def robust_loss(residual: Column, weight: Column) -> Column:
    """Quadratic up to one, linear beyond."""
    z = F.pow(residual * weight, F.lit(2.0))
    return F.when(z <= 1, z).otherwise(2 * F.sqrt(z) - 1)


def fit_objective(points, A: Column, DR: Column, DL: Column) -> Column:
    """Penalised loss over a bounded list of (time, observed, weight) columns."""
    total = F.lit(DL_PENALTY) * F.abs(DL)
    for x, y, w in points:
        total = total + robust_loss(y - gompertz_eval(x, A, DR, DL), w)
    return total


def span_slack(A: Column, DR: Column, DL: Column, t_last: float) -> Column:
    """Constraint 1, feasible when >= 0: the whole transition ends shortly after the last point."""
    return F.lit(t_last + SPAN_SLACK) - F.abs(A) / F.abs(DR) - DL


def smooth_slack(A: Column, DR: Column, DL: Column) -> Column:
    """Constraint 2, feasible when >= 0: the slope one unit around its maximum stays high."""
    peak = DL + A / DR / math.e
    around = F.abs(gompertz_slope(peak - 1, A, DR, DL)) + F.abs(gompertz_slope(peak + 1, A, DR, DL))
    return around - SLOPE_SHARE * F.abs(DR)


def time_at(p: float, A: Column, DR: Column, DL: Column) -> Column:
    """Time at which the curve reaches the share ``p`` of its plateau."""
    return DL - F.abs(A) / (F.abs(DR) * math.e) * (math.log(-math.log(p)) - 1)
