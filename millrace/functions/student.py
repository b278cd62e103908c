"""Two-sided tail of Student's t for one scalar (continued fraction of the beta ratio)."""

from __future__ import annotations

import math


def two_sided_p(t: float, freedom: float) -> float:
    """P(|T| >= |t|) with the given degrees of freedom."""
    if math.isinf(t):
        return 0.0
    if freedom <= 0 or math.isnan(t):
        return math.nan
    if freedom > 1e6:
        return math.erfc(abs(t) / math.sqrt(2.0))  # normal limit; lgamma would lose digits
    x = freedom / (freedom + t * t)
    return _regularised_beta(x, freedom / 2.0, 0.5)


def _regularised_beta(x: float, a: float, b: float) -> float:
    if x <= 0.0 or x >= 1.0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - _regularised_beta(1.0 - x, b, a)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    # Evaluate the fraction backwards; the depth covers large degrees of freedom.
    fraction = 1.0
    for m in range(400, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        fraction = 1.0 + even / (1.0 + odd / fraction)
    first = -(a + b) * x / (a + 1.0)
    return math.exp(log_front) / (a * (1.0 + first / fraction))
