"""Small numeric helpers: least squares, tail probabilities and the model recursions of single short series."""

from __future__ import annotations

import math

import numpy as np


def ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Coefficients, residual sum of squares and standard errors; constant columns are the caller's."""
    beta, _, rank, _ = np.linalg.lstsq(x, y, rcond=None)
    e = y - x @ beta
    rss, free = float(e @ e), len(y) - rank
    s2 = rss / free if free > 0 else math.nan
    return beta, rss, np.sqrt(np.maximum(np.diag(np.linalg.pinv(x.T @ x)) * s2, 0))


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_inc(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log(1 - x)) / a
    c, d, h = 1.0, 1 / max(1e-300, abs(1 - (a + b) * x / (a + 1))), 0.0
    h = d
    for m in range(1, 400):
        for up in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + up * d
            c = 1 + up / c
            d = 1 / (d if abs(d) > 1e-300 else 1e-300)
            h *= c * d
        if abs(c * d - 1) < 1e-12:
            break
    return front * h


def f_tail(f: float, d1: float, d2: float) -> float:
    """P(F > f)."""
    return 1.0 if f <= 0 else beta_inc(d2 / 2, d1 / 2, d2 / (d2 + d1 * f))


def t_tail(t: float, d: float) -> float:
    """P(|T| > |t|)."""
    return beta_inc(d / 2, 0.5, d / (d + t * t))


def chi2_tail(x: float, k: float) -> float:
    """P(X > x), by series or continued fraction of the incomplete gamma function."""
    a, x = k / 2, x / 2
    if x <= 0:
        return 1.0
    front = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-15:
            n += 1
            term *= x / n
            total += term
        return 1 - front * total
    b, c = x + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * h


def lagged(x: np.ndarray, lags: int) -> np.ndarray:
    """Columns of the values 1 to `lags` rows before, for rows from `lags` on."""
    return np.column_stack([x[lags - k : len(x) - k] for k in range(1, lags + 1)]) if lags else np.zeros((len(x), 0))


def granger(y: np.ndarray, x: np.ndarray, lags: int) -> tuple[float, float, int]:
    """(F, p, rows): whether x's lags help beside y's own. Too few rows or a constant series: NaN."""
    n = len(y) - lags
    if n < 3 * lags + 3 or np.ptp(x) == 0 or np.ptp(y) == 0:
        return math.nan, math.nan, max(n, 0)
    own = np.column_stack([np.ones(n), lagged(y, lags)])
    both = np.column_stack([own, lagged(x, lags)])
    _, r0, _ = ols(own, y[lags:])
    _, r1, _ = ols(both, y[lags:])
    free = n - both.shape[1]
    f = (r0 - r1) / lags / (r1 / free) if r1 > 0 else math.inf
    return f, f_tail(f, lags, free), n


# MacKinnon's critical values for a unit-root test with a constant (1, 5 and 10 percent, large samples and their 1/n terms).
ADF_CRITICAL = [(0.01, -3.43035, -6.5393), (0.05, -2.86154, -2.8903), (0.10, -2.56677, -1.5384)]


def adf(y: np.ndarray, most: int = 4) -> tuple[float, int, bool]:
    """(t statistic, lags by AIC, stationary at 5 percent); fewer than 20 points or a constant series: not stationary."""
    if len(y) < 20 or np.ptp(y) == 0:
        return math.nan, 0, False
    d, best = np.diff(y), None
    for k in range(most + 1):
        rows = d[most:]
        x = np.column_stack([np.ones(len(rows)), y[most:-1], *(d[most - j : len(d) - j] for j in range(1, k + 1))])
        beta, rss, se = ols(x, rows)
        aic = len(rows) * math.log(max(rss, 1e-300) / len(rows)) + 2 * x.shape[1]
        if best is None or aic < best[0]:
            best = (aic, beta[1] / se[1] if se[1] > 0 else -math.inf, k)
    level = ADF_CRITICAL[1]
    return best[1], best[2], best[1] < level[1] + level[2] / len(y)


def ljung_box(e: np.ndarray, lags: int) -> tuple[float, float]:
    """(statistic, p) of the first autocorrelations."""
    n, c = len(e), e - e.mean()
    r = np.array([(c[k:] @ c[: n - k]) / (c @ c) for k in range(1, lags + 1)])
    q = n * (n + 2) * float((r * r / (n - np.arange(1, lags + 1))).sum())
    return q, chi2_tail(q, lags)


def kpss(y: np.ndarray) -> float:
    """Statistic of trend stationarity, with Newey-West weights."""
    n = len(y)
    x = np.column_stack([np.ones(n), np.arange(n)])
    e = y - x @ ols(x, y)[0]
    s, k = np.cumsum(e), int(4 * (n / 100) ** 0.25)
    var = e @ e / n + 2 * sum((1 - j / (k + 1)) * (e[j:] @ e[:-j]) / n for j in range(1, k + 1))
    return float(s @ s / (n * n * var)) if var > 0 else math.nan


def holt_winters(y: np.ndarray, horizon: int, season: int = 12, damping: float = 0.98) -> np.ndarray | None:
    """Additive trend and season, damped; smoothing weights from a grid, all of it at once, by squared error. Two seasons at least."""
    if len(y) < 2 * season or not np.isfinite(y).all():
        return None
    grid = np.array([(a, b, g) for a in (0.1, 0.3, 0.5, 0.8) for b in (0.01, 0.1, 0.3) for g in (0.05, 0.2, 0.5)])
    a, b, g = grid.T
    level = np.full(len(grid), y[:season].mean())
    trend = np.full(len(grid), (y[season : 2 * season].mean() - y[:season].mean()) / season)
    seasons = np.tile(y[:season] - y[:season].mean(), (len(grid), 1))
    sse = np.zeros(len(grid))
    for t in range(season, len(y)):
        s = seasons[:, t % season]
        e = y[t] - (level + damping * trend + s)
        sse += e * e
        new = level + damping * trend + a * e
        trend = damping * trend + a * b * e
        level = new
        seasons[:, t % season] = s + g * (1 - a) * e
    i = int(sse.argmin())
    ahead = np.cumsum(damping ** np.arange(1, horizon + 1))
    return level[i] + trend[i] * ahead + seasons[i, (len(y) + np.arange(horizon)) % season]


def arima111(y: np.ndarray, horizon: int) -> np.ndarray | None:
    """ARIMA(1,1,1) by conditional sum of squares over a grid of both coefficients, refined once."""
    if len(y) < 12 or not np.isfinite(y).all():
        return None
    d = np.diff(y)
    mean = d.mean()
    z = d - mean

    def fit(phi: np.ndarray, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e, sse = np.zeros(len(phi)), np.zeros(len(phi))
        for t in range(1, len(z)):
            e = z[t] - phi * z[t - 1] - theta * e
            sse += e * e
        return sse, e

    centre, wide = np.zeros(2), 0.9
    for _ in range(3):
        steps = np.linspace(-wide, wide, 13)
        phi, theta = (x.ravel() for x in np.meshgrid(np.clip(centre[0] + steps, -0.97, 0.97), np.clip(centre[1] + steps, -0.97, 0.97)))
        sse, last = fit(phi, theta)
        i = int(sse.argmin())
        centre, wide = np.array([phi[i], theta[i]]), wide / 6
    out, before, e = [], z[-1], last[i]
    for _ in range(horizon):
        before = centre[0] * before + centre[1] * e
        e = 0.0
        out.append(before + mean)
    return y[-1] + np.cumsum(out)


def structural(y: np.ndarray, horizon: int, bends: int = 5, waves: int = 3, ridge: float = 1.0) -> np.ndarray | None:
    """Piecewise-linear trend and yearly Fourier terms, by ridge regression on bends; the last slope goes on."""
    n = len(y)
    if n < 24 or not np.isfinite(y).all():
        return None
    t = np.arange(n + horizon) / n
    knots = np.linspace(0, 0.8, bends + 2)[1:-1]
    x = np.column_stack([np.ones(n + horizon), t, *(np.maximum(t - k, 0) for k in knots), *(f(2 * np.pi * w * np.arange(n + horizon) / 12) for w in range(1, waves + 1) for f in (np.sin, np.cos))])
    penalty = np.diag([1e-6, 1e-6, *[ridge] * len(knots), *[ridge / 10] * (2 * waves)])
    beta = np.linalg.solve(x[:n].T @ x[:n] + penalty, x[:n].T @ y)
    return x[n:] @ beta
