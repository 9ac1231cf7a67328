"""Numpy fits of one weekly series; each is called on one group by `forecasting`.

A fit takes the training values (and week ends) and returns the fitted values, the
forecast and the number of parameters. Series are bounded by the calendar.
"""

from __future__ import annotations

import datetime as dt
import itertools
from typing import NamedTuple

import numpy as np

# Non-seasonal orders (p, d, q) and seasonal (P, Q) choices of the grid.
ARIMA_ORDERS = [(0, 1, 1), (1, 1, 1), (1, 0, 1), (2, 1, 1)]
SEASONAL_CHOICES = [(0, 0), (1, 1)]
YEAR_WEEKS = 52


class Fit(NamedTuple):
    fitted: np.ndarray
    forecast: np.ndarray
    parameters: int


def smoothing_season(n: int) -> int:
    return min(YEAR_WEEKS, max(4, n // 2))


def arima_season(n: int) -> int:
    return min(YEAR_WEEKS, max(2, n // 3))


def _smooth(y: np.ndarray, m: int, rates: np.ndarray, keep: bool = False):
    """Additive level/trend/season recursion for all candidate ``rates`` at once."""
    alpha, beta, gamma = rates.T
    head = y[: 2 * m] if m else y[:2]
    half = m or 1
    level = np.full(len(rates), head[:half].mean())
    trend = np.full(len(rates), (head[half:].mean() - head[:half].mean()) / half)
    season = np.tile((head.reshape(2, m) - head.reshape(2, m).mean(axis=1, keepdims=True)).mean(axis=0) if m else [0.0], (len(rates), 1))
    sse, fitted = np.zeros(len(rates)), np.empty(len(y))
    for t, value in enumerate(y):
        slot = t % m if m else 0
        expected = level + trend + season[:, slot]
        miss = value - expected
        sse += miss * miss
        level = level + trend + alpha * miss
        trend = trend + alpha * beta * miss
        if m:
            season[:, slot] += gamma * (1 - alpha) * miss
        if keep:
            fitted[t] = expected[0]
    return sse, fitted, level, trend, season


def holt_winters(y: np.ndarray, horizon: int) -> Fit:
    """Additive trend and season; smoothing rates from a grid that is refined twice."""
    m = smoothing_season(len(y))
    if len(y) < 2 * m:
        m = 0
    best, width = np.array([0.5, 0.5, 0.5]), 0.5
    for _ in range(3):
        axes = [np.clip(np.linspace(c - width, c + width, 7), 0.001, 0.999) for c in best]
        if not m:
            axes[2] = np.array([0.0])
        candidates = np.array(list(itertools.product(*axes)))
        best = candidates[np.argmin(_smooth(y, m, candidates)[0])]
        width /= 3.5
    _, fitted, level, trend, season = _smooth(y, m, best[None, :], keep=True)
    ahead = np.arange(1, horizon + 1)
    slots = (len(y) + ahead - 1) % m if m else np.zeros(horizon, dtype=int)
    return Fit(fitted, level[0] + ahead * trend[0] + season[0, slots], 5 + m if m else 4)


def moving_average_of_steps(y: np.ndarray, horizon: int) -> Fit:
    """ARIMA (0, 1, 1) without season or constant, for any series of two values: the moving-average weight with the least sum of
    squared one-step errors, from a grid that is refined three times."""
    if len(y) < 2:
        raise ValueError("series too short for this order")
    steps = np.diff(y)

    def errors(weights: np.ndarray) -> np.ndarray:
        """One-step errors [time, weight]."""
        found = np.zeros((len(steps), len(weights)))
        shock = np.zeros(len(weights))
        for t, step in enumerate(steps):
            shock = found[t] = step - weights * shock
        return found

    best, width = 0.0, 0.99
    for _ in range(4):
        grid = np.clip(np.linspace(best - width, best + width, 41), -0.99, 0.99)
        best = float(grid[(errors(grid) ** 2).sum(axis=0).argmin()])
        width /= 20
    shocks = errors(np.array([best]))[:, 0]
    fitted = np.concatenate([[y[0]], y[1:] - shocks])
    return Fit(fitted, np.full(horizon, y[-1] + best * shocks[-1]), 2)


def _lagged(x: np.ndarray, lags: list[int]) -> np.ndarray:
    return np.column_stack([np.concatenate([np.zeros(k), x[:-k]]) for k in lags]) if lags else np.empty((len(x), 0))


def _polynomial_lags(order: int, seasonal: int, s: int) -> list[int]:
    return [*range(1, order + 1), *([s + i for i in range(order + 1)] if seasonal else [])]


def arima(y: np.ndarray, horizon: int, order: tuple, seasonal: tuple) -> Fit:
    """Two-stage least squares: a long autoregression supplies the innovations for the second fit."""
    (p, d, q), (sp, sq), s = order, seasonal, arima_season(len(y))
    z = np.diff(y, d) if d else y
    ar, ma = _polynomial_lags(p, sp, s), _polynomial_lags(q, sq, s)
    start = s + 3 - d
    long_lags = sorted({*range(1, min(12, len(z) // 6) + 1), *([s] if sp or sq else [])})
    if len(z) - start < 2 * (len(ar) + len(ma) + 1) or len(z) - start < len(long_lags) + 8:
        raise ValueError("series too short for this order")
    first = np.column_stack([np.ones(len(z)), _lagged(z, long_lags)])
    lead = max(long_lags)
    shocks = z - first @ np.linalg.lstsq(first[lead:], z[lead:], rcond=None)[0]
    shocks[:lead] = 0.0
    design = np.column_stack([np.ones(len(z)), _lagged(z, ar), _lagged(shocks, ma)])
    coef = np.linalg.lstsq(design[start:], z[start:], rcond=None)[0]

    path, innovations = np.concatenate([z, np.zeros(horizon)]), np.zeros(len(z) + horizon)
    expected = np.full(len(z) + horizon, np.nan)
    for t in range(start, len(path)):
        history = [path[t - k] for k in ar] + [innovations[t - k] for k in ma]
        expected[t] = coef[0] + coef[1:] @ np.array(history)
        if t < len(z):
            innovations[t] = z[t] - expected[t]
        else:
            path[t] = expected[t]
    if not np.isfinite(path).all() or np.var(innovations[start : len(z)]) > 4 * np.var(z):
        raise ValueError("unstable moving-average part")
    fitted = np.full(len(y), np.nan)
    fitted[d:] = expected[: len(z)] + (y[:-1] if d else 0.0)
    forecast = path[len(z) :]
    return Fit(fitted, y[-1] + np.cumsum(forecast) if d else forecast, len(coef) + 1)


def information_criteria(y: np.ndarray, fit: Fit) -> tuple[float, float, float]:
    """AIC, BIC and HQIC of Gaussian residuals."""
    r = (y - fit.fitted)[np.isfinite(fit.fitted)]
    n, k = len(r), fit.parameters
    deviance = n * (np.log(2 * np.pi * max(np.mean(r * r), 1e-12)) + 1)
    return deviance + 2 * k, deviance + k * np.log(n), deviance + 2 * k * np.log(np.log(n))


# US federal holidays as (month, day) or (month, weekday, n-th; -1 = last), Monday = 0.
US_FIXED_HOLIDAYS = {"new_year": (1, 1), "juneteenth": (6, 19), "independence": (7, 4), "veterans": (11, 11), "christmas": (12, 25)}
US_MOVING_HOLIDAYS = {
    "king": (1, 0, 3),
    "presidents": (2, 0, 3),
    "memorial": (5, 0, -1),
    "labor": (9, 0, 1),
    "columbus": (10, 0, 2),
    "thanksgiving": (11, 3, 4),
}


def us_holidays(year: int) -> dict[str, dt.date]:
    days = {name: dt.date(year, *md) for name, md in US_FIXED_HOLIDAYS.items()}
    for name, (month, weekday, nth) in US_MOVING_HOLIDAYS.items():
        first = dt.date(year, month, 1)
        matches = [first + dt.timedelta(days=(weekday - first.weekday()) % 7 + 7 * i) for i in range(5)]
        matches = [d for d in matches if d.month == month]
        days[name] = matches[nth - 1 if nth > 0 else nth]
    return days


def fourier_trend(y: np.ndarray, horizon: int, weeks: list[dt.date], holidays: dict[str, list[dt.date]]) -> Fit:
    """Ridge regression on a bending trend, a yearly Fourier series and holiday weeks."""
    n, scale = len(y), max(np.abs(y).max(), 1e-9)
    time = np.arange(n + horizon) / n
    bends = np.linspace(0, 0.8, 27)[1:-1]
    hinges = np.maximum(time[:, None] - bends, 0)
    angle = 2 * np.pi * np.array([w.toordinal() for w in weeks]) / 365.25
    waves = np.column_stack([f(k * angle) for k in range(1, 11) for f in (np.sin, np.cos)])
    inside = lambda days: np.array([any(0 <= (w - d).days < 7 for d in days) for w in weeks], dtype=float)
    marks = np.column_stack([inside(days) for days in holidays.values()]) if holidays else np.empty((n + horizon, 0))
    design = np.column_stack([np.ones(n + horizon), time, hinges, waves, marks])
    spread = np.concatenate([[5.0, 5.0], np.full(len(bends), 0.05), np.full(waves.shape[1] + marks.shape[1], 10.0)])
    x, target, noise = design[:n], y / scale, 0.1
    for _ in range(3):
        coef = np.linalg.solve(x.T @ x + np.diag((noise / spread) ** 2), x.T @ target)
        noise = max(np.std(target - x @ coef), 1e-4)
    estimate = design @ coef * scale
    return Fit(estimate[:n], estimate[n:], design.shape[1])
