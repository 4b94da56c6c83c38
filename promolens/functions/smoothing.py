"""Additive exponential smoothing with damped trend and season: one series, or a block of series side by side.

Blocks are used inside Arrow functions; Spark places the series.
"""

from __future__ import annotations

import numpy as np


def start_values(y: np.ndarray, season: int) -> tuple[float, float, np.ndarray]:
    """Level, trend and season from the first two seasons."""
    level = y[:season].mean()
    trend = (y[season:2 * season].mean() - level) / season if len(y) >= 2 * season else 0.0
    return float(level), float(trend), y[:season] - level


def run(y: np.ndarray, season: int, alpha: float, beta: float, gamma: float, phi: float):
    """Level, trend, season and one-step fit for every observation."""
    l, b, s0 = start_values(y, season)
    level, trend, cycle, fit, s = [], [], [], [], s0.tolist()
    # Plain floats: a step is a few sums, for which array elements cost more than the sums.
    for t, value in enumerate(y.tolist()):
        i = t % season
        old, ahead = s[i], l + phi * b
        fit.append(ahead + old)
        new = alpha * (value - old) + (1 - alpha) * ahead
        b = beta * (new - l) + (1 - beta) * phi * b
        s[i] = gamma * (value - ahead) + (1 - gamma) * old
        l = new
        level.append(l)
        trend.append(b)
        cycle.append(s[i])
    return np.array(level), np.array(trend), np.array(cycle), np.array(fit)


def forecast(level, trend, cycle, season: int, phi: float, steps: int) -> np.ndarray:
    n = len(level)
    damp = np.cumsum(phi ** np.arange(1, steps + 1))
    tail = cycle[n - season:]
    return level[-1] + damp * trend[-1] + tail[np.arange(steps) % season]


# Bounds of alpha, beta, gamma and phi, and the grid from which the best starts are taken.
LOW, HIGH = np.array([0.01, 0.0, 0.0, 0.8]), np.array([0.99, 0.9, 0.9, 0.995])
GRID = np.array([(a, b, g, f) for a in (0.1, 0.4, 0.8) for b in (0.02, 0.2) for g in (0.05, 0.3) for f in (0.85, 0.99)])
PROBES = np.array([
    [v if i == j else w if i == k else np.nan for i in range(4)]
    for j, k in ((0, 3), (1, 3), (2, 3), (0, 1)) for v in (0.05, 0.3, 0.7) for w in (0.82, 0.95, 0.99)
])
DAMPING = np.array([1e-2, 1.0, 1e2, 1e4])


def side_by_side(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Series stored one after another as columns of a week x series block, zeros after the end of each."""
    block = np.zeros((int(lengths.max(initial=0)), len(lengths)))
    begins = np.cumsum(lengths) - lengths
    block[np.arange(len(values)) - np.repeat(begins, lengths), np.repeat(np.arange(len(lengths)), lengths)] = values
    return block


def _starts(y: np.ndarray, season: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    level = y[:season].mean(axis=0)
    return level, (y[season:2 * season].mean(axis=0) - level) / season, y[:season] - level


def run_block(y: np.ndarray, season: int, p: np.ndarray):
    """Level, trend, season and one-step fit of every series, one vector a week; ``p`` is 4 x series."""
    alpha, beta, gamma, phi = p
    l, b, s = _starts(y, season)
    s = list(s)
    level, trend, cycle, fit = (np.empty_like(y) for _ in range(4))
    for t, value in enumerate(y):
        old, ahead = s[t % season], l + phi * b
        fit[t] = ahead + old
        level[t] = alpha * (value - old) + (1 - alpha) * ahead
        b = trend[t] = beta * (level[t] - l) + (1 - beta) * phi * b
        s[t % season] = cycle[t] = gamma * (value - ahead) + (1 - gamma) * old
        l = level[t]
    return level, trend, cycle, fit


def errors(y: np.ndarray, lengths: np.ndarray, season: int, p: np.ndarray) -> np.ndarray:
    """Squared error by candidate and series; ``p`` is 4 x candidates x series."""
    alpha, beta, gamma, phi = p
    l, b, s = _starts(y, season)
    s, total, shortest = list(s), 0.0, lengths.min()
    keep_a, keep_b, keep_g = 1 - alpha, (1 - beta) * phi, 1 - gamma
    for t, value in enumerate(y):
        old, ahead = s[t % season], l + phi * b
        rest = value - ahead
        gap = np.square(rest - old)
        total = total + (gap if t < shortest else np.where(t < lengths, gap, 0.0))
        new = alpha * (value - old) + keep_a * ahead
        b = beta * (new - l) + keep_b * b
        s[t % season] = gamma * rest + keep_g * old
        l = new
    return np.where(np.isfinite(total), total, np.inf)


def slopes(y: np.ndarray, lengths: np.ndarray, season: int, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """J'r (series x 4) and J'J (series x 4 x 4) of the one-step fits, derivatives carried along the recursion."""
    alpha, beta, gamma, phi = p
    n = y.shape[1]
    l, b, s = _starts(y, season)
    s = list(s)
    dl, db, ds = np.zeros((4, n)), np.zeros((4, n)), [np.zeros((4, n))] * season
    right, square, shortest = np.zeros((4, n)), np.zeros((4, 4, n)), lengths.min()
    keep_a, keep_b, keep_g = 1 - alpha, 1 - beta, 1 - gamma
    damped = keep_b * phi
    for t, value in enumerate(y):
        i = t % season
        old, dold, ahead = s[i], ds[i], l + phi * b
        dahead = dl + phi * db
        dahead[3] += b
        rest = value - ahead
        gap = rest - old
        dfit = dahead + dold
        if t >= shortest:
            dfit = np.where(t < lengths, dfit, 0.0)
        right += dfit * gap
        square += dfit[:, None] * dfit
        new = alpha * (value - old) + keep_a * ahead
        dnew = keep_a * dahead - alpha * dold
        dnew[0] += gap
        db = beta * (dnew - dl) + damped * db
        db[1] += new - l - phi * b
        db[3] += keep_b * b
        dold = keep_g * dold - gamma * dahead
        dold[2] += gap
        ds[i] = dold
        b = beta * (new - l) + damped * b
        s[i] = gamma * rest + keep_g * old
        l, dl = new, dnew
    return right.T, square.transpose(2, 0, 1)


def _descend(y: np.ndarray, lengths: np.ndarray, season: int, p: np.ndarray, rounds: int, tolerance: float):
    """Damped Gauss-Newton inside the bounds; columns that have ended leave the block.

    The Hessian is approximated by J'J. A parameter at a bound that the error pushes outward is held there. Four
    dampings are tried at once and the best one kept. A column has converged when its slope along the free
    parameters is small against its error, or when no damping lowers the error any more.
    """
    best = errors(y, lengths, season, p[:, None])[0]
    scale = np.square(y).sum(axis=0) * 1e-20
    done, damping, open_ = best <= scale, np.full(p.shape[1], 1e-3), np.flatnonzero(best > scale)
    reach = HIGH - LOW
    for _ in range(rounds):
        if not len(open_):
            break
        yo, no, po = y[:, open_], lengths[open_], p[:, open_]
        right, square = slopes(yo, no, season, po)
        held = ((po.T <= LOW) & (right < 0)) | ((po.T >= HIGH) & (right > 0)) | ~np.isfinite(right)
        right = np.where(held, 0.0, right)
        square = np.where(held[:, :, None] | held[:, None, :] | ~np.isfinite(square), 0.0, square)
        weight = np.einsum("nii->ni", square)
        weight = np.maximum(weight, weight.max(axis=1, keepdims=True) * 1e-12) + 1e-300
        lam = damping[open_][:, None] * DAMPING
        lhs = square[:, None] + (lam[:, :, None] * weight[:, None])[..., None] * np.eye(4)
        # Scaled to a unit diagonal: sums of different size stay solvable.
        root = np.sqrt(weight)[:, None]
        step = np.linalg.solve(
            lhs / (root[..., None] * root[..., None, :]) + 1e-14 * np.eye(4), (right[:, None] / root)[..., None]
        )[..., 0] / root
        tried = np.clip(po.T[:, None] + step, LOW, HIGH).transpose(2, 1, 0)
        found = errors(yo, no, season, tried)
        pick = found.argmin(axis=0)
        at = np.arange(len(open_))
        lower = found[pick, at] < best[open_]
        gain = np.where(lower, best[open_] - found[pick, at], 0.0)
        flat = (np.abs(right) * reach).max(axis=1) <= tolerance * best[open_]
        ended = flat | (~lower & (lam[:, -1] > 1e8)) | (lower & (gain <= tolerance * 0.1 * best[open_]))
        p[:, open_[lower]] = tried[:, pick, at][:, lower]
        best[open_] -= gain
        damping[open_] = np.clip(np.where(lower, lam[at, pick], lam[:, -1] * 10), 1e-9, 1e12)
        done[open_[ended | (best[open_] <= scale[open_])]] = True
        open_ = open_[~done[open_]]
    return p, best, done & np.isfinite(best)


def fit_block(
    y: np.ndarray, lengths: np.ndarray, season: int, follow: int = 4, first_rounds: int = 5, rounds: int = 40, scans: int = 1, tolerance: float = 1e-6
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parameters (4 x series) with the least squared error, that error, and whether the search converged.

    Every series has at least two seasons. All points of the grid go down for ``first_rounds``; the best ``follow``
    of each series go on for up to ``rounds``.
    """
    n, m = y.shape[1], len(GRID)
    with np.errstate(over="ignore", invalid="ignore"):
        p = np.repeat(GRID, n, axis=0).T.copy()
        p, best, _ = _descend(np.tile(y, (1, m)), np.tile(lengths, m), season, p, first_rounds, tolerance)
        kept = best.reshape(m, n).argsort(axis=0, kind="stable")[:follow] * n + np.arange(n)
        p = p[:, kept.ravel()]
        p, best, done = _descend(np.tile(y, (1, follow)), np.tile(lengths, follow), season, p, rounds, tolerance)
        pick = best.reshape(follow, n).argmin(axis=0) * n + np.arange(n)
        p, best, done = p[:, pick], best[pick], done[pick]
        for _ in range(scans):
            # Probes along two axes at once leave a local dip; the columns that find a lower point go down again.
            probes = np.repeat(p[:, None], len(PROBES), axis=1)
            probes = np.where(np.isnan(PROBES.T)[:, :, None], probes, PROBES.T[:, :, None])
            found = errors(y, lengths, season, probes)
            low = np.argsort(found, axis=0, kind="stable")[:follow]
            again = probes[:, low, np.arange(n)].reshape(4, -1)
            q, e, d = _descend(np.tile(y, (1, follow)), np.tile(lengths, follow), season, again, rounds, tolerance)
            pick = e.reshape(follow, n).argmin(axis=0) * n + np.arange(n)
            lower = e[pick] < best
            p[:, lower], best[lower], done[lower] = q[:, pick][:, lower], e[pick][lower], d[pick][lower]
    return p, best, done


def fit(y: np.ndarray, season: int) -> tuple[float, float, float, float]:
    """Parameters of one series."""
    p, _, _ = fit_block(np.asarray(y, float)[:, None], np.array([len(y)]), season)
    return tuple(float(v) for v in p[:, 0])


def forecast_block(level, trend, cycle, lengths: np.ndarray, season: int, phi: np.ndarray, steps: int) -> np.ndarray:
    """Weeks ahead of every series, steps x series."""
    at, ahead = np.arange(len(lengths)), np.arange(steps)[:, None]
    damp = np.cumsum(phi ** (ahead + 1), axis=0)
    return level[lengths - 1, at] + damp * trend[lengths - 1, at] + cycle[lengths - season + ahead % season, at]
