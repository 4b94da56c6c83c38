"""Small linear-model maths on stacked sufficient statistics."""

from __future__ import annotations

import numpy as np


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = 300) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, steps + 1):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + num * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + num / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * c * d
    return h


def _log_gamma(z: np.ndarray) -> np.ndarray:
    """Stirling series after shifting the argument upwards."""
    z = np.asarray(z, float)
    shift = np.zeros_like(z)
    for _ in range(8):
        shift += np.log(z)
        z = z + 1
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def incomplete_beta(a, b, x) -> np.ndarray:
    """Regularised incomplete beta function, elementwise."""
    a, b, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(b, float), np.clip(np.asarray(x, float), 0, 1))
    swap = x > (a + 1) / (a + b + 2)
    p, q, u = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    with np.errstate(all="ignore"):
        front = np.exp(
            _log_gamma(p + q) - _log_gamma(p) - _log_gamma(q)
            + p * np.log(np.maximum(u, 1e-300)) + q * np.log(np.maximum(1 - u, 1e-300))
        )
        part = np.where(u <= 0, 0.0, front * _beta_fraction(p, q, u) / p)
    return np.where(swap, 1 - part, part)


def t_pvalue(t, dof) -> np.ndarray:
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    return incomplete_beta(dof / 2, 0.5, dof / (dof + t * t))


def f_pvalue(f, d1, d2) -> np.ndarray:
    f = np.asarray(f, float)
    return incomplete_beta(np.asarray(d2, float) / 2, np.asarray(d1, float) / 2, d2 / (d2 + d1 * np.maximum(f, 0)))


def solve(mean_x: np.ndarray, dev_x: np.ndarray, mean_y: np.ndarray, dev_y: np.ndarray, zz: np.ndarray, zy: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Least squares with a constant for many groups at once, from standardised sums.

    ``zz`` and ``zy`` are sums of products of the columns after each was centred by its group's
    mean and divided by its group's deviation (columns without spread stay 0), so neither the size nor the
    offset of a column matters to the rank. Where the columns depend on each other the coefficients
    are those of least norm in the given units. Also R2, p-values of the coefficients and of the whole fit, and
    variance inflation factors; the constant comes first.
    """
    groups, k, _ = zz.shape
    scale = np.divide(1.0, dev_x, out=np.zeros_like(dev_x), where=dev_x > 0)
    corr = zz / n[:, None, None]
    inverse = np.linalg.pinv(corr, rcond=1e-10, hermitian=True)
    rank = 1 + np.linalg.matrix_rank(corr, tol=1e-10, hermitian=True)
    standard = np.einsum("gij,gj->gi", inverse, zy / n[:, None])
    slopes = standard * scale * dev_y[:, None]
    coef = np.concatenate([(mean_y - (slopes * mean_x).sum(axis=1))[:, None], slopes], axis=1)
    # A generalised inverse of X'X in the given units.
    g = np.zeros((groups, k + 1, k + 1))
    inner = inverse * scale[:, :, None] * scale[:, None, :] / n[:, None, None]
    side = -np.einsum("gij,gj->gi", inner, mean_x)
    g[:, 1:, 1:], g[:, 0, 1:], g[:, 1:, 0] = inner, side, side
    g[:, 0, 0] = 1 / n - np.einsum("gi,gi->g", side, mean_x)
    full = rank == k + 1
    for i in np.flatnonzero(~full):
        values, vectors = np.linalg.eigh(corr[i])
        free = vectors[:, values <= 1e-10].T
        # A direction that changes no fitted value: steps in the columns, undone by the constant.
        steps = np.where(dev_x[i] > 0, free * scale[i], free)
        null = np.concatenate([-(steps @ mean_x[i])[:, None], steps], axis=1)
        basis = np.linalg.qr((null / np.abs(null).max(axis=1, keepdims=True)).T)[0]
        keep = np.eye(k + 1) - basis @ basis.T
        coef[i], g[i] = keep @ coef[i], keep @ g[i] @ keep
    explained = np.einsum("gi,gi->g", standard, zy / n[:, None])
    spread = n * dev_y**2
    ssr = np.maximum(1 - explained, 0.0) * spread
    varies = dev_y > 1e-12 * np.maximum(np.abs(mean_y), 1e-300)
    with np.errstate(all="ignore"):
        r2 = np.where(varies, np.minimum(explained, 1.0), np.nan)
        dof = n - rank
        sigma2 = np.where(dof > 0, ssr / dof, np.nan)
        se = np.sqrt(sigma2[:, None] * np.maximum(np.einsum("gii->gi", g), 0))
        p = np.where(se > 0, t_pvalue(coef / se, np.maximum(dof, 1)[:, None]), np.nan)
        model_dof = rank - 1
        f = np.where((model_dof > 0) & (dof > 0), ((spread - ssr) / np.maximum(model_dof, 1)) / sigma2, np.nan)
        fp = np.where(np.isfinite(f), f_pvalue(np.nan_to_num(f), np.maximum(model_dof, 1), np.maximum(dof, 1)), np.nan)
        constant = n * np.einsum("gii->gi", g)[:, 0]
        vif = np.where(full[:, None], np.concatenate([constant[:, None], np.einsum("gii->gi", inverse)], axis=1), np.inf)
    return {"coef": coef, "r2": r2, "p": p, "f_p": fp, "vif": vif}
