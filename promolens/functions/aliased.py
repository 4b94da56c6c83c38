"""Least squares from summed cross products that names the columns it cannot tell apart."""

from __future__ import annotations

import numpy as np

from .linear import f_pvalue, t_pvalue


def solve_in_order(products: np.ndarray, spread: np.ndarray, rows: float, absorbed: int, tolerance: float = 1e-9) -> dict:
    """One group: ``products`` are sums over its centred columns, the target last; ``spread`` their sums of squares before centring by categories.

    Columns are taken in order. One whose part that earlier columns leave is below ``tolerance`` of it is aliased: it gets no
    coefficient, and the others are those of the fit without it. ``absorbed`` is the number of means taken out.
    """
    k = len(products) - 1
    own, yy = np.diag(products)[:k], products[k, k]
    size = np.sqrt(np.where(own > tolerance * np.maximum(spread[:k], 0), own, 0.0))
    scale = np.divide(1.0, size, out=np.zeros(k), where=size > 0)
    corr, kept, factor = products[:k, :k] * scale[:, None] * scale, [], np.zeros((k, k))
    for j in range(k):
        for m, i in enumerate(kept):
            factor[j, m] = (corr[j, i] - factor[j, :m] @ factor[i, :m]) / factor[i, m]
        left = corr[j, j] - factor[j, : len(kept)] @ factor[j, : len(kept)]
        if size[j] > 0 and left > tolerance:
            factor[j, len(kept)] = np.sqrt(left)
            kept.append(j)
    coef, p = np.full(k, np.nan), np.full(k, np.nan)
    dof = rows - len(kept) - absorbed
    ssr = yy
    if kept:
        lower = factor[kept][:, : len(kept)]
        inverse = np.linalg.inv(lower)
        beta = inverse.T @ (inverse @ (products[kept, k] * scale[kept]))
        coef[kept] = beta * scale[kept]
        ssr = max(yy - float(beta @ (products[kept, k] * scale[kept])), 0.0)
        if dof > 0 and ssr > 0:
            error = np.sqrt(ssr / dof * (inverse**2).sum(axis=0)) * scale[kept]
            p[kept] = t_pvalue(coef[kept] / error, np.full(len(kept), dof))
    varies = yy > tolerance * max(float(spread[k]), 0.0)
    f = (yy - ssr) / len(kept) / (ssr / dof) if kept and dof > 0 and ssr > 0 else np.nan
    return {"coef": coef, "p": p, "aliased": [j for j in range(k) if j not in kept], "r2": 1 - ssr / yy if varies else np.nan, "f": f,
            "f_p": float(f_pvalue(np.array([f]), len(kept), dof)[0]) if np.isfinite(f) else np.nan, "rmse": np.sqrt(max(ssr, 0.0) / rows), "dof": dof}
