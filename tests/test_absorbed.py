"""Fits with absorbed categories against dummy matrices."""

import numpy as np
import pandas as pd
import pytest

from promolens.operators.absorbed import absorbed_ols


def sample(n=600, seed=2):
    r = np.random.default_rng(seed)
    a = np.where(r.random(n) < 0.4, "hot", r.choice(list("pqrstu"), n))
    b = r.choice([f"w{i}" for i in range(9)], n)
    x = r.normal(size=(n, 3)) + (a == "hot")[:, None]
    y = 1.5 * x[:, 0] - 2 * x[:, 1] + (b == "w3") * 2.0 + (a == "hot") * 3.0 + r.normal(0, 0.5, n)
    return pd.DataFrame({"g": np.where(r.random(n) < 0.6, "one", "two"), "a": a, "b": b, **{f"x{i}": x[:, i] for i in range(3)}, "y": y, "w": r.uniform(0.5, 2, n)})


def with_dummies(part, cats, features, weight=None):
    columns = [part[features].to_numpy()]
    columns += [pd.get_dummies(part[c], dtype=float).iloc[:, (1 if i else 0):].to_numpy() for i, c in enumerate(cats)] or [np.ones((len(part), 1))]
    x, w = np.hstack(columns), np.sqrt(part[weight].to_numpy() if weight else np.ones(len(part)))
    beta, *_ = np.linalg.lstsq(x * w[:, None], part["y"].to_numpy() * w, rcond=None)
    gap = (part["y"].to_numpy() - x @ beta) * w
    cov = np.linalg.inv((x * w[:, None]).T @ (x * w[:, None])) * (gap @ gap) / (len(part) - x.shape[1])
    return beta[: len(features)], beta[: len(features)] / np.sqrt(np.diag(cov)[: len(features)]), x.shape[1] - len(features)


@pytest.mark.parametrize("cats,weight", [([], None), (["a"], None), (["a", "b"], None), (["a"], "w"), (["a", "b"], "w")])
def test_coefficients_equal_dummies(spark, cats, weight):
    from promolens.functions.linear import t_pvalue

    rows, features = sample(), ["x0", "x1", "x2"]
    found = absorbed_ols(spark.createDataFrame(rows).repartition(4), ["g"], cats, features, "y", weight).toPandas().set_index("g")
    for g, part in rows.groupby("g"):
        beta, t, levels = with_dummies(part, cats, features, weight)
        fit = found.loc[g]
        assert fit["n"] == len(part) and fit["levels"] == levels and len(fit["aliased"]) == 0
        assert np.allclose([fit[f"coeff_{c}"] for c in features], beta, atol=1e-7)
        assert np.allclose([fit[f"p_coeff_{c}"] for c in features], t_pvalue(t, np.full(3, len(part) - levels - 3)), atol=1e-6)


def test_dependent_columns_are_named(spark):
    rows = sample(200)
    rows["twice"], rows["level"], rows["flat"] = rows["x0"] * 2 + rows["x1"], (rows["a"] == "hot") * 1.0, 4.0
    rows.loc[0, "y"] = np.nan
    found = absorbed_ols(spark.createDataFrame(rows), ["g"], ["a"], ["x0", "x1", "twice", "level", "flat", "x2"], "y").collect()
    for fit in found:
        assert list(fit.aliased) == ["twice", "level", "flat"] and fit.coeff_twice is None and fit.p_coeff_flat is None
        part = rows[(rows["g"] == fit.g) & rows["y"].notna()]
        assert [fit.coeff_x0, fit.coeff_x1, fit.coeff_x2] == pytest.approx(with_dummies(part, ["a"], ["x0", "x1", "x2"])[0])


def test_missing_levels_and_small_groups(spark):
    rows = [("a", None, 1.0, 2.0), ("a", None, 2.0, 4.0), ("a", "x", 5.0, 1.0), ("b", "x", 1.0, 1.0), (None, "x", 1.0, 5.0), (None, "x", 3.0, 9.0)]
    found = {r.g: r for r in absorbed_ols(spark.createDataFrame(rows, "g string, c string, x double, y double"), ["g"], ["c"], ["x"], "y").collect()}
    assert found["a"].levels == 2 and found["a"].coeff_x == pytest.approx(2.0) and found[None].coeff_x == pytest.approx(2.0)
    assert list(found["b"].aliased) == ["x"] and found["b"].coeff_x is None and found["b"].r2 is None
