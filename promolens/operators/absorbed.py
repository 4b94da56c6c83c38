"""Grouped regressions with categories as fixed effects, without a column for each level.

The means of a category's levels are taken out of target and regressors, category after category, until no column
changes by more than ``tolerance`` of its deviation; one category needs one sweep. What is left is regressed on sums of
products, which Spark adds up by group; dependent columns are named. Rows may carry a weight.

Scale: a sweep is an aggregation with map-side combine and a join on (group, level) for each category, and its rows
are written, so the plan does not grow with the sweeps. The solver sees k x k numbers for each group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import aliased, linear
from ..functions.numeric import dbl
from ..session import Workspace

# Workers get the solver with the function and need no installed package.
cloudpickle.register_pickle_by_value(aliased)
cloudpickle.register_pickle_by_value(linear)


def _centred(rows: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns less their weighted means by ``keys``, null-safe."""
    means = rows.groupBy(*keys).agg(*[(F.sum(F.col("_w") * F.col(c)) / F.sum("_w")).alias(f"_m{c}") for c in columns])
    means = means.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[f"_m{c}" for c in columns])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(means, same).select(*[c for c in rows.columns if c not in columns], *[(F.col(c) - F.col(f"_m{c}")).alias(c) for c in columns])


def absorb(rows: DataFrame, group: list[str], categories: list[str], columns: list[str], work: Workspace, tolerance: float = 1e-9, sweeps: int = 200) -> DataFrame:
    """The columns without the means of every category, by alternating sweeps; two or more categories repeat until nothing moves."""
    if len(categories) < 2:
        return work.keep(_centred(rows, [*group, *categories], columns), "centred0")
    spread = rows.agg(*[F.stddev_pop(c).alias(c) for c in columns]).first()
    before = rows
    for n in range(sweeps):
        after = before
        for c in categories:
            after = _centred(after, [*group, c], columns)
        after = work.keep(after, f"centred{n}")
        # Rows carry a number, so the move of a sweep is seen row by row.
        moved = after.select("_row", *columns).join(before.select("_row", *[F.col(c).alias(f"_b{c}") for c in columns]), "_row")
        most = moved.agg(*[F.max(F.abs(F.col(c) - F.col(f"_b{c}"))).alias(c) for c in columns]).first()
        before = after
        if all((most[c] or 0.0) <= tolerance * (spread[c] or 1.0) for c in columns):
            break
    return before


def absorbed_ols(
    df: DataFrame, group: list[str], categories: list[str], features: list[str], target: str, weight: str | None = None, tolerance: float = 1e-9,
) -> DataFrame:
    """One fit per group: n, levels (means taken out), r2 (of what the categories leave), f, f_prob, rmse, aliased and coeff_, p_coeff_ per feature.

    An aliased feature has neither coefficient nor p. Rows with a missing target, feature or weight are left out, a missing category is a
    level of its own. With two categories their levels count less one, as where they are connected.
    """
    work, names = Workspace(df.sparkSession), [f"x{i}" for i in range(len(features))] + ["y"]
    w = F.lit(1.0) if weight is None else dbl(weight)
    rows = df.select(*dict.fromkeys([*group, *categories]), w.alias("_w"), *[dbl(c).alias(n) for c, n in zip([*features, target], names)]).dropna(subset=["_w", *names])
    rows = work.keep(rows.where("_w > 0").withColumn("_row", F.monotonically_increasing_id()), "rows")
    whole = _centred(rows, group, names)
    spread = whole.groupBy(*group).agg(F.array(*[F.sum(F.col("_w") * F.col(n) * F.col(n)) for n in names]).alias("spread"))
    levels = [F.count_distinct(F.to_json(F.struct(c))) for c in categories]
    counted = rows.groupBy(*group).agg(F.count("*").alias("n"), (sum(levels[1:], levels[0]) - (len(levels) - 1) if levels else F.lit(1).cast("long")).alias("levels"))
    left = absorb(rows, group, categories, names, work, tolerance)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = left.groupBy(*group).agg(F.array(*[F.sum(F.col("_w") * F.col(names[i]) * F.col(names[j])) for i, j in pairs]).alias("products"))
    k, labels = len(features), list(features)

    @F.pandas_udf("coef array<double>, p array<double>, aliased array<string>, r2 double, f double, f_p double, rmse double")
    def solved(products: pd.Series, spread: pd.Series, n: pd.Series, levels: pd.Series) -> pd.DataFrame:
        out = []
        for upper, s, rows_, taken in zip(products, spread, n, levels):
            full = np.zeros((k + 1, k + 1))
            full[np.triu_indices(k + 1)] = upper
            full = full + full.T - np.diag(np.diag(full))
            fit = aliased.solve_in_order(full, np.asarray(s, float), float(rows_), int(taken))
            out.append(([None if np.isnan(v) else v for v in fit["coef"]], [None if np.isnan(v) else v for v in fit["p"]], [labels[j] for j in fit["aliased"]],
                        *[None if np.isnan(fit[c]) else float(fit[c]) for c in ("r2", "f", "f_p", "rmse")]))
        return pd.DataFrame(out, columns=["coef", "p", "aliased", "r2", "f", "f_p", "rmse"])

    joined = counted
    for part in (spread, sums):
        renamed = part.select(*[F.col(g).alias(f"_k{i}") for i, g in enumerate(group)], part.columns[-1])
        same = F.lit(True)
        for i, g in enumerate(group):
            same = same & F.col(g).eqNullSafe(F.col(f"_k{i}"))
        joined = joined.join(renamed, same).drop(*[f"_k{i}" for i in range(len(group))])
    fits = joined.withColumn("_fit", solved("products", "spread", "n", "levels"))
    return fits.select(
        *group, "n", "levels", F.col("_fit.r2").alias("r2"), F.col("_fit.f").alias("f"), F.col("_fit.f_p").alias("f_prob"), F.col("_fit.rmse").alias("rmse"), F.col("_fit.aliased").alias("aliased"),
        *[F.col("_fit.coef")[i].alias(f"coeff_{c}") for i, c in enumerate(features)], *[F.col("_fit.p")[i].alias(f"p_coeff_{c}") for i, c in enumerate(features)])
