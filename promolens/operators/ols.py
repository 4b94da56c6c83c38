"""Least squares per hierarchy group, model choice and scoring.

Every training row is copied to each hierarchy level once. The groups of all
levels are then summed in one aggregation (X'X, X'y), and only those small sums
reach the solver.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import linear
from ..functions.joins import all_pairs
from ..functions.numeric import dbl, fixed, mean_of, ratio
from ..functions.ranking import exact_quantile

# Workers get the solver with the function and need no installed package.
cloudpickle.register_pickle_by_value(linear)

# Hierarchy levels in the order of preference.
LEVELS = [["subcategory", "brand_name"], ["segment"], ["subcategory"]]
LEVELS_BY_CATEGORY = [["category", "brand_name"], ["segment"], ["subcategory"]]
LEVELS_BY_MECHANIC = [
    ["sku_root_id", "promo_mechanic_dd"], ["segment", "promo_mechanic_dd"],
    ["subcategory", "promo_mechanic_dd"], ["category", "promo_mechanic_dd"],
]
_GROUP = ["rank", "key"]


def all_keys(levels: list[list[str]]) -> list[str]:
    return list(dict.fromkeys(k for level in levels for k in level))


def _levels(levels: list[list[str]]) -> Column:
    """One struct per level: its rank, field names and key values."""
    return F.explode(F.array(*[
        F.struct(
            F.lit(i + 1).alias("rank"),
            F.lit(",".join(fields)).alias("agg_fields"),
            F.array(*[F.col(f).cast("string") for f in fields]).alias("key"),
        )
        for i, fields in enumerate(levels)
    ])).alias("_level")


def at_levels(df: DataFrame, levels: list[list[str]], columns: list[str]) -> DataFrame:
    return df.select(*columns, _levels(levels)).select(*columns, "_level.*")


def trimmed(rows: DataFrame, target: str, q: float | None) -> DataFrame:
    """Rows below the quantile of their group, with the number left out."""
    if q is None:
        return rows.withColumn("_limit", F.lit(None).cast("double")).withColumn("_in", F.lit(True))
    limits = exact_quantile(rows.select(*_GROUP, target), _GROUP, target, q, "_limit")
    return rows.join(limits, _GROUP).withColumn("_in", dbl(target) < F.col("_limit"))


def _standard_sums(rows: DataFrame, features: list[str], target: str) -> DataFrame:
    """Counts, means, deviations and standardised sums of products of every group.

    Means and deviations come first and are joined to the rows, so that the products are of order one whatever
    the units; their sums neither cancel nor depend visibly on the order of the partial sums.
    """
    names = [f"_x{i}" for i in range(len(features))] + ["_y"]
    rows = rows.select("rank", "agg_fields", "key", "_in", *[dbl(c).alias(n) for c, n in zip([*features, target], names)])
    inside = lambda c: F.when(F.col("_in"), c)
    first = rows.groupBy("rank", "agg_fields", "key").agg(
        F.count_if("_in").alias("no_data_points"), F.count_if(~F.col("_in")).alias("outlier_data_points"),
        F.array(*[F.avg(inside(F.col(n))) for n in names]).alias("_mean"),
        # Equal values have no deviation, whatever rounding says.
        F.array(*[F.when(F.min(inside(F.col(n))) == F.max(inside(F.col(n))), 0.0).otherwise(F.stddev_pop(inside(F.col(n)))) for n in names]).alias("_dev"))
    held = rows.where("_in").join(first.select(*_GROUP, "_mean", "_dev"), _GROUP)
    z = [F.when(F.col("_dev")[i] > 0, (F.col(n) - F.col("_mean")[i]) / F.col("_dev")[i]).otherwise(0.0) for i, n in enumerate(names)]
    held = held.select(*_GROUP, *[c.alias(f"_z{i}") for i, c in enumerate(z)])
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = held.groupBy(*_GROUP).agg(
        F.array(*[F.sum(F.col(f"_z{i}") * F.col(f"_z{j}")) for i, j in pairs]).alias("_zz"),
        F.array(*[F.sum(F.col(f"_z{i}") * F.col(f"_z{k}")) for i in range(k)]).alias("_zy"))
    return first.join(sums, _GROUP, "left")


def _solver(k: int):
    fields = ["coef array<double>", "r2 double", "p array<double>", "f_p double", "vif array<double>"]

    @F.pandas_udf(", ".join(fields))
    def solved(mean: pd.Series, dev: pd.Series, zz: pd.Series, zy: pd.Series, n: pd.Series) -> pd.DataFrame:
        means, devs, upper = (np.array(x.tolist(), float) for x in (mean, dev, zz))
        full = np.zeros((len(upper), k, k))
        rows, columns = np.triu_indices(k)
        full[:, rows, columns] = upper
        full[:, columns, rows] = upper
        out = linear.solve(means[:, :k], devs[:, :k], means[:, k], devs[:, k], full, np.array(zy.tolist(), float), n.to_numpy(float))
        return pd.DataFrame({name: (list(v) if v.ndim > 1 else v) for name, v in out.items()})

    return solved


def grouped_ols(
    train: DataFrame, levels: list[list[str]], features: list[str], target: str,
    min_rows: int = 3, trim_q: float | None = 0.95, names: dict[str, str] | None = None,
) -> DataFrame:
    """One model per group of every level, groups that are too small included without one.

    Columns: rank, agg_fields, key, no_data_points, outlier_data_points, r2, rmse,
    mean_error, mae, mape, f_prob and coeff_, p_coeff_, vif_ per feature.
    """
    names = names or {}
    rows = trimmed(at_levels(train, levels, [*features, target]), target, trim_q)
    sums = _standard_sums(rows, features, target)
    fits = sums.where(F.col("no_data_points") >= min_rows).withColumn(
        "_fit", _solver(len(features))("_mean", "_dev", "_zz", "_zy", "no_data_points")
    )
    terms = ["const", *[names.get(f, f) for f in features]]
    fits = fits.select(
        *_GROUP, F.col("_fit.r2").alias("r2"), F.col("_fit.f_p").alias("f_prob"),
        *[F.col("_fit.coef")[i].alias(f"coeff_{t}") for i, t in enumerate(terms)],
        *[F.col("_fit.p")[i].alias(f"p_coeff_{t}") for i, t in enumerate(terms)],
        *[F.col("_fit.vif")[i].alias(f"vif_{t}") for i, t in enumerate(terms)],
    )
    return _with_errors(sums, fits, rows, features, terms, target)


def _with_errors(
    sums: DataFrame, fits: DataFrame, rows: DataFrame, features: list[str], terms: list[str], target: str
) -> DataFrame:
    """Residual figures need the coefficients, so the rows are read once more."""
    estimate = F.col("coeff_const")
    for f, t in zip(features, terms[1:]):
        estimate = estimate + F.col(f"coeff_{t}") * dbl(f)
    left = rows.where("_in").join(fits.select(*_GROUP, *[f"coeff_{t}" for t in terms]), _GROUP)
    resid = left.select(*_GROUP, dbl(target).alias("y"), (dbl(target) - estimate).alias("e")).select(
        *_GROUP, fixed(F.col("e") * F.col("e")).alias("square"), fixed("e").alias("error"),
        F.abs("e").alias("size"), F.coalesce(F.abs(ratio("e", "y")), F.lit(0.0)).alias("share"),
    )
    means = resid.groupBy(*_GROUP).agg(F.sqrt(mean_of("square")).alias("rmse"), mean_of("error").alias("mean_error"))
    return (
        sums.select("rank", "agg_fields", "key", "no_data_points", "outlier_data_points")
        .join(fits, _GROUP, "left")
        .join(means, _GROUP, "left")
        .join(exact_quantile(resid, _GROUP, "size", 0.5, "mae"), _GROUP, "left")
        .join(exact_quantile(resid, _GROUP, "share", 0.5, "mape"), _GROUP, "left")
    )


def _candidates(train: DataFrame, models: DataFrame, levels: list[list[str]]) -> DataFrame:
    """Fitted models of every key combination, matched level by level."""
    keys = all_keys(levels)
    combos = at_levels(train.select(*keys).distinct(), levels, keys).drop("agg_fields")
    return combos.join(models.where(F.col("rmse").isNotNull()), _GROUP)


def best_model(
    train: DataFrame, models: DataFrame, levels: list[list[str]], r2_min: float = 0.2, r2_any: float | None = None
) -> DataFrame:
    """Smallest median error share, among models with enough R2 if there is one.

    ``r2_any`` is the R2 one model must reach before the filter applies.
    """
    keys = all_keys(levels)
    found = _candidates(train, models, levels)
    trigger = r2_min if r2_any is None else r2_any
    model = F.struct(*[c for c in found.columns if c not in keys])
    order = F.struct("mape", "rank")
    good = F.col("r2") >= r2_min
    picked = found.groupBy(*keys).agg(
        F.max(F.coalesce(F.col("r2") >= trigger, F.lit(False))).alias("_any"),
        F.min_by(model, F.when(good, order)).alias("_good"),
        F.min_by(model, order).alias("_all"),
    )
    chosen = F.when(F.col("_any"), F.col("_good")).otherwise(F.col("_all"))
    return picked.select(*keys, chosen.alias("_m")).select(*keys, "_m.*")


def best_model_by_samples(train: DataFrame, models: DataFrame, levels: list[list[str]], min_samples: int = 15) -> DataFrame:
    """Most detailed level, among models with enough samples if there is one."""
    keys = all_keys(levels)
    found = _candidates(train, models, levels)
    model = F.struct(*[c for c in found.columns if c not in keys])
    enough = F.col("no_data_points") >= min_samples
    picked = found.groupBy(*keys).agg(
        F.max(enough).alias("valid_dp"),
        F.min_by(model, F.when(enough, F.col("rank"))).alias("_good"),
        F.min_by(model, "rank").alias("_all"),
    )
    chosen = F.coalesce("_good", "_all")
    return picked.select(*keys, "valid_dp", chosen.alias("_m")).select(*keys, "valid_dp", "_m.*")


def model_stats(models: DataFrame) -> DataFrame:
    """Means, medians and spreads over the chosen models; one row."""
    rows = models.select(*[fixed(c).alias(c) for c in ("rmse", "mean_error", "r2")], "mae", "mape")
    sums = rows.agg(
        *[mean_of(c).alias(c) for c in ("rmse", "mean_error", "r2")],
        F.stddev_samp("mae").alias("mae_std"),
        F.stddev_samp("mape").alias("mape_std"),
    )
    return sums.withColumns({
        c: exact_quantile(rows, [], c, 0.5, "v").select("v").scalar() for c in ("mae", "mape")
    })


def score_ols(
    skus: DataFrame, depths: DataFrame, best: DataFrame, keys: list[str], features: list[str],
    names: dict[str, str] | None = None, out: str = "prediction",
) -> DataFrame:
    """Every product with every depth, its chosen model and the model's estimate."""
    names = names or {}
    estimate = F.col("coeff_const")
    for f in features:
        estimate = estimate + F.col(f"coeff_{names.get(f, f)}") * dbl(f)
    return all_pairs(skus, depths).join(best, keys).withColumn(out, estimate)
