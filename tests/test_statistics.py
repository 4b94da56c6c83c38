"""Ranks, quantiles, regressions, grouped least squares and training rules against brute force."""

import math
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from promolens.functions import linear
from promolens.functions.joins import all_pairs, spread_missing
from promolens.functions.numeric import fixed, rate_sum
from promolens.functions.ranking import exact_quantile, with_cume_dist, with_percent_rank
from promolens.operators import elasticity, models, ols


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(3)
    values = np.round(np.concatenate([rng.normal(0, 500, 3000), np.repeat(7.5, 1500), rng.normal(0, 1, 60)]), 2)
    keys = ["hot"] * 4500 + [f"k{i % 6}" for i in range(60)]
    pdf = pd.DataFrame({"k": keys, "v": values})
    return pdf, spark.createDataFrame(pdf)


def test_ranks_match_pandas(hot):
    pdf, df = hot
    group = pdf.groupby("k")["v"]
    want_cd = dict(zip(zip(pdf.k, pdf.v), group.rank(method="max") / group.transform("size")))
    want_pr = dict(zip(zip(pdf.k, pdf.v), (group.rank(method="min") - 1) / (group.transform("size") - 1)))
    cd, pr = with_cume_dist(df, ["k"], "v", "x").collect(), with_percent_rank(df, ["k"], "v", "x").collect()
    assert len(cd) == len(pr) == len(pdf)
    assert all(math.isclose(r.x, want_cd[(r.k, r.v)]) for r in cd)
    assert all(math.isclose(r.x, want_pr[(r.k, r.v)]) for r in pr)


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_quantiles_match_numpy(hot, q):
    pdf, df = hot
    got = {r.k: r.x for r in exact_quantile(df, ["k"], "v", q, "x").collect()}
    assert got == pytest.approx({k: float(np.quantile(g, q)) for k, g in pdf.groupby("k")["v"]})
    whole = exact_quantile(df, [], "v", q, "x").collect()[0].x
    assert whole == pytest.approx(float(np.quantile(pdf.v, q)))


def test_rank_of_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("a", -1.0), ("a", 2.0), ("b", 4.0)], "k string, v double")
    got = {(r.k, r.v): r.x for r in with_percent_rank(df, ["k"], "v", "x").collect()}
    assert got == {("a", None): 0.0, ("a", -1.0): 0.5, ("a", 2.0): 1.0, ("b", 4.0): 0.0}


def test_all_pairs_and_spread_keys(spark):
    a, b = spark.range(50).toDF("a"), spark.range(7).toDF("b")
    assert all_pairs(a, b).distinct().count() == 350
    df = spark.range(1000).select(F.when(F.col("id") % 10 == 0, "x").alias("key"), "id").withColumn("k", spread_missing("key", "id"))
    assert df.where("key is null").select("k").distinct().count() > 100
    assert df.where("key is not null and k != key").count() == 0


def points(spark, groups):
    rows = [("r", s, Decimal(str(p)), Decimal(str(q)), Decimal(str(p)), 5) for s, pts in groups.items() for p, q in pts]
    return spark.createDataFrame(rows, "sku_root_id string, store_id string, std_price_per_unit decimal(18,6), avg_sales_qty decimal(18,6), actual_price decimal(18,6), duration_weeks long")


def test_store_lines_of_small_and_flat_groups(spark):
    pts = points(spark, {"one": [(10, 5)], "two": [(10, 5), (12, 3)], "three": [(10, 6), (11, 5), (12, 1)], "price": [(10, 1), (10, 3)], "qty": [(10, 4), (12, 4), (14, 4)]})
    cost = spark.createDataFrame([("other", Decimal("1"))], "sku_root_id string, cost_per_unit decimal(18,6)")
    got = {r.store_id: r for r in elasticity.store_regression(pts, cost).collect()}
    assert (got["one"].coeficient, got["one"].intercept) == (0.0, 5.0)
    assert got["two"].coeficient == pytest.approx(-1) and got["two"].R2 == pytest.approx(1)
    slope, base = np.polyfit([10, 11, 12], [6, 5, 1], 1)
    assert (got["three"].coeficient, got["three"].intercept) == pytest.approx((slope, base))
    assert (got["price"].coeficient, got["price"].intercept, got["price"].R2) == (0.0, 2.0, 0.0)
    assert got["qty"].coeficient == pytest.approx(0, abs=1e-12) and got["qty"].R2 == 1.0 and got["qty"].cost_per_unit is None
    kept = elasticity.sku_elasticity(pts, elasticity.store_regression(pts, cost)).collect()
    assert len(kept) == 1 and kept[0].store_count == 1 and kept[0].optimal_price is None


def solved(x, y):
    """The solver on one group of plain rows, a constant added."""
    dev = np.where(x.min(axis=0) == x.max(axis=0), 0, x.std(axis=0))
    z = np.where(dev > 0, (x - x.mean(axis=0)) / np.where(dev > 0, dev, 1), 0)
    zy = (y - y.mean()) / y.std()
    got = linear.solve(x.mean(axis=0)[None], dev[None], np.array([y.mean()]), np.array([y.std()]), (z.T @ z)[None], (z.T @ zy)[None], np.array([float(len(y))]))
    return {k: v[0] for k, v in got.items()}


@pytest.mark.parametrize("size", [1, 1e6, 1e8])
def test_solver_against_numpy_at_any_size_of_columns(size):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 5)) * [1, size, 1, size, 1] + [0, size, 1, 0, 5]
    y = size + x @ [0.97, 0.30, 0.53, -0.17, 2] + rng.normal(0, 0.5, 200)
    full = np.column_stack([np.ones(200), x])
    scale = np.abs(full).max(axis=0)
    coef = np.linalg.lstsq(full / scale, y, rcond=None)[0] / scale
    got = solved(x, y)
    assert np.allclose(got["coef"], coef, rtol=1e-4)
    assert got["r2"] == pytest.approx(1 - np.square(y - full @ coef).sum() / np.square(y - y.mean()).sum(), abs=1e-9)
    others = np.delete(full / scale, 3, axis=1)
    column = full[:, 3] / scale[3]
    part = column - others @ np.linalg.lstsq(others, column, rcond=None)[0]
    assert got["vif"][3] == pytest.approx(np.square(column - column.mean()).sum() / np.square(part).sum())
    # Published quantiles: t(0.975, 10) = 2.228139, F(0.95; 3, 20) = 3.098391.
    assert float(linear.t_pvalue(2.228139, 10)) == pytest.approx(0.05, abs=1e-6)
    assert float(linear.f_pvalue(3.098391, 3, 20)) == pytest.approx(0.05, abs=1e-6)


def test_rank_deficient_group_has_minimum_norm():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(50, 3))
    x = np.column_stack([x, x[:, 0] + x[:, 1], np.full(50, 3.0)])
    y = x[:, 0] + rng.normal(size=50)
    full = np.column_stack([np.ones(50), x])
    coef = np.linalg.pinv(full) @ y
    sigma2 = np.square(y - full @ coef).sum() / 46
    got = solved(x, y)
    assert np.allclose(got["coef"], coef) and np.isinf(got["vif"]).all()
    assert np.allclose(got["p"], linear.t_pvalue(coef / np.sqrt(sigma2 * np.diag(np.linalg.pinv(full.T @ full))), 46))


def test_grouped_ols_keeps_its_figures_with_large_columns(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"subcategory": "s", "brand_name": "a", "segment": "g", "x": 1e7 + rng.normal(size=300) * 1e6, "w": rng.normal(size=300)})
    pdf["y"] = 1e8 + 0.97 * pdf.x - 3e5 * pdf.w + rng.normal(size=300) * 1e4
    row = ols.grouped_ols(spark.createDataFrame(pdf), [["segment"]], ["x", "w"], "y", trim_q=None).collect()[0]
    full = np.column_stack([np.ones(300), pdf.x, pdf.w])
    coef = np.linalg.lstsq(full, pdf.y, rcond=1e-15)[0]
    assert (row.coeff_x, row.coeff_w) == pytest.approx(tuple(coef[1:]), rel=1e-6) and row.r2 > 0.99
    assert row.rmse == pytest.approx(np.sqrt(np.mean((pdf.y - full @ coef) ** 2)), rel=1e-6)


def test_large_values_stay_in_range(spark):
    row = spark.createDataFrame([(1.1e6,), (2e7,), (-1e10,)], "e double").agg(rate_sum(fixed(F.col("e") * F.col("e"))).alias("s"), F.max(fixed("e")).alias("m")).first()
    assert float(row.s) == 1.21e12 + 4e14 + 1e20 and float(row.m) == 2e7


@pytest.mark.parametrize("values", [np.linspace(0, 0.001, 3000), 1e9 + np.arange(3000) / 7, np.full(3000, 4.0), np.r_[np.linspace(0, 1, 2900), [np.nan] * 100]])
def test_ranks_of_close_and_equal_values(spark, values):
    pdf = pd.DataFrame({"k": "a", "v": values})
    df = spark.createDataFrame([("a", float(v)) for v in values], "k string, v double")  # keeps NaN apart from NULL
    near = df.where(~F.isnan("v"))
    got = exact_quantile(near, ["k"], "v", 0.5, "q").collect()[0].q
    assert got == pytest.approx(np.nanquantile(values, 0.5), rel=1e-12)
    ranks = {r.v: r.p for r in with_percent_rank(df, ["k"], "v", "p").where("NOT isnan(v)").collect()}
    want = pdf.v.rank(method="min", na_option="bottom")
    assert all(abs(ranks[v] - (w - 1) / 2999) < 1e-12 for v, w in zip(values, want) if v == v)


def test_trees_take_as_many_categories_as_there_are(spark, tmp_path):
    rows = spark.range(6000).select((F.col("id") % 3000).cast("string").alias("c"), (F.col("id") % 7).cast("double").alias("x"), ((F.col("id") % 2) * 5.0).alias("y"))
    train, valid = models.split(rows, F.concat("c", "x"))
    fitted = models.fit_trees(train, ["c", "x"], ["c"], "y", rounds=30, depth=3, validation=valid)
    assert fitted.stages[-1].getNumTrees <= 30
    models.save_model(fitted, str(tmp_path / "m"))
    a, b = (models.predict(m, valid, ["c", "x"], ["c"]).orderBy("c", "x").select("prediction").collect() for m in (fitted, models.load_model(str(tmp_path / "m"))))
    assert a == b


def test_grouped_ols_and_choice(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"subcategory": ["s"] * 60, "brand_name": ["a"] * 40 + ["b"] * 18 + ["c"] * 2, "segment": ["g"] * 60, "x": rng.uniform(0, 10, 60)})
    pdf["y"] = np.where(pdf.brand_name == "a", 1 + 2 * pdf.x, 5.0) + rng.uniform(0.1, 1, 60)
    train = spark.createDataFrame(pdf)
    out = ols.grouped_ols(train, ols.LEVELS, ["x"], "y").collect()
    assert len(out) == 5
    got = {(r["rank"], tuple(r["key"])): r for r in out}
    a = pdf[pdf.brand_name == "a"]
    kept = a[a.y < a.y.quantile(0.95)]
    slope, const = np.polyfit(kept.x, kept.y, 1)
    row = got[(1, ("s", "a"))]
    assert (row.coeff_x, row.coeff_const) == pytest.approx((slope, const)) and row.no_data_points == len(kept)
    resid = kept.y - const - slope * kept.x
    assert row.mae == pytest.approx(np.median(np.abs(resid)), abs=1e-9) and row.rmse == pytest.approx(np.sqrt(np.mean(resid**2)), abs=1e-5)
    assert got[(1, ("s", "c"))].rmse is None
    best = {r.brand_name: r for r in ols.best_model(train, spark.createDataFrame(out), ols.LEVELS).collect()}
    assert set(best) == {"a", "b", "c"} and best["a"]["rank"] == 1 and best["c"].coeff_const is not None


def test_training_rules(spark):
    rows = [("Jan", 5, 10, "10% off", 0.5, 200.0), ("Feb", 0, 10, "10% off", 0.5, 200.0), ("Feb", 5, 31, "10% off", 0.5, 200.0), ("Feb", 5, 10, "65% off", 0.5, 200.0),
            ("Feb", 5, 10, "2.5% off", -0.5, 200.0), ("Feb", 5, 10, "5% off", -0.5, 100.0), ("Feb", 5, 10, None, 0.2, 200.0), ("Feb", 5, 30, "60% off", 0.3, 200.0), ("Feb", 5, 30, "buy 3 pay 2", 11.0, 200.0)]
    df = spark.createDataFrame(rows, "campaign_start_month string, no_impacted_stores int, duration_days int, discount_depth string, y double, total_counterfactual_qty double")
    got = models.clean(df, ["duration_days"], "y", models.Rules(excluded_months=models.EXCLUDED_MONTHS)).collect()
    assert [(r.duration_days, r.y) for r in got] == [(30, 0.3)]
    small = models.clean(df, ["discount_depth"], "y", models.Rules(min_stores=None, max_days=None, depths=None, outliers="small_base", trim=1.0)).collect()
    assert sorted((r.discount_depth, r.y) for r in small) == [("-999", 0.2), ("2.5% off", 0.0), ("60% off", 0.3)]
    with pytest.raises(Exception, match="missing value in the target"):
        models.clean(df.withColumn("y", F.when(F.col("y") > 0, F.col("y"))), ["duration_days"], "y", models.Rules(outliers="none")).collect()
    assert len(models.ALLOWED_DEPTHS) == 23
    train, valid = models.split(spark.range(2000).select(F.col("id").cast("string").alias("k")), F.col("k"))
    assert train.count() + valid.count() == 2000 and 1500 < train.count() < 1700
