"""Leaf-wise boosting and ordered target statistics against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from promolens.functions import target_codes
from promolens.functions.trees import Settings, drawn
from promolens.operators import boosting, models
from promolens.session import Workspace

SMALL = Settings(rounds=4, leaves=9, depth=6, bins=20, min_rows=15, row_share=0.8, feature_share=0.7, patience=9, refresh=2, seed=7)


def sample(n, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 4)).round(2)
    x[r.random((n, 4)) < 0.03] = np.nan
    y = np.nan_to_num(x[:, 0]) * 2 + np.where(np.nan_to_num(x[:, 1]) > 0.3, 3.0, 0.0) * (np.nan_to_num(x[:, 2]) > 0) + r.normal(0, 0.3, n)
    return pd.DataFrame({"id": np.arange(n).astype(str), **{f"x{i}": x[:, i] for i in range(4)}, "y": y})


def plain_boost(ranges, y, marks, base, step, s, width):
    """The same booster without batches of leaves, siblings or Spark: each leaf is summed by itself."""
    fit, rng, trees = np.full(len(y), base), np.random.default_rng(s.seed), []
    for number in range(s.rounds):
        features = sorted(rng.choice(width, max(1, round(width * s.feature_share)), replace=False).tolist())
        mine = np.flatnonzero(drawn(marks, number, s.row_share))
        gradient = np.rint((y - fit)[mine] / step) * step
        leaves = [(mine, gradient, [])]

        def best(rows, g, path):
            top = (0.0, None, None)
            if len(path) < s.depth:
                for f in features:
                    for limit in range(256):
                        left = ranges[rows, f] <= limit
                        if left.sum() >= s.min_rows and (~left).sum() >= s.min_rows:
                            worth = lambda m: g[m].sum() ** 2 / (m.sum() + s.pull)
                            gain = worth(left) + worth(~left) - worth(np.ones(len(rows), bool))
                            if gain > top[0] + 1e-9:
                                top = (gain, f, limit)
            return top

        choices = [best(*leaves[0])]
        while len(leaves) < s.leaves and max(c[0] for c in choices) > 0:
            i = int(np.argmax([c[0] for c in choices]))
            (rows, g, path), (_, f, limit) = leaves.pop(i), choices.pop(i)
            left = ranges[rows, f] <= limit
            for side, keep in ((0, left), (1, ~left)):
                leaves.append((rows[keep], g[keep], [*path, (f, limit, side)]))
                choices.append(best(*leaves[-1]))
        trees.append(sorted((path, round(s.rate * g.sum() / (len(g) + s.pull), 9)) for _, g, path in leaves))
        for _, g, path in leaves:
            there = np.ones(len(y), bool)
            for f, limit, side in path:
                there &= (ranges[:, f] <= limit) == (side == 0)
            fit[there] += s.rate * g.sum() / (len(g) + s.pull)
    return trees


def paths_of(tree):
    out = []

    def walk(n, path):
        if tree.left[n] < 0:
            out.append((path, round(tree.value[n], 9)))
        else:
            walk(tree.left[n], [*path, (tree.feature[n], tree.limit[n], 0)])
            walk(tree.right[n], [*path, (tree.feature[n], tree.limit[n], 1)])

    walk(0, [])
    return sorted(out)


def test_trees_equal_a_plain_booster(spark):
    rows = sample(5_000)
    names = [f"x{i}" for i in range(4)]
    df = spark.createDataFrame(rows).repartition(3)
    edges = boosting.range_edges(df, names, SMALL.bins)
    for i, c in enumerate(names):  # edges are those of equal counts
        x = np.sort(rows[c].dropna().to_numpy())
        below = np.searchsorted(x, x, side="left")
        assert edges[i] == sorted({x[below * SMALL.bins // len(x) == b].min() for b in range(SMALL.bins) if (below * SMALL.bins // len(x) == b).any()})
    ranges = boosting.ranges_of(rows[names].to_numpy(), edges)
    marks, base = np.arange(5_000) * 977, float(rows["y"].mean())
    held = np.arange(5_000) % 5 == 0
    state = spark.createDataFrame(pd.DataFrame({"mark": marks, "y": rows["y"], "held": held, "ranges": [r.tobytes() for r in ranges], "fit": base}), boosting.STATE).repartition(4)
    bound = float(np.abs(rows["y"] - base).max() * 2)
    trees, errors = boosting.boost(state, 4, bound, 4_000, SMALL, Workspace(spark))
    step = 2.0 ** (int(np.ceil(np.log2(bound * 4_000))) - 51)
    assert [paths_of(t) for t in trees] == plain_boost(ranges[~held], rows["y"].to_numpy()[~held], marks[~held], base, step, SMALL, 4)
    assert len(errors) == 5 and errors == sorted(errors, reverse=True)
    fit = base + sum(t.values_of(ranges[held]) for t in trees)
    assert errors[-1] == pytest.approx(np.mean((rows["y"][held] - fit) ** 2))


def test_boosting_stops_early_and_is_kept(spark, tmp_path):
    r = np.random.default_rng(3)
    noise = pd.DataFrame({"id": [str(i) for i in range(400)], "x": r.normal(size=400), "c": r.choice(list("abc"), 400), "y": r.normal(size=400)})
    train, valid = spark.createDataFrame(noise[:200]), spark.createDataFrame(noise[200:])
    model = boosting.fit(train, valid, ["x", "c"], ["c"], "y", ["id"], Settings(rounds=60, leaves=8, rate=0.3, min_rows=5, patience=3, refresh=4))
    assert len(model.trees) < 20 and len(model.held_errors) <= len(model.trees) + 5
    boosting.save(model, str(tmp_path / "m"))
    again = boosting.load(spark, str(tmp_path / "m"))
    odd = spark.createDataFrame([("a", 1.0), ("zz", None), (None, 0.2)], "c string, x double")
    first, second = (boosting.predict(m, odd).collect() for m in (model, again))
    assert first == second and all(p.prediction is not None for p in first)
    assert boosting.importance(spark, model).agg(F.round(F.sum("importance"), 6)).first()[0] == (1.0 if model.trees else 0.0)


def test_many_categories_train(spark):
    rows = spark.range(100_000).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("brand"), F.col("id") % 50_000).alias("brand"), ((F.col("id") % 50_000) % 2 + F.rand(1) / 10).alias("y"))
    model = boosting.fit(rows.where("id % 10 > 0"), rows.where("id % 10 = 0"), ["brand"], ["brand"], "y", ["id"], Settings(rounds=3, leaves=4))
    assert model.sums.count() > 40_000 and model.held_errors[-1] < model.held_errors[0]


def test_codes_see_only_rows_before(spark):
    r = np.random.default_rng(5)
    rows = pd.DataFrame({"id": [f"{i}" for i in range(900)], "a": np.where(r.random(900) < 0.5, "hot", r.choice(list("xyz"), 900)), "b": [None if i % 7 == 0 else str(i % 4) for i in range(900)], "y": r.normal(size=900).round(3)})
    order = F.md5(F.concat_ws("|", F.lit(1), "id"))
    df = spark.createDataFrame(rows, "id string, a string, b string, y double").repartition(5)
    found = target_codes.ordered_codes(df, ["a", "b"], "y", order, 2.0).toPandas().set_index("id")
    rows["mark"] = df.select("id", order.alias("m")).toPandas().set_index("id").loc[rows["id"]]["m"].to_numpy()
    prior = rows["y"].mean()
    for c in ("a", "b"):
        for value, part in rows.fillna("none").sort_values("mark").groupby(c):
            before = part["y"].cumsum() - part["y"]
            expected = (before + 2 * prior) / (np.arange(len(part)) + 2)
            assert np.allclose(found.loc[part["id"], c].astype(float), expected)
    sums = target_codes.category_sums(df, ["a", "b"], "y")
    coded = target_codes.codes_of(spark.createDataFrame([("hot", None), ("new", "1")], "a string, b string"), sums, ["a", "b"], prior, 2.0).collect()
    hot, none = rows[rows["a"] == "hot"]["y"], rows[rows["b"].isna()]["y"]
    assert [coded[0].a, coded[0].b, coded[1].a] == pytest.approx([(hot.sum() + 2 * prior) / (len(hot) + 2), (none.sum() + 2 * prior) / (len(none) + 2), prior])


def test_preparing_leaves_tables_of_the_same_folder_alone(spark):
    work = Workspace(spark)
    kept = work.keep(spark.range(3).withColumnRenamed("id", "other"), "train")
    df = spark.createDataFrame(sample(60))
    made = boosting.prepare(df, df.limit(0), ["x0", "x1"], [], "y", ["id"], SMALL, work)
    assert made.rows == 60 and [r.other for r in kept.orderBy("other").collect()] == [0, 1, 2]


def test_no_training_rows(spark, tmp_path):
    """Cleaning may leave nothing to learn from: both learners then predict 0 for every row, and a saved model does too."""
    columns = "k string, c string, x double, y double"
    none, held = spark.createDataFrame([], columns), spark.createDataFrame([("a", "p", 1.0, 0.5), ("b", None, None, 2.0)], columns)
    made = boosting.prepare(none, held, ["c", "x"], ["c"], "y", ["k"], SMALL, Workspace(spark))
    assert boosting.root_histogram(made, ["c", "x"]).count() == 0 and boosting.first_split(made, ["c", "x"], SMALL).count() == 0
    booster = boosting.fit(none, held, ["c", "x"], ["c"], "y", ["k"], SMALL)
    boosting.save(booster, f"{tmp_path}/booster")
    trees = models.fit_trees(none, ["c", "x"], ["c"], "y", validation=held)
    models.save_model(trees, f"{tmp_path}/trees")
    for scored in (boosting.predict(booster, held), boosting.predict(boosting.load(spark, f"{tmp_path}/booster"), held),
                   models.predict(trees, held, ["c", "x"], ["c"]), models.predict(models.load_model(f"{tmp_path}/trees"), held, ["c", "x"], ["c"])):
        assert [r.prediction for r in scored.collect()] == [0.0, 0.0]
        assert scored.columns == [*held.columns, "prediction"] and models.evaluate(scored, "y").first().n == 2
    assert boosting.fit(none, none, ["c", "x"], ["c"], "y", ["k"], SMALL).trees == []
    assert models.predict(models.fit_trees(none, ["c", "x"], ["c"], "y", validation=none), none, ["c", "x"], ["c"]).count() == 0


def test_fewer_rows_than_categories(spark):
    train = spark.createDataFrame([("p", 1.0, 1.0), ("q", 2.0, 3.0)], "c string, x double, y double")
    held = spark.createDataFrame([(f"v{i}", 1.0, 1.0) for i in range(9)], train.schema)
    model = models.fit_trees(train, ["c", "x"], ["c"], "y", rounds=1, validation=held)
    assert [r.prediction for r in models.predict(model, train, ["c", "x"], ["c"]).orderBy("x").collect()] == [1.0, 3.0]


def test_held_rows_far_from_the_training_rows(spark):
    train = spark.createDataFrame([(str(i), i % 7 / 7, i % 7 * 1e-3) for i in range(60)], "k string, x double, y double")
    held = spark.createDataFrame([("h", 0.5, 1e9)], train.schema)
    model = boosting.fit(train, held, ["x"], [], "y", ["k"], SMALL)
    assert abs(model.held_errors[0] / 1e18 - 1) < 1e-6


def test_importance_without_a_split(spark):
    one = spark.createDataFrame([("p", 1.0, 0.5)], "c string, x double, y double")
    for rows in (one, one.limit(0)):
        shares = models.importance(spark, models.fit_trees(rows, ["c", "x"], ["c"], "y", rounds=2), ["c", "x"])
        assert [tuple(r) for r in shares.collect()] == [("c", 0.5), ("x", 0.5)]
