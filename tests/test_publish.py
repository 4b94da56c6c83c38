"""Versions that readers see whole or not at all, and the chain from training to published scores."""

import pytest
from pyspark.sql import functions as F

from promolens.functions.trees import Settings
from promolens.operators import boosting, modes
from promolens.sources import publish as p


def rows(spark, data):
    return spark.createDataFrame(data, "section string, v int")


def seen(df):
    return sorted((r.section or "", r.v) for r in df.collect())


def test_interrupted_publication_is_not_seen(spark, tmp_path):
    root = str(tmp_path / "t")
    with pytest.raises(ValueError, match="no complete version"):
        p.read_published(spark, root)
    p.write_rows(rows(spark, [("a", 0)]), root)
    with pytest.raises(ValueError, match="no complete version"):
        p.read_published(spark, root)
    assert p.publish(rows(spark, [("a", 1), ("b", 1)]), root) == 1
    held = p.read_published(spark, root)
    p.write_rows(rows(spark, [("a", 9)]), root)
    assert seen(p.read_published(spark, root)) == [("a", 1), ("b", 1)]
    assert p.publish(rows(spark, [("c", 2)]), root) == 2
    # A reader that resolved the first version keeps it.
    assert seen(held) == [("a", 1), ("b", 1)] and seen(p.read_published(spark, root)) == [("c", 2)]
    assert seen(p.read_published(spark, root, version=1)) == [("a", 1), ("b", 1)]


def test_slices_replaced_and_kept(spark, tmp_path):
    root = str(tmp_path / "t")
    p.publish(rows(spark, [("01", 1), ("01", 1), (None, 1), ("", 1), ("n", 1), ("a/b=c", 1)]), root, "section")
    p.publish(rows(spark, [("01", 2), ("new", 2)]), root, "section", keep_others=True)
    p.publish(rows(spark, [(None, 3)]), root, "section", keep_others=True)
    got = p.read_published(spark, root)
    assert sorted(got.collect(), key=repr) == sorted(
        rows(spark, [("01", 2), ("new", 2), (None, 3), ("", 1), ("n", 1), ("a/b=c", 1)]).collect(), key=repr)
    assert got.columns == ["section", "v"]
    with pytest.raises(ValueError, match="same columns"):
        p.publish(rows(spark, [("01", 2)]).withColumn("w", F.lit(1)), root, "section", keep_others=True)
    with pytest.raises(ValueError, match="names of the published"):
        p.publish(rows(spark, []).withColumn("_slice", F.lit(1)), root)
    # Without the others, a version is what it holds; an empty one is a version too.
    p.publish(rows(spark, [("z", 4)]), root, "section")
    assert seen(p.read_published(spark, root)) == [("z", 4)]
    p.publish(rows(spark, []), root)
    assert p.read_published(spark, root).count() == 0 and p.versions(spark, root).count() == 5


def test_only_named_folders_are_scanned(spark, tmp_path):
    root = str(tmp_path / "t")
    for i in range(3):
        p.publish(rows(spark, [("a", i), ("b", i)]), root, "section")
    read = p.read_published(spark, root)
    assert len(read.inputFiles()) > 0 and seen(read) == [("a", 2), ("b", 2)]
    plan = read._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "_folder" in plan.split("PartitionFilters: [")[1][:200]


def test_train_predict_publish(spark, tmp_path):
    root = str(tmp_path / "uplift")
    data = spark.range(600).select(
        F.concat(F.lit("r"), F.col("id") % 40).alias("sku_root_id"), F.col("id").cast("string").alias("promo_id"),
        F.element_at(F.array(*[F.lit(c) for c in "abc"]), (F.col("id") % 3 + 1).cast("int")).alias("category"),
        (F.col("id") % 7).cast("double").alias("days"), ((F.col("id") % 3) * 2.0 + F.col("id") % 7).alias("y"))
    settings = Settings(rounds=8, leaves=6, bins=16, patience=8)
    with pytest.raises(ValueError, match="no complete version"):
        modes.predict(spark, data, data, root)
    assert modes.train(data, root, ["category", "days"], ["category"], "y", ["sku_root_id", "promo_id"], settings) == 1
    score = data.select("sku_root_id", "promo_id", "category", "days").limit(50).withColumn("p_qty_bl", F.lit(10.0)).withColumn("discount_depth_rank", F.lit(20.0))
    prices = spark.createDataFrame([(f"r{i}", 2.0, 5.0, 3.0) for i in range(40)], "sku_root_id string, margin_per_unit double, std_price_per_unit double, cost_per_unit double")
    assert modes.predict(spark, score, prices, root) == 1
    got = p.read_published(spark, f"{root}/scores")
    assert got.count() == 50
    entry = p.read_published(spark, f"{root}/model").first()
    direct = boosting.predict(boosting.load(spark, entry.folder), score).select("promo_id", "prediction")
    both = got.join(direct, "promo_id").select("y", "prediction", "p_cal_inc_sale_amt", "prediction_interval").collect()
    assert len(both) == 50
    for r in both:
        assert abs(r.y - r.prediction) < 1e-9 and abs(r.p_cal_inc_sale_amt - r.prediction * 10 * 0.8 * 5) < 1e-6 and r.prediction_interval >= 0
    assert modes.predict(spark, score.limit(5), prices, root) == 2 and p.read_published(spark, f"{root}/scores").count() == 5
