"""Cleaning, encoding, splitting, tree models and their evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import dbl, fixed, mean_of, ratio
from ..functions.ranking import exact_quantile
from ..session import Workspace

# Discount depths that are kept for training.
ALLOWED_DEPTHS = [
    "2.5% off", *[f"{p}% off" for p in range(5, 65, 5)], "buy 2 pay 1",
    *[f"buy 2 pay 1.{d}" for d in range(2, 9)], "buy 3 pay 2", "buy 4 pay 3",
]
# Months left out of training.
EXCLUDED_MONTHS = ["Jan", "Aug", "Nov", "Dec"]
MISSING = -999


@dataclass
class Rules:
    """Which training rows stay. ``outliers`` picks the treatment of extreme targets.

    ``positive`` keeps targets above zero; ``capped`` also asks for less than
    ``cap``; ``small_base`` keeps non-positive targets of counterfactuals above
    ``base`` as zero and shortens durations by ``shorten``; ``negative`` sets
    positive targets to zero (after the promotion); ``none`` changes nothing.
    """

    excluded_months: list[str] | None = None
    min_stores: int | None = 1
    max_days: int | None = 30
    depths: list[str] | None = field(default_factory=lambda: list(ALLOWED_DEPTHS))
    outliers: str = "positive"
    cap: float = 10.0
    base: float = 100.0
    shorten: int = 2
    trim: float = 0.95
    drop_missing_target: bool = False


def _below_quantile(df: DataFrame, target: str, q: float) -> DataFrame:
    limit = exact_quantile(df.select(dbl(target).alias(target)), [], target, q, "limit")
    return df.where(dbl(target) < limit.select("limit").scalar())


def clean(df: DataFrame, features: list[str], target: str, rules: Rules, keep: list[str] = ()) -> DataFrame:
    """Training rows with missing features as -999; a missing target stops or is dropped."""
    has = set(df.columns)
    y = F.col(target)
    if rules.outliers == "small_base" and "duration_wks" in has:
        df = df.withColumn("duration_wks", F.col("duration_wks") - rules.shorten)
    if rules.excluded_months and "campaign_start_month" in has:
        df = df.where(~F.col("campaign_start_month").isin(rules.excluded_months))
    if rules.min_stores is not None and "no_impacted_stores" in has:
        df = df.where(F.col("no_impacted_stores") >= rules.min_stores)
    if rules.max_days is not None and "duration_days" in has:
        df = df.where(F.col("duration_days") <= rules.max_days)
    if rules.depths is not None and "discount_depth" in has:
        df = df.where(F.col("discount_depth").isin(rules.depths))
    if rules.outliers in ("positive", "capped"):
        df = df.where(y > 0)
        if rules.outliers == "capped":
            df = df.where(y < rules.cap)
        df = _below_quantile(df, target, rules.trim)
    elif rules.outliers == "small_base":
        df = df.where((y > 0) | ((y <= 0) & (F.col("total_counterfactual_qty") > rules.base)))
        df = df.withColumn(target, F.greatest(y, F.lit(0.0))).where(F.col(target) < rules.cap)
        df = _below_quantile(df, target, rules.trim)
    elif rules.outliers == "negative":
        df = df.withColumn(target, F.when(y > 0, 0.0).otherwise(y))
    df = df.select(*dict.fromkeys([*keep, *features, target]))
    if rules.drop_missing_target:
        df = df.where(F.col(target).isNotNull())
    else:
        stop = F.raise_error("missing value in the target")
        df = df.withColumn(target, F.when(F.col(target).isNull(), stop.cast("double")).otherwise(F.col(target)))
    filled = {
        c: F.coalesce(F.col(c), F.lit(str(MISSING)) if t == "string" else F.lit(MISSING).cast(t))
        for c, t in df.dtypes if c in features and t not in ("boolean", "date")
    }
    return df.withColumns(filled)


def missing_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, one row each."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "feature", "missing")


def category_codes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Ordinal of every category value, in the order of the values."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "feature", "value")
    values = long.where(F.col("value").isNotNull()).distinct()
    return values.withColumn("code", F.row_number().over(Window.partitionBy("feature").orderBy("value")) - 1)


def encode(df: DataFrame, codes: DataFrame, columns: list[str]) -> DataFrame:
    """Replace category values by their ordinals; a value without one becomes NULL."""
    for c in columns:
        of_column = codes.where(F.col("feature") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        df = df.join(of_column, F.col(c).cast("string") == F.col("_value"), "left").withColumn(c, F.col("_code")).drop("_value", "_code")
    return df


def split_bucket(key: Column) -> Column:
    """Bucket 0-9 of a stable key."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % 10


def split(df: DataFrame, key: Column, train_tenths: int = 8) -> tuple[DataFrame, DataFrame]:
    marked = df.withColumn("_bucket", split_bucket(key))
    train = marked.where(F.col("_bucket") < train_tenths).drop("_bucket")
    return train, marked.where(F.col("_bucket") >= train_tenths).drop("_bucket")


def fit_trees(
    train: DataFrame, features: list[str], categorical: list[str], target: str,
    rounds: int = 20, depth: int = 5, rate: float = 0.1, min_bins: int = 128, seed: int = 42,
    validation: DataFrame | None = None, tolerance: float = 0.01,
) -> PipelineModel:
    """Gradient-boosted trees on indexed categories and numbers.

    A tree needs a bin for each category value, so their number follows from the data and ``min_bins`` is
    for numbers. With ``validation`` rows ``rounds`` is the most: boosting ends when their error no longer falls by
    ``tolerance``. Without training rows the model predicts 0, as Spark's trees need a row. They also need as many rows as a
    category has values: fewer rows are all repeated equally often, which changes no mean and so no split.
    """
    n_train = train.count()
    if not n_train:
        return PipelineModel([SQLTransformer(statement="SELECT *, 0D AS prediction FROM __THIS__")])
    if validation is not None:
        train = train.withColumn("_held", F.lit(False)).unionByName(validation.withColumn("_held", F.lit(True)))
    cats = [c for c in features if c in categorical]
    stages = []
    if cats:
        stages.append(StringIndexer(
            inputCols=cats, outputCols=[f"{c}_ix" for c in cats], handleInvalid="keep", stringOrderType="alphabetAsc"
        ))
    bins = min_bins
    if cats:
        counts = train.agg(*[F.count_distinct(F.col(c).cast("string")).alias(c) for c in cats]).first()
        values = max(counts) + 1  # one more for values not seen
        bins = max(min_bins, values)
        if n_train < values:
            copies = F.sequence(F.lit(1), F.lit(-(-values // n_train)))
            train = train.withColumn("_copy", F.explode(copies)).drop("_copy")
    inputs = [f"{c}_ix" if c in cats else c for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    stages.append(GBTRegressor(
        labelCol=target, featuresCol="features", predictionCol="prediction", maxIter=rounds, maxDepth=depth,
        stepSize=rate, maxBins=bins, seed=seed, validationTol=tolerance,
        **({} if validation is None else {"validationIndicatorCol": "_held"}),
    ))
    typed = train.withColumns({c: F.col(c).cast("string") for c in cats}).withColumns(
        {c: dbl(c) for c in [*features, target] if c not in cats}
    )
    return Pipeline(stages=stages).fit(typed)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, features: list[str], categorical: list[str]) -> DataFrame:
    cats = [c for c in features if c in categorical]
    typed = df.withColumns({c: F.col(c).cast("string") for c in cats}).withColumns(
        {c: dbl(c) for c in features if c not in cats}
    )
    made = [f"{c}_ix" for c in cats] + ["features"]
    return model.transform(typed).drop(*made)


def evaluate(scored: DataFrame, actual: str, predicted: str = "prediction") -> DataFrame:
    """Errors of a prediction beside those of predicting nothing; one row."""
    y, error = dbl(actual), dbl(actual) - dbl(predicted)
    rows = scored.select(
        fixed(y).alias("y"), fixed(F.abs(y)).alias("abs_y"), fixed(error).alias("error"), fixed(error * error).alias("square"),
        F.abs(error).alias("size"), F.coalesce(F.abs(ratio(error, y)), F.lit(0.0)).alias("share"),
    )
    rows = Workspace(scored.sparkSession).keep(rows, "errors")  # scored once for all figures
    usual = mean_of("y")
    sums = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(mean_of("square")).alias("rmse"),
        mean_of("error").alias("mean_error"),
        F.stddev_pop(dbl("y")).alias("benchmark_std"),
        usual.alias("benchmark_mean_error"),
        mean_of("abs_y").alias("benchmark_mae"),
    )
    return sums.withColumn("mae", exact_quantile(rows, [], "size", 0.5, "v").select("v").scalar()).withColumn(
        "mape", exact_quantile(rows, [], "share", 0.5, "v").select("v").scalar()
    )


def group_mean(train: DataFrame, attributes: list[str], target: str, out: str = "prediction") -> DataFrame:
    return train.groupBy(*attributes).agg(mean_of(fixed(target)).alias(out))


def apply_group_mean(df: DataFrame, means: DataFrame, attributes: list[str]) -> DataFrame:
    return df.join(means, attributes, "left")


def with_intervals(scored: DataFrame, evaluation: DataFrame, target: str, quantity_base: str | None = None) -> DataFrame:
    """Predicted target with the median errors as interval and error share.

    With ``quantity_base`` the share is also given as a quantity.
    """
    figures = evaluation.select(dbl("mae").alias("mae"), dbl("mape").alias("mape")).first()
    out = scored.withColumnRenamed("prediction", target).withColumns({
        "prediction_interval": F.lit(figures.mae).cast("double"),
        "prediction_error_perc": F.lit(figures.mape).cast("double"),
    })
    if quantity_base is not None:
        out = out.withColumn("p_cal_inc_sale_qty", dbl(target) * dbl(quantity_base))
    return out


def importance(spark, model: PipelineModel, features: list[str], n: int = 20) -> DataFrame:
    """Most important features of a fitted tree model, as shares of 1; without a split none stands out and all are equal."""
    trees = model.stages[-1]
    weights = [float(w) for w in trees.featureImportances.toArray()] if isinstance(trees, GBTRegressionModel) else []
    if not any(weights):
        weights = [1 / len(features)] * len(features)
    rows = sorted(zip(features, weights), key=lambda fw: (-fw[1], fw[0]))[:n]
    return spark.createDataFrame(rows, "feature string, importance double")
