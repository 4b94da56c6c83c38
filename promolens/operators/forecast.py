"""Forward counterfactual: smoothed history and a damped seasonal forecast per root."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import smoothing
from ..functions.numeric import dbl, fixed, mean_of
from .counterfactual import METRICS

# Workers get the smoothing helper with the function and need no installed package.
cloudpickle.register_pickle_by_value(smoothing)

FIT_SCHEMA = (
    "sku_root_id string, measure string, date date, y_t double, l_t double, b_t double, s_t double, "
    "y_hat_t double, alpha double, beta double, phi double, gamma double, l_0 double, b_0 double, "
    "converged boolean"
)


def history(sku_counterfactual: DataFrame) -> DataFrame:
    """Actual sales outside promotions, expected sales inside; one row per measure."""
    flag = F.col("change_flag")

    def value(m: str) -> Column:
        return (
            F.when(flag == 0, dbl(f"total_{m}"))
            .when(flag.isin(1, 2), dbl(f"{m}_bl"))
            .when(flag == 3, dbl(f"{m}_bl_ext"))
            .otherwise(F.raise_error(F.concat(F.lit("unexpected change_flag of "), F.col("sku_root_id"))))
        )

    return (
        sku_counterfactual.select("sku_root_id", "date", *[value(m).alias(m) for m in METRICS])
        .unpivot(["sku_root_id", "date"], METRICS, "measure", "hist")
    )


def positive_shift(rows: DataFrame, constant: float = 1000.0) -> DataFrame:
    """Constant that lifts a series; a smallest value equal to ``constant`` lifts by itself."""
    low = F.col("low")
    shift = (
        F.when(low > constant, 0.0)
        .when((low >= 0) & (low < constant), constant)
        .when(low < 0, constant - low)
        .otherwise(low)
    )
    lows = rows.groupBy("sku_root_id", "measure").agg(F.min("hist").alias("low"))
    return rows.join(lows.withColumn("shift", shift), ["sku_root_id", "measure"])


def smoothed(rows: DataFrame, window: int = 4) -> DataFrame:
    """Rolling mean of the lifted series; the first ``window - 1`` rows and gaps drop out."""
    w = Window.partitionBy("sku_root_id", "measure").orderBy("date")
    frame = w.rowsBetween(-(window - 1), 0)
    lifted = fixed(F.col("hist") + F.col("shift"))
    mean = F.when(F.count(lifted).over(frame) == window, dbl(F.sum(lifted).over(frame)) / window)
    return (
        rows.withColumn("smooth", mean)
        .withColumn("_n", F.row_number().over(w))
        .where((F.col("_n") >= window) & F.col("smooth").isNotNull())
        .drop("_n")
    )


def _column_block(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, pa.Array]:
    column = batch.column(name)
    return np.diff(column.offsets.to_numpy()), column.flatten()


def _fitted_block(batch: pa.RecordBatch, season: int, horizon: int, params) -> pa.RecordBatch:
    """Rows of ``FIT_SCHEMA`` for the series of one batch: their weeks, then the weeks ahead."""
    lengths, days = _column_block(batch, "days")
    hist = _column_block(batch, "hists")[1].to_numpy(zero_copy_only=False)
    smooth = _column_block(batch, "smooths")[1].to_numpy(zero_copy_only=False)
    days, lengths = days.cast(pa.int32()).to_numpy(), lengths.astype(np.int64)
    shift = batch.column("shift").to_numpy(zero_copy_only=False)
    n, long = len(lengths), lengths >= 2 * season
    rows = lengths + np.where(long, horizon, 0)
    total, begins = int(rows.sum()), np.cumsum(rows) - rows
    owner = np.repeat(np.arange(n), rows)
    week = np.arange(total) - begins[owner]
    past = week < lengths[owner]
    out = {name: np.full(total, np.nan) for name in ("y_t", "l_t", "b_t", "s_t", "y_hat_t")}
    fits = {name: np.full(n, np.nan) for name in ("alpha", "beta", "phi", "gamma", "l_0", "b_0")}
    converged, when = np.zeros(n, bool), np.empty(total, np.int32)
    out["y_t"][past], when[past] = hist, days
    if long.any():
        size, at = lengths[long], np.cumsum(long) - 1
        y = smoothing.side_by_side(smooth[np.repeat(long, lengths)], size)
        if params is None:
            p, _, converged[long] = smoothing.fit_block(y, size, season)
        else:
            p, converged[long] = np.repeat(np.array(params, float)[:, None], len(size), axis=1), True
        with np.errstate(over="ignore", invalid="ignore"):
            level, trend, cycle, fit = smoothing.run_block(y, season, p)
        live = np.arange(len(y))[:, None] < size
        bias = np.where(live, y - fit, 0.0).sum(axis=0) / size
        ahead = smoothing.forecast_block(level, trend, cycle, size, season, p[3], horizon)
        mine = long[owner]
        then, now = np.flatnonzero(mine & past), np.flatnonzero(mine & ~past)
        w, c = week[then], at[owner[then]]
        for name, values in (("l_t", level), ("b_t", trend), ("s_t", cycle), ("y_hat_t", fit + bias)):
            out[name][then] = values[w, c]
        step, c = week[now] - lengths[owner[now]], at[owner[now]]
        out["y_hat_t"][now] = ahead[step, c] + bias[c]
        when[now] = days[np.cumsum(lengths) - 1][owner[now]] + 7 * (step + 1)
        for name, values in zip(("alpha", "beta", "gamma", "phi"), p):
            fits[name][long] = values
        fits["l_0"][long] = y[:season].mean(axis=0)
        fits["b_0"][long] = (y[season:2 * season].mean(axis=0) - fits["l_0"][long]) / season
    measure = batch.column("measure")
    floored = np.array([m != "margin_amt" for m in measure.to_pylist()], bool)[owner]
    back = out["y_hat_t"] - shift[owner]
    out["y_hat_t"] = np.where(floored, np.maximum(back, 0.0), back)
    take = pa.array(owner)
    columns = {
        "sku_root_id": batch.column("sku_root_id").take(take), "measure": measure.take(take),
        "date": pa.array(when).cast(pa.date32()),
        **{name: pa.array(v, from_pandas=True) for name, v in out.items()},
        **{name: pa.array(v[owner], from_pandas=True) for name, v in fits.items()},
        "converged": pa.array(converged[owner]),
    }
    names = [f.split()[0] for f in FIT_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([columns[name] for name in names], names)


def fit_and_forecast(
    rows: DataFrame, season: int = 12, horizon: int = 16, params: tuple[float, float, float, float] | None = None,
    block: int = 512, tasks: int | None = None,
) -> DataFrame:
    """One model per root and measure; a series is at most the calendar's weeks long.

    A series becomes one row of lists, so a task fits ``block`` series side by side. The lists are dealt again over
    ``tasks`` (the session's shuffle partitions), since fitting costs far more than their bytes tell. ``params``
    (alpha, beta, gamma, phi) takes the place of the fit. A series shorter than two seasons has no start values and
    gets no forecast. ``converged`` is false where the search for parameters did not settle or there was no fit.
    """
    spark = rows.sparkSession
    weeks = F.array_sort(F.collect_list(F.struct("date", dbl("hist").alias("hist"), dbl("smooth").alias("smooth"))))
    series = (
        rows.groupBy("sku_root_id", "measure")
        .agg(weeks.alias("weeks"), dbl(F.max("shift")).alias("shift"))
        .select("sku_root_id", "measure", "shift", F.col("weeks.date").alias("days"), F.col("weeks.hist").alias("hists"),
                F.col("weeks.smooth").alias("smooths"))
        .repartition(tasks or int(spark.conf.get("spark.sql.shuffle.partitions")), "sku_root_id", "measure")
    )

    def fitted(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, block):
                yield _fitted_block(batch.slice(begin, block), season, horizon, params)

    return series.mapInArrow(fitted, FIT_SCHEMA)


def forecast_table(fitted: DataFrame) -> DataFrame:
    """One row per root and week with the five values of every measure."""
    names = ["b_t", "l_t", "s_t", "y_hat_t", "y_t"]
    cells = [
        F.max(F.when(F.col("measure") == m, F.col(n))).alias(f"{n}_{m}") for m in METRICS for n in names
    ]
    return fitted.groupBy("date", "sku_root_id").agg(*cells)


def fit_metrics(fitted: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Errors against the unsmoothed history and the mean forecast of (start, end], or of all weeks ahead.

    The flag is 0 where a week has no forecast or the search for parameters did not converge.
    """
    gap = F.col("y_t") - F.col("y_hat_t")
    square, size = fixed(gap * gap), fixed(F.abs(gap))
    chosen = F.col("y_t").isNull() if start is None else F.col("date") > F.lit(start)
    if end is not None:
        chosen &= F.col("date") <= F.lit(end)
    inside = F.when(chosen, fixed("y_hat_t"))
    params = ["alpha", "beta", "phi", "gamma", "l_0", "b_0"]
    return fitted.groupBy(
        "sku_root_id", F.concat(F.lit("pred_counterfactual_"), "measure").alias("metric")
    ).agg(
        *[F.max(p).alias(p) for p in params],
        dbl(F.sum(square)).alias("SSE"),
        mean_of(square).alias("MSE"),
        F.sqrt(mean_of(square)).alias("RMSE"),
        mean_of(size).alias("MAE"),
        F.coalesce(mean_of(inside), mean_of(fixed("y_t"))).alias("avg_forecast_period"),
        F.when(F.count_if(F.col("y_hat_t").isNull() | ~F.col("converged")) > 0, 0).otherwise(1).alias("convergence_flag"),
    )


def forecast(
    sku_counterfactual: DataFrame, season: int = 12, horizon: int = 16, constant: float = 1000.0, window: int = 4
) -> DataFrame:
    return fit_and_forecast(smoothed(positive_shift(history(sku_counterfactual), constant), window), season, horizon)


def republish(df: DataFrame, integers: tuple[str, ...] = ("convergence_flag",)) -> DataFrame:
    """Numbers as exact decimals, flags as integers."""
    out = {}
    for f in df.schema.fields:
        if f.name in integers:
            out[f.name] = F.col(f.name).cast("long")
        elif f.dataType.typeName() in ("double", "float") or f.dataType.typeName() == "decimal":
            out[f.name] = F.col(f.name).cast("decimal(38,9)")
    return df.withColumns(out) if out else df


