"""Gradient boosting that grows trees leaf by leaf on histograms which Spark sums.

Numbers and category codes become at most ``bins`` ranges of about equal counts. A tree always splits the leaf with the largest
gain. A pass over the rows sends, for each task, the summed gradients by leaf, feature and range; one pass serves all
leaves that may be split next, and only the smaller child of a split is summed, the other is its parent less the sibling. So a
tree takes about as many passes as it is deep. Gradients are whole numbers of a step that follows from the data, so the
trees do not depend on the order of the sums. Every round draws its own share of rows (by the row's mark) and features.

The driver holds the trees and the histograms of the open leaves: leaves x features x bins, all parameters. Predictions
of the trees so far are written with the rows every ``refresh`` rounds; a lost task repeats only the trees since.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import trees as core
from ..functions.numeric import dbl, fixed, mean_of
from ..functions.ranking import value_positions
from ..functions.target_codes import category_sums, codes_of, ordered_codes
from ..functions.trees import Histograms, Settings, Tree, drawn, grow, matrix, ranges_of
from ..session import Workspace

# Workers get the tree functions with the job and need no installed package.
cloudpickle.register_pickle_by_value(core)

@dataclass
class Booster:
    features: list[str]
    categorical: list[str]
    edges: list[list[float]]
    base: float
    settings: Settings
    trees: list[Tree]
    held_errors: list[float]
    sums: DataFrame | None = None


def range_edges(df: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Lowest value of each range; ranges hold about equal counts, and equal values share one."""
    long = df.select(*[dbl(c).alias(c) for c in features]).unpivot([], features, "feature", "x").where(F.col("x").isNotNull() & ~F.isnan("x"))
    at = F.floor(F.col("rows_below") * bins / F.col("rows_total"))
    lows = value_positions(long, ["feature"], "x").groupBy("feature", at.alias("at")).agg(F.min("x").alias("low"))
    found = lows.groupBy("feature").agg(F.sort_array(F.collect_list("low")).alias("lows")).collect()  # features x bins numbers
    held = {r.feature: list(r.lows) for r in found}
    return [held.get(c, []) for c in features]


STATE = "mark long, y double, held boolean, ranges binary, fit double"
SUMS = "node int, feature int, bin int, gradient long, n long"


def summed(state: DataFrame, since: list[Tree], tree: Tree, wanted: list[int], features: list[int], width: int, number: int, step: float, s: Settings, unit: float) -> pd.DataFrame:
    """Gradients, as numbers of ``step``, and drawn rows by (node, feature, range), node -1 with squared errors, as numbers of ``unit``, and counts of the held rows."""
    slot = np.full(len(tree.feature), -1)
    slot[wanted] = np.arange(len(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(wanted), len(features), 256, 2), np.int64)
        error = np.zeros(2, np.int64)
        for b in batches:
            ranges, held = matrix(b.column("ranges"), width), b.column("held").to_numpy(zero_copy_only=False)
            gap = b.column("y").to_numpy() - b.column("fit").to_numpy() - sum((t.values_of(ranges) for t in since), np.zeros(b.num_rows))
            error += [int(np.floor(gap[held] ** 2 / unit).sum()), int(held.sum())]
            mine = np.flatnonzero(~held & drawn(b.column("mark").to_numpy(), number, s.row_share))
            at = slot[tree.leaves_of(ranges[mine])]
            mine, at = mine[at >= 0], at[at >= 0]
            gradient = np.rint(gap[mine] / step)
            for i, f in enumerate(features):
                cell = at * 256 + ranges[mine, f]
                total[:, i, :, 0] += np.bincount(cell, gradient, len(wanted) * 256).astype(np.int64).reshape(-1, 256)
                total[:, i, :, 1] += np.bincount(cell, minlength=len(wanted) * 256).reshape(-1, 256)
        node, feature, bin_ = np.nonzero(total[..., 1])
        columns = [np.append(np.array(wanted)[node], -1), np.append(feature, -1), np.append(bin_, -1)]
        figures = [np.append(total[node, feature, bin_, k], error[k]) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int32()) for c in columns], *[pa.array(c, pa.int64()) for c in figures]], ["node", "feature", "bin", "gradient", "n"])

    return state.mapInArrow(run, SUMS).groupBy("node", "feature", "bin").agg(F.sum("gradient").alias("gradient"), F.sum("n").alias("n")).toPandas()


def _advanced(state: DataFrame, since: list[Tree], width: int, work: Workspace, name: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ranges = matrix(b.column("ranges"), width)
            fit = b.column("fit").to_numpy() + sum((t.values_of(ranges) for t in since), np.zeros(b.num_rows))
            yield b.set_column(4, "fit", pa.array(fit))

    return work.keep(state.mapInArrow(run, STATE), name)


def step_of(bound: float, rows: int) -> float:
    """Unit of the gradients in which the sum over all rows is exact in a double."""
    return 2.0 ** (int(np.ceil(np.log2(max(bound, 1e-9) * max(rows, 1)))) - 51)


def by_node(found: pd.DataFrame, wanted: list[int], features: int) -> Histograms:
    out = {w: np.zeros((features, 256, 2)) for w in wanted}
    for w, part in found[found["node"] >= 0].groupby("node"):
        out[w][part["feature"], part["bin"]] = part[["gradient", "n"]].to_numpy(float)
    return out


def boost(state: DataFrame, width: int, bound: float, rows: int, s: Settings, work: Workspace, unit: float | None = None) -> tuple[list[Tree], list[float]]:
    """Trees over the rows not held, and the held rows' mean squared error before each round and after the last one.

    Growth ends when the held rows' error has not fallen for ``patience`` rounds; trees after the best round are left out.
    """
    step = step_of(bound, rows)
    unit = unit or step
    trees, errors, since = [], [], []
    rng = np.random.default_rng(s.seed)
    for number in range(s.rounds + 1):
        last = number == s.rounds
        features = sorted(rng.choice(width, max(1, round(width * s.feature_share)), replace=False).tolist())

        def histograms(tree: Tree, wanted: list[int]) -> Histograms:
            found = summed(state, since, tree, wanted, features, width, number, step, s, unit)
            held = found[found["node"] == -1]
            if len(errors) == number:
                n = int(held["n"].sum())
                errors.append(float(held["gradient"].sum()) * unit / n if n else 0.0)
            return by_node(found, wanted, len(features))

        if last:
            histograms(Tree([-1], [-1], [-1], [-1], [0.0]), [])
            break
        tree = grow(histograms, features, step, s)
        best = int(np.argmin(errors))
        if len(errors) - 1 - best >= s.patience or len(tree.feature) == 1:
            break
        trees.append(tree)
        since.append(tree)
        if len(since) == s.refresh:
            state, since = _advanced(state, since, width, work, f"fit{number}"), []
    held = any(e > 0 for e in errors)
    return (trees[: int(np.argmin(errors))] if held else trees), errors


@dataclass
class Prepared:
    """Rows as ranges of their features, with what is needed to code new rows alike."""

    state: DataFrame
    edges: list[list[float]]
    sums: DataFrame | None
    base: float
    bound: float
    rows: int
    unit: float  # of the held rows' squared errors


def prepare(
    train: DataFrame, validation: DataFrame, features: list[str], categorical: list[str], target: str, key: list[str], settings: Settings, work: Workspace,
) -> Prepared:
    """Ordered target statistics of the categories, numbers as they are, both as ranges; ``key`` names a row and seeds its draws.

    Without training rows the mean that all else starts from is 0, the prediction of nothing.
    """
    cats = [c for c in features if c in categorical]
    mark = F.md5(F.concat_ws("|", F.lit(settings.seed), *key))
    columns = [*key, *[c for c in features if c not in key], target]
    typed = lambda df: df.select(*columns, mark.alias("_m")).withColumns({c: dbl(c) for c in features if c not in cats} | {target: dbl(target)})
    rows, held = work.keep(typed(train), "train"), typed(validation)
    n, base, low, high = rows.agg(F.count("*"), mean_of(fixed(target)), F.min(target), F.max(target)).first()
    if not n:
        base = low = high = 0.0
    bound = 2 * max(high - base, base - low, 1e-6)
    n_held, far = held.agg(F.count("*"), F.max(F.abs(F.col(target) - base))).first()
    unit = step_of((bound + (far or 0.0)) ** 2, n_held)  # the held rows may lie far outside the training rows
    sums = work.keep(category_sums(rows, cats, target), "sums") if cats else None
    coded = work.keep(ordered_codes(rows, cats, target, F.col("_m"), settings.weight), "coded") if cats else rows
    held = codes_of(held, sums, cats, base, settings.weight) if cats else held
    edges = range_edges(coded, features, settings.bins)
    wide = coded.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
    marked = F.conv(F.substring("_m", 1, 15), 16, 10).cast("long")
    wide = wide.select(marked.alias("mark"), F.col(target).alias("y"), "held", F.array(*[dbl(c) for c in features]).alias("x"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).astype(float).reshape(b.num_rows, len(features))
            packed = pa.array([r.tobytes() for r in ranges_of(x, edges)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("mark"), b.column("y"), b.column("held"), packed, pa.array(np.full(b.num_rows, base))], [c.split()[0] for c in STATE.split(", ")])

    return Prepared(work.keep(wide.mapInArrow(pack, STATE), "state"), edges, sums, base, bound, n, unit)


def fit(
    train: DataFrame, validation: DataFrame, features: list[str], categorical: list[str], target: str, key: list[str], settings: Settings = Settings(),
) -> Booster:
    """A booster that stops when the error of the validation rows no longer falls; without training rows it has no tree and predicts 0."""
    work = Workspace(train.sparkSession)
    made = prepare(train, validation, features, categorical, target, key, settings, work)
    trees, errors = boost(made.state, len(features), made.bound, made.rows, settings, work, made.unit)
    return Booster(list(features), [c for c in features if c in categorical], made.edges, made.base, settings, trees, errors, made.sums)


def root_histogram(made: Prepared, features: list[str]) -> DataFrame:
    """(feature, range, n, total): all training rows and their distance from the mean by the ranges of each feature."""
    at = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.conv(F.hex(F.substring("ranges", i + 1, 1)), 16, 10).cast("int").alias("range")) for i, c in enumerate(features)]))
    rows = made.state.where(~F.col("held")).select((F.col("y") - F.col("fit")).alias("gap"), at.alias("at"))
    return rows.groupBy("at.feature", "at.range").agg(F.count("*").alias("n"), F.sum("gap").alias("total"))


def first_split(made: Prepared, features: list[str], settings: Settings) -> DataFrame:
    """The split of the first tree's root over all rows and features: feature, lowest value on the right, rows and sum on the left."""
    whole = replace(settings, row_share=1.0, feature_share=1.0, leaves=2)
    step, n = step_of(made.bound, made.rows), len(features)
    seen = {}

    def histograms(tree: Tree, wanted: list[int]) -> Histograms:
        found = summed(made.state, [], tree, wanted, list(range(n)), n, 0, step, whole, made.unit)
        out = by_node(found, wanted, n)
        seen.update(out)
        return out

    tree = grow(histograms, list(range(n)), step, whole)
    spark = made.state.sparkSession
    columns = "feature string, low double, n_left long, sum_left double"
    if tree.left[0] < 0:
        return spark.createDataFrame([], columns)
    f, limit = tree.feature[0], tree.limit[0]
    left = seen[0][f, : limit + 1].sum(axis=0)
    return spark.createDataFrame([(features[f], made.edges[f][limit], int(left[1]), float(left[0] * step))], columns)


def predict(model: Booster, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Adds the model's estimate; the other columns stay in Spark."""
    hidden = {c: f"_code_{c}" for c in model.categorical}
    coded = df.withColumns({h: F.col(c) for c, h in hidden.items()})
    if model.categorical:
        renamed = model.sums.replace(hidden, subset=["feature"])
        coded = codes_of(coded, renamed, list(hidden.values()), model.base, model.settings.weight)
    edges, trees, base = model.edges, model.trees, model.base

    @F.pandas_udf("double")
    def estimate(x: pd.Series) -> pd.Series:
        values = np.stack([np.array([np.nan if e is None else e for e in v], float) if v.dtype == object else v for v in x]) if len(x) else np.zeros((0, len(edges)))
        ranges = ranges_of(values, edges)
        return pd.Series(base + sum((t.values_of(ranges) for t in trees), np.zeros(len(values))))

    return coded.withColumn(out, estimate(F.array(*[dbl(hidden.get(c, c)) for c in model.features]))).drop(*hidden.values())


def importance(spark: SparkSession, model: Booster, n: int = 20) -> DataFrame:
    """Share of the splits by feature."""
    splits = [f for t in model.trees for f in t.feature if f >= 0]
    shares = [(c, splits.count(i) / max(len(splits), 1)) for i, c in enumerate(model.features)]
    return spark.createDataFrame(sorted(shares, key=lambda r: (-r[1], r[0]))[:n], "feature string, importance double")


def save(model: Booster, path: str) -> None:
    """The trees as one text row, the category sums as a table beside it."""
    spark = SparkSession.active()
    text = json.dumps({**{k: getattr(model, k) for k in ("features", "categorical", "edges", "base", "held_errors")},
                       "settings": asdict(model.settings), "trees": [asdict(t) for t in model.trees]})
    if model.sums is not None:
        model.sums.write.mode("overwrite").parquet(f"{path}/sums")
    spark.createDataFrame([(text,)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")


def load(spark: SparkSession, path: str) -> Booster:
    held = json.loads(spark.read.parquet(f"{path}/model").first().model)
    sums = spark.read.parquet(f"{path}/sums") if held["categorical"] else None
    return Booster(held["features"], held["categorical"], held["edges"], held["base"], Settings(**held["settings"]), [Tree(**t) for t in held["trees"]], held["held_errors"], sums)
