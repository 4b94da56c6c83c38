"""Quality classifier: a sparse ensemble of conjunctive rules over text statistics.

Shallow trees are grown on the statistics of the labelled documents; every path from a root to a node is
a rule, a conjunction of comparisons. A logistic regression with an L1 penalty then keeps few of the
rules. What remains is compiled into one Spark expression, so scoring is a projection over the scan.

Training runs on all labelled documents that ``learn`` admits, spread over the cluster; only trees, rules and
weights reach the driver. Their number is set by ``trees`` and ``depth``, not by the data.

Nulls: a null text has the statistics of an empty one, a null doc_id is never learnt from and is not held
out. Without rows to learn from the score is 0.5 for all, with one class only it is that class's label.
Repeated label rows: the lowest quality counts; repeated documents are learnt and judged each. Empty tables
give no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.session import Workspace

SYMBOLS = "#*$%&|<>!^~=@_+{}[]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
STATISTICS = ["words", "distinct_words", "word_length", "symbols", "capitals", "sentence_ends", "lines", "distinct_lines", "bars"]
Rule = tuple[tuple[str, str, float], ...]


def with_statistics(docs: DataFrame, kept: Column) -> DataFrame:
    """(``kept``, statistics ...) of the whole texts, from a single split into words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(kept.alias("kept"), text.alias("text"), F.split(text, r"[\x20\x09-\x0D]+").alias("w"), F.split(text, "\n").alias("l"))
    n, chars, lines = F.size("w"), F.greatest(F.length("text"), F.lit(1)), F.size("l")
    without = lambda drop: (F.length("text") - F.length(F.translate("text", drop, ""))) / chars
    return rows.select(
        "kept", F.log1p(n.cast("double")).alias("words"), (F.size(F.array_distinct("w")) / n).alias("distinct_words"), (chars / n).alias("word_length"),
        without(SYMBOLS).alias("symbols"), without(CAPITALS).alias("capitals"),
        ((F.length("text") - F.length(F.replace("text", F.lit("."), F.lit("")))) / n).alias("sentence_ends"),
        F.log1p(lines.cast("double")).alias("lines"), (F.size(F.array_distinct("l")) / lines).alias("distinct_lines"),
        ((F.length("text") - F.length(F.replace("text", F.lit("|"), F.lit("")))) / n).alias("bars"))


def tree_rules(printed: str) -> list[Rule]:
    """The conjunctions on all paths of a printed tree, each with its comparisons in order of the path."""
    out, path = [], []
    for line in printed.splitlines():
        m = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth, test = len(m[1]), (STATISTICS[int(m[2])], m[3], float(m[4]))
            path = [p for p in path if p[0] < depth] + [(depth, test)]
            out.append(tuple(t for _, t in path))
    return out


def holds(rule: Rule) -> Column:
    all_hold = F.lit(True)
    for name, side, bound in rule:
        all_hold = all_hold & ((F.col(name) <= bound) if side == "<=" else (F.col(name) > bound))
    return all_hold.cast("double")


def learn_rules(rows: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules from rows (statistics ..., label)."""
    counts = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counts) < 2:
        return (0.0 if not counts else 40.0 if counts.get(1.0) else -40.0), []
    vectors = VectorAssembler(inputCols=STATISTICS, outputCol="v").transform(rows)
    forest = RandomForestClassifier(featuresCol="v", labelCol="label", numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", subsamplingRate=0.7, seed=7).fit(vectors)
    rules = sorted({rule for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    if not rules:
        share = counts.get(1.0, 0) / sum(counts.values())
        return float(_logit(share)), []
    named = rows.select("label", *[holds(r).alias(f"r{i}") for i, r in enumerate(rules)])
    vectors = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="v").transform(named).select("label", "v")
    lasso = LogisticRegression(featuresCol="v", labelCol="label", regParam=penalty, elasticNetParam=1.0, standardization=False, maxIter=60).fit(vectors)
    return float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]


def _logit(p: float) -> float:
    import math

    return math.log(p / (1 - p))


def score_column(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + holds(rule) * F.lit(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def held_out(fold: int = 0, folds: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False))


def _scored(docs: DataFrame, labels: DataFrame, work: Workspace) -> tuple[DataFrame, Column]:
    """(doc_id, statistics ...) of all documents, and the score as a column over them."""
    quality = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("double").alias("label"))
    # One pass over the texts feeds both training and scoring.
    stats = work.keep(with_statistics(docs, F.col("doc_id")).withColumnRenamed("kept", "doc_id"), "statistics")
    rows = work.keep(stats.where(~held_out()).join(quality, "doc_id").drop("doc_id"), "learnt_from")
    return stats, score_column(*learn_rules(rows))


def classify(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    stats, score = _scored(docs, labels, Workspace(docs.sparkSession))
    return stats.select("doc_id", held_out().alias("held_out"), score.alias("score")).select("*", (F.col("score") >= cut).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, cut: float = 0.3) -> DataFrame:
    """The rows of ``docs``, all columns, that the compiled rules accept; a filter over the scan, without a join."""
    _, score = _scored(docs, labels, Workspace(docs.sparkSession))
    # A generated row keeps the filter above the statistics; pushed below, every rule would count the words again.
    rows = with_statistics(docs, F.struct("*")).select(F.inline(F.array(F.struct("*"))))
    return rows.where(score >= cut).select("kept.*")
