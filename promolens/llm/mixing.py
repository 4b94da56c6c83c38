"""Mixing sources to target weights by capped water-filling.

A source's target grows with its weight until it reaches ``max_epochs`` times the source's size; the
rest of the budget then goes to the other sources in proportion to their weights. With sources in order
of size over weight, the clamped ones are a prefix and the water level is a running quotient, so one
window over one row per source solves it. A source's documents are then taken ``floor`` times whole, and
once more in the order of a seeded hash until the target is met to within half a document.

The place in the hash order where a source's last part ends is found by digits: sizes summed by the
first hex digits of the hash, then by the next digits inside the one bucket that holds the end. Only
documents of that last bucket (a 2^-24th of a source) are ever ordered.

Nulls: a null text has size 0, a null source is a source of its own (last in order), a null ``doc_id``
hashes as ''. Documents of size 0 are returned with nothing taken. Repeated rows are separate documents;
among equal rows at the end any may be taken. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promolens.session import Workspace

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = (3, 6)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(weights: tuple[float, ...]) -> Column:
    """Weights given in turn to the sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int"))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Adds ``target`` to rows (source, source_size, weight)."""
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = F.sum("source_size").over(Window.partitionBy())
    rows = sources.select("*", cap.alias("cap"), (total * F.lit(float(share))).alias("budget"), F.sum("weight").over(Window.partitionBy()).alias("weights"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left = F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.select("*", ((F.col("budget") - done) / left).alias("level"))
    full = F.col("level") >= F.col("cap") / F.col("weight")
    rows = rows.select("*", full.alias("full"), F.max("level").over(Window.partitionBy()).alias("water"))
    return rows.select("source", "source_size", "weight", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * F.col("water")).alias("target"))


def _repetitions(docs: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float, seed: str) -> DataFrame:
    """Rows (row, size, source_size, target, times) with the whole document as ``row``."""
    work = Workspace(docs.sparkSession)
    # '=' keeps a null source apart from a source named ''.
    name = F.when(F.col("source").isNotNull(), F.concat(F.lit("="), F.col("source"))).otherwise(F.lit(""))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    whole_rows = docs.select(F.struct("*").alias("row"), "source", name.alias("key"), word_count(F.col("text")).alias("size"), order.alias("h"))
    slim = work.keep(whole_rows.select("source", "key", "size", "h"), "sizes")
    sources = slim.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    plan = water_fill(sources.select("source", "source_size", cyclic_weights(weights).alias("weight")), share, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    need = F.col("target") - F.col("whole") * F.col("source_size")
    plan = work.keep(plan.select(name.alias("key"), "source_size", "target", whole.alias("whole")).select("*", need.alias("need")), "plan")
    sized = slim.where("size > 0")
    ends = plan.select("key", "need", F.lit("").alias("prefix"), F.lit(0).cast("long").alias("base"))
    for width in DIGITS:
        held = sized.join(ends, "key").where(F.expr("startswith(h, prefix)"))
        sums = held.groupBy("key", "need", "base", F.substring("h", 1, width).alias("p")).agg(F.sum("size").alias("s"))
        upto = F.col("base") + F.sum("s").over(Window.partitionBy("key").orderBy("p"))
        sums = sums.select("key", "need", "p", (upto - F.col("s")).alias("base"), upto.alias("upto")).where("upto > need")
        sums = sums.groupBy("key", "need").agg(F.min(F.struct("p", "base")).alias("first"))
        ends = work.keep(sums.select("key", "need", F.col("first.p").alias("prefix"), F.col("first.base").alias("base")), f"ends{width}")
    place = F.substring("h", 1, DIGITS[-1])
    rows = whole_rows.drop("source").join(plan.drop("need"), "key").join(ends, "key", "left").select("*", F.when(F.col("size") > 0, place).alias("place"))
    inside = F.col("place") == F.col("prefix")
    upto = F.col("base") + F.sum("size").over(Window.partitionBy("key").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0))
    last = rows.where(inside).select("*", (2 * upto - F.col("size") <= 2 * F.col("need")).alias("extra"))
    rest = rows.where(~F.coalesce(inside, F.lit(False))).select("*", F.coalesce(F.col("place") < F.col("prefix"), F.lit(False)).alias("extra"))
    times = F.when(F.col("size") > 0, F.col("whole") + F.col("extra").cast("long")).otherwise(F.lit(0))
    return last.unionByName(rest).select("row", "size", "source_size", "target", times.cast("long").alias("times"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, size, source_size, target (its source's) and taken (words, repeats counted)."""
    rows = _repetitions(docs.select("doc_id", "source", "text"), weights, share, max_epochs, seed)
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_epochs: float = 2, seed: str = "mix") -> DataFrame:
    """The mix itself: the rows of ``docs``, all columns, each as often as it is taken."""
    rows = _repetitions(docs, weights, share, max_epochs, seed).where("times > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select("row.*")


SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([5.0, 2.0, 1.0])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () * 1.5::DOUBLE AS budget, sum(weight) OVER () AS weights FROM s),
l AS (
  SELECT *, (budget - coalesce(sum(cap) OVER w, 0)) / (weights - coalesce(sum(weight) OVER w, 0)) AS level FROM c
  WINDOW w AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN level >= cap / weight THEN cap ELSE weight * max(level) OVER () END AS target FROM l),
n AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
r AS (
  SELECT d.*, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
         sum(size) OVER (PARTITION BY d.source ORDER BY h, size ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN 2 * upto - size <= 2 * need THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""
