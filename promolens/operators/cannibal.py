"""Sales a promotion takes from the other products of its segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.folds import fold_rows
from ..functions.numeric import cents, dbl, fixed, ratio
from .counterfactual import METRICS

# Fixed values of cb_flag: 0 no promotion in the segment, 1 first and 2 later weeks
# beside a promotion, 4 own promotion.
QUIET, FIRST, LATER, OWN = 0, 1, 2, 4


def segment_promo_count(rows: DataFrame, level: str = "segment") -> DataFrame:
    """Promoted roots of the segment per week; negative increments become zero.

    The count is summed per week and segment and joined back, so a large segment is
    never gathered in one task.
    """
    clean = rows.withColumn("incremental_qty", F.greatest("incremental_qty", F.lit(0.0)))
    counts = clean.groupBy("date", level).agg(F.sum("promo_flag_binary").alias("cb_flag_temp"))
    return clean.join(counts, ["date", level])


def cannibal_flags(rows: DataFrame) -> DataFrame:
    """Later rules win over earlier ones."""
    near, own = F.col("cb_flag_temp") > 0, F.col("promo_flag_binary") == 1
    first_pass = (
        F.when(own, OWN)
        .when((F.col("change_flag") == 3) & near, FIRST)
        .when(near, LATER)
        .when(F.col("cb_flag_temp") == 0, QUIET)
    )
    w = Window.partitionBy("sku_root_id").orderBy("date")
    flagged = rows.withColumn("_flag", first_pass)
    starts = (F.col("_flag") == LATER) & (F.lag("_flag").over(w) == QUIET)
    return flagged.withColumn("cb_flag", F.when(starts, FIRST).otherwise(F.col("_flag"))).drop("_flag")


def cannibal_counterfactual(rows: DataFrame, level: str = "segment") -> DataFrame:
    """Expected sales of a root in weeks beside a promotion, and what it lost."""
    typed = rows.select(
        "sku_root_id", level, "date", "cb_flag", "promo_flag_binary", dbl("incremental_qty").alias("incremental_qty"),
        *[dbl(f"total_{m}").alias(f"total_{m}") for m in METRICS],
        *[dbl(f"{m}_bl").alias(f"{m}_bl") for m in METRICS],
        *[f"{m}_pct" for m in METRICS],
    )

    def step(acc: Column, row: Column) -> dict[str, Column]:
        flag, before = row["cb_flag"], acc["flag"]
        state: dict[str, Column] = {"flag": flag}
        for m in METRICS:
            pct = row[f"{m}_pct"]
            value = (
                F.when(before.isNull(), F.when(flag.isin(FIRST, LATER), row[f"total_{m}"]))
                .when(flag == LATER, cents(acc[f"c_{m}"] * pct))
                .when((flag == FIRST) & (before == OWN), cents(acc[f"b_{m}"] * pct))
                .when((flag == FIRST) & (before == QUIET), cents(row[f"total_{m}"]))
            )
            state[f"c_{m}"] = value
            state[f"b_{m}"] = row[f"{m}_bl"]
            state[f"{m}_cb_bl"] = value
        return state

    carried = {"flag": "int", **{f"{p}_{m}": "double" for m in METRICS for p in ("c", "b")}}
    fields = [c for c in typed.columns if c not in ("sku_root_id", level, "date")]
    folded = fold_rows(
        typed, ["sku_root_id", level], "date", fields, carried, step, {f"{m}_cb_bl": "double" for m in METRICS}
    )
    return folded.withColumns({f"cb_{m}": F.col(f"{m}_cb_bl") - F.col(f"total_{m}") for m in METRICS})


def attribute(rows: DataFrame, level: str = "segment", negatives: str = "all") -> DataFrame:
    """Share the segment's loss among promoted roots by their incremental quantity."""
    kept = rows
    if negatives == "positive":
        numeric = ["incremental_qty", *[f"cb_{m}" for m in METRICS], *[f"{m}_cb_bl" for m in METRICS]]
        kept = rows.withColumns({c: F.when(F.col(c) < 0, 0.0).otherwise(F.col(c)) for c in numeric})
    exact = {f"_{c}": fixed(c) for c in ["incremental_qty", *[f"cb_{m}" for m in METRICS]]}
    totals = kept.withColumns(exact).groupBy("date", level).agg(
        dbl(F.sum("_incremental_qty")).alias("_inc"),
        *[F.coalesce(dbl(F.sum(f"_cb_{m}")), F.lit(0.0)).alias(f"_ttl_{m}") for m in METRICS],
    )
    share = F.coalesce(ratio("incremental_qty", "_inc"), F.lit(0.0))
    short = {"sale_amt": "ind_cb_sale", "sale_qty": "ind_cb_qty", "margin_amt": "ind_cb_margin"}
    return kept.join(totals, ["date", level]).select(
        "date", level, "cb_flag", *[f"{m}_cb_bl" for m in METRICS], "sku_root_id",
        *[(F.col(f"_ttl_{m}") * share).alias(name) for m, name in short.items()],
    )


def cannibalisation(sku_counterfactual: DataFrame, level: str = "segment", negatives: str = "all") -> DataFrame:
    flagged = cannibal_flags(segment_promo_count(sku_counterfactual, level))
    return attribute(cannibal_counterfactual(flagged, level), level, negatives)
