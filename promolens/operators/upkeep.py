"""Upkeep of the daily and weekly facts: a batch of tickets recomputes the slices that it touches.

A slice holds one month (or quarter, or year) of one bucket of roots. A batch touches the slices of its own days, those of the days that
the calendar gains, all periods of roots and stores that sell for the first time, and the days of offers that were
changed. The facts of these slices are computed by the functions that build the whole tables, and published by slice,
so the others stay as they are on storage. One row of state names the version of every table; it is published last.
Readers see a batch in all tables or in none, and a batch that was cut short is done again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import each_day, week_start
from ..sources.publish import publish, read_published
from . import facts
from .facts import PAIR, PROMO

DAILY = ("daily_promo", "daily", "daily_summary")
WEEKLY = ("weekly_promo", "weekly", "weekly_summary")
_PLACES = ("_slice_key", "_batch")


class FactStore:
    """Facts under ``root``. ``buckets`` and ``grain`` (month, quarter or year) are fixed for the life of the store: periods x buckets
    is the number of slices."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, grain: str = "month"):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.grain, self.months = grain, {"month": 1, "quarter": 3, "year": 12}[grain]

    # --- slices -------------------------------------------------------------

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("sku_root_id"), F.lit(self.buckets)).cast("int")

    def _slice(self, day: Column | str = "date", bucket: Column | None = None) -> Column:
        number = self._bucket() if bucket is None else bucket
        return F.concat_ws("-", F.date_format(F.trunc(day, self.grain), "yyyyMM"), F.lpad(number.cast("string"), 5, "0"))

    def _names(self, slices: DataFrame) -> list[str]:
        """Slice names for partition pruning: at most periods x buckets of them."""
        return sorted(r[0] for r in slices.distinct().collect())

    # --- state --------------------------------------------------------------

    def _state(self) -> dict[str, int]:
        """Version of every table and ``batch:<n>`` of every batch done; empty before the first batch."""
        try:
            rows = read_published(self.spark, f"{self.root}/state").collect()
        except ValueError:
            return {}
        return {r.name: r.version for r in rows}

    def batches(self) -> list[int]:
        return sorted(int(n.split(":")[1]) for n in self._state() if n.startswith("batch:"))

    def __getitem__(self, name: str) -> DataFrame:
        """A table as the last complete batch left it."""
        return self._read(name, self._state())

    def _read(self, name: str, state: dict[str, int], slices: list[str] | None = None) -> DataFrame:
        return read_published(self.spark, f"{self.root}/{name}", state[name], slices).drop("_slice_key")

    def _put(self, name: str, df: DataFrame, state: dict[str, int]) -> int:
        """Next version of a table: the slices of ``df`` anew, the others by reference. No slice ever loses all its rows,
        as a root and store that sold once keeps rows for all days."""
        return publish(
            df.withColumn("_slice_key", self._slice()), f"{self.root}/{name}", "_slice_key", keep_others=name in state, base=state.get(name))

    def _kept(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/work/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # --- batches ------------------------------------------------------------

    def apply(
        self, number: int, batch: DataFrame, roots: DataFrame, campaigns: DataFrame, campaign_days: DataFrame, promo_to_sku: DataFrame,
        cal: DataFrame, changed_offers: DataFrame | None = None,
    ) -> list[str]:
        """Add the tickets of a batch and return the daily slices that were computed.

        ``batch`` has the columns of ``transaction_to_sku``; dimensions are given whole and as they now are, and the
        calendar covers the days of all tickets. ``changed_offers`` (promo_id, promo_year) names campaigns whose days,
        products or stores are not those of the last batch, new ones that reach into earlier days among them. A batch
        that is done is not added again.
        """
        state = self._state()
        if f"batch:{number}" in state:
            return []
        if set(_PLACES) & set(batch.columns):
            raise ValueError(f"{_PLACES} are names of the store")
        folder = f"{self.root}/tickets"
        placed = batch.withColumn("_slice_key", self._slice())
        placed.hint("rebalance", "_slice_key").write.mode("overwrite").partitionBy("_slice_key").parquet(f"{folder}/_batch={number}")
        schema = T.StructType([*batch.schema.fields, T.StructField("_slice_key", T.StringType()), T.StructField("_batch", T.LongType())])
        known = [number, *(int(n.split(":")[1]) for n in state if n.startswith("batch:"))]
        tickets = self.spark.read.schema(schema).parquet(folder).where(F.col("_batch").isin(known))
        mine = tickets.where(F.col("_batch") == number)

        pairs_now = mine.join(roots.select("sku_root_id"), "sku_root_id", "left_semi").select(*PAIR).distinct()
        if "pairs" in state:
            new_pairs = pairs_now.join(self._read("pairs", state).select(*PAIR), PAIR, "left_anti")
            new_days = cal.select("date").join(self._read("days", state), "date", "left_anti")
        else:
            new_pairs, new_days = pairs_now, cal.select("date")
        new_pairs = self._kept(new_pairs, f"{number}/new_pairs")
        new_buckets = sorted(r[0] for r in new_pairs.select(self._bucket()).distinct().collect())
        made = dict(state)
        if new_buckets or "pairs" not in state:
            whole = new_pairs.withColumn("_bucket", self._bucket())
            if "pairs" in state:
                old = read_published(self.spark, f"{self.root}/pairs", state["pairs"], [str(b) for b in new_buckets])
                whole = whole.unionByName(old)
            made["pairs"] = publish(whole, f"{self.root}/pairs", "_bucket", keep_others="pairs" in state, base=state.get("pairs"))
        made["days"] = publish(cal.select("date"), f"{self.root}/days")
        own = mine.join(roots.select("sku_root_id"), "sku_root_id", "left_semi")
        marks = [own.select("date", self._bucket().alias("_bucket"))]
        # Days against bucket numbers: both lists are short, whatever the tickets.
        marks.append(new_days.select("date", F.explode(F.lit(list(range(self.buckets)))).alias("_bucket")))
        if new_buckets:
            marks.append(cal.select("date", F.explode(F.lit(new_buckets)).alias("_bucket")))
        if changed_offers is not None:
            marks += self._offer_days(changed_offers, state, campaign_days, promo_to_sku)
        touched = self._names(self._with_rows(marks, made["pairs"], cal))
        if touched:
            made |= self._daily(touched, tickets, roots, campaigns, campaign_days, promo_to_sku, cal, state, made["pairs"])
            made |= self._weekly(touched, state, made["daily_promo"])
        made[f"batch:{number}"] = number
        publish(self.spark.createDataFrame(sorted(made.items()), "name string, version long"), f"{self.root}/state")
        return touched

    def _offer_days(self, changed: DataFrame, state: dict[str, int], campaign_days: DataFrame, promo_to_sku: DataFrame) -> list[DataFrame]:
        """Days and buckets of changed offers, as they are now and as the facts have them."""
        offers = changed.select("promo_id", "promo_year").distinct()
        now = facts.promo_root_days(promo_to_sku, campaign_days.join(offers, PROMO, "left_semi"))
        found = [now]
        if "daily_promo" in state:
            found.append(self._read("daily_promo", state).select("date", *PAIR, *PROMO).join(offers, PROMO, "left_semi"))
        return [f.select("date", self._bucket().alias("_bucket")) for f in found]

    def _with_rows(self, marks: list[DataFrame], pairs_version: int, cal: DataFrame) -> DataFrame:
        """Slices of the marked days and buckets that have rows: a period of the calendar, a bucket with a root."""
        period = F.trunc("date", self.grain).alias("_period")
        marked = reduce(DataFrame.unionByName, [m.select(period, "_bucket") for m in marks]).distinct()
        held = read_published(self.spark, f"{self.root}/pairs", pairs_version).select("_bucket").distinct()
        periods = cal.select(period).distinct()
        return marked.join(periods, "_period", "left_semi").join(held, "_bucket", "left_semi").select(self._slice("_period", F.col("_bucket")))

    def _daily(self, touched, tickets, roots, campaigns, campaign_days, promo_to_sku, cal, state, pairs_version) -> dict[str, int]:
        rows = tickets.where(F.col("_slice_key").isin(touched)).drop(*_PLACES)
        actuals = facts.daily_root_promo(rows, roots, facts.promo_windows(promo_to_sku, campaigns))
        slots = self.spark.createDataFrame([(s[:6], int(s[7:])) for s in touched], "_period string, _bucket int")
        ends = cal.agg(F.min("date").alias("a"), F.max("date").alias("b"))
        begin = F.to_date(F.concat("_period", F.lit("01")), "yyyyMMdd")
        days = slots.select(
            "_bucket", F.greatest(begin, ends.select("a").scalar()).alias("_first"),
            F.least(F.date_sub(F.add_months(begin, self.months), 1), ends.select("b").scalar()).alias("_last"))
        pairs = read_published(self.spark, f"{self.root}/pairs", pairs_version)
        grid = pairs.join(days, "_bucket").where("_first <= _last").select(*PAIR, each_day("_first", "_last").alias("date"))
        offered = facts.promo_root_days(promo_to_sku, campaign_days).where(self._slice().isin(touched))
        filled = facts.gap_fill(facts.grid_with_promos(grid, offered), actuals)
        out = {"daily_promo": self._put("daily_promo", filled, state)}
        out["daily"] = self._put("daily", facts.daily(self._read("daily_promo", out, touched)), state)
        out["daily_summary"] = self._put("daily_summary", facts.summary(self._read("daily", out, touched)), state)
        return out

    def _weekly(self, touched, state, daily_version) -> dict[str, int]:
        """Weeks lie in the period of their Monday, so a daily slice reaches back into the period before."""
        wanted = sorted({w for s in touched for w in (s, _later(s, -self.months))})
        sources = sorted({d for w in wanted for d in (w, _later(w, self.months))})
        days = self._read("daily_promo", {"daily_promo": daily_version}, sources)
        mine = days.where(self._slice(week_start("date")).isin(wanted))
        out = {"weekly_promo": self._put("weekly_promo", facts.weekly_promo(mine), state)}
        out["weekly"] = self._put("weekly", facts.weekly(self._read("weekly_promo", out, wanted)), state)
        out["weekly_summary"] = self._put("weekly_summary", facts.summary(self._read("weekly", out, wanted)), state)
        return out


def _later(name: str, by: int) -> str:
    """The slice of the same bucket some months later."""
    n = int(name[:4]) * 12 + int(name[4:6]) - 1 + by
    return f"{n // 12:04d}{n % 12 + 1:02d}{name[6:]}"
