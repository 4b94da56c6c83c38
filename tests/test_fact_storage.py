"""Facts without zero days, clustered tables and upkeep by batch, all equal to the dense tables built at once."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from promolens.operators import facts, sparse, uplift
from promolens.operators.upkeep import FactStore
from promolens.plans.mart import open_mart
from promolens.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def mart(spark):
    return open_mart(spark, SF)


def rows_of(df, columns):
    return Counter(str(tuple(r)) for r in df.select(*columns).collect())


def equal(a, b):
    """As ``same``, for few rows."""
    assert rows_of(a, b.columns) == rows_of(b, b.columns)


def same(a, b):
    b = b.select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sparse_equals_dense(mart):
    rows, runs, cal = mart["carrying"], mart["zero_runs"], mart["calendar"]
    same(sparse.dense(rows, runs), mart["daily_promo"])
    weekly = sparse.weekly_promo(rows, runs)
    same(weekly, mart["weekly_promo"])
    same(facts.weekly(weekly), mart["weekly"])
    days = sparse.daily(rows)
    same(sparse.daily_summary(days, cal), facts.summary(mart["daily"]))
    periods = uplift.active_period(days)
    same(periods, mart["periods"])
    same(uplift.avg_per_day(days, periods), mart["per_day"])
    same(sparse.avg_per_weekday(days, periods), mart["per_weekday"])
    assert rows.count() + runs.count() < mart["daily_promo"].count() / 2


def test_runs_at_the_edges(spark):
    cal = spark.sql("select explode(sequence(date'2018-01-01', date'2018-01-21')) as date")
    at = lambda *days: spark.createDataFrame([(dt.date(2018, 1, d), "r", "s") for d in days], "date date, sku_root_id string, store_id string")
    spans = lambda df: sorted((r.first_day.day, r.last_day.day) for r in sparse.zero_runs(df, cal).collect())
    assert spans(at(5, 5, 6, 9)) == [(1, 4), (7, 8), (10, 21)]
    assert spans(at(1, 21)) == [(2, 20)] and spans(at(*range(1, 22))) == [] and spans(at()) == []
    assert spans(at(1)) == [(2, 21)] and spans(at(21)) == [(1, 20)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clustered_facts_join_and_group_without_exchange(spark, mart, tmp_path):
    keys = ["sku_root_id", "store_id"]
    promo = tables.write_clustered(mart["daily_promo"], "test_clustered_promo", str(tmp_path / "p"), 8, keys)
    same(promo.drop("month_key"), mart["daily_promo"])
    weekly = facts.weekly(facts.weekly_promo(promo))
    assert "Exchange" not in plan(weekly)
    same(weekly, mart["weekly"])
    both = tables.write_clustered(mart["daily"], "test_clustered_daily", str(tmp_path / "d"), 8, keys)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = both.select(*keys, "total_sale_qty").join(promo.groupBy(*keys).agg(F.max("date").alias("last")), keys)
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    first, last = dt.date(1996, 2, 10), dt.date(1996, 4, 3)
    part = tables.between_days(both, first, last)
    assert "month_key" in plan(part).split("PartitionFilters: [")[1].split("]")[0]
    same(part, mart["daily"].where(F.col("date").between(F.lit(first), F.lit(last))))
    months = {f.split("month_key=")[1][:7] for f in both.where(F.col("month_key").between("1996-02", "1996-04")).inputFiles()}
    assert months and len(months) <= 96


SPAN = dt.date(1996, 1, 29), dt.date(1996, 4, 28)


def tickets_of(mart):
    """Three months of tickets from 4 roots, and the calendar of these days."""
    inside = F.col("date").between(*[F.lit(d) for d in SPAN])
    roots = mart["root_sku"].orderBy("sku_root_id").limit(4)
    return mart["trans"].where(inside).join(roots.select("sku_root_id"), "sku_root_id", "left_semi"), mart["calendar"].where(inside)


def full_build(mart, tickets, cal, offers):
    """The dense facts of these tickets, built at once."""
    actuals = facts.daily_root_promo(tickets, mart["root_sku"], facts.promo_windows(offers, mart["campaign"]))
    root_days = facts.promo_root_days(offers, mart["campaign_days"])
    promo = facts.gap_fill(facts.grid_with_promos(facts.dense_grid(actuals, cal), root_days), actuals)
    weekly_promo = facts.weekly_promo(promo)
    day, week = facts.daily(promo), facts.weekly(weekly_promo)
    return {"daily_promo": promo, "daily": day, "weekly_promo": weekly_promo, "weekly": week,
            "daily_summary": facts.summary(day), "weekly_summary": facts.summary(week)}


def test_two_batches_equal_a_full_build(spark, mart, tmp_path):
    tickets, cal = tickets_of(mart)
    cut = dt.date(1996, 3, 20)
    early = (F.col("date") <= F.lit(cut)) & (F.pmod(F.xxhash64("transaction_id"), F.lit(10)) != 0)
    fixed = (mart["root_sku"], mart["campaign"], mart["campaign_days"], mart["promo_to_sku"])
    store = FactStore(spark, str(tmp_path / "facts"), 2)
    assert store.apply(1, tickets.where(early), *fixed, cal.where(F.col("date") <= F.lit(cut)))
    before = store["weekly"].count()
    # A batch that ends between its tables and the state is not seen, and is done again.
    real, store._weekly = store._weekly, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    late = tickets.where(~early)
    with pytest.raises(RuntimeError, match="lost"):
        store.apply(2, late, *fixed, cal)
    assert store.batches() == [1] and store["weekly"].count() == before
    store._weekly = real
    assert store.apply(2, late, *fixed, cal)
    assert store.apply(2, late, *fixed, cal) == [] and store.batches() == [1, 2]
    for name, table in full_build(mart, tickets, cal, mart["promo_to_sku"]).items():
        equal(store[name], table)


def test_late_tickets_touch_only_their_slices(spark, mart, tmp_path):
    tickets, cal = tickets_of(mart)
    offers, days = mart["promo_to_sku"], mart["campaign_days"]
    known = tickets.where(F.col("date") < F.lit(dt.date(1996, 4, 10)))
    # One more ticket on a day, root and store that are known.
    late = known.orderBy(F.desc("date"), "transaction_id", "sku_id").limit(1).withColumn("transaction_id", F.lit("late"))
    day = late.first().date
    store, args = FactStore(spark, str(tmp_path / "facts"), 2, "quarter"), (mart["root_sku"], mart["campaign"], days)
    store.apply(1, known, *args, offers, cal)
    got = store.apply(2, late, *args, offers, cal)
    assert [g[:6] for g in got] == [f"{day.year}{(day.month - 1) // 3 * 3 + 1:02d}"]
    equal(store["weekly"], full_build(mart, known.unionByName(late), cal, offers)["weekly"])
    # Offers that end: the days they had are computed again.
    none, gone = tickets.where("false"), offers.select("promo_id", "promo_year").distinct()
    assert store["daily_promo"].where("n_promo > 0").count() > 0
    store.apply(3, none, *args, offers.where("false"), cal, changed_offers=gone)
    assert store["daily_promo"].where("n_promo > 0").count() == 0
    # An empty batch with nothing changed touches nothing.
    assert store.apply(4, none, *args, offers.where("false"), cal) == []
