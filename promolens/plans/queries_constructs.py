"""One query per language construct the promotion scripts use, on the order-entry tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.folds import fold_rows
from ..functions.joins import all_pairs, spread_missing
from ..functions.numeric import cents, dbl, depth_step, fixed, mean_of, percent_off, plain, ratio
from ..functions.ranking import exact_quantile, with_cume_dist, with_percent_rank
from ..operators import counterfactual, forecast
from ..operators.dims import calendar_between
from ..sources import extracts, tables
from ..sources import publish as publishing
from ..sources.retail_adapter import read_tables
from ..streaming import landing
from . import oracle_mart as o
from .mart import open_mart
from .registry import add

_MONEY = "decimal(18,4)"


def q(name: str, frame, spec: str, sql: str | None = None, **kw) -> None:
    """Register a query whose frame is a function of the table dictionary."""
    add(name, lambda spark, sf: frame(read_tables(spark, sf)), spec, sql, **kw)


def money(c: str) -> Column:
    return F.col(c).cast(_MONEY)


def lineval() -> Column:
    return (F.col("l_extendedprice").cast("decimal(12,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast(_MONEY)


_LV = "(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2)))::DECIMAL(18,4)"

# --- projection, filter, predicate -------------------------------------------

q("p01_star_except", lambda t: t["supplier"].drop("s_acctbal"), "s_suppkey:i s_name s_nationkey:i", "SELECT * EXCLUDE (s_acctbal) FROM supplier")
q("p02_qualified_star", lambda t: t["customer"].alias("t").join(t["nation"].alias("n"), F.col("c_nationkey") == F.col("n_nationkey")).select("t.*"),
  "c_custkey:i c_name c_nationkey:i c_acctbal:d c_mktsegment", "SELECT t.* FROM customer t JOIN nation ON c_nationkey = n_nationkey")
q("p03_select_distinct", lambda t: t["lineitem"].select("l_returnflag", "l_linestatus", "l_tax").distinct(), "l_returnflag l_linestatus l_tax:d",
  "SELECT DISTINCT l_returnflag, l_linestatus, l_tax FROM lineitem")
q("p04_searched_case", lambda t: t["part"].select("p_partkey", F.when(F.col("p_size") > 40, F.when(F.col("p_type") == "SMALL", "odd").otherwise("large"))
    .when(F.col("p_size") > 20, "medium").otherwise("small").alias("band"),
    F.when(F.col("p_type") == "ECONOMY", "E").when(F.col("p_type") == "SMALL", "S").alias("letter")), "p_partkey:i band letter",
  """SELECT p_partkey, CASE WHEN p_size > 40 THEN CASE WHEN p_type = 'SMALL' THEN 'odd' ELSE 'large' END WHEN p_size > 20 THEN 'medium' ELSE 'small' END AS band,
  CASE p_type WHEN 'ECONOMY' THEN 'E' WHEN 'SMALL' THEN 'S' END AS letter FROM part""")
q("p05_if", lambda t: t["customer"].select("c_custkey", F.when(F.col("c_acctbal") > 0, "credit").otherwise("debt").alias("side")), "c_custkey:i side",
  "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'credit' ELSE 'debt' END AS side FROM customer")
q("p06_in_list", lambda t: t["orders"].where(F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus"), "o_orderkey:i o_orderstatus",
  "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')")
q("p06_long_list_semi_join", lambda t: t["orders"].join(t["customer"].where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey"), F.col("o_custkey") == F.col("c_custkey"), "left_semi"),
  "o_orderkey:i o_custkey:i", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
q("p07_not_in_list", lambda t: t["orders"].where(~F.col("o_orderstatus").isin("F", "P")).select("o_orderkey", "o_orderstatus"), "o_orderkey:i o_orderstatus",
  "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'P')")
q("p08_not_in_subquery", lambda t: t["part"].join(t["lineitem"].where(F.col("l_quantity") >= 50).select(F.col("l_partkey").alias("p_partkey")).distinct(), "p_partkey", "left_anti"),
  "p_partkey:i p_name", "SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)")
q("p09_between", lambda t: t["orders"].where(F.to_date("o_orderdate").between(dt.date(1998, 1, 1), dt.date(1998, 12, 31))), "o_orderkey:i",
  "SELECT o_orderkey FROM orders WHERE o_orderdate::DATE BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
q("p10_null_tests", lambda t: t["nation"].join(t["supplier"].groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")), F.col("n_nationkey") == F.col("s_nationkey"), "left")
  .select("n_name", F.col("n").isNull().alias("empty"), F.col("n").isNotNull().alias("filled")), "n_name empty filled",
  "SELECT n_name, n IS NULL AS empty, n IS NOT NULL AS filled FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey")
q("p11_regex_predicate", lambda t: t["part"].withColumn("digits", F.replace("p_brand", F.lit("Brand#"), F.lit(""))).where(F.col("digits").rlike("^[0-1,]+$")), "p_partkey:i digits",
  "SELECT p_partkey, replace(p_brand, 'Brand#', '') AS digits FROM part WHERE regexp_matches(replace(p_brand, 'Brand#', ''), '^[0-1,]+$')")
q("p12_boolean_mix", lambda t: t["lineitem"].where((F.col("l_quantity") > 45) & ((F.col("l_discount") >= 0.09) | ~(F.col("l_returnflag") == "R"))).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")),
  "l_returnflag n:i", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 45 AND (l_discount >= 0.09 OR NOT l_returnflag = 'R') GROUP BY 1")
q("p13_constant_columns", lambda t: t["customer"].select("c_name", F.lit(100).alias("stores"), F.lit("Oferta corporativa").alias("kind"), F.lit(None).cast("string").alias("none")), "c_name stores:i kind none",
  "SELECT c_name, 100 AS stores, 'Oferta corporativa' AS kind, NULL::VARCHAR AS none FROM customer")
q("p14_masks", lambda t: t["orders"].where(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & (F.col("o_totalprice") >= 100000)), "o_orderkey:i o_orderpriority",
  "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND o_totalprice >= 100000")

# --- joins --------------------------------------------------------------------

q("j01_inner", lambda t: t["orders"].join(t["customer"], F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"), F.sum(money("o_totalprice")).alias("total")),
  "c_mktsegment n:i total:d", "SELECT c_mktsegment, count(*) AS n, sum(o_totalprice::DECIMAL(18,4)) AS total FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1")
q("j02_left_outer", lambda t: t["customer"].join(t["orders"].groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n")),
  "c_custkey:i n:i", "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")


def _three_full(t: dict[str, DataFrame]) -> DataFrame:
    parts = []
    for name, test in (("big", F.col("l_quantity") > 48), ("free", F.col("l_discount") == 0), ("back", F.col("l_returnflag") == "R")):
        parts.append(t["lineitem"].where(test).groupBy("l_partkey", "l_linestatus").agg(F.count(F.lit(1)).alias(name)))
    return parts[0].join(parts[1], ["l_partkey", "l_linestatus"], "full").join(parts[2], ["l_partkey", "l_linestatus"], "full")


q("j03_full_outer_chain", _three_full, "l_partkey:i l_linestatus big:i free:i back:i", """SELECT * FROM (SELECT l_partkey, l_linestatus, count(*) AS big FROM lineitem WHERE l_quantity > 48 GROUP BY ALL) a
FULL JOIN (SELECT l_partkey, l_linestatus, count(*) AS free FROM lineitem WHERE l_discount = 0 GROUP BY ALL) b USING (l_partkey, l_linestatus)
FULL JOIN (SELECT l_partkey, l_linestatus, count(*) AS back FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) c USING (l_partkey, l_linestatus)""")
q("j04_cross_product", lambda t: all_pairs(t["customer"].select("c_custkey"), t["region"].select("r_name")), "c_custkey:i r_name", "SELECT c_custkey, r_name FROM customer CROSS JOIN region")


def _spans(t: dict[str, DataFrame]) -> DataFrame:
    return t["orders"].groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("first"))


q("j05_day_in_span", lambda t: _spans(t).select("o_custkey", F.explode(F.sequence("first", F.date_add("first", 13))).alias("day")).join(
    t["lineitem"].select(F.to_date("l_shipdate").alias("day")).distinct(), "day", "left_semi"), "o_custkey:i day",
  """SELECT o_custkey, d AS day FROM (SELECT o_custkey, min(o_orderdate::DATE) AS f FROM orders GROUP BY 1) JOIN (SELECT DISTINCT l_shipdate::DATE AS d FROM lineitem) ON d BETWEEN f AND f + 13""")
q("j06_range_after_event", lambda t: _spans(t).join(t["orders"].select("o_custkey", F.to_date("o_orderdate").alias("day")), "o_custkey")
  .where((F.col("day") > F.col("first")) & (F.col("day") <= F.date_add("first", 280))).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")), "o_custkey:i n:i",
  """SELECT o_custkey, count(*) AS n FROM orders JOIN (SELECT o_custkey, min(o_orderdate::DATE) AS f FROM orders GROUP BY 1) USING (o_custkey)
  WHERE o_orderdate::DATE > f AND o_orderdate::DATE <= f + 280 GROUP BY 1""")


def _weekly(t: dict[str, DataFrame]) -> DataFrame:
    week = F.to_date(F.date_trunc("week", "l_shipdate")).alias("week")
    return t["lineitem"].groupBy(week, "l_returnflag").agg(F.sum("l_quantity").cast("long").alias("qty"))


q("j07_computed_key", lambda t: _weekly(t).join(_weekly(t).select(F.date_add("week", 7).alias("week"), "l_returnflag", F.col("qty").alias("before")), ["week", "l_returnflag"], "left"),
  "week l_returnflag qty:i before:i", """SELECT a.*, b.qty AS before FROM c_wk7 a LEFT JOIN c_wk7 b ON b.week + 7 = a.week AND b.l_returnflag = a.l_returnflag""",
  extra={"c_wk7": "SELECT date_trunc('week', l_shipdate)::DATE AS week, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL"})
q("j08_null_test_in_condition", lambda t: t["part"].join(t["lineitem"].where(F.col("l_discount") == 0).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n")), F.col("p_partkey") == F.col("l_partkey"), "left"),
  "p_partkey:i n:i", "SELECT p_partkey, nullif(count(l_orderkey), 0) AS n FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND nullif(l_discount, 0) IS NULL GROUP BY 1")
q("j09_left_join_null_filtered", lambda t: t["customer"].join(t["orders"].where(F.col("o_totalprice") > 450000), F.col("c_custkey") == F.col("o_custkey")), "c_custkey:i o_orderkey:i",
  "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 450000 WHERE o_orderkey IS NOT NULL")
q("j10_semi_join", lambda t: t["customer"].join(t["orders"], F.col("c_custkey") == F.col("o_custkey"), "left_semi"), "c_custkey:i c_name",
  "SELECT c_custkey, c_name FROM customer JOIN (SELECT DISTINCT o_custkey FROM orders) ON o_custkey = c_custkey")
q("j11_anti_join", lambda t: t["customer"].join(t["orders"].where(F.col("o_orderstatus") == "P"), F.col("c_custkey") == F.col("o_custkey"), "left_anti"), "c_custkey:i",
  "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
q("j12_same_table_twice", lambda t: t["customer"].join(t["nation"].alias("a"), F.col("c_nationkey") == F.col("a.n_nationkey")).join(t["nation"].alias("b"), F.col("a.n_regionkey") == F.col("b.n_nationkey"))
  .select("c_custkey", F.col("a.n_name").alias("home"), F.col("b.n_name").alias("other")), "c_custkey:i home other",
  "SELECT c_custkey, a.n_name AS home, b.n_name AS other FROM customer JOIN nation a ON c_nationkey = a.n_nationkey JOIN nation b ON a.n_regionkey = b.n_nationkey")
q("j13_attach_group_count", lambda t: t["supplier"].join(t["supplier"].groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n")), "s_nationkey"), "s_suppkey:i n:i",
  "SELECT s_suppkey, n FROM supplier JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) USING (s_nationkey)")
q("j14_array_expansion", lambda t: t["part"].select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")), "p_partkey:i word", "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
q("j15_missing_keys_spread", lambda t: t["lineitem"].withColumn("code", spread_missing(F.when(F.col("l_returnflag") == "R", F.col("l_partkey")), "l_orderkey", "l_linenumber"))
  .join(t["part"].select(F.col("p_partkey").cast("string").alias("code"), "p_brand"), "code", "left").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")), "p_brand n:i",
  "SELECT p_brand, count(*) AS n FROM lineitem LEFT JOIN part ON p_partkey = CASE WHEN l_returnflag = 'R' THEN l_partkey END GROUP BY 1")

# --- aggregation --------------------------------------------------------------

q("a01_group_by", lambda t: t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(F.sum(money("l_quantity")).alias("qty"), mean_of(money("l_quantity")).alias("mean"), F.max("l_discount").alias("high"),
  F.min("l_tax").alias("low"), F.count(F.lit(1)).alias("n"), F.sum(lineval()).alias("revenue")), "l_returnflag l_linestatus qty:d mean:d high:d low:d n:i revenue:d",
  f"""SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,4)) AS qty, {o.mean('l_quantity::DECIMAL(18,4)')} AS mean, max(l_discount) AS high, min(l_tax) AS low, count(*) AS n, sum({_LV}) AS revenue FROM lineitem GROUP BY ALL""")
q("a02_conditional_sum", lambda t: t["lineitem"].groupBy("l_partkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", money("l_quantity")).otherwise(0)).alias("back")), "l_partkey:i back:d",
  "SELECT l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::DECIMAL(18,4) ELSE 0 END) AS back FROM lineitem GROUP BY 1")
q("a03_count_distinct", lambda t: t["lineitem"].groupBy("l_returnflag").agg(F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers")), "l_returnflag parts:i suppliers:i",
  "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem GROUP BY 1")
q("a04_countif", lambda t: t["orders"].groupBy("o_orderpriority").agg(F.count_if(F.col("o_orderstatus") == "F").alias("done")), "o_orderpriority done:i",
  "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS done FROM orders GROUP BY 1")


def _set_or_null(c: Column) -> Column:
    found = F.sort_array(F.collect_set(c))
    return F.when(F.size(found) > 0, found)


q("a05_array_agg_distinct", lambda t: t["lineitem"].groupBy("l_suppkey").agg(_set_or_null(F.when(F.col("l_quantity") >= 49, F.col("l_returnflag"))).alias("flags")), "l_suppkey:i flags:l",
  "SELECT l_suppkey, list_sort(list(DISTINCT l_returnflag) FILTER (WHERE l_quantity >= 49)) AS flags FROM lineitem GROUP BY 1")
q("a06_array_agg_ordered_structs", lambda t: t["lineitem"].groupBy("l_partkey", "l_returnflag").agg(F.sum("l_quantity").cast("long").alias("qty"))
  .groupBy("l_partkey").agg(F.sort_array(F.collect_list(F.struct("l_returnflag", "qty"))).alias("s"))
  .select("l_partkey", F.array_join(F.transform("s", lambda x: F.concat(x["l_returnflag"], F.lit("="), x["qty"].cast("string"))), ",").alias("flags")), "l_partkey:i flags",
  """SELECT l_partkey, string_agg(l_returnflag || '=' || qty, ',' ORDER BY l_returnflag) AS flags
  FROM (SELECT l_partkey, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL) GROUP BY 1""")
q("a07_standard_deviation", lambda t: t["lineitem"].groupBy("l_returnflag").agg(F.stddev_samp("l_quantity").alias("sample"), F.stddev_pop("l_quantity").alias("whole")), "l_returnflag sample:r whole:r",
  "SELECT l_returnflag, stddev_samp(l_quantity) AS sample, stddev_pop(l_quantity) AS whole FROM lineitem GROUP BY 1")
q("a08_group_by_expression", lambda t: t["orders"].groupBy(F.to_date(F.date_trunc("week", "o_orderdate")).alias("week")).agg(F.count(F.lit(1)).alias("n")), "week n:i",
  "SELECT date_trunc('week', o_orderdate)::DATE AS week, count(*) AS n FROM orders GROUP BY 1")
q("a09_group_by_as_distinct", lambda t: t["lineitem"].groupBy("l_partkey", "l_suppkey").agg(F.lit(1).alias("x")).drop("x"), "l_partkey:i l_suppkey:i", "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL")
q("a10_two_stage", lambda t: t["lineitem"].groupBy("l_partkey", "l_suppkey").agg(fixed(mean_of(money("l_quantity"))).alias("m")).groupBy("l_partkey").agg(mean_of("m").alias("mean")), "l_partkey:i mean:d",
  f"SELECT l_partkey, {o.mean('m')} AS mean FROM (SELECT l_partkey, l_suppkey, {o.fixed(o.mean('l_quantity::DECIMAL(18,4)'))} AS m FROM lineitem GROUP BY ALL) GROUP BY 1")
q("a11_max_over_bool", lambda t: t["lineitem"].groupBy("l_orderkey").agg(F.max(F.dayofweek("l_shipdate").isin(1, 7)).alias("weekend")), "l_orderkey:i weekend",
  "SELECT l_orderkey, max(dayofweek(l_shipdate) IN (0, 6)) AS weekend FROM lineitem GROUP BY 1")
q("a12_ratio_of_sums", lambda t: t["lineitem"].groupBy("l_partkey").agg(ratio(F.sum(F.when(F.col("l_returnflag") == "R", money("l_quantity")).otherwise(0)), F.sum(F.when(F.col("l_linestatus") == "F", money("l_quantity")).otherwise(0))).alias("share")),
  "l_partkey:i share:d", f"""SELECT l_partkey, {o.ratio("sum(CASE WHEN l_returnflag = 'R' THEN l_quantity::DECIMAL(18,4) ELSE 0 END)", "sum(CASE WHEN l_linestatus = 'F' THEN l_quantity::DECIMAL(18,4) ELSE 0 END)")} AS share FROM lineitem GROUP BY 1""")
q("a13_global_aggregate", lambda t: t["lineitem"].agg(F.count(F.lit(1)).alias("n"), F.sum(lineval()).alias("revenue")), "n:i revenue:d", f"SELECT count(*) AS n, sum({_LV}) AS revenue FROM lineitem")
q("a14_exact_quantile", lambda t: exact_quantile(t["orders"], ["o_orderpriority"], "o_totalprice", 0.95, "q95"), "o_orderpriority q95:d", "SELECT o_orderpriority, quantile_cont(o_totalprice, 0.95) AS q95 FROM orders GROUP BY 1")
q("a15_median", lambda t: exact_quantile(t["lineitem"], ["l_suppkey"], "l_extendedprice", 0.5, "mid"), "l_suppkey:i mid:d", "SELECT l_suppkey, median(l_extendedprice) AS mid FROM lineitem GROUP BY 1")
q("a16_null_counts", lambda t: t["customer"].join(t["orders"].groupBy("o_custkey").agg(F.max("o_totalprice").alias("top")), F.col("c_custkey") == F.col("o_custkey"), "left")
  .agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("c_name", "c_acctbal", "top")]), "c_name:i c_acctbal:i top:i",
  "SELECT count(*) FILTER (WHERE c_name IS NULL) AS c_name, count(*) FILTER (WHERE c_acctbal IS NULL) AS c_acctbal, count(*) FILTER (WHERE top IS NULL) AS top FROM customer LEFT JOIN (SELECT o_custkey, max(o_totalprice) AS top FROM orders GROUP BY 1) ON o_custkey = c_custkey")
q("a17_regression", lambda t: t["lineitem"].groupBy("l_suppkey").agg(F.regr_slope("l_extendedprice", "l_quantity").alias("slope"), F.regr_intercept("l_extendedprice", "l_quantity").alias("base"), F.regr_r2("l_extendedprice", "l_quantity").alias("r2")),
  "l_suppkey:i slope:r base:r r2:r", "SELECT l_suppkey, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS base, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem GROUP BY 1")
q("a18_frame_group_sums", lambda t: t["orders"].groupBy("o_custkey").agg(F.sum(money("o_totalprice")).alias("total"), mean_of(money("o_totalprice")).alias("mean")), "o_custkey:i total:d mean:d",
  f"SELECT o_custkey, sum(o_totalprice::DECIMAL(18,4)) AS total, {o.mean('o_totalprice::DECIMAL(18,4)')} AS mean FROM orders GROUP BY 1")

# --- windows ------------------------------------------------------------------

q("w01_first_row", lambda t: t["lineitem"].groupBy("l_partkey").agg(F.min(F.struct("l_suppkey", "l_orderkey")).alias("m")).select("l_partkey", F.col("m.l_suppkey").alias("l_suppkey")), "l_partkey:i l_suppkey:i",
  "SELECT l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey, l_orderkey) = 1")
q("w02_best_child", lambda t: t["part"].groupBy("p_brand").agg(F.min_by("p_partkey", F.struct((-F.col("p_retailprice")).alias("a"), F.col("p_partkey"))).alias("best")), "p_brand best:i",
  "SELECT p_brand, p_partkey AS best FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1")
q("w03_top_n", lambda t: t["orders"].withColumn("rn", F.row_number().over(Window.partitionBy("o_orderpriority").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where(F.col("rn") <= 20), "o_orderpriority rn:i o_orderkey:i",
  "SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders QUALIFY rn <= 20")
q("w04_first_last_date", lambda t: t["lineitem"].groupBy("l_partkey").agg(F.min(F.to_date("l_shipdate")).alias("a"), F.max(F.to_date("l_shipdate")).alias("b")), "l_partkey:i a b",
  """SELECT DISTINCT l_partkey, first_value(l_shipdate::DATE) OVER (PARTITION BY l_partkey ORDER BY l_shipdate) AS a, first_value(l_shipdate::DATE) OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) AS b FROM lineitem""")
q("w05_cume_dist", lambda t: with_cume_dist(t["orders"], ["o_orderstatus"], "o_totalprice", "cd"), "o_orderkey:i cd:d", "SELECT o_orderkey, cume_dist() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice) AS cd FROM orders")
q("w06_percent_rank", lambda t: with_percent_rank(t["lineitem"], ["l_returnflag"], "l_quantity", "_pr").select("l_returnflag", "l_quantity", F.round("_pr", 2).alias("pr")), "l_returnflag l_quantity:d pr:d",
  "SELECT l_returnflag, l_quantity, round(percent_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity), 2) AS pr FROM lineitem")
q("w07_lag_ratio", lambda t: counterfactual.change_index(_weekly(t).withColumnRenamed("week", "date"), ["l_returnflag"], "qty", "pct"), "date l_returnflag qty:i pct:d",
  f"""SELECT date, l_returnflag, qty, CASE WHEN row_number() OVER w = 1 THEN 1 ELSE {o.ratio('qty', 'lag(qty) OVER w')} END AS pct
  FROM (SELECT date_trunc('week', l_shipdate)::DATE AS date, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY l_returnflag ORDER BY date)""")
q("w08_lag_flag", lambda t: _weekly(t).withColumn("rose", F.coalesce(F.lag("qty").over(Window.partitionBy("l_returnflag").orderBy("week")) < F.col("qty"), F.lit(False))), "week l_returnflag qty:i rose",
  """SELECT *, coalesce(lag(qty) OVER (PARTITION BY l_returnflag ORDER BY week) < qty, false) AS rose
  FROM (SELECT date_trunc('week', l_shipdate)::DATE AS week, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL)""")
q("w09_rolling_mean", lambda t: forecast.smoothed(_weekly(t).select(F.col("l_returnflag").alias("sku_root_id"), F.lit("qty").alias("measure"), F.col("week").alias("date"), dbl("qty").alias("hist"), F.lit(0.0).alias("shift"))),
  "sku_root_id date smooth:d", """SELECT sku_root_id, date, smooth FROM (SELECT l_returnflag AS sku_root_id, week AS date, (sum(qty) OVER f)::DOUBLE / 4 AS smooth, count(*) OVER f AS c
  FROM (SELECT date_trunc('week', l_shipdate)::DATE AS week, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL)
  WINDOW f AS (PARTITION BY l_returnflag ORDER BY week ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)) WHERE c = 4""")


def _carry(t: dict[str, DataFrame]) -> DataFrame:
    """A decayed stock per flag, rounded each week; a key holds the calendar's weeks only."""

    def step(acc: Column, row: Column) -> dict[str, Column]:
        value = cents(F.coalesce(acc["s"] * 0.7, F.lit(0.0)) + row["v"])
        return {"s": value, "carried": value}

    rows = _weekly(t).withColumn("v", dbl("qty") / 1000)
    return fold_rows(rows, ["l_returnflag"], "week", ["v"], {"s": "double"}, step, {"carried": "double"})


q("w10_stepwise_carry", _carry, "l_returnflag week carried:d", "SELECT l_returnflag, week, carried FROM c_carry", recursive={"c_carry"}, extra={
    "c_cin": """SELECT l_returnflag, week, qty::DOUBLE / 1000 AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY week) AS i
      FROM (SELECT date_trunc('week', l_shipdate)::DATE AS week, l_returnflag, sum(l_quantity)::BIGINT AS qty FROM lineitem GROUP BY ALL)""",
    "c_carry": f"""SELECT l_returnflag, week, i, {o.cents('0 + v')} AS carried FROM c_cin WHERE i = 1
      UNION ALL SELECT b.l_returnflag, b.week, b.i, {o.cents('a.carried * 0.7::DOUBLE + b.v')} FROM c_carry a JOIN c_cin b ON b.l_returnflag = a.l_returnflag AND b.i = a.i + 1"""})

# --- order, limit, set operations ---------------------------------------------

q("o01_order_by", lambda t: t["customer"].orderBy("c_name"), "c_custkey:i c_name", "SELECT c_custkey, c_name FROM customer ORDER BY c_name")
q("o02_mixed_order", lambda t: t["supplier"].orderBy(F.col("s_nationkey").asc(), F.col("s_acctbal").desc()), "s_suppkey:i s_acctbal:d", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_nationkey, s_acctbal DESC")
q("o03_best_row", lambda t: t["orders"].groupBy("o_custkey").agg(F.min_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("cheapest")), "o_custkey:i cheapest:i",
  "SELECT o_custkey, o_orderkey AS cheapest FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) = 1")
q("o04_preview", lambda t: t["part"].orderBy("p_partkey").limit(5), "p_partkey:i p_name", "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 5")
q("u01_union_distinct", lambda t: t["customer"].select("c_nationkey").unionByName(t["supplier"].select(F.col("s_nationkey").alias("c_nationkey"))).distinct(), "c_nationkey:i", "SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
q("u02_union_all_two_levels", lambda t: t["part"].select(F.explode(F.array("p_brand", "p_type")).alias("node"), "p_retailprice").groupBy("node").agg(F.sum(money("p_retailprice")).alias("total")), "node total:d",
  "SELECT node, sum(p_retailprice::DECIMAL(18,4)) AS total FROM (SELECT p_brand AS node, p_retailprice FROM part UNION ALL SELECT p_type, p_retailprice FROM part) GROUP BY 1")
q("u03_row_append", lambda t: t["customer"].select(F.col("c_name").alias("name"), F.lit("c").alias("kind")).unionByName(t["supplier"].select(F.col("s_name").alias("name"), F.lit("s").alias("kind"))), "name kind",
  "SELECT c_name AS name, 'c' AS kind FROM customer UNION ALL SELECT s_name, 's' FROM supplier")

# --- scalar functions ---------------------------------------------------------

add("f_date_build", lambda spark, sf: calendar_between(spark, dt.date(2017, 10, 2), dt.date(2019, 10, 6)).join(
    read_tables(spark, sf)["orders"].select(F.to_date(F.date_format("o_orderdate", "dd/MM/yyyy"), "dd/MM/yyyy").alias("o")).distinct(), F.col("o") == F.add_months("date", -228), "left").select(
    "date", "year_sem", F.col("o").alias("ordered")), "date year_sem ordered",
    """SELECT date, year(date) || 'SEM' || lpad(week(date)::VARCHAR, 2, '0') AS year_sem, o AS ordered FROM (SELECT unnest(generate_series(TIMESTAMP '2017-10-02', TIMESTAMP '2019-10-06', INTERVAL 1 DAY))::DATE AS date)
    LEFT JOIN (SELECT DISTINCT strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::DATE AS o FROM orders) ON o = (date - INTERVAL 228 MONTH)::DATE""")
q("f_date_part", lambda t: t["orders"].select("o_orderkey", F.dayofweek("o_orderdate").alias("dow"), F.weekofyear("o_orderdate").alias("wk"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("qt"), F.month("o_orderdate").alias("m"), F.dayofyear("o_orderdate").alias("doy")),
  "o_orderkey:i dow:i wk:i y:i qt:i m:i doy:i", "SELECT o_orderkey, dayofweek(o_orderdate) + 1 AS dow, week(o_orderdate) AS wk, year(o_orderdate) AS y, quarter(o_orderdate) AS qt, month(o_orderdate) AS m, dayofyear(o_orderdate) AS doy FROM orders")
q("f_date_math", lambda t: t["orders"].select("o_orderkey", F.to_date(F.date_trunc("week", "o_orderdate")).alias("monday"), F.date_add(F.to_date("o_orderdate"), 28).alias("later"), F.datediff(F.lit(dt.date(2002, 1, 1)), "o_orderdate").alias("days"), (2002 - F.year("o_orderdate")).alias("years")),
  "o_orderkey:i monday later days:i years:i", "SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE AS monday, o_orderdate::DATE + 28 AS later, DATE '2002-01-01' - o_orderdate::DATE AS days, 2002 - year(o_orderdate) AS years FROM orders")
q("f_date_format", lambda t: t["orders"].select("o_orderkey", F.date_format("o_orderdate", "EEEE").alias("day"), F.date_format("o_orderdate", "yyyyMMdd HH:mm").alias("stamp")), "o_orderkey:i day stamp",
  "SELECT o_orderkey, dayname(o_orderdate) AS day, strftime(o_orderdate, '%Y%m%d %H:%M') AS stamp FROM orders")
q("f_clock_as_of", lambda t: t["orders"].select("o_orderkey", F.datediff(F.lit(dt.date(2019, 12, 1)), "o_orderdate").alias("age")), "o_orderkey:i age:i", "SELECT o_orderkey, DATE '2019-12-01' - o_orderdate::DATE AS age FROM orders")
q("f_strings", lambda t: t["part"].select("p_partkey", F.concat("p_brand", F.lit("-"), "p_type").alias("code"), F.replace("p_brand", F.lit("#"), F.lit(",")).alias("comma"), F.format_string("%02d", "p_size").alias("two"),
  F.regexp_replace("p_brand", r"\d", "X").alias("masked"), F.get(F.split("p_name", " "), F.lit(1)).alias("second"), F.get(F.split("p_name", " "), F.lit(9)).alias("tenth")), "p_partkey:i code comma two masked second tenth",
  r"""SELECT p_partkey, p_brand || '-' || p_type AS code, replace(p_brand, '#', ',') AS comma, lpad(p_size::VARCHAR, 2, '0') AS two, regexp_replace(p_brand, '\d', 'X', 'g') AS masked,
  string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[10] AS tenth FROM part""")
q("f_conditional", lambda t: t["orders"].select("o_orderkey", F.coalesce(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")), F.lit(-999.0)).alias("v")), "o_orderkey:i v:d",
  "SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, -999) AS v FROM orders")
q("f_safe_math", lambda t: t["lineitem"].select("l_orderkey", "l_linenumber", ratio("l_tax", "l_discount").alias("r"), F.replace("l_returnflag", F.lit("N"), F.lit("7")).try_cast("int").alias("n")), "l_orderkey:i l_linenumber:i r:d n:i",
  f"SELECT l_orderkey, l_linenumber, {o.ratio('l_tax', 'l_discount')} AS r, try_cast(replace(l_returnflag, 'N', '7') AS INT) AS n FROM lineitem")
q("f_rounding", lambda t: t["part"].select("p_partkey", depth_step(F.col("p_size") / 4).alias("step"), cents(F.col("p_retailprice") / 8).alias("even"), F.abs(F.col("p_size") - 25).alias("gap"), F.sqrt("p_size").alias("root")),
  "p_partkey:i step:d even:d gap:i root:r", f"SELECT p_partkey, {o.step('p_size::DOUBLE / 4')} AS step, {o.cents('p_retailprice / 8')} AS even, abs(p_size - 25) AS gap, sqrt(p_size) AS root FROM part")
q("f_cast_labels", lambda t: t["part"].select("p_partkey", percent_off(depth_step(F.col("p_size") / 4)).alias("label"), plain(F.col("p_retailprice").cast("decimal(10,2)")).alias("price")), "p_partkey:i label price",
  f"SELECT p_partkey, {o.plain(o.step('p_size::DOUBLE / 4'))} || '% off' AS label, {o.plain('p_retailprice::DECIMAL(10,2)')} AS price FROM part")
q("f_arrays_structs", lambda t: t["part"].select("p_partkey", F.struct("p_size", "p_brand").alias("s"), F.split("p_name", " ").alias("w")).select("p_partkey", F.col("s.p_brand").alias("brand"), F.size("w").alias("words"), "w"), "p_partkey:i brand words:i w:l",
  "SELECT p_partkey, {'p_size': p_size, 'p_brand': p_brand}.p_brand AS brand, len(string_split(p_name, ' ')) AS words, string_split(p_name, ' ') AS w FROM part")
q("f_row_as_json", lambda t: t["customer"].select("c_custkey", F.to_json(F.struct("c_custkey", "c_name")).alias("js")), "c_custkey:i js", "SELECT c_custkey, to_json({'c_custkey': c_custkey, 'c_name': c_name})::VARCHAR AS js FROM customer")

# --- sources and sinks: text written from the tables, read back ---------------

_PART = T.StructType([T.StructField("P_PARTKEY", T.LongType()), T.StructField("P_NAME", T.StringType()), T.StructField("P_BRAND", T.StringType()), T.StructField("P_SIZE", T.IntegerType()), T.StructField("P_RETAILPRICE", T.DecimalType(10, 2))])
_PCOLS = ["p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"]


def _part_text(spark: SparkSession, sf: str, name: str, header: bool = False, extra: DataFrame | None = None) -> str:
    """The part table as a pipe-delimited extract, made once per session."""
    mart = open_mart(spark, sf)
    path = f"{mart.space.folder}/{name}"
    if name not in mart._made:
        rows = read_tables(spark, sf)["part"].select(*[F.col(c).cast("decimal(10,2)").cast("string").alias(c) if c == "p_retailprice" else F.col(c).cast("string").alias(c) for c in _PCOLS])
        text = rows.select(F.concat_ws("|", *_PCOLS).alias("value"))
        if extra is not None:
            text = text.unionByName(extra).repartition(4)  # every file holds a share of the odd rows
        if header:
            first = spark.range(1).select(F.lit("|".join(c.upper() if i % 2 else c for i, c in enumerate(_PCOLS))).alias("value"))
            text = first.unionByName(text)
        text.write.mode("overwrite").option("compression", "gzip").text(path)
        mart._made[name] = text
    return path


def _reader_frame(spark: SparkSession, path: str) -> DataFrame:
    return extracts.read_extract(spark, path, _PART).toDF(*_PCOLS)


_PSPEC = "p_partkey:i p_name p_brand p_size:i p_retailprice:d"
add("s01_load_extract", lambda spark, sf: _reader_frame(spark, _part_text(spark, sf, "20191128_part_plain")), _PSPEC, "SELECT * FROM part")
add("s02_header_detection", lambda spark, sf: _reader_frame(spark, _part_text(spark, sf, "20191128_part_header", header=True)), _PSPEC, "SELECT * FROM part")
q("s03_route_files", lambda t: t["orders"].select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.when(F.col("o_orderkey") % 2 == 0, "_M_ARTICULOS_").otherwise("_M_OTHER_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit(".csv")).alias("f"))
  .select("o_orderkey", extracts.table_of(F.col("f")).alias("target")), "o_orderkey:i target", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN '11_M_ARTICULOS' END AS target FROM orders")
q("s04_batch_stamp", lambda t: extracts.stamp(t["orders"].select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_LINEAS.csv")).alias("file_name"))), "o_orderkey:i TIMESTAMP:i",
  "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d')::BIGINT AS TIMESTAMP FROM orders")


def _with_bad(spark: SparkSession, sf: str) -> str:
    part = read_tables(spark, sf)["part"]
    bad = part.where(F.col("p_size") == 50).select(F.concat(F.col("p_partkey").cast("string"), F.lit("|a|b|c|1|too|long")).alias("value"))
    short = part.where(F.col("p_size") == 49).select(F.concat(F.col("p_partkey").cast("string"), F.lit("|short")).alias("value"))
    return _part_text(spark, sf, "20191128_part_bad", extra=bad.unionByName(short))


add("s05_load_audit", lambda spark, sf: extracts.audit(extracts.raw_rows(spark, _with_bad(spark, sf), _PART)).agg(*[F.sum(c).alias(c) for c in ("source_rows", "loaded_rows", "rejected_rows")]),
    "source_rows:i loaded_rows:i rejected_rows:i",
    "SELECT count(*) + count(*) FILTER (WHERE p_size IN (49, 50)) AS source_rows, count(*) + count(*) FILTER (WHERE p_size = 49) AS loaded_rows, count(*) FILTER (WHERE p_size = 50) AS rejected_rows FROM part")


def _profile_sql(table: str, cols: dict[str, str]) -> str:
    parts = []
    for c, e in cols.items():
        n = f"try_cast({e}::VARCHAR AS DECIMAL(18,6))"
        parts.append(f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, count(*) FILTER (WHERE {c} IS NULL) AS no_nulls, count({c}) AS no_non_nulls,
        floor({o.mean(n)} * 10 + 0.5) / 10 AS avg_value, max({n}) AS max_value, min({n}) AS min_value FROM {table}""")
    return " UNION ALL ".join(parts)


_PROF = "column_name distinct_values:i no_nulls:i no_non_nulls:i avg_value:d max_value:d min_value:d"
q("s06_profile_part", lambda t: extracts.column_profile(t["part"]), _PROF, _profile_sql("part", {c: c for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")}))
q("s06_profile_customer", lambda t: extracts.column_profile(t["customer"]), _PROF, _profile_sql("customer", {c: c for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")}))
q("s07_pad_rename_dedupe", lambda t: extracts.fit_columns(t["lineitem"].select("l_partkey", "l_returnflag"), ["part", "flag", "note", "extra"]), "part:i flag note extra",
  "SELECT DISTINCT l_partkey AS part, l_returnflag AS flag, NULL::VARCHAR AS note, NULL::VARCHAR AS extra FROM lineitem")
add("s08_drop_short_lines", lambda spark, sf: extracts.drop_short_lines(spark.read.text(_with_bad(spark, sf)), 5).agg(F.count(F.lit(1)).alias("kept")), "kept:i",
    "SELECT count(*) + count(*) FILTER (WHERE p_size = 50) AS kept FROM part")


def _stored(spark: SparkSession, sf: str, name: str, write) -> DataFrame:
    mart = open_mart(spark, sf)
    path = f"{mart.space.folder}/{name}"
    if name not in mart._made:
        write(read_tables(spark, sf), path)
        mart._made[name] = spark.read.parquet(path)
    return mart._made[name]


def _write_partitioned(t: dict[str, DataFrame], path: str) -> None:
    tables.write_table(t["orders"].withColumn("o_year", F.year("o_orderdate")), path, ["o_year"], ["o_custkey"])


def _write_slices(t: dict[str, DataFrame], path: str) -> None:
    rows = t["orders"].select("o_orderkey", "o_orderstatus", F.lit(1).alias("version"))
    tables.write_table(rows, path, ["o_orderstatus"])
    tables.write_table(rows.where(F.col("o_orderstatus") == "F").withColumn("version", F.lit(2)), path, ["o_orderstatus"], slices_only=True)


add("s09_partitioned_table", lambda spark, sf: _stored(spark, sf, "s09", _write_partitioned), "o_orderkey:i o_custkey:i o_year:i",
    "SELECT o_orderkey, o_custkey, year(o_orderdate) AS o_year FROM orders")
add("s10_replace_by_slice", lambda spark, sf: _stored(spark, sf, "s10", _write_slices), "o_orderkey:i o_orderstatus version:i",
    "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS version FROM orders")


def _published(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions by status: all, one slice replaced, and one whose job ended before its manifest."""
    mart = open_mart(spark, sf)
    root = f"{mart.space.folder}/s10_published"
    if "s10_published" not in mart._made:
        rows = read_tables(spark, sf)["orders"].select("o_orderkey", "o_orderstatus", F.lit(1).alias("version"))
        publishing.publish(rows, root, "o_orderstatus")
        open_rows = rows.where(F.col("o_orderstatus") == "O")
        publishing.publish(open_rows.where(F.col("o_orderkey") % 2 == 0).withColumn("version", F.lit(2)), root, "o_orderstatus", keep_others=True)
        publishing.write_rows(open_rows.withColumn("version", F.lit(3)), root, "o_orderstatus")
        mart._made["s10_published"] = publishing.read_published(spark, root)
    return mart._made["s10_published"]


add("s10_published_slices", _published, "o_orderkey:i o_orderstatus version:i",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN 2 ELSE 1 END AS version FROM orders
    WHERE o_orderstatus <> 'O' OR o_orderkey % 2 = 0""")


def _write_republished(t: dict[str, DataFrame], path: str) -> None:
    spark = t["orders"].sparkSession
    t["orders"].write.mode("overwrite").parquet(f"{path}_source")
    tables.republish(spark, f"{path}_source", path, {"o_totalprice": "decimal(38,9)", "o_orderkey": "string"})


add("s11_republish_with_casts", lambda spark, sf: _stored(spark, sf, "s11", _write_republished), "o_orderkey o_totalprice:d", "SELECT o_orderkey::VARCHAR AS o_orderkey, o_totalprice FROM orders")


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    mart = open_mart(spark, sf)
    path = f"{mart.space.folder}/s12"
    rows = read_tables(spark, sf)["customer"].select("c_custkey", "c_name", "c_acctbal")
    if "s12" not in mart._made:
        extracts.write_model_csv(rows, path)
        mart._made["s12"] = extracts.read_model_csv(spark, path, rows.schema)
    return mart._made["s12"]


add("s12_model_csv", _csv_round_trip, "c_custkey:i c_name c_acctbal:d", "SELECT c_custkey, c_name, c_acctbal FROM customer")
q("s13_parameterised_scan", lambda t: t["part"].where((F.col("p_brand") == F.lit("Brand#7")) & (F.col("p_type") == F.lit("ECONOMY"))), "p_partkey:i", "SELECT p_partkey FROM part WHERE p_brand = 'Brand#7' AND p_type = 'ECONOMY'")


def _landed(spark: SparkSession, sf: str) -> DataFrame:
    mart = open_mart(spark, sf)
    target = f"{mart.space.folder}/s14"
    if "s14" not in mart._made:
        source = _with_bad(spark, sf)
        landing.land(spark, source, target, f"{target}_state", _PART)
        mart._made["s14"] = landing.landed(spark, target)
    return mart._made["s14"].toDF(*_PCOLS, "file_name", "TIMESTAMP", "batch")


add("s14_incremental_landing", _landed, _PSPEC,
    "SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part UNION ALL SELECT p_partkey, 'short', NULL, NULL, NULL FROM part WHERE p_size = 49")

