"""The mart's tables once more as SQL, for comparison on another engine."""

from __future__ import annotations

import re

from ..operators.sales import COMPONENTS, MEASURES, OFFER_MEASURES, OTHER_DISCOUNTS, PLAIN_MEASURES

_M = "DECIMAL(18,4)"
_R = "DECIMAL(18,6)"


def ratio(a: str, b: str) -> str:
    return f"(({a})::DOUBLE / nullif(({b})::DOUBLE, 0))"


def fixed(x: str) -> str:
    return f"(floor(({x})::DOUBLE * 1000000 + 0.5)::DECIMAL(18,0) * 0.000001)::{_R}"


def mean(x: str, where: str = "") -> str:
    tail = f" FILTER (WHERE {where})" if where else ""
    return f"((sum({x}){tail})::DOUBLE / nullif(count({x}){tail}, 0))"


def cents(x: str) -> str:
    return f"(round_even(({x}) * 100, 0) / 100)"


def plain(x: str) -> str:
    return rf"regexp_replace(regexp_replace(({x})::VARCHAR, '(\.\d*?)0+$', '\1'), '\.$', '')"


def step(p: str) -> str:
    return f"(CASE WHEN ({p}) > 5 THEN round(({p}) / 5) * 5 WHEN ({p}) >= 0 THEN round(({p}) / 2.5::DOUBLE) * 2.5::DOUBLE END)"


def week(d: str) -> str:
    return f"date_trunc('week', {d})::DATE"


def csum(names: list[str], kind: str = _M) -> str:
    return ", ".join(f"sum({n})::{kind} AS {n}" for n in names)


# --- raw extracts -----------------------------------------------------------

_AREA = "CASE WHEN bn % 3 = 0 THEN '0' ELSE '1' END"
_LVL = {
    1: ("A", "AREA_", _AREA),
    2: ("S", "SECTION_", "(bn % 3)::VARCHAR"),
    3: ("C", "CATEGORY_", "(bn % 3)::VARCHAR"),
    4: ("B", "SUBCATEGORY_", "(bn % 6)::VARCHAR"),
    5: ("G", "SEGMENT_", "(bn % 12)::VARCHAR"),
}


def _code(n: int) -> str:
    return f"'{_LVL[n][0]}' || ({_LVL[n][2]})"


def _label(n: int) -> str:
    return f"'{_LVL[n][1]}' || ({_LVL[n][2]})"


def _yn(d: int) -> str:
    return f"CASE WHEN p_size % {d} = 0 THEN 'S' ELSE 'N' END"


CTE: dict[str, str] = {}

CTE["c_part"] = """SELECT p_partkey, p_name, p_brand, p_type, p_size, substring(p_brand, 7)::INT AS bn,
  p_retailprice::DECIMAL(10,2) AS std FROM part"""

CTE["c_sold"] = """SELECT l.*, p.*, s_nationkey, l_shipdate::DATE AS d, year(l_shipdate) AS y, month(l_shipdate) AS m,
  (bn + s_nationkey + month(l_shipdate)) % 4 AS phase
  FROM lineitem l JOIN c_part p ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""

CTE["c_calendar"] = """SELECT unnest(generate_series(date_trunc('week', min(l_shipdate))::TIMESTAMP,
  date_trunc('week', max(l_shipdate)) + INTERVAL 6 DAY, INTERVAL 1 DAY))::DATE AS date FROM lineitem"""

CTE["c_sku"] = f"""SELECT p_partkey::VARCHAR AS sku_id, p_brand AS sku_root_id, p_name AS description, p_type AS type,
  {', '.join(f"{_code(n)} AS {c}_id, {_label(n)} AS {c}" for n, c in enumerate(['area', 'section', 'category', 'subcategory', 'segment'], 1))},
  CASE WHEN bn % 5 = 0 THEN 'OWN LABEL' ELSE p_brand END AS brand_name,
  CASE WHEN bn % 5 = 0 THEN CASE bn % 3 WHEN 0 THEN 'Premium' WHEN 1 THEN 'Normal' ELSE 'Non premium' END END AS own_brand_label,
  CASE WHEN bn % 5 = 0 THEN 'Y' ELSE 'N' END AS own_brand_flag,
  {_yn(2)} AS flag_healthy, CASE WHEN p_size > 40 THEN 'WOW' END AS wow_flag, {_yn(3)} AS innovation_flag,
  {_yn(4)} AS tourism_flag, {_yn(5)} AS local_flag, {_yn(7)} AS regional_flag,
  CASE WHEN bn % 2 = 0 THEN 'S' ELSE 'N' END AS wealthy_range_flag,
  'VENDOR_' || (p_partkey % 50) AS vendor_name,
  CASE WHEN p_size % 9 <> 0 THEN (std * 0.6)::DECIMAL(10,2) END AS cost_per_unit,
  least(lpad(((p_partkey * 7) % 11)::VARCHAR, 2, '0'), lpad(((p_partkey * 7 + 5) % 11)::VARCHAR, 2, '0')) AS sales_loc_code
  FROM c_part"""

CTE["c_store"] = """SELECT n_nationkey::VARCHAR AS store_id, n_name AS name, r_name AS store_geography_region,
  CASE n_nationkey % 7 WHEN 0 THEN 'HIPERMERCADOS' WHEN 1 THEN 'SUPERMERCADOS' WHEN 2 THEN 'GASOLINERAS'
    WHEN 3 THEN 'COMERCIO ELECTRONICO' WHEN 4 THEN 'OTROS NEGOCIOS' WHEN 5 THEN 'PLATAFORMAS' ELSE '69' END AS store_type1,
  coalesce(m2, 0)::DECIMAL(12,2) AS size_m2, 'COMPANY_' || (n_nationkey % 4) AS business_area
  FROM nation JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN (SELECT s_nationkey, max(s_acctbal::DECIMAL(12,2)) AS m2 FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey"""

_QS = "CASE WHEN m % 3 = 2 THEN 8 ELSE 12 END"
_QE = "CASE m % 3 WHEN 0 THEN 18 WHEN 1 THEN 25 ELSE 28 END"

CTE["c_campaign"] = f"""SELECT kind || y || lpad(m::VARCHAR, 2, '0') AS promo_id, y::BIGINT AS promo_year,
  'CAMPAIGN ' || kind || y || lpad(m::VARCHAR, 2, '0') AS name, CASE kind WHEN 'P' THEN '1' ELSE '2' END AS type,
  make_date(y, m, CASE kind WHEN 'P' THEN 5 ELSE {_QS} END) AS start_date,
  make_date(y, m, CASE kind WHEN 'P' THEN 18 ELSE {_QE} END) AS end_date,
  'C1' AS class, (m % 2)::VARCHAR AS customer_profile_type, 'Oferta corporativa' AS marketing_type
  FROM (SELECT DISTINCT year(l_shipdate) AS y, month(l_shipdate) AS m FROM lineitem), (VALUES ('P'), ('Q')) k(kind)
  WHERE make_date(y, m, CASE kind WHEN 'P' THEN 5 ELSE {_QS} END) >= (SELECT min(date) FROM c_calendar)
    AND make_date(y, m, CASE kind WHEN 'P' THEN 18 ELSE {_QE} END) <= (SELECT max(date) FROM c_calendar)"""

CTE["c_days"] = """SELECT promo_id, promo_year, date FROM c_campaign JOIN c_calendar ON date BETWEEN start_date AND end_date"""

CTE["c_rawoffer"] = """SELECT DISTINCT p_partkey, p_size, std, s_nationkey, y, m, phase,
  CASE p_partkey % 5 WHEN 0 THEN '10' WHEN 1 THEN '20' WHEN 2 THEN '30' WHEN 3 THEN '40' ELSE '60' END AS mech,
  kind || y || lpad(m::VARCHAR, 2, '0') AS promo_id
  FROM c_sold, (VALUES ('P'), ('Q')) k(kind)
  WHERE (kind = 'P' AND phase IN (0, 1)) OR (kind = 'Q' AND phase IN (0, 3))"""

_SH = "(CASE WHEN mech = '60' THEN p_size % 8 END)"
_P2 = f"(CASE {_SH} WHEN 4 THEN round(std * 0.8, 2) WHEN 5 THEN round(std * 0.96, 2) WHEN 6 THEN round(std * 0.9, 2) WHEN 7 THEN round(std * 0.9, 2) END)::DECIMAL(10,2)"
_PCT = f"(CASE {_SH} WHEN 0 THEN 12::DOUBLE WHEN 1 THEN 4::DOUBLE WHEN 2 THEN 23::DOUBLE WHEN 3 THEN 3::DOUBLE WHEN 4 THEN 100 * (1 - {ratio(_P2, 'std')}) WHEN 5 THEN 100 * (1 - {ratio(_P2, 'std')}) END)"
_N = "(CASE p_size % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 4 END)::DECIMAL(6,2)"
_MM = "(CASE p_size % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 1.5 ELSE 3 END)::DECIMAL(6,2)"
_DESC = ("CASE mech WHEN '10' THEN 'OFFER PRICE-PRODUCT' WHEN '20' THEN 'OFFER N * M CONSTANT' "
         "WHEN '30' THEN 'OFFER N * H heterogenous SAME PVP' WHEN '40' THEN 'OFFER N * H heterogenous GIFT' "
         "ELSE 'N OFFER BETTER THAN M' END")

CTE["c_offer"] = f"""SELECT r.promo_id, c.promo_year, p_partkey::VARCHAR AS sku_id, s.sku_root_id, s_nationkey::VARCHAR AS store_id,
  mech AS promo_mechanic, {_DESC} AS promo_mechanic_description,
  CASE WHEN {_SH} IN (2,3,4,5) THEN std WHEN p_size % 13 <> 0 THEN std END AS std_price,
  CASE WHEN mech = '10' THEN round((std * (100 - 5 * (p_size % 7)))::DECIMAL(18,2) * 0.01, 2)::DECIMAL(18,4) END AS discounted_price_promo,
  CASE WHEN mech IN ('20','30','40') THEN {fixed(f"100 * (1 - {ratio(_MM, _N)})")} WHEN mech = '60' THEN {fixed(step(_PCT))} END AS discount_depth_rank,
  CASE WHEN mech IN ('20','30','40') THEN 'buy ' || {plain(_N)} || ' pay ' || {plain(_MM)}
    WHEN {_SH} = 6 THEN 'buy 1 at ' || {plain('std')} || ', buy 2 at ' || {plain(_P2)}
    WHEN {_SH} = 7 THEN 'buy 1 at ' || {plain('std')} || ', buy 2 at ' || {plain(_P2)} || ', buy 3 at ' || {plain('round(std * 0.85, 2)::DECIMAL(10,2)')}
    WHEN mech = '60' THEN {plain(step(_PCT))} || '% off' END AS discount_depth,
  (p_partkey % 3 = 0)::INT AS leaflet_cover, (p_partkey % 7 = 0)::INT AS leaflet_priv_space, (p_partkey % 11 = 0)::INT AS brochure,
  (p_partkey % 3 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0)::INT AS in_leaflet_flag,
  (p_partkey % 2 = 0)::INT AS in_gondola_flag,
  (p_partkey % 2 = 0 AND (p_partkey % 3 = 0 OR p_partkey % 7 = 0 OR p_partkey % 11 = 0))::INT AS in_both_leaflet_gondola_flag
  FROM c_rawoffer r JOIN c_campaign c ON c.promo_id = r.promo_id JOIN c_sku s ON s.sku_id = p_partkey::VARCHAR
  JOIN c_store st ON st.store_id = s_nationkey::VARCHAR"""

# --- sales ------------------------------------------------------------------

_HHMM = "lpad((l_orderkey % 12 + 8)::VARCHAR, 2, '0') || ':' || lpad((l_orderkey % 4 * 15)::VARCHAR, 2, '0')"
_DIA = "strftime(d, '%Y%m%d')"

CTE["c_ticket"] = f"""SELECT s.*, o_custkey, o_orderpriority,
  s_nationkey || '_' || {_DIA} || ' ' || {_HHMM} || '_' || (l_suppkey % 8 + 1) || '_' || l_orderkey || '_' || {_DIA} AS transaction_id,
  {_HHMM} || ':00' AS time
  FROM c_sold s JOIN orders ON l_orderkey = o_orderkey"""

CTE["c_line"] = f"""SELECT transaction_id, p_partkey::VARCHAR AS sku_id, s_nationkey::VARCHAR AS store_id, o_custkey::VARCHAR AS customer_id,
  d AS date, time, l_returnflag = 'R' AS tariff, l_linestatus, round(l_tax * 100)::INT AS tax,
  (l_quantity::DECIMAL(8,0) * std)::{_M} AS lst, l_discount::DECIMAL(6,2) AS disc, l_quantity::{_M} AS qty,
  CASE WHEN l_linenumber <= 5 THEN
    CASE WHEN phase IN (0, 1) AND day(d) BETWEEN 5 AND 18 THEN 'P'
         WHEN phase IN (0, 3) AND day(d) BETWEEN {_QS} AND {_QE} THEN 'Q' END END AS kind, y, m
  FROM c_ticket"""

CTE["c_lineparts"] = f"""SELECT l.*, s.sku_root_id, kind || y || lpad(m::VARCHAR, 2, '0') AS code,
  (lst * (1 - disc))::{_M} AS net, (lst * (0.4 - disc))::{_M} AS mar,
  (CASE WHEN l_linestatus = 'F' THEN lst * 1.5 ELSE lst * (1 - disc) END)::{_M} AS raised,
  (CASE tax WHEN 8 THEN -1 WHEN 7 THEN -lst * disc WHEN 6 THEN 1 ELSE 0 END)::{_M} AS oth,
  (CASE tax WHEN 6 THEN 0 WHEN 8 THEN -1 WHEN 7 THEN -lst * disc ELSE 0 END)::{_M} AS oth_ex
  FROM c_line l JOIN c_sku s USING (sku_id)"""

CTE["c_lin"] = f"""SELECT p.transaction_id, p.sku_id, p.sku_root_id, p.store_id, p.customer_id, p.date, p.time,
  o.promo_id, o.promo_year, p.lst AS IMP_PVP_TARIFA,
  CASE WHEN tariff THEN raised ELSE 0 END::{_M} AS sale_std, CASE WHEN tariff THEN 0 ELSE net END::{_M} AS sale_off,
  CASE WHEN tariff THEN qty ELSE 0 END::{_M} AS qty_std, CASE WHEN tariff THEN 0 ELSE qty END::{_M} AS qty_off,
  CASE WHEN tariff THEN mar ELSE 0 END::{_M} AS mar_std, CASE WHEN tariff THEN 0 ELSE mar END::{_M} AS mar_off,
  oth AS total_non_oferta_discount_amt, oth_ex AS total_non_oferta_discount_amt_ex_vale,
  CASE WHEN tariff THEN raised ELSE net END::{_M} AS total_sale_amt, qty AS total_sale_qty, mar AS total_margin_amt
  FROM c_lineparts p LEFT JOIN (SELECT DISTINCT promo_id, promo_year, sku_id, store_id FROM c_offer) o
    ON o.promo_id = p.code AND o.promo_year = p.y AND o.sku_id = p.sku_id AND o.store_id = p.store_id"""

CTE["c_lintype"] = """SELECT *, CASE WHEN promo_id IS NULL OR promo_year IS NULL THEN 'Non-oferta sale'
  WHEN sale_off = IMP_PVP_TARIFA AND total_non_oferta_discount_amt = 0 THEN 'Non-promo sale during oferta promo'
  WHEN sale_off = IMP_PVP_TARIFA OR IMP_PVP_TARIFA + total_non_oferta_discount_amt = sale_off THEN 'Non-oferta promo sale during oferta promo'
  WHEN IMP_PVP_TARIFA > sale_off AND total_non_oferta_discount_amt = 0 THEN 'Oferta promo sale during oferta promo'
  WHEN IMP_PVP_TARIFA + total_non_oferta_discount_amt > sale_off AND total_non_oferta_discount_amt < 0 THEN 'Combo promo sale during oferta promo'
  WHEN sale_off > 0 THEN 'Oferta promo sale non matching during oferta promo'
  WHEN sale_std > 0 AND total_non_oferta_discount_amt <> 0 AND IMP_PVP_TARIFA + total_non_oferta_discount_amt >= sale_std
    THEN 'Non-oferta promo sale during oferta promo'
  ELSE 'Other sale during oferta promo' END AS sale_type FROM c_lin"""


def _attr(whole: str, part: str) -> str:
    return (f"CASE WHEN sale_type = 'Oferta promo sale during oferta promo' THEN {whole} WHEN sale_type IN "
            f"('Combo promo sale during oferta promo', 'Oferta promo sale non matching during oferta promo') THEN {part} ELSE 0 END")


_SHORT = {"sale_amt": "sale", "sale_qty": "qty", "margin_amt": "mar"}
_COLS = {}
for _kind, _s in _SHORT.items():
    for _part in COMPONENTS.values():
        _COLS[f"total_{_kind}_{_part}"] = {"std": f"{_s}_std", "discount": f"{_s}_off"}.get(_part, "0")
_COLS |= {n: n for n in PLAIN_MEASURES[15:20]}
_COLS |= {
    "total_price_if_sku_std_price": "IMP_PVP_TARIFA",
    "oferta_promo_total_sale_amt": _attr("total_sale_amt", "sale_off"),
    "oferta_promo_total_sale_qty": _attr("total_sale_qty", "qty_off"),
    "oferta_promo_total_margin_amt": _attr("total_margin_amt", "mar_off"),
    "oferta_promo_total_discount_amt": _attr(
        "-abs(IMP_PVP_TARIFA - total_sale_amt)", "-abs(IMP_PVP_TARIFA - total_sale_amt + total_non_oferta_discount_amt_ex_vale)"
    ),
}
assert set(_COLS) == set(MEASURES) and OTHER_DISCOUNTS

CTE["c_trans"] = f"""SELECT transaction_id, sku_id, sku_root_id, store_id, promo_id, promo_year, customer_id, sale_type, date, time,
  {', '.join(f'sum({e})::{_M} AS {n}' for n, e in _COLS.items())},
  {fixed(mean(fixed(ratio('IMP_PVP_TARIFA', 'total_sale_qty'))))} AS std_price_per_unit
  FROM c_lintype GROUP BY ALL"""

CTE["c_funding"] = f"""SELECT sku_id, sku_root_id, {mean('unit')} AS expected_vendor_funding_per_unit FROM (
  SELECT t.sku_id, t.sku_root_id, coalesce({fixed(ratio('f.funding', 't.q'))}, 0)::{_R} AS unit
  FROM (SELECT sku_id, sku_root_id, store_id, date, sum(total_sale_qty)::{_M} AS q FROM c_trans GROUP BY ALL) t
  JOIN (SELECT DISTINCT sku_id, store_id, promo_id, promo_year FROM c_offer) o ON o.sku_id = t.sku_id AND o.store_id = t.store_id
  JOIN c_days d ON d.promo_id = o.promo_id AND d.promo_year = o.promo_year AND d.date = t.date
  LEFT JOIN (SELECT p_partkey::VARCHAR AS sku_id, s_nationkey::VARCHAR AS store_id, d AS date,
      sum((l_quantity::DECIMAL(8,0) * std * 0.02)::{_M} + (CASE WHEN round(l_tax * 100)::INT > 4 THEN l_quantity::DECIMAL(8,0) * std * 0.01 ELSE 0 END)::{_M}) AS funding
      FROM c_sold WHERE l_returnflag = 'N' GROUP BY ALL) f ON f.sku_id = t.sku_id AND f.store_id = t.store_id AND f.date = t.date
  ) GROUP BY ALL"""

CTE["c_root"] = """SELECT * FROM (SELECT s.*, f.expected_vendor_funding_per_unit,
  row_number() OVER (PARTITION BY s.sku_root_id ORDER BY t.total DESC, s.sku_id) AS rn
  FROM c_sku s JOIN (SELECT sku_id, sum(total_sale_amt) AS total FROM c_trans GROUP BY 1) t USING (sku_id)
  LEFT JOIN c_funding f ON f.sku_id = s.sku_id) WHERE rn = 1"""

# --- dense facts ------------------------------------------------------------

CTE["c_rootdays"] = """SELECT DISTINCT d.date, o.sku_root_id, o.store_id, o.promo_id, o.promo_year
  FROM c_offer o JOIN c_days d ON d.promo_id = o.promo_id AND d.promo_year = o.promo_year"""

_LIVE = "p.promo_id IS NOT NULL AND p.promo_year IS NOT NULL"
CTE["c_actual"] = f"""SELECT t.date, t.sku_root_id, t.store_id, p.promo_id, p.promo_year,
  {', '.join(f'sum(t.{n})::{_M} AS {n}' for n in PLAIN_MEASURES)},
  {', '.join(f'sum(CASE WHEN {_LIVE} THEN t.{n} ELSE 0 END)::{_M} AS {n}' for n in OFFER_MEASURES)},
  {fixed(mean('t.std_price_per_unit'))} AS std_price_per_unit
  FROM c_trans t JOIN (SELECT sku_root_id FROM c_root) r ON r.sku_root_id = t.sku_root_id
  LEFT JOIN c_rootdays p ON p.date = t.date AND p.sku_root_id = t.sku_root_id AND p.store_id = t.store_id
    AND p.promo_id = t.promo_id AND p.promo_year = t.promo_year GROUP BY ALL"""

CTE["c_grid"] = """SELECT sku_root_id, store_id, date FROM (SELECT DISTINCT sku_root_id, store_id FROM c_actual), c_calendar"""

CTE["c_gridpromo"] = """SELECT g.*, p.promo_id, p.promo_year FROM c_grid g LEFT JOIN c_rootdays p
  ON p.date = g.date AND p.sku_root_id = g.sku_root_id AND p.store_id = g.store_id"""

CTE["c_filled"] = f"""SELECT g.date, g.sku_root_id, g.store_id, g.promo_id, g.promo_year,
  {', '.join(f'coalesce(a.{n}, 0)::{_M} AS {n}' for n in MEASURES)}, a.std_price_per_unit
  FROM c_gridpromo g LEFT JOIN c_actual a ON a.date = g.date AND a.sku_root_id = g.sku_root_id AND a.store_id = g.store_id
    AND a.promo_id = g.promo_id AND a.promo_year = g.promo_year
  UNION
  SELECT date, sku_root_id, store_id, promo_id, promo_year, {', '.join(MEASURES)}, std_price_per_unit FROM c_actual"""


def _counted(sub: str) -> str:
    return f"""SELECT *, CASE WHEN n_promo = 0 THEN 0 ELSE 1 END AS promo_flag FROM (SELECT *,
  count(promo_id) OVER (PARTITION BY date, sku_root_id, store_id) AS n_promo FROM ({sub}))"""


CTE["c_dailypromo"] = _counted(
    f"SELECT date, sku_root_id, store_id, promo_id, promo_year, {csum(MEASURES)}, "
    f"{fixed(mean('std_price_per_unit'))} AS std_price_per_unit FROM c_filled GROUP BY ALL"
)


def _collapsed(src: str, extra: str = "") -> str:
    return f"""SELECT date, sku_root_id, store_id, list_sort(list(DISTINCT promo_id) FILTER (WHERE promo_id IS NOT NULL)) AS promo_id_list,
  {csum(MEASURES)}, {fixed(mean('std_price_per_unit'))} AS std_price_per_unit, max(n_promo) AS n_promo, max(promo_flag) AS promo_flag{extra}
  FROM {src} GROUP BY date, sku_root_id, store_id"""


CTE["c_daily"] = _collapsed("c_dailypromo")
CTE["c_weeklypromo"] = _counted(
    f"SELECT {week('date')} AS date, sku_root_id, store_id, promo_id, promo_year, {csum(MEASURES)}, "
    f"{fixed(mean('std_price_per_unit'))} AS std_price_per_unit, "
    "sum(CASE WHEN promo_id IS NOT NULL THEN promo_flag ELSE 0 END) AS no_days_with_promo "
    f"FROM c_dailypromo GROUP BY {week('date')}, sku_root_id, store_id, promo_id, promo_year"
)
CTE["c_weekly"] = _collapsed("c_weeklypromo", ", max(no_days_with_promo) AS no_days_with_promo")


def _or_zero(a: str, b: str) -> str:
    return f"CASE WHEN {a} = 0 OR {a} IS NULL THEN {b} ELSE {a} END"


def _unit(src: str, where: str) -> str:
    return f"""SELECT sku_root_id, {fixed(mean(fixed(ratio('total_margin_amt', 'total_sale_qty'))))} AS mar,
    {_or_zero(fixed(mean('std_price_per_unit')), fixed(mean(fixed(ratio('total_sale_amt', 'total_sale_qty')))))} AS price
    FROM {src} SEMI JOIN c_root USING (sku_root_id) WHERE {where} GROUP BY sku_root_id"""


CTE["c_price"] = f"""SELECT *, (std_price_per_unit - margin_per_unit)::{_R} AS cost_per_unit FROM (
  SELECT a.sku_root_id, {_or_zero('a.mar', 'b.mar')} AS margin_per_unit, {_or_zero('a.price', 'b.price')} AS std_price_per_unit
  FROM ({_unit('c_daily', 'promo_flag = 0')}) a LEFT JOIN ({_unit('c_trans', 'promo_id IS NULL')}) b USING (sku_root_id))"""

# --- promo facts ------------------------------------------------------------

_DISP = "leaflet_cover leaflet_priv_space in_leaflet_flag in_gondola_flag in_both_leaflet_gondola_flag".split()
_OKEY = ("promo_id, promo_year, sku_root_id, store_id, promo_mechanic, promo_mechanic_description, "
         "discount_depth_rank, discount_depth")
_PKEY = "promo_id, promo_year, sku_root_id, promo_mechanic, promo_mechanic_description, discount_depth_rank, discount_depth"
_ALLOC = ["total_sale_amt", "total_sale_qty", "total_margin_amt", "total_discount_amt"]

CTE["c_valid"] = f"""SELECT {_OKEY}, max(std_price) AS std_price, min(discounted_price_promo) AS discounted_price_promo,
  {', '.join(f'max({c}) AS {c}' for c in _DISP)}
  FROM c_offer WHERE promo_mechanic NOT IN ('10','20','30','40','60') OR discount_depth IS NOT NULL OR discounted_price_promo IS NOT NULL
  GROUP BY ALL"""

CTE["c_pday"] = f"""SELECT d.date, v.* REPLACE (coalesce(v.std_price::{_R}, t.std_price_per_unit) AS std_price),
  count(*) OVER (PARTITION BY d.date, v.sku_root_id, v.store_id, v.promo_id, v.promo_year) AS n_promo_mech
  FROM c_valid v SEMI JOIN c_root r ON r.sku_root_id = v.sku_root_id
  JOIN c_days d ON d.promo_id = v.promo_id AND d.promo_year = v.promo_year
  LEFT JOIN c_daily t ON t.date = d.date AND t.sku_root_id = v.sku_root_id AND t.store_id = v.store_id"""


def _share(n: str) -> str:
    return (f"(coalesce(a.{n}::DOUBLE * {ratio('1', 'n_promo_mech')}, 0) + "
            f"coalesce(b.{n}::DOUBLE * {ratio('1', '(n_promo_mech * c.n_promo)')}, 0))")


CTE["c_alloc"] = f"""SELECT p.*, c.n_promo,
  CASE WHEN promo_mechanic = '10' AND discounted_price_promo > 0 AND std_price > 0 AND std_price >= discounted_price_promo
    THEN {fixed('100 * (1 - ' + ratio('discounted_price_promo', 'std_price') + ')')} END AS discount_depth_10,
  {', '.join(f'{fixed(_share(n))} AS {n}' for n in _ALLOC[:3])},
  {fixed(_share('total_sale_amt') + ' - ' + _share('total_price_if_sku_std_price'))} AS total_discount_amt,
  {', '.join(f'a.{n}' for n in OFFER_MEASURES)}
  FROM c_pday p
  LEFT JOIN c_dailypromo a ON a.date = p.date AND a.sku_root_id = p.sku_root_id AND a.store_id = p.store_id AND a.promo_id = p.promo_id AND a.promo_year = p.promo_year
  LEFT JOIN c_dailypromo b ON b.date = p.date AND b.sku_root_id = p.sku_root_id AND b.store_id = p.store_id AND b.promo_id IS NULL AND b.promo_year IS NULL
  LEFT JOIN c_daily c ON c.date = p.date AND c.sku_root_id = p.sku_root_id AND c.store_id = p.store_id"""

CTE["c_matched"] = "SELECT * FROM c_alloc WHERE n_promo IS NOT NULL"

_D3 = ["discounted_price_promo", "std_price", "discount_depth_10"]
CTE["c_depthstore"] = f"""SELECT promo_id, promo_year, sku_root_id, store_id, promo_mechanic, discount_depth_rank, discount_depth,
  {', '.join(f'{fixed(mean(c))} AS {c}' for c in _D3)} FROM c_matched WHERE promo_mechanic = '10' GROUP BY ALL"""
CTE["c_depth"] = f"""SELECT promo_id, promo_year, sku_root_id, promo_mechanic, discounted_price_promo, std_price, discount_depth_10,
  coalesce({plain(step('discount_depth_10::DOUBLE'))} || '% off', discount_depth) AS discount_depth,
  coalesce({fixed(step('discount_depth_10::DOUBLE'))}, discount_depth_rank) AS discount_depth_rank FROM (
  SELECT promo_id, promo_year, sku_root_id, promo_mechanic, discount_depth_rank, discount_depth,
  {', '.join(f'{fixed(mean(c))} AS {c}' for c in _D3)} FROM c_depthstore GROUP BY ALL)"""

CTE["c_pdtotal"] = f"""SELECT p.date, p.promo_id, p.promo_year, p.sku_root_id, p.store_id, p.promo_mechanic, p.promo_mechanic_description,
  CASE WHEN p.promo_mechanic = '10' THEN d.discount_depth_rank ELSE p.discount_depth_rank END AS discount_depth_rank,
  CASE WHEN p.promo_mechanic = '10' THEN d.discount_depth ELSE p.discount_depth END AS discount_depth,
  {', '.join('p.' + c for c in _DISP)}, p.n_promo_mech, p.n_promo, wb.promo_flag AS promo_prev_week, wa.promo_flag AS promo_pf_week,
  {', '.join('p.' + c for c in _ALLOC + OFFER_MEASURES)}
  FROM c_matched p JOIN c_campaign c ON c.promo_id = p.promo_id AND c.promo_year = p.promo_year
  LEFT JOIN c_depth d ON d.promo_id = p.promo_id AND d.promo_year = p.promo_year AND d.sku_root_id = p.sku_root_id AND d.promo_mechanic = p.promo_mechanic
  LEFT JOIN c_weekly wb ON wb.sku_root_id = p.sku_root_id AND wb.store_id = p.store_id AND wb.date = ({week('c.start_date')} - 7)
  LEFT JOIN c_weekly wa ON wa.sku_root_id = p.sku_root_id AND wa.store_id = p.store_id AND wa.date = ({week('c.end_date')} + 7)"""

_MX = [*_DISP, "n_promo_mech", "n_promo", "promo_prev_week", "promo_pf_week"]
CTE["c_pwtotal"] = f"""SELECT {week('date')} AS date, {_OKEY}, max(dayofweek(date) IN (0, 6)) AS includes_weekend,
  {', '.join(f'max({c}) AS {c}' for c in _MX)}, count(*) AS n_days_promo_week, {csum(_ALLOC + OFFER_MEASURES, _R)}
  FROM c_pdtotal GROUP BY {week('date')}, {_OKEY}"""

_FMT = {"HIPERMERCADOS": "hipermercados", "SUPERMERCADOS": "supermercados", "GASOLINERAS": "gasolineras",
        "COMERCIO ELECTRONICO": "comercio_electronico", "OTROS NEGOCIOS": "otros_negocio", "PLATAFORMAS": "plataformas", "69": "other"}
CTE["c_psum"] = f"""SELECT date, {_PKEY},
  {', '.join(f"count(*) FILTER (WHERE store_type1 = '{k}') AS no_{v}_stores" for k, v in _FMT.items())},
  list_sort(list(DISTINCT store_id)) AS store_ids, count(DISTINCT store_id) AS no_impacted_stores,
  count(DISTINCT store_geography_region) AS no_impacted_regions, {mean('size_m2')} AS avg_store_size,
  max(includes_weekend) AS includes_weekend, {', '.join(f'max({c}) AS {c}' for c in _MX)},
  {mean('n_days_promo_week')} AS n_days_promo_week, {csum(_ALLOC + OFFER_MEASURES, _R)},
  sum(prev)::{_R} AS s_prev_bl_qty, sum({fixed('prev::DOUBLE * part')})::{_R} AS s_prev_bl_qty_norm, sum(nxt)::{_R} AS pf_after_bl_qty,
  sum({fixed('av * part')})::{_R} AS avg_bline_qty, sum({fixed('av_all * part')})::{_R} AS avg_bline_qty_all
  FROM (SELECT w.*, st.store_type1, st.store_geography_region, st.size_m2, b.total_sale_qty AS prev, a.total_sale_qty AS nxt, u.av, u.av_all,
      n_days_promo_week::DOUBLE / 7 AS part
    FROM c_pwtotal w JOIN c_campaign c ON c.promo_id = w.promo_id AND c.promo_year = w.promo_year
    JOIN c_store st ON st.store_id = w.store_id
    LEFT JOIN c_weekly b ON b.sku_root_id = w.sku_root_id AND b.store_id = w.store_id AND b.date = ({week('c.start_date')} - 7)
    LEFT JOIN c_weekly a ON a.sku_root_id = w.sku_root_id AND a.store_id = w.store_id AND a.date = ({week('c.end_date')} + 7)
    LEFT JOIN (SELECT sku_root_id, store_id, {mean('total_sale_qty', 'promo_flag = 0')} AS av, {mean('total_sale_qty')} AS av_all
      FROM c_weekly GROUP BY ALL) u ON u.sku_root_id = w.sku_root_id AND u.store_id = w.store_id
    WHERE w.discount_depth IS NOT NULL) GROUP BY date, {_PKEY}"""

CTE["c_post"] = f"""SELECT DISTINCT t.date, {', '.join('p.' + c.strip() for c in _OKEY.split(','))}, {', '.join('p.' + c for c in _DISP)}, p.n_promo_mech, p.promo_prev_week,
  t.total_sale_amt AS pf_sale_amt, t.total_sale_qty AS pf_sale_qty, t.total_margin_amt AS pf_margin_amt, t.n_promo AS pf_n_promo, t.promo_flag AS pf_promo_flag
  FROM c_pdtotal p JOIN c_campaign c ON c.promo_id = p.promo_id AND c.promo_year = p.promo_year
  JOIN c_daily t ON t.sku_root_id = p.sku_root_id AND t.store_id = p.store_id AND t.date > c.end_date AND t.date <= c.end_date + 28"""

# --- counterfactual ---------------------------------------------------------------

CTE["c_pweeks"] = """SELECT s.date, s.sku_root_id || '-' || promo_id || '-' || promo_year || '-' || promo_mechanic || '-' || coalesce(discount_depth, 'ISNULL') AS uniq_id,
  r.section, s.sku_root_id, promo_id, promo_year::VARCHAR AS promo_year, promo_mechanic, discount_depth, total_sale_qty, s_prev_bl_qty, pf_after_bl_qty
  FROM c_psum s JOIN c_root r USING (sku_root_id) WHERE s_prev_bl_qty IS NOT NULL AND pf_after_bl_qty IS NOT NULL"""

CTE["c_trend"] = f"""SELECT date, section, sale_qty_np, CASE WHEN row_number() OVER w = 1 THEN 1.0::DOUBLE
  ELSE {ratio('sale_qty_np', 'lag(sale_qty_np) OVER w')} END AS sale_qty_pct FROM (
  SELECT w.date, r.section, sum(total_sale_qty)::{_M} AS sale_qty_np FROM c_weekly w JOIN c_root r USING (sku_root_id)
  WHERE promo_flag = 0 GROUP BY ALL) WINDOW w AS (PARTITION BY section ORDER BY date)"""

CTE["c_ext"] = """SELECT date, uniq_id, section, sku_root_id, promo_id, promo_year, promo_mechanic, discount_depth, total_sale_qty, s_prev_bl_qty, pf_after_bl_qty,
  CASE WHEN row_number() OVER (PARTITION BY uniq_id ORDER BY date) = 1 THEN 1 ELSE 2 END AS change_flag FROM c_pweeks
  UNION ALL
  SELECT date + (7 * k)::INT, uniq_id, section, sku_root_id, promo_id, promo_year, promo_mechanic, discount_depth, NULL, NULL, NULL, 3
  FROM (SELECT * FROM c_pweeks QUALIFY row_number() OVER (PARTITION BY uniq_id ORDER BY date DESC) = 1), range(1, 5) t(k)"""

CTE["c_blin"] = """SELECT e.*, t.sale_qty_pct, s_prev_bl_qty::DOUBLE AS prev, pf_after_bl_qty::DOUBLE AS after,
  row_number() OVER (PARTITION BY uniq_id ORDER BY e.date) AS i FROM c_ext e JOIN c_trend t ON t.date = e.date AND t.section = e.section"""

CTE["c_blrec"] = f"""SELECT uniq_id, i, change_flag, after, CASE WHEN change_flag = 1 THEN {cents('prev * sale_qty_pct')} END AS bl FROM c_blin WHERE i = 1
  UNION ALL
  SELECT b.uniq_id, b.i, b.change_flag, b.after, CASE WHEN b.change_flag = 1 THEN {cents('b.prev * b.sale_qty_pct')}
    WHEN b.change_flag = 2 OR r.change_flag = 3 THEN {cents('r.bl * b.sale_qty_pct')} ELSE {cents('r.after')} END
  FROM c_blrec r JOIN c_blin b ON b.uniq_id = r.uniq_id AND b.i = r.i + 1"""

CTE["c_counterfactual"] = """SELECT b.date, uniq_id, sku_root_id, promo_id, promo_year, promo_mechanic, discount_depth, b.change_flag, total_sale_qty, r.bl AS sale_qty_bl, sale_qty_pct
  FROM c_blin b JOIN c_blrec r USING (uniq_id, i)"""

_K5 = "sku_root_id, promo_id, promo_year, promo_mechanic, discount_depth"
CTE["c_psumk"] = "SELECT * REPLACE (promo_year::VARCHAR AS promo_year, coalesce(discount_depth, 'ISNULL') AS discount_depth) FROM c_psum"
CTE["c_stores5"] = f"SELECT DISTINCT {_K5}, unnest(store_ids) AS store_id FROM c_psumk"
CTE["c_forward"] = f"""SELECT w.date, {', '.join('s.' + c.strip() for c in _K5.split(','))}, sum(total_sale_qty)::{_M} AS q, sum(total_sale_amt)::{_M} AS a,
  sum(total_margin_amt)::{_M} AS m, sum(total_price_if_sku_std_price - total_sale_amt)::{_M} AS x
  FROM c_stores5 s JOIN c_campaign c ON c.promo_id = s.promo_id AND c.promo_year::VARCHAR = s.promo_year
  JOIN c_weekly w ON w.sku_root_id = s.sku_root_id AND w.store_id = s.store_id
    AND w.date >= {week('c.end_date')} + 7 AND w.date <= {week('c.end_date')} + 28 GROUP BY ALL"""
CTE["c_spf"] = f"""SELECT b.date, b.uniq_id, count(*) AS store_promo_flag FROM c_counterfactual b
  JOIN c_stores5 s ON s.sku_root_id = b.sku_root_id AND s.promo_id = b.promo_id AND s.promo_year = b.promo_year AND s.promo_mechanic = b.promo_mechanic
    AND s.discount_depth = coalesce(b.discount_depth, 'ISNULL')
  SEMI JOIN (SELECT DISTINCT date, sku_root_id, unnest(store_ids) AS store_id FROM c_psumk) o
    ON o.date = b.date AND o.sku_root_id = b.sku_root_id AND o.store_id = s.store_id GROUP BY ALL"""
_STABLE = """promo_mechanic_description discount_depth_rank no_hipermercados_stores no_supermercados_stores no_gasolineras_stores
  no_comercio_electronico_stores no_otros_negocio_stores no_plataformas_stores no_other_stores no_impacted_stores no_impacted_regions
  avg_store_size leaflet_cover leaflet_priv_space in_leaflet_flag in_gondola_flag in_both_leaflet_gondola_flag""".split()
CTE["c_bp0"] = f"""SELECT b.date, b.uniq_id, b.sku_root_id, b.promo_id, b.promo_year, b.promo_mechanic, coalesce(b.discount_depth, 'ISNULL') AS discount_depth,
  b.change_flag, b.total_sale_qty AS tt_sale_qty_ref, {fixed('b.sale_qty_bl')} AS sale_qty_bl, b.sale_qty_pct,
  CASE WHEN change_flag = 3 THEN f.q::{_R} ELSE s.total_sale_qty::{_R} END AS tt_sale_qty,
  CASE WHEN change_flag = 3 THEN f.a::{_R} ELSE s.total_sale_amt::{_R} END AS tt_sale_amt,
  CASE WHEN change_flag = 3 THEN f.m::{_R} ELSE s.total_margin_amt::{_R} END AS tt_margin_amt,
  CASE WHEN change_flag = 3 THEN f.x::{_R} ELSE s.total_discount_amt::{_R} END AS tt_discount,
  s.avg_bline_qty, s.s_prev_bl_qty, s.pf_after_bl_qty, coalesce(s.includes_weekend, true) AS includes_weekend,
  p.std_price_per_unit::DOUBLE AS pr, p.margin_per_unit::DOUBLE AS mg, {', '.join('z.' + c for c in _STABLE)}
  FROM c_counterfactual b
  LEFT JOIN c_forward f ON f.date = b.date AND f.sku_root_id = b.sku_root_id AND f.promo_id = b.promo_id AND f.promo_year = b.promo_year AND f.promo_mechanic = b.promo_mechanic AND f.discount_depth = coalesce(b.discount_depth, 'ISNULL')
  LEFT JOIN c_psumk s ON s.date = b.date AND s.sku_root_id = b.sku_root_id AND s.promo_id = b.promo_id AND s.promo_year = b.promo_year AND s.promo_mechanic = b.promo_mechanic AND s.discount_depth = coalesce(b.discount_depth, 'ISNULL')
  LEFT JOIN c_price p ON p.sku_root_id = b.sku_root_id
  LEFT JOIN (SELECT * FROM c_psumk QUALIFY row_number() OVER (PARTITION BY {_K5} ORDER BY date) = 1) z
    ON z.sku_root_id = b.sku_root_id AND z.promo_id = b.promo_id AND z.promo_year = b.promo_year AND z.promo_mechanic = b.promo_mechanic AND z.discount_depth = coalesce(b.discount_depth, 'ISNULL')"""
CTE["c_bp1"] = f"""SELECT *, {fixed('sale_qty_bl::DOUBLE * pr')} AS sale_amt_bl, {fixed('sale_qty_bl::DOUBLE * mg')} AS margin_amt_bl,
  {fixed('avg_bline_qty::DOUBLE * pr')} AS avg_bline_sale, {fixed('avg_bline_qty::DOUBLE * mg')} AS avg_bline_margin FROM c_bp0"""
CTE["c_bp"] = f"""SELECT b.*, (tt_sale_amt - sale_amt_bl)::{_R} AS inc_sale_amt, (tt_sale_qty - sale_qty_bl)::{_R} AS inc_sale_qty,
  (tt_margin_amt - margin_amt_bl)::{_R} AS inc_margin_amt, (tt_sale_amt - avg_bline_sale)::{_R} AS avg_bl_inc_sale,
  (tt_sale_qty - avg_bline_qty)::{_R} AS avg_bl_inc_qty, (tt_margin_amt - avg_bline_margin)::{_R} AS avg_bl_inc_margin,
  CASE WHEN change_flag <> 3 THEN 1 END AS promo_flag, f.store_promo_flag
  FROM c_bp1 b LEFT JOIN c_spf f ON f.date = b.date AND f.uniq_id = b.uniq_id"""

# --- weekly root counterfactual, cannibalisation ----------------------------------

_MET = ["sale_amt", "sale_qty", "margin_amt"]
CTE["c_sbtot"] = f"""SELECT date, sku_root_id, r.section, r.segment, {', '.join(f'sum(total_{m})::{_M} AS total_{m}' for m in _MET)},
  CASE WHEN sum(promo_flag) * 2 > count(*) THEN 1 ELSE 0 END AS pfb,
  {', '.join(f'(sum(total_{m}) FILTER (WHERE promo_flag = 0))::{_M} AS np_{m}' for m in _MET)}
  FROM c_weekly JOIN c_root r USING (sku_root_id) GROUP BY ALL"""
CTE["c_sbtrend"] = f"""SELECT date, section, {', '.join(f"CASE WHEN row_number() OVER w = 1 THEN 1.0::DOUBLE ELSE {ratio(f'np_{m}', f'lag(np_{m}) OVER w')} END AS {m}_pct" for m in _MET)}
  FROM (SELECT date, section, {', '.join(f'coalesce(sum(np_{m}), 0)::{_M} AS np_{m}' for m in _MET)} FROM c_sbtot GROUP BY ALL)
  WINDOW w AS (PARTITION BY section ORDER BY date)"""
CTE["c_sbin"] = f"""SELECT t.*, {', '.join(m + '_pct' for m in _MET)}, row_number() OVER w AS i,
  CASE WHEN pfb = 1 AND coalesce(lag(pfb) OVER w, 0) = 0 THEN 1 WHEN pfb = 1 THEN 2
    WHEN coalesce(t.date - max(CASE WHEN pfb = 1 THEN t.date END) OVER w <= 7, false) THEN 3 ELSE 0 END AS change_flag
  FROM c_sbtot t JOIN c_sbtrend r ON r.date = t.date AND r.section = t.section
  WINDOW w AS (PARTITION BY sku_root_id ORDER BY t.date)"""


def _sbstep(m: str, prev_total: str, prev_bl: str, x: str) -> str:
    return (f"CASE WHEN {x}.change_flag = 1 THEN {cents(f'{prev_total} * {x}.{m}_pct')} "
            f"WHEN {x}.change_flag IN (2, 3) THEN {cents(f'{prev_bl} * {x}.{m}_pct')} END AS b_{m}")


CTE["c_sbrec"] = f"""SELECT sku_root_id, i, {', '.join(f'x.total_{m}::DOUBLE AS t_{m}' for m in _MET)},
  {', '.join(_sbstep(m, f'x.total_{m}::DOUBLE', 'NULL::DOUBLE', 'x') for m in _MET)} FROM c_sbin x WHERE i = 1
  UNION ALL
  SELECT x.sku_root_id, x.i, {', '.join(f'x.total_{m}::DOUBLE' for m in _MET)},
  {', '.join(_sbstep(m, f'r.t_{m}', f'r.b_{m}', 'x') for m in _MET)}
  FROM c_sbrec r JOIN c_sbin x ON x.sku_root_id = r.sku_root_id AND x.i = r.i + 1"""
CTE["c_sb"] = f"""SELECT x.date, x.sku_root_id, x.section, x.segment, x.pfb AS promo_flag_binary, x.change_flag, x.i,
  {', '.join(f'x.total_{m}, x.{m}_pct, CASE WHEN x.change_flag IN (1, 2) THEN r.b_{m} END AS {m}_bl, CASE WHEN x.change_flag = 3 THEN r.b_{m} END AS {m}_bl_ext' for m in _MET)},
  CASE WHEN x.pfb = 1 THEN coalesce(x.total_sale_qty::DOUBLE - r.b_sale_qty, 0) ELSE 0 END AS incremental_qty
  FROM c_sbin x JOIN c_sbrec r ON r.sku_root_id = x.sku_root_id AND r.i = x.i"""
CTE["c_cb0"] = """SELECT *, CASE WHEN pf = 1 THEN 4 WHEN change_flag = 3 AND cnt > 0 THEN 1 WHEN cnt > 0 THEN 2 ELSE 0 END AS f0 FROM (
  SELECT * REPLACE (greatest(incremental_qty, 0) AS incremental_qty), promo_flag_binary AS pf, sum(promo_flag_binary) OVER (PARTITION BY date, segment) AS cnt FROM c_sb)"""
CTE["c_cb1"] = """SELECT *, CASE WHEN f0 = 2 AND lag(f0) OVER (PARTITION BY sku_root_id ORDER BY date) = 0 THEN 1 ELSE f0 END AS cb_flag FROM c_cb0"""
CTE["c_cbrec"] = f"""SELECT sku_root_id, i, cb_flag, {', '.join(f'{m}_bl AS b_{m}, CASE WHEN cb_flag IN (1, 2) THEN total_{m}::DOUBLE END AS c_{m}' for m in _MET)} FROM c_cb1 WHERE i = 1
  UNION ALL
  SELECT x.sku_root_id, x.i, x.cb_flag, {', '.join(f'''x.{m}_bl, CASE WHEN x.cb_flag = 2 THEN {cents(f'r.c_{m} * x.{m}_pct')}
    WHEN x.cb_flag = 1 AND r.cb_flag = 4 THEN {cents(f'r.b_{m} * x.{m}_pct')} WHEN x.cb_flag = 1 AND r.cb_flag = 0 THEN {cents(f'x.total_{m}::DOUBLE')} END''' for m in _MET)}
  FROM c_cbrec r JOIN c_cb1 x ON x.sku_root_id = r.sku_root_id AND x.i = r.i + 1"""
CTE["c_cb"] = f"""SELECT x.date, x.sku_root_id, x.segment, x.promo_flag_binary, x.incremental_qty, x.cb_flag, x.cnt,
  {', '.join(f'r.c_{m} AS {m}_cb_bl, r.c_{m} - x.total_{m}::DOUBLE AS cb_{m}' for m in _MET)}
  FROM c_cb1 x JOIN c_cbrec r ON r.sku_root_id = x.sku_root_id AND r.i = x.i"""

# --- elasticity -------------------------------------------------------------

CTE["c_point"] = f"""SELECT sku_root_id, store_id, std_price_per_unit, {fixed(mean('qty'))} AS avg_sales_qty, {fixed(mean('paid'))} AS actual_price,
  count(w) AS duration_weeks, stddev_samp(qty::DOUBLE) AS std_dev_sales_qty FROM (
  SELECT sku_root_id, store_id, {week('date')} AS w, std_price_per_unit, {fixed('sum(total_sale_qty)')} AS qty,
    {fixed(ratio('sum(total_sale_amt)', 'sum(total_sale_qty)'))} AS paid
  FROM c_daily WHERE promo_flag = 0 AND total_sale_qty <> 0 GROUP BY ALL)
  WHERE month(w) <> 12 AND {ratio('abs(paid - std_price_per_unit)', 'std_price_per_unit')} < 0.1 GROUP BY sku_root_id, store_id, std_price_per_unit"""


def line(x: str, y: str) -> tuple[str, str, str]:
    """Slope, intercept and R2 with the rules for constant x or y."""
    flat = f"min({x}) = max({x})"
    one = f"min({y}) = max({y})"
    slope = f"CASE WHEN {flat} THEN 0 ELSE regr_slope({y}::DOUBLE, {x}::DOUBLE) END"
    inter = f"CASE WHEN {flat} THEN avg({y}::DOUBLE) ELSE regr_intercept({y}::DOUBLE, {x}::DOUBLE) END"
    r2 = f"CASE WHEN {one} THEN 1 WHEN {flat} THEN 0 ELSE regr_r2({y}::DOUBLE, {x}::DOUBLE) END"
    return slope, inter, r2


_L = line("std_price_per_unit", "avg_sales_qty")
CTE["c_cost"] = "SELECT sku_root_id, min(cost_per_unit) AS cost_per_unit FROM c_price GROUP BY 1"
CTE["c_sline"] = f"""SELECT *, {ratio('coeficient', 'Nfactor')} AS gradient FROM (
  SELECT sku_root_id, store_id, {_L[0]} AS coeficient, {_L[1]} AS intercept, {_L[2]} AS R2, {mean('avg_sales_qty')} AS Nfactor,
  count(*) AS points, {mean('actual_price')} AS avg_price FROM c_point GROUP BY sku_root_id, store_id) LEFT JOIN c_cost USING (sku_root_id)"""

# --- day-of-week uplift -----------------------------------------------------

CTE["c_period"] = """SELECT sku_root_id, store_id, min(date) AS start_date, max(date) AS end_date, (max(date) - min(date) + 1)::INT AS period
  FROM c_daily WHERE total_sale_qty <> 0 GROUP BY ALL"""
CTE["c_perday"] = f"""SELECT sku_root_id, store_id, {fixed(ratio('q', 'period'))} AS avg_sale_qty, period FROM
  (SELECT sku_root_id, store_id, sum(total_sale_qty) AS q FROM c_daily GROUP BY ALL) JOIN c_period USING (sku_root_id, store_id)"""
CTE["c_perweekday"] = f"""SELECT d.sku_root_id, d.store_id, dayname(d.date) AS dayweek, {fixed(mean('total_sale_qty'))} AS total_sale_qty, max(period) AS period
  FROM c_daily d JOIN c_period p ON p.sku_root_id = d.sku_root_id AND p.store_id = d.store_id AND d.date BETWEEN p.start_date AND p.end_date GROUP BY ALL"""


def _lined(src: str) -> str:
    return f"""SELECT x.*, coalesce(a.avg_sale_qty, 0)::{_R} AS bline_qty_all, coalesce(b.total_sale_qty, 0)::{_R} AS bline_qty_all_day
  FROM {src} x LEFT JOIN c_perday a ON a.sku_root_id = x.sku_root_id AND a.store_id = x.store_id
  LEFT JOIN c_perweekday b ON b.sku_root_id = x.sku_root_id AND b.store_id = x.store_id AND b.dayweek = dayname(x.date)"""


CTE["c_dlined"] = _lined("c_daily")
CTE["c_plined"] = _lined("c_pdtotal")
CTE["c_postlined"] = _lined("c_post")
CTE["c_cumeall"] = """SELECT *, cume_dist() OVER (PARTITION BY sku_root_id ORDER BY bline_qty_all) AS cum_dist
  FROM (SELECT DISTINCT sku_root_id, store_id, bline_qty_all FROM c_plined)"""
CTE["c_cume"] = "SELECT * FROM c_cumeall WHERE cum_dist >= 0.1"
CTE["c_pkept"] = "SELECT * FROM c_plined SEMI JOIN c_cume USING (sku_root_id, store_id) WHERE n_promo = 1 AND n_promo_mech = 1"
CTE["c_postkept"] = "SELECT * FROM c_postlined SEMI JOIN c_cume USING (sku_root_id, store_id) WHERE pf_n_promo <= 1 AND n_promo_mech = 1"
CTE["c_wk"] = """SELECT promo_id, promo_year, start_date, end_date, (end_date - start_date + 1)::INT // 7 AS duration_week
  FROM c_campaign WHERE (end_date - start_date + 1)::INT IN (7, 14, 21, 28)"""
CTE["c_ptotals"] = f"""SELECT promo_id, promo_year, sku_root_id, promo_mechanic, promo_mechanic_description, discount_depth, discount_depth_rank, in_leaflet_flag, in_gondola_flag,
  {csum(_ALLOC + OFFER_MEASURES, _R)}, sum(bline_qty_all_day)::{_R} AS total_counterfactual_qty, max(promo_prev_week) AS promo_prev_week, max(promo_pf_week) AS promo_pf_week,
  (sum(total_sale_qty) - sum(bline_qty_all_day))::{_R} AS total_inc_qty,
  {ratio(f'(sum(total_sale_qty) - sum(bline_qty_all_day))::{_R}', f'sum(bline_qty_all_day)::{_R}')} AS perc_inc_qty,
  greatest(1, round((max(c.end_date - c.start_date) + 1)::DOUBLE / 7)) AS duration_wks
  FROM c_pkept JOIN c_campaign c USING (promo_id, promo_year)
  GROUP BY promo_id, promo_year, sku_root_id, promo_mechanic, promo_mechanic_description, discount_depth, discount_depth_rank, in_leaflet_flag, in_gondola_flag"""

_REC = {"c_blrec", "c_sbrec", "c_cbrec"}


def compose(final: str, extra: dict[str, str] | None = None, recursive: set[str] = frozenset()) -> str:
    """A complete statement: the tables a query needs, in order, then the query."""
    known = {**CTE, **(extra or {})}
    order: list[str] = []

    def visit(sql: str, own: str = "") -> None:
        for name in re.findall(r"\bc_\w+", sql):
            if name in known and name != own and name not in order:
                visit(known[name], name)
                order.append(name)

    visit(final)
    if not order:
        return final
    rec = _REC | set(recursive)
    parts = [f"{n} AS {'' if n in rec else 'MATERIALIZED '}({known[n]})" for n in order]
    word = "WITH RECURSIVE" if rec & set(order) else "WITH"
    return f"{word} " + ",\n".join(parts) + "\n" + final
