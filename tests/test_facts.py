"""Sale types, gap filling, overlapping campaigns and allocation on small frames."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import functions as F

from promolens.functions.numeric import plain
from promolens.operators import dims, facts, promo_facts, sales
from promolens.operators.sales import MEASURES
from promolens.plans.mart import open_mart
from promolens.session import hash_joins

D = dt.date
MONEY = "decimal(18,4)"


def test_sale_type_outcomes(spark):
    # list price, offer part, tariff part, other discounts, offer id, offer year, expected
    cases = [
        (10, 10, 0, 0, "P", 2018, sales.NON_PROMO),
        (10, 10, 0, -1, "P", 2018, sales.OTHER_PROMO),
        (10, 9, 0, -1, "P", 2018, sales.OTHER_PROMO),
        (10, 8, 0, 0, "P", 2018, sales.OFFER),
        (10, 8, 0, -1, "P", 2018, sales.COMBO),
        (10, 8, 0, 1, "P", 2018, sales.NON_MATCHING),
        (10, 0, 9, -10, "P", 2018, sales.OTHER_PROMO if 10 - 10 == 0 else None),
        (10, 0, 11, 1, "P", 2018, sales.OTHER_PROMO),
        (10, 0, 15, 1, "P", 2018, sales.OTHER),
        (10, 8, 0, 0, None, None, sales.NO_OFFER),
        (10, 8, 0, 0, "P", None, sales.NO_OFFER),
    ]
    rows = [(i, *[Decimal(v) for v in c[:4]], c[4], c[5]) for i, c in enumerate(cases)]
    df = spark.createDataFrame(rows, f"i int, IMP_PVP_TARIFA {MONEY}, IMP_VENTA_OFERTA {MONEY}, IMP_VENTA_TARIFA {MONEY}, total_non_oferta_discount_amt {MONEY}, promo_id string, promo_year long")
    for c in ("LIQUID", "CAMPANA", "COMPETE"):
        df = df.withColumn(f"IMP_VENTA_{c}", F.lit(0).cast(MONEY))
    got = {r.i: r.t for r in df.select("i", sales.sale_type().alias("t")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[-1] for c in cases]


def actual(spark, rows):
    df = spark.createDataFrame(rows, f"date date, sku_root_id string, store_id string, promo_id string, promo_year long, total_sale_qty {MONEY}, std_price_per_unit decimal(18,6)")
    return df.withColumns({m: F.lit(0).cast(MONEY) for m in MEASURES if m != "total_sale_qty"})


def test_gap_fill_equals_union_of_grid_and_actuals(spark):
    cal = dims.calendar_between(spark, D(2018, 1, 1), D(2018, 1, 7))
    one = Decimal(1)
    acts = actual(spark, [
        (D(2018, 1, 2), "r", "s", None, None, Decimal(5), one), (D(2018, 1, 3), "r", "s", "A", 2018, Decimal(2), one),
        (D(2018, 1, 3), "r", "s", None, None, Decimal(4), one), (D(2018, 1, 6), "q", "s", None, None, Decimal(1), one),
    ])
    days = spark.createDataFrame(
        [(D(2018, 1, d), "r", "s", p, 2018) for p, ds in (("A", (3, 4)), ("B", (4, 5))) for d in ds],
        "date date, sku_root_id string, store_id string, promo_id string, promo_year long")
    grid = facts.dense_grid(acts, cal)
    assert grid.count() == 2 * 7
    filled = facts.gap_fill(facts.grid_with_promos(grid, days), acts)
    key = ["date", "sku_root_id", "store_id", "promo_id", "promo_year"]
    literal = (
        facts.grid_with_promos(grid, days).withColumn("total_sale_qty", F.lit(0).cast(MONEY))
        .unionByName(acts.select(*key, "total_sale_qty")).groupBy(*key).agg(F.sum("total_sale_qty").alias("q"))
    )
    got = {tuple(r)[:5]: float(r[5]) for r in filled.select(*key, "total_sale_qty").collect()}
    assert got == {tuple(r)[:5]: float(r[5]) for r in literal.collect()}
    counts = {(r.date.day, r.promo_id): (r.n_promo, r.promo_flag) for r in filled.where("sku_root_id = 'r'").collect()}
    assert counts[(4, "A")] == (2, 1) and counts[(3, None)] == (1, 1) and counts[(6, None)] == (0, 0)
    day = {(r.sku_root_id, r.date.day): r for r in facts.daily(filled).collect()}
    assert len(day) == 14 and float(day[("r", 3)].total_sale_qty) == 6 and day[("r", 4)].promo_id_list == ["A", "B"]
    assert day[("r", 2)].promo_id_list is None and float(day[("r", 2)].total_sale_qty) == 5


def test_campaign_over_three_weeks_and_overlap(spark):
    cal = dims.calendar_between(spark, D(2018, 1, 1), D(2018, 1, 28))
    promos = spark.createDataFrame([
        ("A", "2018", "a", "1", "20180105", "20180116", "c", "p", "m"), ("B", "2018", "b", "1", "20180110", "20180112", "c", "p", "m"),
        ("X", "2018", "x", "1", "20180120", "20180110", "c", "p", "m"), ("Y", "2018", "y", "1", "20171230", "20180103", "c", "p", "m"),
    ], "COD_PROMOCION string, EJER_PROMOCION string, DESCRIPCION string, COD_TP_PROMOCION string, FEC_INICIO string, FEC_FIN string, COD_TP_IMP_OFERTA string, COD_PERFIL string, DESC_PLAN_PUBLI string")
    known = dims.campaign(promos, cal)
    assert sorted(r.promo_id for r in known.collect()) == ["A", "B"]
    days = dims.campaign_days(known, cal)
    per = {r.promo_id: r.n for r in days.groupBy("promo_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per == {"A": 12, "B": 3}
    weeks = {r.w for r in days.where("promo_id = 'A'").select(F.to_date(F.date_trunc("week", "date")).alias("w")).collect()}
    assert len(weeks) == 3


def test_allocation_adds_up_to_the_day(spark):
    day = D(2018, 1, 4)
    offers = spark.createDataFrame(
        [("A", 2018, "r", "s", "20", "x", None, f"buy {i} pay 1", None, None, 0, 0, 0, 0, 0, n) for i, n in ((2, 2), (3, 2))]
        + [("B", 2018, "r", "s", "20", "x", None, "buy 4 pay 3", None, None, 0, 0, 0, 0, 0, 1)],
        "promo_id string, promo_year long, sku_root_id string, store_id string, promo_mechanic string, promo_mechanic_description string, "
        "discount_depth_rank decimal(18,6), discount_depth string, std_price decimal(10,2), discounted_price_promo decimal(18,4), leaflet_cover int, "
        "leaflet_priv_space int, in_leaflet_flag int, in_gondola_flag int, in_both_leaflet_gondola_flag int, n_promo_mech long")
    days = spark.createDataFrame([("A", 2018, day), ("B", 2018, day)], "promo_id string, promo_year long, date date")
    acts = actual(spark, [(day, "r", "s", "A", 2018, Decimal(6), Decimal(1)), (day, "r", "s", None, None, Decimal(8), Decimal(1))])
    filled = facts.gap_fill(facts.grid_with_promos(acts.select("sku_root_id", "store_id", "date").distinct(), days.withColumns({"sku_root_id": F.lit("r"), "store_id": F.lit("s")})), acts)
    rows = promo_facts.allocate(promo_facts.promo_daily(offers, promo_facts.offer_days(offers, days, facts.daily(filled), filled)))
    got = {r.discount_depth: float(r.total_sale_qty) for r in rows.collect()}
    assert got == {"buy 2 pay 1": 5.0, "buy 3 pay 1": 5.0, "buy 4 pay 3": 4.0}
    assert sum(got.values()) == 14


def test_customer_age_and_status(spark):
    df = spark.createDataFrame([("1", "ALTA", None, "ALTA PENDIENTE CONFIRMACION", "F", "02/12/1990", "9"), ("2", None, "BAJA", "ALTA", "M", "30/11/1990", "9")],
                               "ID_CLIENTE_HUB string, DESC_ESTATUS_TARJ_CLUB string, DESC_ESTATUS_SOCIO_ORO string, DESC_ESTATUS_TARJ_TRAVEL string, COD_SEXO string, FECHADENACIMIENTO string, CP string")
    a, b = sorted(dims.customer(df, D(2019, 12, 1)).collect(), key=lambda r: r.customer_id)
    assert (a.club_loyalty_member, a.gold_member, a.travel_card_member, a.age) == ("1", None, dims.PENDING, 28)
    assert (b.club_loyalty_member, b.gold_member, b.age) == (None, "1", 29)


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_daily_sums_meet_the_campaigns_as_days(spark):
    trans = actual(spark, [
        (D(2018, 3, 5), "r", "s", "P", 2018, Decimal(2), Decimal(4)), (D(2018, 3, 5), "r", "s", "P", 2018, Decimal(3), None), (D(2018, 3, 5), "r", "s", None, None, Decimal(1), Decimal(6)),
        (D(2018, 3, 9), "r", "s", "P", 2018, Decimal(5), Decimal(2)), (D(2018, 3, 9), "r", "s", None, None, Decimal(7), Decimal(5)), (D(2018, 3, 5), "other", "s", None, None, Decimal(9), None),
    ]).withColumn("oferta_promo_total_sale_qty", F.col("total_sale_qty"))
    windows = spark.createDataFrame([("r", "s", "P", 2018, D(2018, 3, 1), D(2018, 3, 7))], "sku_root_id string, store_id string, promo_id string, promo_year long, start_date date, end_date date")
    found = facts.daily_root_promo(trans, spark.createDataFrame([("r",)], "sku_root_id string"), windows)
    got = {(r.date.day, r.promo_id): (int(r.total_sale_qty), int(r.oferta_promo_total_sale_qty), float(r.std_price_per_unit)) for r in found.collect()}
    assert got == {(5, "P"): (5, 5, 4.0), (5, None): (1, 0, 6.0), (9, None): (12, 0, 3.5)}
    assert plan_of(found).count("Aggregate [date") == 2


def test_vendor_funding_does_not_fan_offers_out_to_days(spark):
    trans = spark.createDataFrame([("a", "r", "s", D(2018, 3, 5), Decimal(2)), ("a", "r", "s", D(2018, 3, 9), Decimal(4)), ("b", "r", "s", D(2018, 3, 5), Decimal(1))], f"sku_id string, sku_root_id string, store_id string, date date, total_sale_qty {MONEY}")
    paid = spark.createDataFrame([("a", "s", 20180305, Decimal(6)), ("a", "s", 20180309, Decimal(40))], f"COD_ART string, COD_LOC string, DIA int, IMP_REDENCION {MONEY}").withColumns({c: F.lit(0).cast(MONEY) for c in ("IMP_REDENCION_PS", "IMP_REDENCION_OSS")})
    offers = spark.createDataFrame([("a", "r", "s", "P", 2018), ("a", "r", "s", "Q", 2018), ("a", "r", "s", "P", 2018), ("b", "r", "t", "P", 2018)], "sku_id string, sku_root_id string, store_id string, promo_id string, promo_year long")
    days = spark.createDataFrame([("P", 2018, D(2018, 3, 5)), ("Q", 2018, D(2018, 3, 5)), ("Q", 2018, D(2018, 3, 9))], "promo_id string, promo_year long, date date")
    found = dims.vendor_funding(trans, paid, offers, days)
    assert [(r.sku_id, round(float(r.expected_vendor_funding_per_unit), 6)) for r in found.collect()] == [("a", round((3 + 3 + 10) / 3, 6))]
    joins = [line for line in plan_of(found).splitlines() if "Join" in line and "promo_year" in line]
    assert joins and all("sku_id" in line for line in joins)


def placements(spark, make):
    """Keys of the hash exchanges of a frame where no side of a join is broadcast."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        plan = make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(broadcast, before)
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]


def test_vendor_funding_places_days_and_offers_once(spark):
    trans = spark.createDataFrame([], f"sku_id string, sku_root_id string, store_id string, date date, total_sale_qty {MONEY}")
    paid = spark.createDataFrame([], f"COD_ART string, COD_LOC string, DIA int, IMP_REDENCION {MONEY}, IMP_REDENCION_PS {MONEY}, IMP_REDENCION_OSS {MONEY}")
    offers = spark.createDataFrame([], "sku_id string, sku_root_id string, store_id string, promo_id string, promo_year long")
    days = spark.createDataFrame([], "promo_id string, promo_year long, date date")
    trans, paid, offers, days = (df.repartition(3) for df in (trans, paid, offers, days))
    keys = placements(spark, lambda: dims.vendor_funding(trans, paid, offers, days))
    assert keys.count("sku_id, store_id, date") == 1
    assert not any(k.startswith("sku_root_id") or "_root" in k.split(", ") for k in keys)


def test_only_lines_with_a_code_are_placed_for_their_offer(spark):
    deals = [("P", "2018"), ("P", "2017"), ("Z", "2018"), ("P", None), ("0", "2018"), (None, "2018"), (None, None)]
    rows = [("s", "20180305 10:00", "1", str(i), "20180305", "a", c, y, "9", "N") for i, (c, y) in enumerate(deals)]
    rows += [("t", *rows[0][1:]), (*rows[0][:5], "b", *rows[0][6:]), ("s", "20190305 10:00", *rows[0][2:]), (*rows[0][:9], "X")]
    lines = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in ("COD_LOC", "HORA_EMISION", "COD_CAJA", "NUM_TICKET", "DIA", "COD_ART", "COD_OFERTA", "ANO_OFERTA", "ID_CLIENTE", "COD_TIPO_MOVIM")))
    one, zero = F.lit(1).cast(MONEY), F.lit(0).cast(MONEY)
    lines = lines.withColumns({f"{m}_{c}": one if c == "OFERTA" else zero for m in ("IMP_VENTA", "UNID_VENTA", "MARGEN") for c in sales.COMPONENTS})
    lines = lines.withColumns({"IMP_PVP_TARIFA": F.lit(2).cast(MONEY), **{c: zero for c in sales.OTHER_DISCOUNTS}})
    stores, skus = spark.createDataFrame([("s",)], "store_id string"), spark.createDataFrame([("a", "r")], "sku_id string, sku_root_id string")
    offers = spark.createDataFrame([("P", 2018, "a", "r", "s"), ("P", 2018, "a", "r", "s"), ("0", 2018, "a", "r", "s")], "promo_id string, promo_year long, sku_id string, sku_root_id string, store_id string")

    def found():
        return sales.lin_transaction(lines, stores, dims.calendar_between(spark, D(2018, 3, 1), D(2018, 3, 9)), skus, offers)

    got = sorted((r.transaction_id.split("_")[3], r.sku_root_id, r.promo_id, r.promo_year, r.sale_type, int(r.total_sale_qty)) for r in found().collect())
    assert got == [("0", "r", "P", 2018, sales.OFFER, 1)] + [(str(i), "r", None, None, sales.NO_OFFER, 1) for i in range(1, 7)]
    assert "Union" in plan_of(found()) and "none" not in plan_of(found())
    assert sum(k.startswith("_code") for k in placements(spark, found)) == 1


def test_ticket_products_are_summed_after_one_shuffle_by_day(spark):
    lin = open_mart(spark, "/root/testdata/sf0.001")["lin"]
    plan = sales.transaction_to_sku(lin)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(sku_root_id" in plan and "hashpartitioning(transaction_id" not in plan


def test_offer_parts_follow_from_the_sums_of_their_sale_type(spark):
    rows = [("1", sales.OFFER, 8, 1), ("1", sales.OFFER, 4, None), ("1", sales.OFFER, 2, 0), ("1", sales.COMBO, 6, 1), ("2", sales.COMBO, 5, 2), ("2", sales.COMBO, 1, 1),
            ("2", sales.NON_MATCHING, 3, 0), ("2", sales.NO_OFFER, 7, 0), ("3", sales.OFFER, 4, None)]
    lin = spark.createDataFrame([(t, k, Decimal(o), None if s is None else Decimal(s)) for t, k, o, s in rows], f"transaction_id string, sale_type string, o {MONEY}, s {MONEY}")
    zero, whole = F.lit(0).cast(MONEY), (F.col("o") + F.col("s")).cast(MONEY)
    lin = lin.withColumns({
        **{f"{m}_{c}": F.col("o") if c == "OFERTA" else F.col("s") if c == "TARIFA" else zero for m in ("IMP_VENTA", "UNID_VENTA", "MARGEN") for c in sales.COMPONENTS},
        **{m: whole for m in ("total_sale_amt", "total_sale_qty", "total_margin_amt")},
        **{m: zero for m in ("total_non_oferta_discount_amt", "total_non_oferta_discount_amt_ex_vale")},
        **{c: F.lit(c) for c in ("sku_id", "sku_root_id", "store_id", "promo_id", "customer_id", "time")},
        "IMP_PVP_TARIFA": F.lit(10).cast(MONEY), "promo_year": F.lit(2018).cast("long"), "date": F.lit(D(2018, 3, 5)),
    })
    found = sales.transaction_to_sku(lin)
    got = {(r.transaction_id, r.sale_type): tuple(None if r[f"oferta_promo_total_{m}"] is None else int(r[f"oferta_promo_total_{m}"]) for m in ("sale_amt", "sale_qty", "margin_amt", "discount_amt"))
           for r in found.collect()}
    assert got == {
        ("1", sales.OFFER): (11, 11, 11, -9), ("1", sales.COMBO): (6, 6, 6, -3), ("2", sales.COMBO): (6, 6, 6, -11), ("2", sales.NON_MATCHING): (3, 3, 3, -7),
        ("2", sales.NO_OFFER): (0, 0, 0, 0), ("3", sales.OFFER): (None, None, None, None),
    }
    assert found.columns[10:] == [*MEASURES, "std_price_per_unit"]
    assert "sum(oferta_promo_total_discount_amt" in plan_of(found) and "sum(oferta_promo_total_sale_amt" not in plan_of(found)


def test_kept_tables_join_small_parts_without_sorting(spark):
    limit, broadcast = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "spark.sql.autoBroadcastJoinThreshold"
    before, usual = spark.conf.get(limit), spark.conf.get(broadcast)

    def joined():
        left, right = (spark.range(100).select(F.col("id").alias("k"), (F.col("id") * n).alias(f"v{n}")) for n in (2, 3))
        df = left.join(right, "k", "left")
        assert df.where("v2 = 10").select("v3").collect()[0].v3 == 15 and len(df.collect()) == 100
        return "ShuffledHashJoin" in df._jdf.queryExecution().executedPlan().toString()

    spark.conf.set(broadcast, "-1")
    try:
        assert not joined()
        with hash_joins(spark):
            assert joined()
        assert spark.conf.get(limit) == before
        spark.conf.set(limit, "65m")
        with hash_joins(spark):
            assert spark.conf.get(limit) == "65m"
    finally:
        spark.conf.set(broadcast, usual)
        spark.conf.set(limit, before)


def test_plain_numbers(spark):
    texts = ["15.0", "2.50", "0.00", "100", "-7.10", "1.0E10", "1.50E-7", "3.", "NaN", None, "10.05"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    before = F.regexp_replace(F.regexp_replace("t", r"(\.\d*?)0+$", "$1"), r"\.$", "")
    assert all(r.a == r.b for r in df.select(plain("t").alias("a"), before.alias("b")).collect())
    assert "RegExp" not in plan_of(df.select(plain("t"))) and "regexp" not in plan_of(df.select(plain("t")))
