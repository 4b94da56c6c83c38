"""Offer decoding: every branch and the boundaries of the depth steps."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from promolens.functions.numeric import depth_step, plain
from promolens.operators.offers import decode, promo_to_sku
from promolens.sources import retail_adapter

NUM = "decimal(10,4)"
FIELDS = ["PVP_TARIFA", "CANT_N", "CANT_M", "UMBRAL1", "PVPUMBRAL1", "DESCUMBRAL1", "UMBRAL2", "PVPUMBRAL2", "DESCUMBRAL2", "UMBRAL3", "PVPUMBRAL3"]
TEXT = ["year_sem", "COD_OFERTA", "ANO_OFERTA", "COD_ART", "COD_LOC", "COD_TIPOOFERTA", "COD_PRECIO", "COD_PORTADA", "COD_DESTACAR", "COD_FOLLETO",
        "COD_GONDOLA", "COD_BLOQUE", "IMPLANTAH", "IMPLANTAM", "IMPLANTAB", "CABSECCM", "CABSECCB"]

CASES = [
    ("20", dict(CANT_N=3, CANT_M=2), "buy 3 pay 2", 33.333333),
    ("40", dict(CANT_N=2, CANT_M="1.5"), "buy 2 pay 1.5", 25.0),
    ("30", dict(CANT_N=0, CANT_M=1), "buy 0 pay 1", None),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1=12), "10% off", 10.0),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1="12.5"), "15% off", 15.0),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1=5), "5% off", 5.0),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1="2.5"), "2.5% off", 2.5),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1="1.25"), "2.5% off", 2.5),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1=0), "0% off", 0.0),
    ("60", dict(UMBRAL1=1, DESCUMBRAL1=-3), None, None),
    ("60", dict(UMBRAL1=0, PVPUMBRAL1=10, UMBRAL2=1, DESCUMBRAL2=23), "25% off", 25.0),
    ("60", dict(UMBRAL1=0, PVPUMBRAL1=10, UMBRAL2=2, PVPUMBRAL2=8), "20% off", 20.0),
    ("60", dict(UMBRAL1=0, PVPUMBRAL1=10, UMBRAL2=2, PVPUMBRAL2=11), None, None),
    ("60", dict(UMBRAL1=1, PVPUMBRAL1=10), "buy 1 at 10", None),
    ("60", dict(UMBRAL1=1, PVPUMBRAL1=10, UMBRAL2=2, PVPUMBRAL2="9.50"), "buy 1 at 10, buy 2 at 9.5", None),
    ("60", dict(UMBRAL1=1, PVPUMBRAL1=10, UMBRAL2=2, PVPUMBRAL2=9, UMBRAL3=3, PVPUMBRAL3=8), "buy 1 at 10, buy 2 at 9, buy 3 at 8", None),
    ("10", dict(), None, None),
    ("50", dict(), None, None),
]


def offer(code, **values):
    row = {**dict.fromkeys(TEXT), **dict.fromkeys(FIELDS), "COD_TIPOOFERTA": code, "ANO_OFERTA": "2018", "PVP_TARIFA": Decimal(7)}
    row.update({k: v if k in TEXT else Decimal(str(v)) for k, v in values.items()})
    return row


def raw(spark, rows):
    schema = ", ".join([f"{c} string" for c in TEXT] + [f"{c} {NUM}" for c in FIELDS])
    return spark.createDataFrame([[r[c] for c in TEXT + FIELDS] for r in rows], schema)


def decoded(spark, rows):
    return decode(raw(spark, rows))


def test_depth_of_every_shape(spark):
    rows = [{**offer(code, **values), "COD_ART": str(i)} for i, (code, values, _, _) in enumerate(CASES)]
    got = {r.sku_id: r for r in decoded(spark, rows).collect()}
    for i, (_, _, text, rank) in enumerate(CASES):
        assert got[str(i)].discount_depth == text, CASES[i]
        found = got[str(i)].discount_depth_rank
        assert (found is None and rank is None) or float(found) == pytest.approx(rank), CASES[i]


def test_prices_and_flags(spark):
    rows = [offer("10", COD_PRECIO="5.40", COD_PORTADA="P"), offer("60", UMBRAL1=0, PVPUMBRAL1=9, COD_GONDOLA="G", COD_FOLLETO="F")]
    cut, stepped = sorted(decoded(spark, rows).collect(), key=lambda r: r.promo_mechanic)
    assert float(cut.std_price) == 7 and float(cut.discounted_price_promo) == 5.4
    assert (cut.leaflet_cover, cut.in_leaflet_flag, cut.in_gondola_flag, cut.in_both_leaflet_gondola_flag) == (1, 1, 0, 0)
    assert float(stepped.std_price) == 9 and stepped.discounted_price_promo is None
    assert (stepped.brochure, stepped.in_both_leaflet_gondola_flag) == (1, 1)


def test_step_and_label(spark):
    values = [(5.0, 5.0), (5.01, 5.0), (7.5, 10.0), (1.25, 2.5), (1.24, 0.0), (-0.1, None)]
    df = spark.createDataFrame(values, "x double, want double").withColumn("got", depth_step(F.col("x")))
    assert all(r.got == r.want for r in df.collect())
    labels = spark.createDataFrame([("15.0", "15"), ("2.50", "2.5"), ("900.10", "900.1"), ("100", "100")], "x string, want string")
    assert all(r.got == r.want for r in labels.withColumn("got", plain("x")).collect())


def test_raw_offers_are_shuffled_and_decoded_ones_are_not(spark):
    deal = dict(COD_OFERTA="P", COD_ART="a", COD_LOC="s")
    rows = [offer("20", **deal, CANT_N=3, CANT_M=2)] * 2 + [offer("20", **deal, CANT_N=4, CANT_M=3), offer("10", **{**deal, "COD_ART": "b"}, COD_PRECIO="5.40")]
    rows += [offer("10", **{**deal, **other}) for other in ({"COD_OFERTA": "Q"}, {"COD_ART": "c"}, {"COD_LOC": "t"})]
    known = [("P", 2018)], [("a", "r"), ("b", "q")], [("s",)]
    named = "promo_id string, promo_year long", "sku_id string, sku_root_id string", "store_id string"
    found = promo_to_sku(raw(spark, rows), *[F.broadcast(spark.createDataFrame(k, n)) for k, n in zip(known, named)])
    placed = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(placed) == 1 and "hashpartitioning(COD_ART" in placed[0]
    assert sorted((r.sku_id, r.sku_root_id, str(r.discount_depth)) for r in found.collect()) == [("a", "r", "buy 3 pay 2"), ("a", "r", "buy 4 pay 3"), ("b", "q", "None")]


def test_derived_offers_are_placed_once_while_narrow(spark):
    tables = retail_adapter.read_tables(spark, "/root/testdata/sf0.001")
    derived = retail_adapter.offers(tables)
    known = [("P", 2018)], [("a", "r")], [("s",)]
    named = "promo_id string, promo_year long", "sku_id string, sku_root_id string", "store_id string"
    found = promo_to_sku(derived, *[F.broadcast(spark.createDataFrame(k, n)) for k, n in zip(known, named)])
    placed = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert len(placed) == 1 and "hashpartitioning(COD_ART" in placed[0]
    cells = retail_adapter._sold(tables).select("p_partkey", "s_nationkey", "y", "m", "phase").distinct()
    want = cells.agg(F.sum(F.when(F.col("phase") == 0, 2).when(F.col("phase") == 2, 0).otherwise(1))).scalar()
    assert derived.count() == derived.distinct().count() == spark.range(1).select(want).collect()[0][0]
    assert derived.columns[:5] == ["year_sem", "COD_OFERTA", "ANO_OFERTA", "COD_ART", "COD_LOC"]
    odd = derived.where((F.substring("COD_OFERTA", 2, 4) != F.col("ANO_OFERTA")) | (F.substring("COD_OFERTA", 6, 2) != F.substring("year_sem", 8, 2)))
    assert odd.count() == 0
