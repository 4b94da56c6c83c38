"""Decoding of offers into mechanic, price and discount depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import depth_step, fixed, percent_off, plain, ratio

# Offer codes and their descriptions.
MECHANICS = {
    "10": "OFFER PRICE-PRODUCT",
    "20": "OFFER N * M CONSTANT",
    "30": "OFFER N * H heterogenous SAME PVP",
    "40": "OFFER N * H heterogenous GIFT",
    "50": "GIFT OFFER",
    "60": "N OFFER BETTER THAN M",
    "70": "Virtual LOT",
    "72": "LOT VIRTUAL GIFT",
    "73": "VIRTUAL LOT BLOCK UNICO",
    "75": "Savings offer",
    "99": "FICTIONAL",
}
MULTI_BUY = ("20", "30", "40")
STEPPED = "60"
PRICE_CUT = "10"


def _missing(*names: str) -> Column:
    test = F.lit(True)
    for n in names:
        test = test & F.col(n).isNull()
    return test


def _given(*names: str) -> Column:
    test = F.lit(True)
    for n in names:
        test = test & F.col(n).isNotNull()
    return test


def _stepped_percent() -> Column:
    """Discount percentage of a stepped offer in one of its three readable shapes."""
    first = F.col("UMBRAL1")
    straight = (first == 1) & _missing("PVPUMBRAL1", "UMBRAL2") & _given("DESCUMBRAL1")
    second_off = (
        (first == 0) & (F.col("UMBRAL2") == 1)
        & _given("PVPUMBRAL1", "DESCUMBRAL2") & _missing("PVPUMBRAL2", "UMBRAL3")
    )
    second_price = (
        (first == 0) & _given("PVPUMBRAL1", "UMBRAL2", "PVPUMBRAL2") & _missing("DESCUMBRAL2", "UMBRAL3")
    )
    return (
        F.when(straight, F.col("DESCUMBRAL1").cast("double"))
        .when(second_off, F.col("DESCUMBRAL2").cast("double"))
        .when(second_price, 100 * (1 - ratio("PVPUMBRAL2", "PVPUMBRAL1")))
    )


# Numbers that texts show.
SHOWN = ["CANT_N", "CANT_M", "PVPUMBRAL1", "UMBRAL2", "PVPUMBRAL2", "UMBRAL3", "PVPUMBRAL3"]


def _price_ladder() -> Column:
    """'buy 1 at P, buy 2 at P2, ...' for stepped offers that give prices."""
    priced = (F.col("UMBRAL1") == 1) & _given("PVPUMBRAL1")
    return F.when(
        priced,
        F.when(_missing("UMBRAL2"), F.col("_rung1"))
        .when(_given("PVPUMBRAL2") & _missing("UMBRAL3"), F.concat("_rung1", "_rung2"))
        .when(_given("PVPUMBRAL2", "PVPUMBRAL3"), F.concat("_rung1", "_rung2", "_rung3")),
    )


def _with_depth(offers: DataFrame) -> DataFrame:
    """Raw offers with the parts of depth and text that are used more than once.

    As columns of their own they are computed once a row; written out in place they grow the generated method of
    the whole stage beyond what the virtual machine compiles.
    """
    code = F.col("COD_TIPOOFERTA")
    multi, stepped = code.isin(*MULTI_BUY), code == STEPPED

    def rung(n: int) -> Column:
        count = F.lit("buy 1") if n == 1 else F.concat(F.lit(", buy "), F.col(f"_UMBRAL{n}"))
        return F.concat(count, F.lit(" at "), F.col(f"_PVPUMBRAL{n}"))

    return (
        offers.withColumns({"_percent": F.when(stepped, _stepped_percent()), **{f"_{c}": F.col(c).cast("string") for c in SHOWN}})
        .withColumns({"_step": depth_step(F.col("_percent")), **{f"_{c}": plain(f"_{c}") for c in SHOWN}})
        .withColumns({
            "_rank": F.when(multi, 100 * (1 - ratio("CANT_M", "CANT_N"))).otherwise(F.col("_step")),
            "_step_text": F.col("_step").cast("string"),
            **{f"_rung{n}": rung(n) for n in (1, 2, 3)},
        })
    )


def decode(offers: DataFrame) -> DataFrame:
    """Mechanic, prices, depth and display flags of every raw offer row."""
    code = F.col("COD_TIPOOFERTA")
    described = F.element_at(F.create_map(*[F.lit(x) for kv in MECHANICS.items() for x in kv]), code)
    multi, stepped = code.isin(*MULTI_BUY), code == STEPPED
    text = F.when(
        multi, F.concat(F.lit("buy "), F.col("_CANT_N"), F.lit(" pay "), F.col("_CANT_M"))
    ).when(stepped, F.coalesce(_price_ladder(), percent_off(F.col("_step_text"))))
    cover, priv, brochure, gondola = (
        F.col(c).isNotNull() for c in ("COD_PORTADA", "COD_DESTACAR", "COD_FOLLETO", "COD_GONDOLA")
    )
    leaflet = cover | priv | brochure
    from_first = stepped & (F.col("UMBRAL1") == 0) & _given("PVPUMBRAL1")
    return _with_depth(offers).select(
        "year_sem",
        F.col("COD_OFERTA").alias("promo_id"),
        F.col("ANO_OFERTA").cast("long").alias("promo_year"),
        F.col("COD_ART").alias("sku_id"),
        F.col("COD_LOC").alias("store_id"),
        code.alias("promo_mechanic"),
        described.alias("promo_mechanic_description"),
        F.when(from_first, F.col("PVPUMBRAL1")).otherwise(F.col("PVP_TARIFA")).alias("std_price"),
        F.when(code == PRICE_CUT, F.col("COD_PRECIO").cast("decimal(18,4)")).alias("discounted_price_promo"),
        fixed("_rank").alias("discount_depth_rank"),
        F.col("CANT_M").alias("no_to_pay"),
        F.col("CANT_N").alias("no_to_buy"),
        text.alias("discount_depth"),
        cover.cast("int").alias("leaflet_cover"),
        priv.cast("int").alias("leaflet_priv_space"),
        brochure.cast("int").alias("brochure"),
        leaflet.cast("int").alias("in_leaflet_flag"),
        F.col("COD_GONDOLA").alias("gondola_desc"),
        gondola.cast("int").alias("in_gondola_flag"),
        (leaflet & gondola).cast("int").alias("in_both_leaflet_gondola_flag"),
        F.col("COD_BLOQUE").alias("promo_group_code"),
        F.col("IMPLANTAH").alias("marketing_ad_desc_1"),
        F.col("IMPLANTAM").alias("marketing_ad_desc_2"),
        F.col("IMPLANTAB").alias("marketing_ad_desc_3"),
        F.col("CABSECCM").alias("store_placement_desc_1"),
        F.col("CABSECCB").alias("store_placement_desc_2"),
    )


def promo_to_sku(offers: DataFrame, campaigns: DataFrame, skus: DataFrame, stores: DataFrame) -> DataFrame:
    """Offers of known campaigns, products and stores.

    Raw rows are narrower than decoded ones, so they are placed by product before they are decoded. The join with the
    products and the removal of repeated rows find that placement and need no other shuffle.
    """
    return (
        decode(offers.repartition("COD_ART"))
        .join(campaigns, ["promo_id", "promo_year"], "left_semi")
        .join(stores, "store_id", "left_semi")
        .join(skus.select("sku_id", "sku_root_id"), "sku_id")
        .distinct()
    )
