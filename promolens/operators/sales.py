"""Ticket lines, ticket products and tickets."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import MONEY, col, fixed, mean_of, money_sum, ratio

# Suffixes of the five sale components in the raw lines and in the facts.
COMPONENTS = {"TARIFA": "std", "OFERTA": "discount", "LIQUID": "markdown", "CAMPANA": "campaign", "COMPETE": "other"}
# Raw discount columns outside the offer scheme.
OTHER_DISCOUNTS = [
    "IMP_DTO_VALE", "IMP_DTO_TRAVEL", "IMP_DTO_TMONEDERO", "IMP_DTO_OTROS", "IMP_DTO_ONSITE",
    "IMP_DTO_CUPON", "IMP_DTO_CUOTA", "IMP_DTO_CONSUMER", "IMP_CONSUMO_RAP",
]
# Labels of the sale types.
NON_PROMO = "Non-promo sale during oferta promo"
OTHER_PROMO = "Non-oferta promo sale during oferta promo"
OFFER = "Oferta promo sale during oferta promo"
COMBO = "Combo promo sale during oferta promo"
NON_MATCHING = "Oferta promo sale non matching during oferta promo"
OTHER = "Other sale during oferta promo"
NO_OFFER = "Non-oferta sale"

OFFER_MEASURES = [
    "oferta_promo_total_sale_amt", "oferta_promo_total_sale_qty",
    "oferta_promo_total_margin_amt", "oferta_promo_total_discount_amt",
]
PLAIN_MEASURES = [
    *[f"total_{kind}_{part}" for kind in ("sale_amt", "sale_qty", "margin_amt") for part in COMPONENTS.values()],
    "total_sale_amt", "total_sale_qty", "total_margin_amt",
    "total_non_oferta_discount_amt", "total_non_oferta_discount_amt_ex_vale", "total_price_if_sku_std_price",
]
MEASURES = PLAIN_MEASURES + OFFER_MEASURES
PLACE = ["sku_root_id", "store_id", "date"]


def ticket_key() -> Column:
    parts = ["COD_LOC", "HORA_EMISION", "COD_CAJA", "NUM_TICKET", "DIA"]
    pieces = [F.col(parts[0])]
    for p in parts[1:]:
        pieces += [F.lit("_"), F.col(p)]
    return F.concat(*pieces)


def _total(names: list[str]) -> Column:
    return reduce(add, [F.col(n) for n in names]).cast(MONEY)


def sale_type() -> Column:
    """How a line under a known offer was really sold."""
    lst, offer, other = (F.col(c) for c in ("IMP_PVP_TARIFA", "IMP_VENTA_OFERTA", "total_non_oferta_discount_amt"))
    rest = _total([f"IMP_VENTA_{c}" for c in COMPONENTS if c != "OFERTA"])
    at_list = offer == lst
    by_other = (rest > 0) & (other != 0) & (lst + other >= rest)
    known = (
        F.when(at_list & (other == 0), NON_PROMO)
        .when(at_list & (other != 0), OTHER_PROMO)
        .when(lst + other == offer, OTHER_PROMO)
        .when((lst > offer) & (other == 0), OFFER)
        .when((lst + other > offer) & (other < 0), COMBO)
        .when(offer > 0, NON_MATCHING)
        .when(by_other, OTHER_PROMO)
        .otherwise(OTHER)
    )
    return F.when(F.col("promo_id").isNotNull() & F.col("promo_year").isNotNull(), known).otherwise(NO_OFFER)


def lin_transaction(
    lines: DataFrame, stores: DataFrame, cal: DataFrame, skus: DataFrame, promo_to_sku: DataFrame, in_place: bool = False
) -> DataFrame:
    """Ordinary sale lines with their offer, totals and sale type.

    Most lines carry no offer code. They have no offer to find, so only the lines with a code are placed for the join
    with the offers. ``in_place`` says that lines and offers come placed by product; then all lines meet the offers where
    they are (``session.joins_in_place``) and are read once. Lines go on to their day, root and store before totals and
    keys are derived, which only widen them.
    """
    stamp = F.to_timestamp("HORA_EMISION", "yyyyMMdd HH:mm")
    offered = promo_to_sku.select("promo_id", "promo_year", "sku_id", "store_id").distinct().select(
        F.col("promo_id").alias("_code"),
        F.col("promo_year").alias("_year"),
        "sku_id", "store_id", "promo_id", "promo_year",
    )
    kept = lines.where(
        (F.col("COD_TIPO_MOVIM") == "N") & F.col("COD_LOC").isNotNull() & F.col("HORA_EMISION").isNotNull()
    )
    # Known places, days and products are sought before the totals, which would only widen the rows of the joins.
    known = (
        kept.select("*", F.col("COD_ART").alias("sku_id"), F.col("COD_LOC").alias("store_id"), F.to_date(stamp).alias("date"))
        .join(stores.select("store_id"), "store_id", "left_semi")
        .join(cal.select("date"), "date", "left_semi")
        .join(skus.select("sku_id", "sku_root_id"), "sku_id")
    )
    keyed = [
        ticket_key().alias("transaction_id"), "sku_id", "sku_root_id", "store_id",
        F.col("ID_CLIENTE").alias("customer_id"), "date",
        F.date_format(stamp, "HH:mm:ss").alias("time"),
        "IMP_PVP_TARIFA",
        *[f"{m}_{c}" for m in ("IMP_VENTA", "UNID_VENTA", "MARGEN") for c in COMPONENTS],
        *OTHER_DISCOUNTS,
        _total([f"IMP_VENTA_{c}" for c in COMPONENTS]).alias("total_sale_amt"),
        _total([f"UNID_VENTA_{c}" for c in COMPONENTS]).alias("total_sale_qty"),
        _total([f"MARGEN_{c}" for c in COMPONENTS]).alias("total_margin_amt"),
        _total(OTHER_DISCOUNTS).alias("total_non_oferta_discount_amt"),
        _total(OTHER_DISCOUNTS[1:]).alias("total_non_oferta_discount_amt_ex_vale"),
    ]
    raw = [
        "sku_id", "sku_root_id", "store_id", "date", "HORA_EMISION", "COD_CAJA", "NUM_TICKET", "DIA", "ID_CLIENTE", "IMP_PVP_TARIFA",
        *[f"{m}_{c}" for m in ("IMP_VENTA", "UNID_VENTA", "MARGEN") for c in COMPONENTS], *OTHER_DISCOUNTS,
    ]
    code, year = F.col("COD_OFERTA"), F.col("ANO_OFERTA").cast("long")
    deal, place = ["_code", "_year"], ["sku_id", "store_id"]
    if in_place:  # in this order the rows are sorted by the key that tells most of them apart
        asked = known.select(*raw, F.when(code != "0", code).alias("_code"), year.alias("_year"))
        found = asked.join(offered, place + deal, "left").drop(*deal)
    else:
        coded = known.where(code != "0").select(*raw, code.alias("_code"), year.alias("_year"))
        plain = known.where(code.isNull() | (code == "0")).select(
            *raw, F.lit(None).cast("string").alias("promo_id"), F.lit(None).cast("long").alias("promo_year")
        )
        found = coded.join(offered, deal + place, "left").drop(*deal).unionByName(plain)
    placed = found.repartition(*PLACE).withColumn("COD_LOC", F.col("store_id"))
    return placed.select(*keyed, "promo_id", "promo_year").withColumn("sale_type", sale_type())


def transaction_to_sku(lin: DataFrame) -> DataFrame:
    """One row per ticket, product, offer and sale type."""
    kind = F.col("sale_type")
    lst, sale, ex_vale = (
        F.col(c) for c in ("IMP_PVP_TARIFA", "total_sale_amt", "total_non_oferta_discount_amt_ex_vale")
    )

    def attributed(whole: Column | str, part: Column | str) -> Column:
        return (
            F.when(kind == OFFER, col(whole))
            .when(kind.isin(COMBO, NON_MATCHING), col(part))
            .otherwise(F.lit(0))
            .cast(MONEY)
        )

    renamed = {
        **{f"total_sale_amt_{n}": F.col(f"IMP_VENTA_{c}") for c, n in COMPONENTS.items()},
        **{f"total_sale_qty_{n}": F.col(f"UNID_VENTA_{c}") for c, n in COMPONENTS.items()},
        **{f"total_margin_amt_{n}": F.col(f"MARGEN_{c}") for c, n in COMPONENTS.items()},
        "total_price_if_sku_std_price": lst,
        "oferta_promo_total_discount_amt": attributed(-F.abs(lst - sale), -F.abs(lst - sale + ex_vale)),
    }
    # All lines of a group have one sale type, so these are the group's total or its offer part and need no sum of their own.
    chosen = {f"oferta_promo_{m}": attributed(m, f"{m}_{COMPONENTS['OFERTA']}") for m in ("total_sale_amt", "total_sale_qty", "total_margin_amt")}
    summed = [m for m in MEASURES if m not in chosen]
    key = ["transaction_id", "sku_id", "sku_root_id", "store_id", "promo_id", "promo_year",
           "customer_id", "sale_type", "date", "time"]
    unit = fixed(ratio(lst, "total_sale_qty"))
    rows = lin.withColumns({**renamed, "_unit": unit}).select(*key, *summed, "_unit")
    # Hardly any two lines share a key, so sums before the shuffle would only widen it. Placed by day, root and store,
    # the rows of a daily sum are neighbours in the written table and combine where they are read.
    groups = rows.repartition(*PLACE).groupBy(*key).agg(
        *[money_sum(m).alias(m) for m in summed],
        fixed(mean_of("_unit")).alias("std_price_per_unit"),
    )
    return groups.withColumns(chosen).select(*key, *MEASURES, "std_price_per_unit")


def transaction(trans: DataFrame, headers: DataFrame) -> DataFrame:
    """Tickets with their header's sale kind."""
    heads = headers.select(ticket_key().alias("transaction_id"), F.col("COD_TIPO_VENTA").alias("type")).distinct()
    renamed = {"total_sale_qty": "total_sale_sku_qty", "total_margin_amt": "total_margin"}
    measures = [
        "total_sale_amt", "total_sale_qty", "total_margin_amt", "total_non_oferta_discount_amt",
        "total_non_oferta_discount_amt_ex_vale", "total_price_if_sku_std_price", *OFFER_MEASURES,
    ]
    tickets = trans.groupBy("transaction_id", "store_id", "date", "time", "customer_id").agg(
        *[money_sum(m).alias(renamed.get(m, m)) for m in measures]
    )
    return tickets.join(heads, "transaction_id", "left")
