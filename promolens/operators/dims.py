"""Calendar, product, store, campaign, root product and customer tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import day_name, each_day, month_name
from ..functions.numeric import RATE, fixed, mean_of, money_sum, ratio

# Fixed value: the status text of a membership that is still pending.
PENDING = "ALTA PENDIENTE CONFIRMACION"


def calendar(days: DataFrame) -> DataFrame:
    """Describe every day of a one-column ``date`` frame."""
    d = F.col("date")
    iso_week = F.weekofyear(d)
    blank = ["national_holiday_1", "national_holiday_2", "national_holiday_3",
             "national_event_1", "national_event_2", "national_event_3"]
    return days.select(
        "date",
        day_name(d).alias("day"),
        iso_week.alias("week"),
        F.concat(F.year(d).cast("string"), F.lit("SEM"), F.format_string("%02d", iso_week)).alias("year_sem"),
        month_name(d).alias("month"),
        F.dayofweek(d).isin(1, 7).alias("weekend"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        *[F.lit(None).cast("string").alias(c) for c in blank],
    )


def calendar_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    days = spark.range(1).select(each_day(F.lit(start), F.lit(end)).alias("date"))
    return calendar(days)


def calendar_covering(df: DataFrame, day: Column) -> DataFrame:
    """Whole Monday weeks that cover the days of ``df``."""
    bounds = df.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    start = F.to_date(F.date_trunc("week", "a"))
    end = F.date_add(F.to_date(F.date_trunc("week", "b")), 6)
    return calendar(bounds.select(each_day(start, end).alias("date")))


def sku(
    articles: DataFrame,
    structure: DataFrame,
    markers: DataFrame,
    own_brands: DataFrame,
    net_costs: DataFrame,
    sales_locations: DataFrame,
    node: int,
    own_brand_name: str,
) -> DataFrame:
    """Saleable products with their five-level hierarchy, brand and cost."""
    first_location = (
        sales_locations.where(F.col("COD_NIVEL_ESTR_LOC") == node)
        .groupBy(F.col("COD_ARTICULO").cast("string").alias("COD_ART"))
        .agg(F.min(F.struct("COD_AMBITO", "AMBITO")).alias("loc"))
        .select("COD_ART", F.col("loc.AMBITO").alias("sales_loc"), F.col("loc.COD_AMBITO").alias("sales_loc_code"))
    )
    costs = net_costs.where(F.col("NETO_COMERCIAL").rlike(r"^[0-9,]+$")).select(
        F.col("PROVR_GEN").alias("COD_PROVR_GEN"),
        F.col("PROVR_TRABAJO").alias("COD_PROVR_TRABAJO"),
        "NOMBRE",
        F.col("COD_ARTICULO").alias("COD_ART"),
        F.replace("NETO_COMERCIAL", F.lit(","), F.lit(".")).try_cast("decimal(38,9)").alias("cost_per_unit"),
    )
    brands = own_brands.select(
        "COD_MARCA", "DESC_TIPOMARCA", "DESC_TIPOMARCA2",
        F.col("COD_POSICION_MARCA").cast("string").alias("COD_POSICION_MARCA"),
        "DESC_POSICION_MARCA",
        (F.col("FLG_MMPP") == 1).alias("is_own"),
        F.col("Premium_Normal_Non_premium").alias("own_label"),
    )
    levels = [F.col(f"COD_N{n}_PPAL") for n in range(1, 6)]
    path = levels[0]
    for level in levels[1:]:
        path = F.concat(path, F.lit("-"), level)
    is_own = F.coalesce("is_own", F.lit(False))
    saleable = articles.where(
        (F.col("FLG_BLOQ_DEFINITIVO") == "N") & F.col("COD_ART").isNotNull() & F.col("COD_ART_PRIM").isNotNull()
    )
    return (
        saleable.withColumn("l5", path)
        .join(structure, "l5", "left")
        .join(markers.withColumnRenamed("COD_ARTICULO", "COD_ART"), "COD_ART", "left")
        .join(brands, ["COD_MARCA", "DESC_TIPOMARCA", "DESC_TIPOMARCA2", "COD_POSICION_MARCA", "DESC_POSICION_MARCA"], "left")
        .join(costs, ["COD_PROVR_GEN", "COD_PROVR_TRABAJO", "NOMBRE", "COD_ART"], "left")
        .join(first_location, "COD_ART", "left")
        .select(
            F.col("COD_ART").alias("sku_id"),
            F.col("COD_ART_PRIM").alias("sku_root_id"),
            F.col("COD_EAN").alias("sku_ean_id"),
            F.col("DESC_TP_ARTICULO").alias("type"),
            F.col("DESC_ART").alias("description"),
            F.col("COD_N1_PPAL").alias("area_id"),
            F.coalesce("DESC_N1", "area2").alias("area"),
            F.col("COD_N2_PPAL").alias("section_id"),
            F.coalesce("DESC_N2", "section2").alias("section"),
            F.col("COD_N3_PPAL").alias("category_id"),
            F.coalesce("DESC_N3", "category2").alias("category"),
            F.col("COD_N4_PPAL").alias("subcategory_id"),
            F.coalesce("DESC_N4", "subcategory2").alias("subcategory"),
            F.col("COD_N5_PPAL").alias("segment_id"),
            F.coalesce("DESC_N5", "segment2").alias("segment"),
            F.when(is_own, own_brand_name).otherwise(F.col("COD_MARCA")).alias("brand_name"),
            F.col("COD_TALLA").alias("size"),
            F.col("DESC_TALLA").alias("size_desc"),
            F.col("COD_TIPO_FORMATO").alias("unit_desc"),
            F.col("COD_FORMATO").alias("unit"),
            F.col("COD_PACK").alias("units_per_pack"),
            F.col("DESC_COLOR").alias("color"),
            F.when(is_own, F.col("own_label")).alias("own_brand_label"),
            F.when(is_own, "Y").otherwise("N").alias("own_brand_flag"),
            F.col("FLG_SALUD_BIENESTAR").alias("flag_healthy"),
            F.col("MARCADOR_CASTE").alias("wow_flag"),
            F.col("FLG_INNOVACION").alias("innovation_flag"),
            F.col("FLG_GAMA_TURISTICA").alias("tourism_flag"),
            F.col("FLG_GAMA_LOCAL").alias("local_flag"),
            F.col("FLG_GAMA_REGIONAL").alias("regional_flag"),
            F.col("FLG_PODER_ADQUISITIVO").alias("wealthy_range_flag"),
            F.col("COD_PROVR_GEN").alias("generic_vendor_code"),
            F.col("COD_PROVR_TRABAJO").alias("working_vendor_code"),
            F.col("NOMBRE").alias("vendor_name"),
            "cost_per_unit",
            "sales_loc",
            "sales_loc_code",
        )
    )


def store(locations: DataFrame, companies: list[str]) -> DataFrame:
    return locations.where(F.col("DESC_SOCIEDAD").isin(companies)).select(
        F.col("COD_LOC").alias("store_id"),
        F.col("DESC_LOC").alias("name"),
        F.col("DESC_PROVIN").alias("store_geography_region"),
        F.col("DESC_POBLACION").alias("store_geography_location"),
        F.col("COD_POSTAL").alias("store_geography_postal"),
        F.col("DESC_DIRECCION").alias("store_geography_address"),
        F.col("DESC_SOCIEDAD").alias("business_area"),
        F.col("DESC_NEGOCIO").alias("business_desc"),
        F.col("DES_N1").alias("store_type1"),
        F.col("DESC_N2").alias("store_type2"),
        F.col("DESC_TP_LOC").alias("store_type_location"),
        F.col("FLG_CUOTA").alias("market_share"),
        F.col("FEC_INI_LOC").alias("opening_date"),
        F.col("FEC_FIN_LOC").alias("closing_date"),
        F.col("NUM_M2").alias("size_m2"),
        F.col("NUM_CAJAS").alias("n_isles"),
        F.col("FLG_LEAN").alias("store_desc_1"),
        F.col("FLG_TRANSFORMADO").alias("store_desc_2"),
        F.col("FLG_PUESTA_PUNTO_PLUS").alias("store_desc_3"),
    )


def campaign(promos: DataFrame, cal: DataFrame) -> DataFrame:
    """Campaigns whose first and last day are both in the calendar."""
    dated = promos.select(
        F.col("COD_PROMOCION").alias("promo_id"),
        F.col("EJER_PROMOCION").cast("long").alias("promo_year"),
        F.col("DESCRIPCION").alias("name"),
        F.col("COD_TP_PROMOCION").alias("type"),
        F.to_date("FEC_INICIO", "yyyyMMdd").alias("start_date"),
        F.to_date("FEC_FIN", "yyyyMMdd").alias("end_date"),
        F.col("COD_TP_IMP_OFERTA").alias("class"),
        F.col("COD_PERFIL").alias("customer_profile_type"),
        F.col("DESC_PLAN_PUBLI").alias("marketing_type"),
    ).where(F.col("end_date") >= F.col("start_date"))
    days = cal.select("date")
    return dated.join(days, F.col("start_date") == days["date"], "left_semi").join(
        days, F.col("end_date") == days["date"], "left_semi"
    )


def campaign_days(campaigns: DataFrame, cal: DataFrame) -> DataFrame:
    """Every calendar day of every campaign."""
    days = campaigns.select("promo_id", "promo_year", each_day("start_date", "end_date").alias("date"))
    return days.join(cal.select("date"), "date", "left_semi")


def vendor_funding(trans: DataFrame, redemptions: DataFrame, promo_to_sku: DataFrame, days: DataFrame) -> DataFrame:
    """Average vendor funding per unit over the days a product was on offer.

    A day under two campaigns counts twice. Days sold and offers are placed by product before they are summed or made
    distinct; where joins find their rows in place (``session.joins_in_place``), neither is shuffled again.
    """
    key, offer_key = ["sku_id", "store_id", "date"], ["sku_id", "store_id", "promo_id", "promo_year"]
    sold = trans.select("sku_root_id", *key, "total_sale_qty").repartition("sku_id").groupBy("sku_root_id", *key).agg(
        money_sum("total_sale_qty").alias("total_sale_qty")
    )
    paid = F.col("IMP_REDENCION_PS") + F.col("IMP_REDENCION_OSS") + F.col("IMP_REDENCION")
    funded = redemptions.groupBy(
        F.col("COD_ART").alias("sku_id"),
        F.col("COD_LOC").cast("string").alias("store_id"),
        F.to_date(F.col("DIA").cast("string"), "yyyyMMdd").alias("date"),
    ).agg(money_sum(paid).alias("funding"))
    # The days sold meet the campaigns of the day first, so offers never fan out to all days of their campaigns.
    offered = promo_to_sku.select(*offer_key, F.col("sku_root_id").alias("_root")).repartition("sku_id").distinct()
    unit = F.coalesce(fixed(ratio("funding", "total_sale_qty")), F.lit(0).cast(RATE))
    return (
        sold.join(funded, key, "left")
        .join(days.select("promo_id", "promo_year", "date"), "date")
        .join(offered, offer_key)
        .withColumn("unit", unit)
        .groupBy("sku_id", "sku_root_id")
        .agg(mean_of("unit").alias("expected_vendor_funding_per_unit"))
    )


def promo_days(promo_to_sku: DataFrame, days: DataFrame) -> DataFrame:
    """Offer products and stores on every day of their campaign."""
    offered = promo_to_sku.select("sku_id", "sku_root_id", "store_id", "promo_id", "promo_year").distinct()
    return days.join(offered, ["promo_id", "promo_year"]).select(
        "promo_id", "promo_year", "date", "sku_id", "sku_root_id", "store_id"
    )


def root_sku(trans: DataFrame, skus: DataFrame, funding: DataFrame) -> DataFrame:
    """Attributes of the best-selling child of every root; ties go to the lower id."""
    sales = trans.groupBy("sku_id").agg(F.sum("total_sale_amt").alias("_sales"))
    full = skus.join(funding.select("sku_id", "expected_vendor_funding_per_unit"), "sku_id", "left").join(sales, "sku_id")
    kept = [c for c in full.columns if c not in ("sku_id", "sku_root_id", "_sales")]
    best = full.groupBy("sku_root_id").agg(
        F.min_by(F.struct(*kept), F.struct((-F.col("_sales")).alias("a"), F.col("sku_id").alias("b"))).alias("best")
    )
    return best.select("sku_root_id", "best.*")


def sku_campaign_dates(campaigns: DataFrame, promo_to_sku: DataFrame, roots: DataFrame) -> DataFrame:
    dated = campaigns.select(
        "promo_id", "promo_year", "name", "start_date", "end_date",
        day_name("start_date").alias("start_day"),
        day_name("end_date").alias("end_day"),
    )
    offered = promo_to_sku.select("promo_id", "promo_year", "sku_root_id").distinct()
    return offered.join(dated, ["promo_id", "promo_year"]).join(roots, "sku_root_id")


def customer(customers: DataFrame, as_of: dt.date, club_status: str = "DESC_ESTATUS_TARJ_CLUB") -> DataFrame:
    """Membership flags and the age reached on ``as_of``."""
    today = F.lit(as_of)
    born = F.to_date("FECHADENACIMIENTO", "dd/MM/yyyy")
    years = F.year(today) - F.year(born)
    age = F.when(F.dayofyear(today) < F.dayofyear(born), years - 1).otherwise(years)

    def member(c: str) -> Column:
        return F.when(F.col(c) != PENDING, "1").otherwise(F.col(c))

    return customers.select(
        F.col("ID_CLIENTE_HUB").alias("customer_id"),
        member(club_status).alias("club_loyalty_member"),
        member("DESC_ESTATUS_SOCIO_ORO").alias("gold_member"),
        member("DESC_ESTATUS_TARJ_TRAVEL").alias("travel_card_member"),
        F.col("COD_SEXO").alias("gender"),
        age.alias("age"),
        F.col("CP").alias("location"),
    )
