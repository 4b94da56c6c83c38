"""Raw retail extracts derived from the order-entry tables on disk.

Parts become products, nations stores, shipped lines ticket lines. Campaigns and
offers are derived from the months in which a product was sold, so every extract
grows with the tables. All fields are plain expressions of the source columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Store formats counted in the promotion summary.
STORE_FORMATS = [
    "HIPERMERCADOS",
    "SUPERMERCADOS",
    "GASOLINERAS",
    "COMERCIO ELECTRONICO",
    "OTROS NEGOCIOS",
    "PLATAFORMAS",
    "69",
]
COMPANIES = ["COMPANY_0", "COMPANY_1", "COMPANY_2", "COMPANY_3"]
OWN_BRAND_NAME = "OWN LABEL"
SALES_NODE = 30632

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


class Tables(dict):
    """Tables of a folder, opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._open = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        if name not in _TABLES:
            raise KeyError(name)
        self[name] = self._open(name)
        return self[name]


def read_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _flag(divisor: int) -> Column:
    return F.when(F.col("p_size") % divisor == 0, "S").otherwise("N")


def _parts(t: dict[str, DataFrame]) -> DataFrame:
    return t["part"].select(
        "p_partkey",
        "p_name",
        "p_brand",
        "p_type",
        "p_size",
        F.substring("p_brand", 7, 10).cast("int").alias("bn"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("std"),
    )


def _hierarchy() -> dict[str, Column]:
    bn = F.col("bn")
    area = F.when(bn % 3 == 0, "0").otherwise("1")
    return {
        "1": area,
        "2": _text(bn % 3),
        "3": _text(bn % 3),
        "4": _text(bn % 6),
        "5": _text(bn % 12),
    }


# Fixed values of this adapter: code letter and label of every hierarchy level.
_LEVELS = {
    "1": ("A", "AREA_"),
    "2": ("S", "SECTION_"),
    "3": ("C", "CATEGORY_"),
    "4": ("B", "SUBCATEGORY_"),
    "5": ("G", "SEGMENT_"),
}


def _code(level: str) -> Column:
    return F.concat(F.lit(_LEVELS[level][0]), _hierarchy()[level])


def _label(level: str) -> Column:
    return F.concat(F.lit(_LEVELS[level][1]), _hierarchy()[level])


def articles(t: dict[str, DataFrame]) -> DataFrame:
    bn, size, key = F.col("bn"), F.col("p_size"), F.col("p_partkey")
    known = size % 5 != 0
    return _parts(t).select(
        _text("p_partkey").alias("COD_ART"),
        F.col("p_brand").alias("COD_ART_PRIM"),
        F.concat(F.lit("84"), F.lpad(_text("p_partkey"), 11, "0")).alias("COD_EAN"),
        F.col("p_type").alias("DESC_TP_ARTICULO"),
        F.col("p_name").alias("DESC_ART"),
        *[_code(n).alias(f"COD_N{n}_PPAL") for n in _LEVELS],
        *[_label(n).alias(f"DESC_N{n}") for n in ("1", "2", "3")],
        *[F.when(known, _label(n)).alias(f"DESC_N{n}") for n in ("4", "5")],
        F.col("p_brand").alias("COD_MARCA"),
        F.concat(F.lit("T"), _text(bn % 3)).alias("DESC_TIPOMARCA"),
        F.concat(F.lit("U"), _text(bn % 2)).alias("DESC_TIPOMARCA2"),
        _text(bn % 4).alias("COD_POSICION_MARCA"),
        F.concat(F.lit("POS"), _text(bn % 4)).alias("DESC_POSICION_MARCA"),
        _text(size).alias("COD_TALLA"),
        F.concat(F.lit("SIZE "), _text(size)).alias("DESC_TALLA"),
        F.lit("U").alias("COD_TIPO_FORMATO"),
        _text(size % 10).alias("COD_FORMATO"),
        _text(size % 6 + 1).alias("COD_PACK"),
        F.split("p_name", " ")[0].alias("DESC_COLOR"),
        F.concat(F.lit("V"), _text(key % 50)).alias("COD_PROVR_GEN"),
        F.concat(F.lit("W"), _text(key % 20)).alias("COD_PROVR_TRABAJO"),
        F.concat(F.lit("VENDOR_"), _text(key % 50)).alias("NOMBRE"),
        _flag(2).alias("FLG_SALUD_BIENESTAR"),
        _flag(3).alias("FLG_INNOVACION"),
        _flag(4).alias("FLG_GAMA_TURISTICA"),
        _flag(5).alias("FLG_GAMA_LOCAL"),
        _flag(7).alias("FLG_GAMA_REGIONAL"),
        F.when(bn % 2 == 0, "S").otherwise("N").alias("FLG_PODER_ADQUISITIVO"),
        F.lit("N").alias("FLG_BLOQ_DEFINITIVO"),
    )


def structure(t: dict[str, DataFrame]) -> DataFrame:
    code = F.concat_ws("-", *[_code(n) for n in _LEVELS])
    return (
        _parts(t)
        .select(
            code.alias("l5"),
            _label("1").alias("area2"),
            _label("2").alias("section2"),
            _label("3").alias("category2"),
            _label("4").alias("subcategory2"),
            _label("5").alias("segment2"),
        )
        .distinct()
    )


def markers(t: dict[str, DataFrame]) -> DataFrame:
    return (
        _parts(t)
        .where(F.col("p_size") > 40)
        .select(_text("p_partkey").alias("COD_ARTICULO"), F.lit("WOW").alias("MARCADOR_CASTE"))
    )


def own_brands(t: dict[str, DataFrame]) -> DataFrame:
    bn = F.col("bn")
    price_band = F.when(bn % 3 == 0, "Premium").when(bn % 3 == 1, "Normal").otherwise("Non premium")
    return (
        _parts(t)
        .where(bn % 5 == 0)
        .select(
            F.col("p_brand").alias("COD_MARCA"),
            F.concat(F.lit("T"), _text(bn % 3)).alias("DESC_TIPOMARCA"),
            F.concat(F.lit("U"), _text(bn % 2)).alias("DESC_TIPOMARCA2"),
            (bn % 4).alias("COD_POSICION_MARCA"),
            F.concat(F.lit("POS"), _text(bn % 4)).alias("DESC_POSICION_MARCA"),
            F.lit(1).alias("FLG_MMPP"),
            price_band.alias("Premium_Normal_Non_premium"),
        )
        .distinct()
    )


def net_costs(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("p_partkey")
    net = (F.col("std") * F.lit(Decimal("0.6"))).cast("decimal(10,2)")
    return _parts(t).select(
        F.concat(F.lit("V"), _text(key % 50)).alias("PROVR_GEN"),
        F.concat(F.lit("W"), _text(key % 20)).alias("PROVR_TRABAJO"),
        F.concat(F.lit("VENDOR_"), _text(key % 50)).alias("NOMBRE"),
        _text(key).alias("COD_ARTICULO"),
        F.when(F.col("p_size") % 9 == 0, "N/D")
        .otherwise(F.replace(_text(net), F.lit("."), F.lit(",")))
        .alias("NETO_COMERCIAL"),
    )


def sales_locations(t: dict[str, DataFrame]) -> DataFrame:
    k = F.explode(F.sequence(F.lit(0), F.lit(2))).alias("k")
    code = F.lpad(_text((F.col("p_partkey") * 7 + F.col("k") * 5) % 11), 2, "0")
    return (
        t["part"]
        .select("p_partkey", k)
        .select(
            F.col("p_partkey").alias("COD_ARTICULO"),
            code.alias("COD_AMBITO"),
            F.concat(F.lit("AMBITO "), code).alias("AMBITO"),
            F.when(F.col("k") < 2, SALES_NODE).otherwise(1).alias("COD_NIVEL_ESTR_LOC"),
        )
    )


def locations(t: dict[str, DataFrame]) -> DataFrame:
    size = t["supplier"].groupBy("s_nationkey").agg(
        F.max(F.col("s_acctbal").cast("decimal(12,2)")).alias("m2")
    )
    n = F.col("n_nationkey")
    fmt = F.element_at(F.array(*[F.lit(f) for f in STORE_FORMATS]), n % 7 + 1)
    return (
        t["nation"]
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        .join(size, n == F.col("s_nationkey"), "left")
        .select(
            _text(n).alias("COD_LOC"),
            F.col("n_name").alias("DESC_LOC"),
            F.col("r_name").alias("DESC_PROVIN"),
            F.concat(F.lit("TOWN_"), _text(n)).alias("DESC_POBLACION"),
            F.lpad(_text(n * 137), 5, "0").alias("COD_POSTAL"),
            F.concat(F.lit("STREET "), _text(n)).alias("DESC_DIRECCION"),
            F.concat(F.lit("COMPANY_"), _text(n % 4)).alias("DESC_SOCIEDAD"),
            F.lit("RETAIL").alias("DESC_NEGOCIO"),
            fmt.alias("DES_N1"),
            F.concat(F.lit("TYPE_"), _text(n % 3)).alias("DESC_N2"),
            F.lit("STORE").alias("DESC_TP_LOC"),
            F.when(n % 2 == 0, "S").otherwise("N").alias("FLG_CUOTA"),
            F.lit("19900101").alias("FEC_INI_LOC"),
            F.lit(None).cast("string").alias("FEC_FIN_LOC"),
            F.coalesce("m2", F.lit(0).cast("decimal(12,2)")).alias("NUM_M2"),
            (n % 10 + 2).alias("NUM_CAJAS"),
            F.lit("N").alias("FLG_LEAN"),
            F.lit("N").alias("FLG_TRANSFORMADO"),
            F.lit("N").alias("FLG_PUESTA_PUNTO_PLUS"),
        )
    )


def _second_start(m: Column) -> Column:
    return F.when(m % 3 == 2, 8).otherwise(12)


def _second_end(m: Column) -> Column:
    return F.when(m % 3 == 0, 18).when(m % 3 == 1, 25).otherwise(28)


def _month_text(y: Column, m: Column) -> Column:
    return F.concat(_text(y), F.lpad(_text(m), 2, "0"))


def promos(t: dict[str, DataFrame]) -> DataFrame:
    """Two campaigns a month: P from the 5th to the 18th, Q around it."""
    y, m = F.col("y"), F.col("m")
    months = t["lineitem"].select(
        F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m")
    ).distinct()
    both = F.explode(F.array(F.lit("P"), F.lit("Q"))).alias("kind")
    first = F.when(F.col("kind") == "P", 5).otherwise(_second_start(m))
    last = F.when(F.col("kind") == "P", 18).otherwise(_second_end(m))
    return months.select("y", "m", both).select(
        F.concat("kind", _month_text(y, m)).alias("COD_PROMOCION"),
        _text(y).alias("EJER_PROMOCION"),
        F.concat(F.lit("CAMPAIGN "), "kind", _month_text(y, m)).alias("DESCRIPCION"),
        F.when(F.col("kind") == "P", "1").otherwise("2").alias("COD_TP_PROMOCION"),
        F.concat(_month_text(y, m), F.lpad(_text(first), 2, "0")).alias("FEC_INICIO"),
        F.concat(_month_text(y, m), F.lpad(_text(last), 2, "0")).alias("FEC_FIN"),
        F.lit("C1").alias("COD_TP_IMP_OFERTA"),
        _text(m % 2).alias("COD_PERFIL"),
        F.lit("Oferta corporativa").alias("DESC_PLAN_PUBLI"),
    )


def _shipped(t: dict[str, DataFrame]) -> DataFrame:
    """Shipped lines with their day, in types that take little room when they are moved."""
    return t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        F.col("l_discount").cast("decimal(6,2)").alias("disc"),
        F.round(F.col("l_tax") * 100).cast("int").alias("tax"),
        "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("d"),
    )


def _in_stores(t: dict[str, DataFrame], rows: DataFrame) -> DataFrame:
    return rows.join(t["supplier"].select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))


def _sold(t: dict[str, DataFrame], rows: DataFrame | None = None) -> DataFrame:
    """Shipped lines with product, store and day.

    They are placed by product code while they are narrow; whoever wants them by product finds them there.
    """
    parts = _parts(t).withColumn("COD_ART", _text("p_partkey"))
    return (
        (_in_stores(t, _shipped(t)) if rows is None else rows)
        .withColumn("COD_ART", _text("l_partkey"))
        .repartition("COD_ART")
        .join(parts, "COD_ART")
        .withColumn("y", F.year("d"))
        .withColumn("m", F.month("d"))
        .withColumn("phase", (F.col("bn") + F.col("s_nationkey") + F.col("m")) % 4)
    )


def offers(t: dict[str, DataFrame]) -> DataFrame:
    """A product sold in a store in a month is on P, on Q, on both or on none.

    Sales are moved with product, store and month alone. What P and Q share is computed before they part, which also
    keeps the generated method within what the virtual machine compiles.
    """
    y, m, size, key, std = (F.col(c) for c in ("y", "m", "p_size", "p_partkey", "std"))
    months = _in_stores(t, _shipped(t)).select("l_partkey", "s_nationkey", F.trunc("d", "month").alias("d"))
    sold = _sold(t, months).select("COD_ART", "p_partkey", "p_size", "std", "s_nationkey", "y", "m", "phase").distinct()
    kinds = (
        F.when(F.col("phase") == 0, F.array(F.lit("P"), F.lit("Q")))
        .when(F.col("phase") == 1, F.array(F.lit("P")))
        .when(F.col("phase") == 3, F.array(F.lit("Q")))
    )
    mech = F.element_at(F.array(*[F.lit(x) for x in ("10", "20", "30", "40", "60")]), (key % 5 + 1).cast("int"))
    multi = F.col("mech").isin("20", "30", "40")
    shape = F.when(F.col("mech") == "60", size % 8)
    qty = "decimal(6,2)"

    def amount(of_std: str) -> Column:
        return F.round(std * F.lit(Decimal(of_std)), 2).cast("decimal(10,2)")

    def number(x: str | int) -> Column:
        return F.lit(Decimal(str(x))).cast(qty)

    price10 = F.round((std * (100 - 5 * (size % 7))).cast("decimal(18,2)") * F.lit(Decimal("0.01")), 2)
    buy = F.when(size % 4 == 1, number(3)).when(size % 4 == 3, number(4)).otherwise(number(2))
    pay = (
        F.when(size % 4 == 0, number(1)).when(size % 4 == 1, number(2))
        .when(size % 4 == 2, number("1.5")).otherwise(number(3))
    )
    s = F.col("shape")
    shared = sold.withColumn("mech", mech).withColumn("shape", shape).select(
        kinds.alias("kinds"),
        _month_text(y, m).alias("month"),
        F.concat(_text(y), F.lit("SEM"), F.lpad(_text(m), 2, "0")).alias("year_sem"),
        _text(y).alias("ANO_OFERTA"),
        "COD_ART",
        _text("s_nationkey").alias("COD_LOC"),
        F.col("mech").alias("COD_TIPOOFERTA"),
        F.when(size % 13 != 0, std).alias("PVP_TARIFA"),
        F.when(F.col("mech") == "10", _text(price10.cast("decimal(10,2)"))).alias("COD_PRECIO"),
        F.when(multi, buy).alias("CANT_N"),
        F.when(multi, pay).alias("CANT_M"),
        F.when(s.isin(0, 1, 6, 7), 1).when(s.isin(2, 3, 4, 5), 0).alias("UMBRAL1"),
        F.when(s.isin(2, 3, 4, 5, 6, 7), std).alias("PVPUMBRAL1"),
        F.when(s == 0, number(12)).when(s == 1, number(4)).alias("DESCUMBRAL1"),
        F.when(s.isin(2, 3), 1).when(s.isin(4, 5, 6, 7), 2).alias("UMBRAL2"),
        F.when(s == 4, amount("0.8")).when(s == 5, amount("0.96")).when(s.isin(6, 7), amount("0.9")).alias("PVPUMBRAL2"),
        F.when(s == 2, number(23)).when(s == 3, number(3)).alias("DESCUMBRAL2"),
        F.when(s == 7, 3).alias("UMBRAL3"),
        F.when(s == 7, amount("0.85")).alias("PVPUMBRAL3"),
        F.when(key % 3 == 0, "P").alias("COD_PORTADA"),
        F.when(key % 7 == 0, "D").alias("COD_DESTACAR"),
        F.when(key % 11 == 0, "F").alias("COD_FOLLETO"),
        F.when(key % 2 == 0, "G1").alias("COD_GONDOLA"),
        _text(key % 4).alias("COD_BLOQUE"),
        *[F.lit("N").alias(c) for c in ("IMPLANTAH", "IMPLANTAM", "IMPLANTAB", "CABSECCM", "CABSECCB")],
    )
    kept = [c for c in shared.columns if c not in ("kinds", "month", "year_sem")]
    return shared.select("*", F.explode("kinds").alias("kind")).select("year_sem", F.concat("kind", "month").alias("COD_OFERTA"), *kept)


def _ordered(t: dict[str, DataFrame], rows: DataFrame) -> DataFrame:
    """Rows of known orders."""
    return rows.join(t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority"), F.col("l_orderkey") == F.col("o_orderkey"))


def _tickets(rows: DataFrame) -> DataFrame:
    key, dia = F.col("l_orderkey"), F.date_format("d", "yyyyMMdd")
    clock = F.concat(F.lpad(_text(key % 12 + 8), 2, "0"), F.lit(":"), F.lpad(_text(key % 4 * 15), 2, "0"))
    return (
        rows.withColumn("COD_LOC", _text("s_nationkey"))
        .withColumn("DIA", dia)
        .withColumn("HORA_EMISION", F.concat(dia, F.lit(" "), clock))
        .withColumn("COD_CAJA", _text(F.col("l_suppkey") % 8 + 1))
        .withColumn("NUM_TICKET", _text("l_orderkey"))
    )


def _unplaced(t: dict[str, DataFrame]) -> DataFrame:
    """Tickets of the lines of known products, for extracts that tell nothing of the product and need not move it."""
    known = _in_stores(t, _shipped(t)).join(t["part"].select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"))
    return _tickets(_ordered(t, known))


def line_days(t: dict[str, DataFrame]) -> DataFrame:
    """The day of every line of ``lines``."""
    return _unplaced(t).select("DIA")


def headers(t: dict[str, DataFrame]) -> DataFrame:
    return _unplaced(t).select(
        "COD_LOC", "HORA_EMISION", "COD_CAJA", "NUM_TICKET", "DIA",
        F.substring("o_orderpriority", 1, 1).alias("COD_TIPO_VENTA"),
    )


def lines(t: dict[str, DataFrame]) -> DataFrame:
    money = "decimal(18,4)"
    m, day = F.col("m"), F.dayofmonth("d")
    lst = (F.col("l_quantity").cast("decimal(8,0)") * F.col("std")).cast(money)
    qty = F.col("l_quantity").cast(money)
    zero = F.lit(Decimal("0")).cast(money)
    tax = F.col("tax")
    on_p = F.col("phase").isin(0, 1) & day.between(5, 18)
    on_q = F.col("phase").isin(3, 0) & (day >= _second_start(m)) & (day <= _second_end(m))
    kind = F.when(F.col("l_linenumber") <= 5, F.when(on_p, "P").when(on_q, "Q"))
    tariff = F.col("l_returnflag") == "R"
    net = (F.col("lst") * (1 - F.col("disc"))).cast(money)
    raised = (F.col("lst") * F.lit(Decimal("1.5"))).cast(money)
    std_sale = F.when(F.col("l_linestatus") == "F", raised).otherwise(net)
    margin = (F.col("lst") * (F.lit(Decimal("0.4")) - F.col("disc"))).cast(money)
    parts = {
        "IMP_VENTA": (std_sale, net),
        "UNID_VENTA": (F.col("qty"), F.col("qty")),
        "MARGEN": (margin, margin),
    }
    out = []
    for name, (as_std, as_offer) in parts.items():
        out.append(F.when(tariff, as_std).otherwise(zero).alias(f"{name}_TARIFA"))
        out.append(F.when(tariff, zero).otherwise(as_offer).alias(f"{name}_OFERTA"))
        out += [zero.alias(f"{name}_{p}") for p in ("LIQUID", "CAMPANA", "COMPETE")]
    coupon = (
        F.when(tax == 8, F.lit(Decimal("-1")).cast(money))
        .when(tax == 7, (-F.col("lst") * F.col("disc")).cast(money))
        .otherwise(zero)
    )
    voucher = F.when(tax == 6, F.lit(Decimal("1")).cast(money)).otherwise(zero)
    # Raw lines are moved to their orders before anything widens them.
    rows = _tickets(_sold(t, _in_stores(t, _ordered(t, _shipped(t))))).withColumn("lst", lst).withColumn("qty", qty).withColumn("kind", kind)
    return rows.select(
        "COD_LOC", "HORA_EMISION", "COD_CAJA", "NUM_TICKET", "DIA",
        "COD_ART",
        F.concat("kind", _month_text(F.col("y"), m)).alias("COD_OFERTA"),
        F.when(F.col("kind").isNotNull(), _text("y")).alias("ANO_OFERTA"),
        _text("o_custkey").alias("ID_CLIENTE"),
        F.lit("N").alias("COD_TIPO_MOVIM"),
        F.col("lst").alias("IMP_PVP_TARIFA"),
        *out,
        voucher.alias("IMP_DTO_VALE"),
        coupon.alias("IMP_DTO_CUPON"),
        *[zero.alias(f"IMP_DTO_{p}") for p in ("TRAVEL", "TMONEDERO", "OTROS", "ONSITE", "CUOTA", "CONSUMER")],
        zero.alias("IMP_CONSUMO_RAP"),
    )


def redemptions(t: dict[str, DataFrame]) -> DataFrame:
    money = "decimal(18,4)"
    lst = F.col("l_quantity").cast("decimal(8,0)") * F.col("std")
    extra = F.when(F.col("tax") > 4, lst * F.lit(Decimal("0.01")))
    return (
        _sold(t, _in_stores(t, _shipped(t).where(F.col("l_returnflag") == "N")))
        .select(
            F.date_format("d", "yyyyMMdd").cast("int").alias("DIA"),
            F.col("s_nationkey").alias("COD_LOC"),
            "COD_ART",
            F.col("l_quantity").cast(money).alias("UNID_VENTA"),
            (lst * F.lit(Decimal("0.02"))).cast(money).alias("IMP_REDENCION"),
            F.coalesce(extra.cast(money), F.lit(Decimal("0")).cast(money)).alias("IMP_REDENCION_PS"),
            F.lit(Decimal("0")).cast(money).alias("IMP_REDENCION_OSS"),
        )
    )


def customers(t: dict[str, DataFrame]) -> DataFrame:
    key = F.col("c_custkey")
    pending = F.lit("ALTA PENDIENTE CONFIRMACION")
    status = (
        F.when(F.col("c_mktsegment") == "MACHINERY", pending)
        .when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
        .otherwise("ALTA")
    )
    born = F.date_add(F.to_date(F.lit("1940-01-01")), (key * 37 % 20000).cast("int"))
    return t["customer"].select(
        _text(key).alias("ID_CLIENTE_HUB"),
        status.alias("DESC_ESTATUS_TARJ_CLUB"),
        F.when(F.col("c_acctbal") > 5000, "ALTA").otherwise(pending).alias("DESC_ESTATUS_SOCIO_ORO"),
        F.when(key % 2 == 0, "ALTA").alias("DESC_ESTATUS_TARJ_TRAVEL"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("COD_SEXO"),
        F.date_format(born, "dd/MM/yyyy").alias("FECHADENACIMIENTO"),
        _text("c_nationkey").alias("CP"),
    )


def raw_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    t = read_tables(spark, sf_dir)
    builders = {
        "articles": articles, "structure": structure, "markers": markers, "own_brands": own_brands,
        "net_costs": net_costs, "sales_locations": sales_locations, "locations": locations,
        "promos": promos, "offers": offers, "lines": lines, "line_days": line_days, "headers": headers,
        "redemptions": redemptions, "customers": customers,
    }
    return {name: build(t) for name, build in builders.items()}
