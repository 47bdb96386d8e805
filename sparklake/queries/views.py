"""The test tables seen as a loan portfolio, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparklake.operators.cleaning import with_quality_flags
from sparklake.schemas import SILVER_COLUMNS

# loan column -> (table it needs besides lineitem, Spark expression, DuckDB expression)
_MONTH = "date_format(o_orderdate, 'yyyy-MM')", "strftime(o_orderdate, '%Y-%m')"
_FIRST = "to_date(trunc(o_orderdate, 'MM'))", "CAST(date_trunc('month', o_orderdate) AS DATE)"
_YEAR = "cast(year(o_orderdate) as bigint)", "CAST(year(o_orderdate) AS BIGINT)"
_MON = "cast(month(o_orderdate) as bigint)", "CAST(month(o_orderdate) AS BIGINT)"
LOAN_VIEW = {
    "periodo": ("orders", *_MONTH),
    "tipoCliente": ("customer", "c_mktsegment", "c_mktsegment"),
    "actividad": ("part", "p_type", "p_type"),
    "entidad": ("supplier", "s_name", "s_name"),
    "sector": ("orders", "o_orderpriority", "o_orderpriority"),
    "moneda": ("orders", "o_orderstatus", "o_orderstatus"),
    "provincia": ("nation", "n_name", "n_name"),
    "residencia": ("part", "p_brand", "p_brand"),
    "genero": (None, "l_returnflag", "l_returnflag"),
    "persona": (None, "l_linestatus", "l_linestatus"),
    "deudaCapital": (None, "l_extendedprice", "l_extendedprice"),
    "deudaVencida": (
        None,
        "if(l_returnflag = 'R', l_extendedprice, 0D)",
        "CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE CAST(0 AS DOUBLE) END",
    ),
    "deudaVencidaDe31A90Dias": (None, "l_extendedprice * l_discount", "l_extendedprice * l_discount"),
    "cantidadCredito": (None, "cast(l_quantity as bigint)", "CAST(l_quantity AS BIGINT)"),
    "valorDesembolso": ("orders", "o_totalprice", "o_totalprice"),
    "valorGarantia": ("part", "p_retailprice * l_quantity", "p_retailprice * l_quantity"),
    "valorProvisionCapitalYRendimiento": (None, "l_extendedprice * l_tax", "l_extendedprice * l_tax"),
    "deuda": (None, "l_extendedprice * (1 - l_discount)", "l_extendedprice * (1 - l_discount)"),
    "periodo_date": ("orders", *_FIRST),
    "anio": ("orders", *_YEAR),
    "mes": ("orders", *_MON),
    "periodo_ym": ("orders", f"{_YEAR[0]} * 100 + {_MON[0]}", f"{_YEAR[1]} * 100 + {_MON[1]}"),
    "dt_captura": (None, "to_date(l_shipdate)", "CAST(l_shipdate AS DATE)"),
}
# decimals of the measures, for sums that do not depend on the order of addition
MEASURE_SCALES = {
    "deudaCapital": 2,
    "deudaVencida": 2,
    "deudaVencidaDe31A90Dias": 4,
    "valorDesembolso": 2,
    "valorGarantia": 2,
    "valorProvisionCapitalYRendimiento": 4,
    "deuda": 4,
}
_FROM_SQL = """
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN part ON l_partkey = p_partkey"""
_SELECT_SQL = ",\n    ".join(f'{sql} AS {name}' for name, (_, _, sql) in LOAN_VIEW.items())
_FLAGS_SQL = """
    CAST(CASE WHEN periodo_date IS NULL OR periodo IS NULL OR periodo = '' THEN 1 ELSE 0 END AS BIGINT)
      AS flg_periodo_invalido,
    CAST(CASE WHEN deudaCapital < 0 OR deudaVencida < 0 OR deuda < 0 THEN 1 ELSE 0 END AS BIGINT)
      AS flg_importe_negativo"""
# "WITH " + LOANS_SQL + " SELECT ... FROM loans"
LOANS_SQL = f"""loans AS (
  SELECT *,{_FLAGS_SQL}
  FROM (SELECT
    {_SELECT_SQL}{_FROM_SQL}) v
)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Loan rows with the given columns (all silver columns by default).

    Only the tables that the columns need are joined: they are joined from the left by
    their unique keys, so a join that adds no column changes nothing.
    """
    wanted = columns or [c for c in SILVER_COLUMNS if c in LOAN_VIEW]
    needed = {LOAN_VIEW[c][0] for c in wanted}
    if "nation" in needed:
        needed.add("customer")
    if "customer" in needed:
        needed.add("orders")
    rows = table(spark, sf_dir, "lineitem")
    # every join here may shuffle lineitem: it takes the few columns of supplier and part first and
    # the many of orders last, so that the shuffles before stay narrow
    if "supplier" in needed:
        rows = rows.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    if "part" in needed:
        rows = rows.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if "orders" in needed:
        # widen orders before the large join, so that lineitem is shuffled once for all of it
        orders = table(spark, sf_dir, "orders")
        if "customer" in needed:
            customer = table(spark, sf_dir, "customer")
            if "nation" in needed:
                nation = table(spark, sf_dir, "nation")
                customer = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return rows.select(*[F.expr(LOAN_VIEW[c][1]).alias(c) for c in wanted])


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view with all 25 silver columns, flags included."""
    return loans(spark, sf_dir).transform(with_quality_flags).select(*SILVER_COLUMNS)


def macro_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as macro series: total price as the value, order status as the kind of rate."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.to_date("o_orderdate").alias("fecha"),
        F.col("o_totalprice").alias("inflacion_anual"),
        F.col("o_totalprice").alias("tasa_cambio"),
        F.col("o_orderstatus").alias("tipo_cambio"),
    )


MACRO_KINDS = {"tc_venta": "F", "tc_compra": "O"}
MACRO_SINCE = "1996-01-01"
# "WITH " + MACRO_SQL + ..., two monthly frames
MACRO_SQL = f"""inflation AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
         round(sum(o_totalprice), 2) / count(o_totalprice) AS inflacion
  FROM orders WHERE o_orderdate >= DATE '{MACRO_SINCE}' GROUP BY 1
), exchange AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
         round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2)
           / nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS tc_venta,
         round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2)
           / nullif(count(*) FILTER (o_orderstatus = 'O'), 0) AS tc_compra
  FROM orders WHERE o_orderdate >= DATE '{MACRO_SINCE}' GROUP BY 1
)"""


def _sum_sql(name: str) -> str:
    scale = MEASURE_SCALES.get(name)
    total = f"sum(COALESCE({name}, 0))"
    return f"round({total}, {scale})" if scale is not None else f"CAST({total} AS BIGINT)"


FACTS_SQL = f"""facts AS (
  SELECT periodo_date, provincia AS PROVINCIA,
         CAST(year(periodo_date) AS BIGINT) AS ANIO, CAST(month(periodo_date) AS BIGINT) AS MES,
         CAST(1 AS BIGINT) AS PD_AGREGADA,
         {', '.join(f'{_sum_sql(s)} AS {s.upper()}' for s in [
             "deudaCapital", "deudaVencida", "deudaVencidaDe31A90Dias", "cantidadCredito",
             "valorDesembolso", "valorGarantia", "valorProvisionCapitalYRendimiento", "deuda"])},
         {', '.join(f'CAST(count(DISTINCT {d}) AS DOUBLE) AS {d.upper()}' for d in [
             "genero", "persona", "moneda", "sector", "entidad", "residencia"])}
  FROM loans
  WHERE flg_periodo_invalido = 0 AND provincia IS NOT NULL AND periodo_date IS NOT NULL
  GROUP BY 1, 2
), kpi AS (
  SELECT *,
    CASE WHEN DEUDACAPITAL > 0 THEN DEUDAVENCIDA / DEUDACAPITAL ELSE 0 END AS TASA_MORA,
    CASE WHEN DEUDACAPITAL > 0 THEN VALORGARANTIA / DEUDACAPITAL ELSE 0 END AS COBERTURA_GARANTIA,
    CASE WHEN DEUDACAPITAL > 0 THEN VALORPROVISIONCAPITALYRENDIMIENTO / DEUDACAPITAL ELSE 0 END
      AS PROPORCION_PROVISIONADA
  FROM facts
)"""
GOLD_SQL = f"""{LOANS_SQL}, {MACRO_SQL}, {FACTS_SQL}, gold AS (
  SELECT k.*, COALESCE(i.inflacion, 0) AS INFLACION,
         COALESCE(x.tc_venta, 0) AS TC_VENTA, COALESCE(x.tc_compra, 0) AS TC_COMPRA
  FROM kpi k
  LEFT JOIN inflation i ON k.periodo_date = i.periodo_date
  LEFT JOIN exchange x ON k.periodo_date = x.periodo_date
)"""
