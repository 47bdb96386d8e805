"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.operators import quality
from sparklake.operators.cleaning import with_quality_flags
from sparklake.plans import procedures
from sparklake.queries import views
from sparklake.queries.registry import query

_MACRO_SINCE = "1995-06-01"

# months are unreadable in one state, amounts negative for customers in debt
_CHECKED_SQL = f"""checked AS (
  SELECT provincia, periodo_date,
    CAST(CASE WHEN periodo_date IS NULL THEN 1 ELSE 0 END AS BIGINT) AS flg_periodo_invalido,
    CAST(CASE WHEN deuda < 0 THEN 1 ELSE 0 END AS BIGINT) AS flg_importe_negativo
  FROM (SELECT n_name AS provincia,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS periodo_date,
      c_acctbal AS deuda
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) v
), gold AS (
  SELECT n_name AS PROVINCIA, CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo_date,
    CASE WHEN min(o_orderpriority) = '1-URGENT' THEN 1 ELSE 0 END AS INFLACION
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
), counts AS (
  SELECT (SELECT count(*) FROM checked WHERE flg_periodo_invalido = 1) AS periodos_invalidos,
    (SELECT count(*) FROM checked WHERE flg_importe_negativo = 1) AS importes_negativos,
    (SELECT count(DISTINCT concat(provincia, '_', strftime(periodo_date, '%Y-%m'))) FROM checked
      WHERE provincia IS NOT NULL AND periodo_date IS NOT NULL) AS claves_silver,
    (SELECT count(DISTINCT concat(PROVINCIA, '_', strftime(periodo_date, '%Y-%m'))) FROM gold) AS claves_gold,
    (SELECT count(*) FROM gold WHERE periodo_date >= DATE '{_MACRO_SINCE}'
      AND (INFLACION = 0 OR INFLACION IS NULL)) AS sin_inflacion
), drift AS (SELECT *, abs(claves_gold - claves_silver) AS diferencia_claves FROM counts)"""


def _located(spark, sf_dir) -> DataFrame:
    customer = views.table(spark, sf_dir, "customer").join(
        views.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return views.table(spark, sf_dir, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))


def _silver(spark, sf_dir) -> DataFrame:
    month = F.to_date(F.trunc("o_orderdate", "MM"))
    rows = _located(spark, sf_dir).select(
        F.col("n_name").alias("provincia"),
        F.when(F.col("o_orderstatus") != "P", month).alias("periodo_date"),
        F.date_format("o_orderdate", "yyyy-MM").alias("periodo"),
        F.col("c_acctbal").alias("deuda"),
        F.lit(0.0).alias("deudaCapital"),
        F.lit(0.0).alias("deudaVencida"),
    )
    return rows.transform(with_quality_flags)


def _gold(spark, sf_dir) -> DataFrame:
    month = F.to_date(F.trunc("o_orderdate", "MM"))
    grouped = _located(spark, sf_dir).groupBy(F.col("n_name").alias("PROVINCIA"), month.alias("periodo_date"))
    # a maximum of numbers stays in the hash aggregate; a minimum of texts would sort all rows
    urgent = F.max(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0))
    return grouped.agg(urgent.alias("INFLACION"))


_COUNTS = ["periodos_invalidos", "importes_negativos", "claves_silver", "claves_gold", "sin_inflacion", "diferencia_claves"]


def _counts(spark, sf_dir) -> DataFrame:
    return quality.check_counts(_silver(spark, sf_dir), _gold(spark, sf_dir), _MACRO_SINCE)


@query("dq_counts_one_pass", f"WITH {_CHECKED_SQL} SELECT {', '.join(_COUNTS)} FROM drift")
def dq_counts_one_pass(spark, sf_dir):
    return _counts(spark, sf_dir).select(*_COUNTS)


@query("dq_invalid_period", f"WITH {_CHECKED_SQL} SELECT periodos_invalidos FROM drift")
def dq_invalid_period(spark, sf_dir):
    return quality.silver_checks(_silver(spark, sf_dir)).select("periodos_invalidos")


@query("dq_negative", f"WITH {_CHECKED_SQL} SELECT importes_negativos FROM drift")
def dq_negative(spark, sf_dir):
    return quality.silver_checks(_silver(spark, sf_dir)).select("importes_negativos")


@query("dq_drift", f"WITH {_CHECKED_SQL} SELECT claves_silver, claves_gold, diferencia_claves FROM drift")
def dq_drift(spark, sf_dir):
    return _counts(spark, sf_dir).select("claves_silver", "claves_gold", "diferencia_claves")


@query("dq_missing_macro", f"WITH {_CHECKED_SQL} SELECT sin_inflacion FROM drift")
def dq_missing_macro(spark, sf_dir):
    return quality.gold_checks(_gold(spark, sf_dir), _MACRO_SINCE).select("sin_inflacion")


_VERDICT_SQL = f"""WITH {_CHECKED_SQL}, worded AS (
  SELECT *, concat(
    CASE WHEN periodos_invalidos > 0 THEN concat('ALERTA: ', periodos_invalidos, ' registros con períodos inválidos en Silver. ') ELSE '' END,
    CASE WHEN importes_negativos > 0 THEN concat('ALERTA: ', importes_negativos, ' registros con importes negativos en Silver. ') ELSE '' END,
    CASE WHEN diferencia_claves > 100 THEN concat('ALERTA: Diferencia significativa entre Silver y Gold: ', diferencia_claves, ' combinaciones. ') ELSE '' END,
    CASE WHEN sin_inflacion > 0 THEN concat('ALERTA: ', sin_inflacion, ' registros sin datos de inflación recientes. ') ELSE '' END) AS m
  FROM drift)
SELECT CASE WHEN m = '' THEN 'SUCCESS' ELSE 'WARNING' END AS status,
  CASE WHEN m = '' THEN 'Todas las validaciones de calidad pasaron exitosamente.' ELSE m END AS message FROM worded"""


@query("dq_verdict", _VERDICT_SQL)
def dq_verdict(spark, sf_dir):
    return quality.verdict(_counts(spark, sf_dir)).select("status", "message")


@query(
    "key_drift",
    f"""WITH {views.LOANS_SQL}
    SELECT abs((SELECT count(DISTINCT concat(provincia, '_', strftime(periodo_date, '%Y-%m'))) FROM loans)
      - (SELECT count(DISTINCT concat(n_name, '_', strftime(o_orderdate, '%Y-%m')))
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)) AS diferencia""",
)
def key_drift(spark, sf_dir):
    """Province-month pairs of the loans against those of the orders: two aggregates, one row."""
    pairs = views.loans(spark, sf_dir, "provincia", "periodo_date").agg(
        F.count_distinct(quality.composite_key("provincia", "periodo_date")).alias("n")
    )
    located = _located(spark, sf_dir).agg(
        F.count_distinct(quality.composite_key("n_name", "o_orderdate")).alias("m")
    )
    return pairs.select(F.abs(F.col("n") - located.scalar()).alias("diferencia"))


@query(
    "dq_profile",
    """WITH rows AS (SELECT CASE WHEN c_acctbal >= 0 THEN c_name END AS entidad, c_mktsegment AS provincia,
        CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS f1,
        CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS BIGINT) AS f2 FROM customer)
    SELECT count(*) AS filas, count(*) FILTER (entidad IS NULL) AS nulos_entidad,
      count(*) FILTER (provincia IS NULL) AS nulos_provincia,
      CAST(sum(greatest(f1, f2)) AS BIGINT) AS filas_marcadas, sum(greatest(f1, f2)) / count(*) AS tasa_error FROM rows""",
)
def dq_profile(spark, sf_dir):
    rows = views.table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("entidad"),
        F.col("c_mktsegment").alias("provincia"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).cast("bigint").alias("f1"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).cast("bigint").alias("f2"),
    )
    return quality.null_profile(rows, ["entidad", "provincia"], ["f1", "f2"])


@query(
    "dq_duplicates",
    """SELECT count(*) AS claves, count(*) FILTER (n > 1) AS claves_repetidas, CAST(sum(n - 1) AS BIGINT) AS filas_sobrantes
    FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2) g""",
)
def dq_duplicates(spark, sf_dir):
    return quality.duplicate_profile(views.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "range_validation",
    """SELECT count(*) AS filas, count(*) FILTER (o_totalprice < 20000) AS o_totalprice_bajo,
      count(*) FILTER (o_totalprice > 400000) AS o_totalprice_alto,
      count(*) FILTER (o_custkey < 10) AS o_custkey_bajo, count(*) FILTER (o_custkey > 1000) AS o_custkey_alto FROM orders""",
)
def range_validation(spark, sf_dir):
    rules = {"o_totalprice": (20000, 400000), "o_custkey": (10, 1000)}
    return quality.range_violations(views.table(spark, sf_dir, "orders"), rules)


@query(
    "catalogue_check",
    """SELECT c_mktsegment, count(*) AS filas, count(*) FILTER (n_name IS NULL) AS sin_catalogo
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey GROUP BY 1""",
)
def catalogue_check(spark, sf_dir):
    """Rows whose code is missing in a reference catalogue (here: nations of four regions)."""
    catalogue = views.table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 2)
    joined = views.table(spark, sf_dir, "customer").join(
        catalogue, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("filas"), F.count_if(F.col("n_name").isNull()).alias("sin_catalogo")
    )


@query(
    "quality_checks_sql",
    f"""WITH {_CHECKED_SQL}, checks AS (
      SELECT 'periodos_invalidos' AS control, CAST(periodos_invalidos AS BIGINT) AS valor, 0 AS limite FROM drift
      UNION ALL SELECT 'importes_negativos', CAST(importes_negativos AS BIGINT), 0 FROM drift
      UNION ALL SELECT 'diferencia_claves', CAST(diferencia_claves AS BIGINT), 100 FROM drift
      UNION ALL SELECT 'sin_inflacion', CAST(sin_inflacion AS BIGINT), 0 FROM drift)
    SELECT control, valor, CAST(limite AS BIGINT) AS limite, valor <= limite AS correcto FROM checks""",
)
def quality_checks_sql(spark, sf_dir):
    """The checks as a procedure that is called from SQL."""
    procedures.define_checks(spark, _silver(spark, sf_dir), _gold(spark, sf_dir), _MACRO_SINCE)
    return spark.sql("SELECT * FROM quality_checks()")
