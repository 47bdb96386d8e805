"""Silver queries: cleaning, casting, flags, latest row per key, column shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklake.functions import periods
from sparklake.functions.scalars import clean_text, money_lenient, money_strict, to_double, to_int_truncated, to_long
from sparklake.operators.cleaning import silver_rows
from sparklake.operators.dedup import latest_per_key
from sparklake.operators.normalize import (
    align_columns,
    fallback_period,
    only_category,
    preferred_order,
    require_fields,
)
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.schemas import SILVER_COLUMNS, SILVER_KEY
from sparklake.sources.landing import concat_pieces

# dirty text made from clean columns, in both dialects; the row's own keys pick the dirt
_DIRTY_MONTH = """CASE {mod} WHEN 0 THEN concat(' ', {ym}, '\t') WHEN 1 THEN {slash}
  WHEN 2 THEN '' WHEN 3 THEN {turned} WHEN 4 THEN {plain} WHEN 5 THEN concat({ym}, '-15') ELSE {ym} END"""
_DIRTY_MONEY = """CASE {mod} WHEN 0 THEN concat('$', {v}) WHEN 1 THEN concat(' ', {v}, ' ')
  WHEN 2 THEN '' WHEN 3 THEN 'N/A' WHEN 4 THEN NULL WHEN 5 THEN concat('RD$1,', {v})
  WHEN 6 THEN concat('-', {v}) WHEN 7 THEN concat('(', {v}, ')') ELSE {v} END"""


def _month(dialect: str) -> str:
    if dialect == "spark":
        fmt = "date_format(o_orderdate, '{}')"
        forms = [fmt.format(f) for f in ("yyyy-MM", "yyyy/MM", "MM/yyyy", "yyyyMM")]
        mod = "pmod(l_orderkey, 7)"
    else:
        fmt = "strftime(o_orderdate, '{}')"
        forms = [fmt.format(f) for f in ("%Y-%m", "%Y/%m", "%m/%Y", "%Y%m")]
        mod = "(l_orderkey % 7)"
    return _DIRTY_MONTH.format(mod=mod, ym=forms[0], slash=forms[1], turned=forms[2], plain=forms[3])


def _money(value: str, shift: int, dialect: str) -> str:
    mod = f"pmod(l_orderkey + l_linenumber + {shift}, 9)"
    text = f"cast({value} as string)"
    if dialect == "duckdb":
        mod, text = f"((l_orderkey + l_linenumber + {shift}) % 9)", f"CAST({value} AS VARCHAR)"
    return _DIRTY_MONEY.format(mod=mod, v=text)


_AMOUNTS = {
    "deudaCapital": "l_extendedprice",
    "deudaVencida": "l_tax",
    "deudaVencidaDe31A90Dias": "l_discount",
    "valorDesembolso": "o_totalprice",
    "valorGarantia": "l_extendedprice",
    "valorProvisionCapitalYRendimiento": "l_tax",
    "deuda": "l_extendedprice",
}


def _dirty_select(dialect: str) -> dict[str, str]:
    tab = "'\t'" if dialect == "spark" else "chr(9)"
    string = "string" if dialect == "spark" else "VARCHAR"
    cols = {
        "periodo": _month(dialect) if dialect == "spark" else _month(dialect).replace("'\t'", "chr(9)"),
        "tipoCliente": f"concat(l_returnflag, ' ', {tab})",
        "actividad": f"concat({tab}, l_linestatus)",
        "entidad": f"cast(l_suppkey as {string})",
        "sector": "o_orderpriority",
        "moneda": "concat('  ', o_orderstatus)",
        "provincia": f"cast(o_custkey as {string})",
        "residencia": f"cast(l_partkey as {string})",
        "genero": "l_returnflag",
        "persona": "l_linestatus",
    }
    for shift, (name, value) in enumerate(_AMOUNTS.items()):
        cols[name] = _money(value, shift, dialect)
    quantity = "cast(l_quantity as bigint)"
    cols["cantidadCredito"] = (
        f"CASE l_returnflag WHEN 'A' THEN cast(l_quantity as {string}) ELSE cast({quantity} as {string}) END"
    )
    cols["dt_captura"] = "to_date(l_shipdate)" if dialect == "spark" else "CAST(l_shipdate AS DATE)"
    return cols


_DIRTY_SQL = (
    "dirty AS (SELECT "
    + ", ".join(f"{v} AS {k}" for k, v in _dirty_select("duckdb").items())
    + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)


def dirty_loans(spark, sf_dir: str) -> DataFrame:
    """Loan rows as text with blanks, currency signs, several month forms and gaps."""
    lineitem, orders = views.table(spark, sf_dir, "lineitem"), views.table(spark, sf_dir, "orders")
    joined = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*[F.expr(v).alias(k) for k, v in _dirty_select("spark").items()])


# DuckDB counterparts of the column functions
_TRIM = "trim({c}, ' ' || chr(9))"
_STRICT = "TRY_CAST(replace(replace({c}, ',', ''), '$', '') AS DOUBLE)"
_LENIENT = "TRY_CAST(regexp_replace(COALESCE({c}, '0'), '[^0-9.\\-]', '', 'g') AS DOUBLE)"
_CAST = "TRY_CAST({c} AS DOUBLE)"


def _period_sql(c: str, count: int) -> str:
    forms = [
        (r"^\d{4}-\d{1,2}$", "%Y-%m"),
        (r"^\d{4}/\d{1,2}$", "%Y/%m"),
        (r"^\d{1,2}/\d{4}$", "%m/%Y"),
        (r"^\d{6}$", "%Y%m"),
    ][:count]
    tries = [
        f"CASE WHEN regexp_matches({c}, '{shape}') THEN CAST(try_strptime({c}, '{f}') AS DATE) END"
        for shape, f in forms
    ]
    return f"COALESCE({', '.join(tries)})" if count > 1 else tries[0]


def _silver_sql(money: str, formats: int) -> str:
    text = ", ".join(
        f"{_TRIM.format(c=c)} AS {c}"
        for c in ("periodo", "tipoCliente", "actividad", "entidad", "sector", "moneda", "provincia",
                  "residencia", "genero", "persona")
    )
    amounts = ", ".join(f"{money.format(c=c)} AS {c}" for c in _AMOUNTS)
    return f"""{_DIRTY_SQL}, typed AS (
      SELECT {text}, {amounts},
        CASE WHEN regexp_matches(cantidadCredito, '^[0-9]+$') THEN CAST(cantidadCredito AS BIGINT) END
          AS cantidadCredito, dt_captura FROM dirty
    ), dated AS (SELECT *, {_period_sql('periodo', formats)} AS periodo_date FROM typed
    ), silver AS (
      SELECT *, CAST(year(periodo_date) AS BIGINT) AS anio, CAST(month(periodo_date) AS BIGINT) AS mes,
        CAST(year(periodo_date) * 100 + month(periodo_date) AS BIGINT) AS periodo_ym,
        CAST(CASE WHEN periodo_date IS NULL OR periodo IS NULL OR periodo = '' THEN 1 ELSE 0 END AS BIGINT)
          AS flg_periodo_invalido,
        CAST(CASE WHEN deudaCapital < 0 OR deudaVencida < 0 OR deuda < 0 THEN 1 ELSE 0 END AS BIGINT)
          AS flg_importe_negativo
      FROM dated)"""


_SILVER_LIST = ", ".join(SILVER_COLUMNS)


@query("silver_clean_flags", f"WITH {_silver_sql(_CAST, 1)} SELECT {_SILVER_LIST} FROM silver")
def silver_clean_flags(spark, sf_dir):
    return dirty_loans(spark, sf_dir).transform(silver_rows)


@query("silver_clean_strict", f"WITH {_silver_sql(_STRICT, 3)} SELECT {_SILVER_LIST} FROM silver")
def silver_clean_strict(spark, sf_dir):
    return dirty_loans(spark, sf_dir).transform(silver_rows, "strict", periods.THREE_FORMATS)


@query("silver_clean_lenient", f"WITH {_silver_sql(_LENIENT, 4)} SELECT {_SILVER_LIST} FROM silver")
def silver_clean_lenient(spark, sf_dir):
    return dirty_loans(spark, sf_dir).transform(silver_rows, "lenient", periods.FOUR_FORMATS)


def _latest_sql(source: str, columns: list[str], key: list[str], order_by: str) -> str:
    rest = [f"{c} ASC NULLS FIRST" for c in columns if c not in {*key, order_by}]
    order = ", ".join([f"{order_by} DESC NULLS LAST", *rest])
    return f"""SELECT {', '.join(columns)} FROM {source}
    QUALIFY row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {order}) = 1"""


@query("dedup_latest", f"WITH {views.LOANS_SQL} {_latest_sql('loans', SILVER_COLUMNS, SILVER_KEY, 'dt_captura')}")
def dedup_latest(spark, sf_dir):
    return views.silver(spark, sf_dir).transform(latest_per_key)


_COARSE_KEY = [c for c in SILVER_KEY if c != "entidad"]


@query(
    "dedup_latest_coarse_key",
    f"WITH {views.LOANS_SQL} {_latest_sql('loans', SILVER_COLUMNS, _COARSE_KEY, 'dt_captura')}",
)
def dedup_latest_coarse_key(spark, sf_dir):
    return views.silver(spark, sf_dir).transform(latest_per_key, _COARSE_KEY)


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("dedup_latest_orders", _latest_sql("orders", _ORDER_COLUMNS, ["o_custkey"], "o_orderdate"))
def dedup_latest_orders(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").transform(latest_per_key, ["o_custkey"], "o_orderdate")


@query(
    "landing_to_silver_rows",
    f"WITH {_silver_sql(_LENIENT, 4)} "
    + _latest_sql(
        "(SELECT * FROM silver WHERE entidad IS NOT NULL AND provincia IS NOT NULL AND dt_captura IS NOT NULL)",
        SILVER_COLUMNS,
        SILVER_KEY,
        "dt_captura",
    ),
)
def landing_to_silver_rows(spark, sf_dir):
    """The whole landing route on dirty text: clean, flag, require fields, latest per key."""
    rows = dirty_loans(spark, sf_dir).transform(silver_rows, "lenient", periods.FOUR_FORMATS)
    return rows.transform(require_fields, ["entidad", "provincia", "dt_captura"]).transform(latest_per_key)


def _money_query(clean, as_name: str):
    def run(spark, sf_dir):
        rows = views.table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", F.expr(_money("l_extendedprice", 0, "spark")).alias("texto")
        )
        return rows.select("l_orderkey", "l_linenumber", "texto", clean(F.col("texto")).alias(as_name))

    return run


def _money_sql(cast: str) -> str:
    return f"""SELECT l_orderkey, l_linenumber, texto, {cast.format(c='texto')} AS monto FROM (
      SELECT l_orderkey, l_linenumber, {_money('l_extendedprice', 0, 'duckdb')} AS texto FROM lineitem) v"""


query("money_replace", _money_sql(_STRICT))(_money_query(money_strict, "monto"))
query("money_regex", _money_sql(_LENIENT))(_money_query(money_lenient, "monto"))


def _period_query(formats: tuple[str, ...]):
    def run(spark, sf_dir):
        month = _month("spark").replace("l_orderkey", "o_orderkey")
        rows = views.table(spark, sf_dir, "orders").select("o_orderkey", clean_text(F.expr(month)).alias("periodo"))
        return rows.select("o_orderkey", "periodo", periods.parse_period(F.col("periodo"), formats).alias("fecha"))

    return run


def _period_query_sql(count: int) -> str:
    month = _dirty_select("duckdb")["periodo"].replace("l_orderkey", "o_orderkey")
    return f"""SELECT o_orderkey, periodo, {_period_sql('periodo', count)} AS fecha
    FROM (SELECT o_orderkey, {_TRIM.format(c=f'({month})')} AS periodo FROM orders) v"""


query("period_parse_1fmt", _period_query_sql(1))(_period_query(periods.ONE_FORMAT))
query("period_parse_3fmt", _period_query_sql(3))(_period_query(periods.THREE_FORMATS))
query("period_parse_multi", _period_query_sql(4))(_period_query(periods.FOUR_FORMATS))


@query(
    "numeric_cast_bronze",
    f"""SELECT l_orderkey, l_linenumber,
      CAST(l_quantity AS INTEGER) AS entero,
      CASE WHEN l_returnflag <> 'A' THEN CAST(l_quantity AS BIGINT) END AS largo,
      {_CAST.format(c=f"({_money('l_extendedprice', 0, 'duckdb')})")} AS doble
    FROM lineitem""",
)
def numeric_cast_bronze(spark, sf_dir):
    """Tolerant casts of dirty text: bronze integers lose their fraction, the warehouse's long
    integers must have none, and a word is no number.
    """
    text = F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("string")).otherwise(
        F.col("l_quantity").cast("bigint").cast("string")
    )
    rows = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.alias("cantidad"),
        F.expr(_money("l_extendedprice", 0, "spark")).alias("monto"),
    )
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        to_int_truncated(F.col("cantidad")).alias("entero"),
        to_long(F.col("cantidad")).alias("largo"),
        to_double(F.col("monto")).alias("doble"),
    )


@query(
    "required_fields",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_name END AS entidad, c_mktsegment AS provincia
    FROM customer WHERE c_acctbal >= 0""",
)
def required_fields(spark, sf_dir):
    """Rows that name their entity; customers with a negative balance lose the name first."""
    rows = views.table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("entidad"),
        F.col("c_mktsegment").alias("provincia"),
    )
    return require_fields(rows, ["entidad", "provincia"])


@query(
    "category_filter",
    """SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'Créditos Hipotecarios'
      WHEN 'SMALL' THEN 'CRÉDITOS HIPOTECARIOS' ELSE p_type END AS tipoCartera
    FROM part WHERE p_type IN ('PROMO', 'SMALL')""",
)
def category_filter(spark, sf_dir):
    kind = (
        F.when(F.col("p_type") == "PROMO", "Créditos Hipotecarios")
        .when(F.col("p_type") == "SMALL", "CRÉDITOS HIPOTECARIOS")
        .otherwise(F.col("p_type"))
    )
    rows = views.table(spark, sf_dir, "part").select("p_partkey", kind.alias("tipoCartera"))
    return only_category(rows)


@query(
    "normalize_schema",
    """SELECT c_name AS entidad, CAST(NULL AS VARCHAR) AS region, c_mktsegment AS sector,
      CAST(NULL AS VARCHAR) AS moneda FROM customer""",
)
def normalize_schema(spark, sf_dir):
    """Expected columns in order: missing ones NULL, extra ones dropped."""
    rows = views.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("sector"), F.col("c_name").alias("entidad"), "c_acctbal"
    )
    return align_columns(rows, ["entidad", "region", "sector", "moneda"])


@query(
    "preferred_columns",
    "SELECT c_name AS entidad, c_mktsegment AS sector, c_custkey, c_acctbal FROM customer",
)
def preferred_columns(spark, sf_dir):
    rows = views.table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_mktsegment").alias("sector"), "c_acctbal", F.col("c_name").alias("entidad")
    )
    return preferred_order(rows)


@query(
    "fallback_column",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS periodo, o_orderpriority AS __periodo FROM orders
    UNION ALL
    SELECT c_custkey, c_mktsegment, c_mktsegment FROM customer""",
)
def fallback_column(spark, sf_dir):
    """``periodo`` as text where the piece has it, else the requested month."""
    with_period = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("periodo"), F.col("o_orderpriority").alias("__periodo")
    )
    without = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_orderkey"), F.col("c_mktsegment").alias("__periodo")
    )
    return fallback_period(with_period).unionByName(fallback_period(without))


@query(
    "rename_select",
    """SELECT c_custkey AS cliente_id, c_name AS cliente, c_mktsegment AS segmento,
      c_acctbal AS "Saldo Neto", n_name AS "País" FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def rename_select(spark, sf_dir):
    joined = views.table(spark, sf_dir, "customer").join(
        views.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    chosen = joined.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_name")
    return chosen.withColumnsRenamed(
        {
            "c_custkey": "cliente_id",
            "c_name": "cliente",
            "c_mktsegment": "segmento",
            "c_acctbal": "Saldo Neto",
            "n_name": "País",
        }
    )


@query(
    "union_pieces",
    """SELECT o_orderkey, o_orderpriority AS sector, CAST(NULL AS DOUBLE) AS monto FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'P'""",
)
def union_pieces(spark, sf_dir):
    """Three pieces with different columns, stacked by name."""
    orders = views.table(spark, sf_dir, "orders")
    sector, amount = F.col("o_orderpriority").alias("sector"), F.col("o_totalprice").alias("monto")
    return concat_pieces(
        [
            orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", sector),
            orders.where(F.col("o_orderstatus") == "O").select(amount, "o_orderkey"),
            orders.where(F.col("o_orderstatus") == "P").select(amount, sector, "o_orderkey"),
        ]
    )
