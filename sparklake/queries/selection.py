"""Row selection: watermarks, newest partitions, periods, calendars, ad-hoc reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklake.functions import periods
from sparklake.operators.quality import span_profile
from sparklake.queries import views
from sparklake.queries.registry import query
from sparklake.sinks.audit import health
from sparklake.sources.landing import latest_loaded_period, latest_rows, path_date_text, rows_after


@query(
    "watermark_filter",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS dt_captura FROM lineitem
    WHERE CAST(l_shipdate AS DATE) > (SELECT COALESCE(max(CAST(o_orderdate AS DATE)), DATE '1900-01-01') FROM orders)""",
)
def watermark_filter(spark, sf_dir):
    """Rows captured after the newest date of the target."""
    rows = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("dt_captura")
    )
    target = views.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt_captura"))
    return rows_after(rows, "dt_captura", target, "dt_captura", "1900-01-01")


@query(
    "watermark_empty_target",
    """SELECT CAST(l_shipdate AS DATE) AS dt_captura, count(*) AS filas FROM lineitem
    WHERE CAST(l_shipdate AS DATE) > DATE '1900-01-01' GROUP BY 1""",
)
def watermark_empty_target(spark, sf_dir):
    rows = views.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("dt_captura"))
    empty = views.table(spark, sf_dir, "orders").where(F.col("o_totalprice") < 0).select(
        F.to_date("o_orderdate").alias("dt_captura")
    )
    newer = rows_after(rows, "dt_captura", empty, "dt_captura", "1900-01-01")
    return newer.groupBy("dt_captura").agg(F.count(F.lit(1)).alias("filas"))


@query(
    "lookback_filter",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS fecha, o_totalprice FROM orders
    WHERE CAST(o_orderdate AS DATE) >= (SELECT CAST(COALESCE(max(CAST(o_orderdate AS DATE)) - INTERVAL 2 MONTH,
      DATE '2012-01-01') AS DATE) FROM orders)""",
)
def lookback_filter(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("fecha"), "o_totalprice"
    )
    start = orders.agg(
        F.coalesce(F.add_months(F.max("fecha"), -2), F.lit("2012-01-01").cast("date")).alias("s")
    ).scalar()
    return orders.where(F.col("fecha") >= start)


_NEW_DATES = """new_dates AS (
  SELECT DISTINCT strftime(l_shipdate, '%Y-%m-%d') AS dt FROM lineitem
  WHERE strftime(l_shipdate, '%Y-%m-%d') > (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM orders))"""


def _new_dates(spark, sf_dir):
    """Capture dates that lie after everything already loaded."""
    captured = views.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("dt"))
    loaded = views.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("dt"))
    return rows_after(captured, "dt", loaded, "dt", "1900-01-01").distinct()


@query(
    "new_dates_semi",
    f"""WITH {_NEW_DATES} SELECT l_orderkey, l_linenumber, l_suppkey, strftime(l_shipdate, '%Y-%m-%d') AS dt
    FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') IN (SELECT dt FROM new_dates)""",
)
def new_dates_semi(spark, sf_dir):
    rows = views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.to_date("l_shipdate").alias("dt")
    )
    kept = rows.join(_new_dates(spark, sf_dir), "dt", "left_semi")
    return kept.withColumn("dt", F.date_format("dt", "yyyy-MM-dd"))


@query(
    "new_dates_array",
    f"""WITH {_NEW_DATES} SELECT count(*) AS cantidad, string_agg(dt, ', ' ORDER BY dt) AS fechas FROM new_dates""",
)
def new_dates_array(spark, sf_dir):
    """The new dates as one text, as the run log shows them: at most one value per day."""
    dates = _new_dates(spark, sf_dir).agg(F.collect_set(F.date_format("dt", "yyyy-MM-dd")).alias("d"))
    return dates.select(
        F.size("d").cast("bigint").alias("cantidad"),
        F.array_join(F.array_sort("d"), ", ").alias("fechas"),
    )


@query(
    "latest_partition",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
    WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""",
)
def latest_partition(spark, sf_dir):
    rows = latest_rows(views.table(spark, sf_dir, "lineitem"), "l_shipdate")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


@query(
    "path_partition_value",
    """SELECT page_id, nullif(regexp_extract(url, '/dt=(\\d{4}-\\d{2}-\\d{2})/', 1), '') AS dt,
      nullif(regexp_extract(url, '/([a-z]{2})/', 1), '') AS idioma FROM (
        SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN replace(url, '/en/', '/dt=2024-09-14/') ELSE url END AS url
        FROM pages) v""",
)
def path_partition_value(spark, sf_dir):
    """A date folder inside a path, NULL where there is none; and another path segment."""
    pages = views.table(spark, sf_dir, "pages")
    path = F.when(F.col("url").like("%/en/%"), F.replace("url", F.lit("/en/"), F.lit("/dt=2024-09-14/"))).otherwise(
        F.col("url")
    )
    rows = pages.select("page_id", path.alias("path"))
    return rows.select(
        "page_id",
        path_date_text(F.col("path")).alias("dt"),
        F.nullif(F.regexp_extract("path", "/([a-z]{2})/", 1), F.lit("")).alias("idioma"),
    )


_LISTING_SQL = """listing AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN concat('loans/dt=', strftime(l_shipdate, '%Y-%m-%d'), '/consolidado_', l_orderkey, '.csv')
    ELSE concat('loans/dt=', strftime(l_shipdate, '%Y-%m-%d'), '/incremental_', l_orderkey, '.csv') END AS path
  FROM lineitem)"""


@query(
    "latest_loaded_period",
    f"""WITH {_LISTING_SQL} SELECT max(substr(regexp_extract(path, '/dt=([^/]*)', 1), 1, 7)) AS ultimo_periodo
    FROM listing WHERE path LIKE '%consolidado%' AND path LIKE '%.csv%'""",
)
def latest_loaded(spark, sf_dir):
    """Newest month among consolidated files of a listing."""
    kind = F.when(F.col("l_returnflag") == "R", "consolidado").otherwise("incremental")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    path = F.concat(F.lit("loans/dt="), day, F.lit("/"), kind, F.lit("_"), F.col("l_orderkey"), F.lit(".csv"))
    return latest_loaded_period(views.table(spark, sf_dir, "lineitem").select(path.alias("path")))


@query(
    "rows_per_key",
    "SELECT user_id, event_type, count(*) AS filas FROM events GROUP BY 1, 2",
)
def rows_per_key(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    return events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("filas"))


@query(
    "distinct_dates",
    "SELECT DISTINCT CAST(year(o_orderdate) AS BIGINT) AS anio, CAST(o_orderdate AS DATE) AS fecha FROM orders",
)
def distinct_dates(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return orders.select(F.year("o_orderdate").cast("bigint").alias("anio"), F.to_date("o_orderdate").alias("fecha")).distinct()


@query(
    "profile_min_max",
    """SELECT o_orderstatus, count(*) AS filas, min(CAST(o_orderdate AS DATE)) AS desde, max(CAST(o_orderdate AS DATE)) AS hasta
    FROM orders GROUP BY 1""",
)
def profile_min_max(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select("o_orderstatus", F.to_date("o_orderdate").alias("fecha"))
    return span_profile(orders, "fecha", ["o_orderstatus"])


def _bounds(spark, sf_dir):
    return views.table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )


_SPINE_SQL = """SELECT CAST(unnest(generate_series(date_trunc('month', {first}), date_trunc('month', {last}),
  INTERVAL 1 MONTH)) AS DATE) AS periodo_date FROM (
    SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders) b"""


@query("month_spine", _SPINE_SQL.format(first="lo", last="hi"))
def month_spine(spark, sf_dir):
    return periods.month_spine(_bounds(spark, sf_dir))


@query("lookback_months", _SPINE_SQL.format(first="hi - INTERVAL 2 MONTH", last="hi"))
def lookback_months(spark, sf_dir):
    return periods.lookback_months(_bounds(spark, sf_dir), 3)


@query(
    "lookback_rows",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS periodo_date FROM orders
    WHERE date_trunc('month', o_orderdate) >= (SELECT date_trunc('month', max(o_orderdate)) - INTERVAL 2 MONTH FROM orders)""",
)
def lookback_rows(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("periodo_date"))
    return periods.select_periods(rows, periods.lookback_months(_bounds(spark, sf_dir), 3))


@query(
    "forced_periods",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS periodo_date FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') IN ('1996-02', '1999-12')""",
)
def forced_periods(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("periodo_date"))
    return periods.select_periods(rows, periods.lookback_months(_bounds(spark, sf_dir), 3), ["1996-02", "1999-12"])


@query(
    "coverage_gaps",
    """WITH seen AS (
      SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
    ), spine AS (
      SELECT o_custkey, CAST(unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT o_custkey, min(m) AS lo, max(m) AS hi FROM seen GROUP BY 1) b)
    SELECT s.o_custkey, s.m AS periodo_date FROM spine s ANTI JOIN seen t ON s.o_custkey = t.o_custkey AND s.m = t.m""",
)
def coverage_gaps(spark, sf_dir):
    """Months without an order between the first and last order of every customer."""
    orders = views.table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return periods.coverage_gaps(orders, "o_orderdate", ["o_custkey"])


@query(
    "period_from_parts",
    """SELECT make_date(year(o_orderdate), month(o_orderdate), 1) AS periodo_date, count(*) AS filas
    FROM orders WHERE make_date(year(o_orderdate), month(o_orderdate), 1) >= DATE '1998-05-01' GROUP BY 1""",
)
def period_from_parts(spark, sf_dir):
    month = periods.month_start(F.year("o_orderdate"), F.month("o_orderdate"))
    orders = views.table(spark, sf_dir, "orders").select(month.alias("periodo_date"))
    recent = orders.where(F.col("periodo_date") >= F.lit("1998-05-01").cast("date"))
    return recent.groupBy("periodo_date").agg(F.count(F.lit(1)).alias("filas"))


def _log(spark, sf_dir):
    """Events as a run log."""
    return views.table(spark, sf_dir, "events").select(
        F.concat(F.col("event_type"), F.lit("_"), F.col("user_id")).alias("process_name"),
        F.upper("event_type").alias("status"),
        F.col("event_id").alias("rows_processed"),
        F.col("ts").alias("created_at"),
        F.concat(F.lit("ALERTA: "), F.col("props")).alias("message"),
    )


_LOG_SQL = """log AS (SELECT concat(event_type, '_', user_id) AS process_name, upper(event_type) AS status,
  event_id AS rows_processed, ts AS created_at, concat('ALERTA: ', props) AS message FROM events)"""


@query(
    "log_health",
    f"WITH {_LOG_SQL} SELECT * FROM log WHERE created_at >= TIMESTAMP '2024-01-30' ORDER BY created_at DESC, process_name",
)
def log_health(spark, sf_dir):
    """Events since a day, newest first (a full sort, for presentation)."""
    return health(_log(spark, sf_dir), "2024-01-30")


@query(
    "recent_log_topn",
    f"""WITH {_LOG_SQL} SELECT * FROM log WHERE created_at >= TIMESTAMP '2024-01-15' AND process_name LIKE 'error_%'
    ORDER BY created_at DESC, process_name LIMIT 20""",
)
def recent_log_topn(spark, sf_dir):
    """The last 20 events of a kind of process."""
    return health(_log(spark, sf_dir), "2024-01-15", "error_%", 20)


@query(
    "log_alert_regex",
    f"""WITH {_LOG_SQL} SELECT status, CASE WHEN regexp_matches(message, 'ALERTA.*9') THEN 'WARNING' ELSE 'SUCCESS' END AS veredicto,
      count(*) AS filas FROM log GROUP BY 1, 2""",
)
def log_alert_regex(spark, sf_dir):
    rows = _log(spark, sf_dir).select(
        "status", F.when(F.col("message").rlike("ALERTA.*9"), "WARNING").otherwise("SUCCESS").alias("veredicto")
    )
    return rows.groupBy("status", "veredicto").agg(F.count(F.lit(1)).alias("filas"))
