"""Queries of the monitoring operators, over events as metric samples."""

from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog import quality as Q
from tallywell.catalog.base import query, ratio, sql
from tallywell.operators import monitoring as M
from tallywell.operators.quality import count_columns, valid_rows
from tallywell.operators.revenue import add_line_revenue, business_kpis, revenue_by_product_date
from tallywell.catalog.checks import totals_by
from tallywell.session import materialize, new_path
from tallywell.sources import star

AS_OF = datetime(2024, 2, 1, 6, 0)
SERIES = ["metric", "instance"]


def samples(spark: SparkSession, folder: str) -> DataFrame:
    return star.metric_samples(spark, folder)


@query("published_coverage", sql(
    """SELECT max(sale_date) AS latest_date, count(DISTINCT sale_date) AS days, count(sale_date) > 0 AS ok FROM valid
    UNION ALL SELECT max(sale_date), count(DISTINCT sale_date), count(sale_date) > 0 FROM valid WHERE quantity > 1000000""",
    "valid"))
def published_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """The published days, and those of a table that came out empty."""
    lines = star.valid_lines(spark, folder, ("sale_date", "quantity"))
    found = [M.published_coverage(totals_by(part, "sale_date")) for part in (lines, lines.where("quantity > 1000000"))]
    return found[0].unionByName(found[1])


_TABLES = {
    "detail": "SELECT * FROM valid",
    "days": "SELECT DISTINCT sale_date FROM valid",
    "products": "SELECT DISTINCT product_id FROM valid",
    "countries": "SELECT DISTINCT country FROM valid",
    "returned_parts_of_tax": "SELECT * FROM valid WHERE l_tax > 1",
}


@query("table_volumes", sql(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS table_rows, count(*) > 0 AS ok FROM ({body})" for t, body in _TABLES.items()
    ), "valid"))
def table_volumes(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("sale_date", "product_id", "country", "l_tax"))
    return M.table_volumes(
        {
            "detail": detail,
            "days": totals_by(detail, "sale_date"),
            "products": totals_by(detail, "product_id"),
            "countries": totals_by(detail, "country"),
            "returned_parts_of_tax": detail.where(F.col("l_tax") > 1),
        }
    )


@query("layer_coherence", sql(
    """SELECT detail_total, aggregate_total, CAST(abs(detail_total - aggregate_total) AS DECIMAL(29,2)) AS difference,
        abs(detail_total - aggregate_total) <= 0.01 AS ok
    FROM (SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) AS detail_total FROM valid),
        (SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) AS aggregate_total FROM valid
            UNION ALL SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) FROM valid WHERE quantity > 3)""", "valid"))
def layer_coherence(spark: SparkSession, folder: str) -> DataFrame:
    """The detail against the totals of all its lines, and of a part of them."""
    detail = star.valid_lines(spark, folder, ("product_id", "quantity"))
    found = [M.layer_coherence(detail, totals_by(part, "product_id")) for part in (detail, detail.where("quantity > 3"))]
    return found[0].unionByName(found[1])


LATEST = """SELECT metric, instance, ts, value FROM samples
    QUALIFY row_number() OVER (PARTITION BY metric, instance ORDER BY ts DESC, sample_id DESC) = 1"""


@query("latest_values", sql(LATEST, "samples"))
def latest_values(spark: SparkSession, folder: str) -> DataFrame:
    return M.latest_values(samples(spark, folder), SERIES)


@query("threshold_alerts", sql(f"SELECT * FROM ({LATEST}) WHERE value > 100", "samples"))
def threshold_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return M.threshold_alerts(samples(spark, folder), SERIES, ">", F.lit(100))


@query("staleness", sql(
    """SELECT *, age_seconds > 93600 AS is_stale FROM (SELECT metric, instance, max(ts) AS last_ts,
        (epoch_us(TIMESTAMP '2024-02-01 06:00:00') - epoch_us(max(ts))) // 1000000 AS age_seconds
        FROM samples GROUP BY metric, instance)""", "samples"))
def staleness(spark: SparkSession, folder: str) -> DataFrame:
    return M.staleness(samples(spark, folder), SERIES, AS_OF)


@query("group_total_by_label", sql(
    f"SELECT metric, CAST(sum(value) AS DECIMAL(28,4)) AS total FROM ({LATEST}) GROUP BY metric", "samples"))
def group_total(spark: SparkSession, folder: str) -> DataFrame:
    return M.group_total_by_label(samples(spark, folder), SERIES, "metric")


@query("top_metrics", sql(f"SELECT * FROM ({LATEST}) ORDER BY value DESC, metric, instance LIMIT 10", "samples"))
def top_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return M.top_metrics(samples(spark, folder), SERIES, 10)


@query("absent_series", "SELECT CAST(c_custkey AS VARCHAR) AS instance FROM customer "
    "WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def absent_series(spark: SparkSession, folder: str) -> DataFrame:
    expected = star.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("instance"))
    return M.absent_series(expected, samples(spark, folder), ["instance"])


@query("match_scalar_series", sql(
    f"""SELECT * FROM (SELECT metric, ts, value, whole, {ratio("value", "whole", 4, 4, 4)} AS share FROM
        (SELECT metric, date_trunc('hour', ts) AS ts, CAST(sum(value) AS DECIMAL(28,4)) AS value FROM samples GROUP BY 1, 2)
        JOIN (SELECT date_trunc('hour', ts) AS ts, CAST(sum(value) AS DECIMAL(28,4)) AS whole FROM samples GROUP BY 1)
        USING (ts)) WHERE share > 0.8""", "samples"))
def match_scalar_series(spark: SparkSession, folder: str) -> DataFrame:
    hourly = samples(spark, folder).withColumn("ts", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    total = F.sum("value").cast("decimal(28,4)").alias("value")
    return M.match_scalar_series(hourly.groupBy("metric", "ts").agg(total), hourly.groupBy("ts").agg(total), ["metric"])


@query("stage_survival", sql(
    f"""SELECT *, {ratio("part_value", "whole_value", 4, 4, 4)} AS share FROM (SELECT instance,
        max(value) FILTER (WHERE metric = 'purchase') AS part_value,
        max(value) FILTER (WHERE metric = 'view') AS whole_value FROM ({LATEST}) GROUP BY instance)
    WHERE part_value IS NOT NULL AND whole_value <> 0""", "samples"))
def stage_survival(spark: SparkSession, folder: str) -> DataFrame:
    return M.stage_survival(samples(spark, folder), "metric", "purchase", "view", ["instance"])


def _range(micros: int) -> str:
    return f"OVER (PARTITION BY metric ORDER BY micros RANGE BETWEEN {micros} PRECEDING AND CURRENT ROW)"


@query("volume_drop", sql(
    f"""SELECT metric, ts, sample_id, value, {ratio("total", "n", 4, 4)} AS trailing_mean FROM (
        SELECT *, sum(value) {_range(M.DAY * 7)} AS total, count(*) {_range(M.DAY * 7)} AS n FROM samples)
    WHERE value * n < 0.5 * total""", "samples"))
def volume_drop(spark: SparkSession, folder: str) -> DataFrame:
    return M.volume_drop(samples(spark, folder), ["metric"])


def _increase(micros: int) -> str:
    return f"""SELECT metric, ts, sample_id, CAST(sum(coalesce(delta, 0)) {_range(micros)}
            - coalesce(first_value(delta) {_range(micros)}, 0) AS DECIMAL(28,4)) AS increase
        FROM (SELECT *, CASE WHEN value >= before THEN value - before WHEN before IS NOT NULL THEN value END AS delta
            FROM (SELECT *, lag(value) OVER (PARTITION BY metric ORDER BY micros, sample_id) AS before FROM samples))"""


@query("counter_increase", sql(_increase(M.HOUR), "samples"))
def counter_increase(spark: SparkSession, folder: str) -> DataFrame:
    return M.counter_increase(samples(spark, folder), ["metric"])


_DAY_RATE = f"""SELECT metric, ts, sample_id, {ratio("increase", "86400", 6, 4)} AS rate
    FROM ({_increase(M.DAY)})"""


@query("counter_rate", sql(_DAY_RATE.replace("AS DECIMAL(22,6)", "AS DECIMAL(28,6)"), "samples"))
def counter_rate(spark: SparkSession, folder: str) -> DataFrame:
    return M.counter_rate(samples(spark, folder), ["metric"], M.DAY)


@query("sustained_condition", sql(
    """SELECT metric, min(ts) AS since, max(ts) AS until, count(*) AS samples FROM (
        SELECT *, sum(CASE WHEN value > 20 THEN 0 ELSE 1 END) OVER (PARTITION BY metric ORDER BY micros) AS span FROM samples)
    WHERE value > 20 GROUP BY metric, span HAVING max(micros) - min(micros) >= 7200000000""", "samples"))
def sustained_condition(spark: SparkSession, folder: str) -> DataFrame:
    return M.sustained_condition(samples(spark, folder), ["metric"], F.col("value") > 20, 7200)


@query("offset_delta", sql(
    f"""SELECT s.metric, s.ts, s.sample_id, s.value, o.value AS earlier_value,
        CAST(s.value - o.value AS DECIMAL(20,4)) AS delta
    FROM samples s ASOF JOIN samples o ON s.metric = o.metric AND s.micros - {M.DAY} >= o.micros""", "samples"))
def offset_delta(spark: SparkSession, folder: str) -> DataFrame:
    return M.offset_delta(samples(spark, folder), ["metric"])


_DOTTED = """SELECT sample_id, CASE metric
    WHEN 'view' THEN 'airflow.dag.flow_' || instance || '.task_' || job || '.duration'
    WHEN 'click' THEN 'airflow.ti.finish.flow_' || instance || '.task_' || job || '.success'
    WHEN 'error' THEN 'airflow.ti_failures' WHEN 'signup' THEN 'airflow.pool.open.' || job
    ELSE 'other.' || job END AS dotted, metric AS kind, instance, job FROM samples"""


@query("relabel_metrics", sql(
    f"""SELECT sample_id, CASE kind WHEN 'view' THEN 'airflow_tarea_duracion_segundos'
        WHEN 'click' THEN 'airflow_tarea_finalizada_total' WHEN 'error' THEN 'airflow_ti_failures'
        WHEN 'signup' THEN 'airflow_pool_open_' || job ELSE dotted END AS metric_name,
        CASE WHEN kind IN ('view', 'click') THEN 'flow_' || instance END AS grafo,
        CASE WHEN kind IN ('view', 'click') THEN 'task_' || job END AS tarea,
        CASE WHEN kind = 'click' THEN 'success' END AS estado,
        CASE WHEN kind = 'error' THEN 'fallo' END AS resultado FROM ({_DOTTED})""", "samples"))
def relabel_metrics(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("metric")
    flow, task = F.concat(F.lit("flow_"), "instance"), F.concat(F.lit("task_"), "job")
    dotted = (
        F.when(kind == "view", F.concat_ws(".", F.lit("airflow.dag"), flow, task, F.lit("duration")))
        .when(kind == "click", F.concat_ws(".", F.lit("airflow.ti.finish"), flow, task, F.lit("success")))
        .when(kind == "error", "airflow.ti_failures")
        .when(kind == "signup", F.concat(F.lit("airflow.pool.open."), "job"))
        .otherwise(F.concat(F.lit("other."), "job"))
    )
    named = M.relabel_metrics(samples(spark, folder).select("sample_id", dotted.alias("metric")))
    labels = [F.col("labels")[k].alias(k) for k in ("grafo", "tarea", "estado", "resultado")]
    return named.select("sample_id", "metric_name", *labels)


_REASONS = " UNION ALL ".join(
    f"SELECT 'pipeline_ventas_filas_rechazadas_total', '{r.name}', count(*) FILTER (WHERE reject_reason = '{r.name}') FROM classified"
    for r in Q.RULES
)


@query("run_metrics", sql(
    f"""SELECT metric, label, value FROM (
        SELECT 'pipeline_ventas_filas_procesadas' AS metric, 'ingesta' AS label, CAST(count(*) AS DOUBLE) AS value FROM classified
        UNION ALL SELECT 'pipeline_ventas_filas_procesadas', 'validacion', count(*) FROM classified WHERE reject_reason IS NULL
        UNION ALL {_REASONS}
        UNION ALL SELECT 'pipeline_ventas_porcentaje_rechazo', NULL,
            CAST({ratio("count(reject_reason)", "count(*)", 4, 0, 0, 100)} AS DOUBLE) FROM classified
        UNION ALL SELECT 'pipeline_ventas_ingreso_total', NULL, CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DOUBLE) FROM classified
            WHERE reject_reason IS NULL
        UNION ALL SELECT 'pipeline_ventas_productos_distintos', NULL, count(DISTINCT product_id) FROM classified
            WHERE reject_reason IS NULL
        UNION ALL SELECT 'pipeline_ventas_dias_cubiertos', NULL, count(DISTINCT sale_date) FROM classified
            WHERE reject_reason IS NULL
        UNION ALL SELECT 'pipeline_ventas_ejecucion_exitosa', NULL, 1)""", "classified"))
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The metric rows of a run, written to the table of samples and read back."""
    seen = Observation()
    lines = materialize(Q.classified(spark, folder, "sale_date").observe(seen, *count_columns(Q.RULES)).drop("ordinal"), "lines")
    stats = dict(seen.get)
    stats["reject_pct"] = round(stats["rejected_rows"] / stats["input_rows"] * 100, 4)
    detail = add_line_revenue(valid_rows(lines))
    kpis = business_kpis(revenue_by_product_date(detail, ordered=False)).first().asDict()
    stages = {"ingesta": (stats["input_rows"], 1.0), "validacion": (stats["valid_rows"], 1.0)}
    rows = M.run_metrics(stats, [r.name for r in Q.RULES], stages, kpis, True, AS_OF)
    path = new_path(spark, "run_metrics")
    M.append_metrics(spark, rows, path, "run", AS_OF)
    timeless = ~F.col("metric").isin(M.M_SECONDS, M.M_LAST_SUCCESS)
    label = F.coalesce(F.col("labels")["etapa"], F.col("labels")["regla"])
    return spark.read.parquet(path).where(timeless).select("metric", label.alias("label"), "value")
