"""Monitoring queries over published tables and over metric samples.

Metric samples are rows of (metric, labels..., ts, value, sample_id); a series
is one combination of metric and labels.
"""

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.functions import numbers as N
from tallywell.functions.text import bind
from tallywell.operators import series as T
from tallywell.operators.checks import reconcile_totals
from tallywell.session import materialize

HOUR = 3600 * T.MICROS
DAY = 24 * HOUR

# Limits of the alerts.
MAX_STALENESS_SECONDS = 93_600
REJECT_PCT_ALERT = 10
STAGE_SECONDS_ALERT = 900
VOLUME_DROP_FACTOR = "0.5"
CONNECTION_SHARE_ALERT = "0.8"
FAILURES_PER_HOUR_ALERT = 3

# Names of the metrics of a run.
M_ROWS = "pipeline_ventas_filas_procesadas"
M_SECONDS = "pipeline_ventas_duracion_segundos"
M_REJECTED = "pipeline_ventas_filas_rechazadas_total"
M_REVENUE = "pipeline_ventas_ingreso_total"
M_PRODUCTS = "pipeline_ventas_productos_distintos"
M_DAYS = "pipeline_ventas_dias_cubiertos"
M_REJECT_PCT = "pipeline_ventas_porcentaje_rechazo"
M_SUCCESS = "pipeline_ventas_ejecucion_exitosa"
M_LAST_SUCCESS = "pipeline_ventas_ultima_ejecucion_exitosa_timestamp"
M_TABLE_ROWS = "almacen_filas_por_tabla"
M_PUBLISHED_DAYS = "almacen_dias_publicados"
M_LAYER_DIFFERENCE = "almacen_diferencia_entre_capas"
M_WATCH_DONE = "almacen_vigilancia_completada"


# Published tables.


def published_coverage(daily: DataFrame) -> DataFrame:
    """MN1: latest published date, number of days, and whether that is sound."""
    return daily.agg(F.max("sale_date").alias("latest_date"), F.count("*").alias("days")).withColumn(
        "ok", (F.col("days") > 0) & F.col("latest_date").isNotNull()
    )


def table_volumes(tables: dict[str, DataFrame]) -> DataFrame:
    """MN2: rows per table and whether any is there."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("table_rows")).select(F.lit(name).alias("table_name"), "table_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("ok", F.col("table_rows") > 0)


def layer_coherence(raw: DataFrame, published: DataFrame, tolerance: str = S.AMOUNT_TOLERANCE) -> DataFrame:
    """MN3: raw and published totals and whether they agree."""
    both = reconcile_totals(raw, published)
    return both.withColumn("ok", F.col("difference") <= F.lit(tolerance).cast(S.MONEY))


# Latest values and thresholds.


def latest_values(samples: DataFrame, by: Sequence[str], time: str = "ts") -> DataFrame:
    """The last sample of each series."""
    last = F.max_by(F.struct(F.col(time).alias("ts"), "value"), F.struct(time, "sample_id"))
    return samples.groupBy(*by).agg(last.alias("last")).select(*by, "last.ts", "last.value")


_COMPARISONS = {
    "==": lambda a, b: a == b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


def threshold_alerts(samples: DataFrame, by: Sequence[str], comparison: str, limit: Column) -> DataFrame:
    """MN5: series whose latest value is beyond a limit."""
    return latest_values(samples, by).where(_COMPARISONS[comparison](F.col("value"), limit))


def staleness(samples: DataFrame, by: Sequence[str], as_of: datetime, limit: int = MAX_STALENESS_SECONDS) -> DataFrame:
    """MN6: seconds since the last sample of each series and whether too long."""
    now = F.lit(as_of).cast("timestamp_ntz")
    return (
        samples.groupBy(*by)
        .agg(F.max("ts").alias("last_ts"))
        .withColumn("age_seconds", F.timestamp_diff("SECOND", F.col("last_ts"), now))
        .withColumn("is_stale", F.col("age_seconds") > limit)
    )


def group_total_by_label(samples: DataFrame, series: Sequence[str], label: str) -> DataFrame:
    """AG17: the latest value of every series, summed per label."""
    return latest_values(samples, series).groupBy(label).agg(F.sum("value").cast("decimal(28,4)").alias("total"))


def top_metrics(samples: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """ST5: the k series with the largest latest value."""
    return latest_values(samples, by).orderBy(F.desc("value"), *by).limit(k)


def absent_series(expected: DataFrame, samples: DataFrame, by: Sequence[str]) -> DataFrame:
    """MN10/JN9: expected series without any sample; a missing label is a value of its own."""
    seen = samples.select(*[F.col(c).alias(f"_seen_{c}") for c in by]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_seen_{c}")) for c in by]
    return expected.join(seen, reduce(lambda a, b: a & b, same), "left_anti")


def match_scalar_series(many: DataFrame, one: DataFrame, by: Sequence[str], limit: str = CONNECTION_SHARE_ALERT) -> DataFrame:
    """JN7: each series over the single series of the same instant, above a limit."""
    whole = one.select("ts", F.col("value").alias("whole"))
    share = N.ratio(F.col("value"), F.col("whole"), 4, scale=4)
    return (
        many.join(whole, "ts")
        .select(*by, "ts", "value", "whole", share.alias("share"))
        .where(F.col("share") > F.lit(limit).cast("decimal(10,4)"))
    )


def stage_survival(samples: DataFrame, label: str, part: str, whole: str, by: Sequence[str] = ()) -> DataFrame:
    """JN8: latest value of one label over that of another, per remaining labels."""
    latest = latest_values(samples, [*by, label])
    sides = latest.groupBy(*by).agg(
        F.max(F.when(F.col(label) == part, F.col("value"))).alias("part_value"),
        F.max(F.when(F.col(label) == whole, F.col("value"))).alias("whole_value"),
    )
    return sides.withColumn("share", N.ratio(F.col("part_value"), F.col("whole_value"), 4, scale=4)).where(
        F.col("share").isNotNull()
    )


# Windows over the history of a series.


def volume_drop(
    samples: DataFrame, by: Sequence[str], window: int = 7 * DAY, factor: str = VOLUME_DROP_FACTOR
) -> DataFrame:
    """MN7: samples below a fraction of the trailing mean, their own value included."""
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at"), F.lit(1).alias("one"))
    summed = T.trailing_sum(
        timed.withColumn("part", F.col("value")),
        by, "at", F.col("at") + window, {"part": "window_sum", "one": "window_count"},
    )
    mean = N.mean(F.col("window_sum"), F.col("window_count"), 4, scale=4)
    below = F.col("value") * F.col("window_count") < F.lit(factor).cast("decimal(4,2)") * F.col("window_sum")
    return summed.where(below).select(*by, "ts", "sample_id", "value", mean.alias("trailing_mean"))


def counter_increase(samples: DataFrame, by: Sequence[str], window: int = HOUR) -> DataFrame:
    """MN8: growth that samples show over the trailing window, per sample; ``counters`` has the extrapolated form.

    A fall means the counter restarted, so the new value is the growth. Growth
    between two samples counts while both lie in the window; nothing is
    extrapolated. The growths are written out, as the running total reads them
    twice.
    """
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at"))
    paired = T.with_previous(timed, by, "at", "sample_id", ["at", "value"])
    before = F.col("previous.value")
    growth = F.when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    in_window = F.col("previous.at") + window >= F.col("at")
    grown = paired.withColumn(
        "growth", F.when(F.col("previous").isNotNull() & in_window, growth).otherwise(0).cast("decimal(20,4)")
    ).withColumn("until", F.greatest("at", F.coalesce(F.col("previous.at") + window, F.col("at"))))
    grown = materialize(grown.drop("previous"), "growth")
    summed = T.trailing_sum(grown, by, "at", F.col("until"), {"growth": "increase"})
    return summed.select(*by, "ts", "sample_id", F.col("increase").cast("decimal(28,4)").alias("increase"))


def counter_rate(samples: DataFrame, by: Sequence[str], window: int = 300 * T.MICROS) -> DataFrame:
    """MN8: growth of a counter per second over the trailing window."""
    grown = counter_increase(samples, by, window)
    per_second = F.col("increase") / F.lit(window // T.MICROS).cast("decimal(10,0)")
    return grown.withColumn("rate", F.round(per_second, 6).cast("decimal(28,6)")).drop("increase")


def sustained_condition(samples: DataFrame, by: Sequence[str], condition: Column, seconds: int) -> DataFrame:
    """MN9: spans in which every sample met a condition, at least so long.

    A span is numbered by the samples that broke the condition before it. The
    spans are aggregated, so one of any length is no burden.
    """
    return _spans(samples.select(*by, "ts", condition.alias("met")), by).where(F.col("lasted") >= seconds * T.MICROS).drop("lasted")


def _spans(samples: DataFrame, by: Sequence[str]) -> DataFrame:
    """Spans of samples that are ``met``, with the microseconds they ``lasted``."""
    timed = samples.select(*by, "ts", T.micros("ts").alias("at"), F.coalesce("met", F.lit(False)).alias("met"))
    timed = timed.withColumn("broke", F.when(F.col("met"), 0).otherwise(1))
    numbered = T.running_total(timed, by, "at", {"broke": "span"})
    spans = (
        numbered.where("met")
        .groupBy(*by, "span")
        .agg(F.min("ts").alias("since"), F.max("ts").alias("until"), F.count("*").alias("samples"))
    )
    return spans.withColumn("lasted", T.micros("until") - T.micros("since")).drop("span")


def offset_delta(samples: DataFrame, by: Sequence[str], back: int = DAY) -> DataFrame:
    """MN11: value minus the value of the same series ``back`` earlier."""
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at"))
    found = T.value_before(timed, by, "at", "sample_id", "value", back, "earlier_value")
    return found.where(F.col("earlier_value").isNotNull()).select(
        *by, "ts", "sample_id", "value", "earlier_value",
        (F.col("value") - F.col("earlier_value")).cast("decimal(20,4)").alias("delta"),
    )


# Names.

# Dotted metric names (one part per star) with the stable name and
# the labels of each; the first match wins and the last line takes the rest.
METRIC_PATTERNS = (
    ("airflow.dagrun.duration.success.*", "airflow_dagrun_duracion_exitosa_segundos", {"grafo": "$1", "resultado": "exitosa"}),
    ("airflow.dagrun.duration.failed.*", "airflow_dagrun_duracion_fallida_segundos", {"grafo": "$1", "resultado": "fallida"}),
    ("airflow.dagrun.schedule_delay.*", "airflow_dagrun_retraso_programacion_segundos", {"grafo": "$1"}),
    ("airflow.dag.*.*.duration", "airflow_tarea_duracion_segundos", {"grafo": "$1", "tarea": "$2"}),
    ("airflow.ti.finish.*.*.*", "airflow_tarea_finalizada_total", {"grafo": "$1", "tarea": "$2", "estado": "$3"}),
    ("airflow.ti_failures", "airflow_ti_failures", {"resultado": "fallo"}),
    ("airflow.ti_successes", "airflow_ti_successes", {"resultado": "exito"}),
    ("airflow.scheduler_heartbeat", "airflow_scheduler_heartbeat", {}),
    ("airflow.scheduler.tasks.running", "airflow_tareas_en_ejecucion", {}),
    ("airflow.scheduler.tasks.starving", "airflow_tareas_sin_recursos", {}),
    ("airflow.executor.open_slots", "airflow_ranuras_libres", {}),
    ("airflow.executor.queued_tasks", "airflow_tareas_en_cola", {}),
    ("airflow.executor.running_tasks", "airflow_tareas_ejecutor_activas", {}),
    ("airflow.dag_processing.import_errors", "airflow_errores_de_importacion", {}),
    ("airflow.dag_processing.total_parse_time", "airflow_tiempo_analisis_grafos_segundos", {}),
)
METRIC_REST = (r"^airflow\.(.+)$", "airflow_")


@dataclass
class _Node:
    """A place in the trie of patterns: what may follow, and the number of the pattern that ends here."""

    parts: dict[str, "_Node"] = field(default_factory=dict)
    pattern: int | None = None


def _trie() -> _Node:
    root = _Node()
    for number, (pattern, _, _) in enumerate(METRIC_PATTERNS):
        node = root
        for part in pattern.split("."):
            node = node.parts.setdefault(part, _Node())
        node.pattern = number if node.pattern is None else node.pattern
    return root


def _first_pattern(parts: Column, node: _Node, depth: int = 0) -> Column:
    """Number of the first pattern that the parts of a name match, null for none; each part is compared along its branch only."""
    here = F.get(parts, F.lit(depth))
    found = []
    if node.pattern is not None:
        found.append(F.when(F.size(parts) == depth, F.lit(node.pattern)))
    for part, below in node.parts.items():
        fits = here != "" if part == "*" else here == part
        found.append(F.when(fits, _first_pattern(parts, below, depth + 1)))
    # least() passes over nulls
    return F.least(*found) if len(found) > 1 else found[0]


def _named(source: Column, parts: Column, number: Column) -> Column:
    """Struct of the stable name and the labels of a name whose pattern is known."""
    regex, prefix = METRIC_REST
    rest = F.concat(F.lit(prefix), F.regexp_replace(F.regexp_extract(source, regex, 1), "[^a-zA-Z0-9_]", "_"))
    names = F.array(*[F.lit(name) for _, name, _ in METRIC_PATTERNS])
    name = F.coalesce(F.get(names, number), F.when(source.rlike(regex), rest), source)
    empty = F.create_map().cast("map<string,string>")
    labels = F.when(number.isNull(), empty)
    for k, (pattern, _, values) in enumerate(METRIC_PATTERNS):
        stars = [i for i, part in enumerate(pattern.split(".")) if part == "*"]
        pairs = [
            x
            for key, value in values.items()
            for x in (F.lit(key), F.get(parts, F.lit(stars[int(value[1:]) - 1])) if value.startswith("$") else F.lit(value))
        ]
        labels = labels.when(number == k, F.create_map(*pairs) if pairs else empty)
    return F.struct(name.alias("name"), labels.alias("labels"))


def relabel_metrics(df: DataFrame, name: str = "metric") -> DataFrame:
    """MN12: dotted metric names as a stable name and a map of labels.

    Each name is split once and walked through the trie of all patterns. Names of no
    pattern keep their name and get no labels.
    """
    source = F.col(name)
    found = bind(F.split(source, r"\.", -1), lambda parts: bind(_first_pattern(parts, _trie()), lambda number: _named(source, parts, number)))
    told = df.withColumn("_named", found)
    return told.withColumns({"metric_name": F.col("_named.name"), "labels": F.coalesce("_named.labels", F.create_map().cast("map<string,string>"))}).drop("_named")


# Rows of a run.


def metric_row(metric: str, value: float, **labels: str) -> dict:
    return {"metric": metric, "labels": labels, "value": float(value)}


def run_metrics(stats: dict, rules: Sequence[str], stages: dict[str, tuple[int | None, float | None]], kpis: dict, success: bool, now: datetime) -> list[dict]:
    """MN4: the metric rows of one run, a few dozen figures."""
    rows = [metric_row(M_ROWS, n, etapa=stage) for stage, (n, _) in stages.items() if n is not None]
    rows += [metric_row(M_SECONDS, seconds, etapa=stage) for stage, (_, seconds) in stages.items() if seconds is not None]
    rows += [metric_row(M_REJECTED, stats[rule], regla=rule) for rule in rules]
    rows += [
        metric_row(M_REVENUE, kpis["total_revenue"]),
        metric_row(M_PRODUCTS, kpis["distinct_products"]),
        metric_row(M_DAYS, kpis["days_covered"]),
        metric_row(M_REJECT_PCT, stats["reject_pct"]),
        metric_row(M_SUCCESS, 1 if success else 0),
    ]
    if success:
        rows.append(metric_row(M_LAST_SUCCESS, now.timestamp()))
    return rows


def watch_metrics(volumes: dict[str, int] | None, days: int | None, difference: float | None) -> list[dict]:
    """MN4: the metric rows of one watch over the warehouse."""
    rows = [
        metric_row(M_TABLE_ROWS, n, tabla=table.replace(".", "_")) for table, n in (volumes or {}).items()
    ]
    if days is not None:
        rows.append(metric_row(M_PUBLISHED_DAYS, days))
    if difference is not None:
        rows.append(metric_row(M_LAYER_DIFFERENCE, difference))
    done = bool(volumes) and difference is not None
    return [*rows, metric_row(M_WATCH_DONE, 1 if done else 0)]


def append_metrics(spark, rows: list[dict], path: str, run_id: str, now: datetime) -> None:
    """MN4: append the rows of a run to the table of metric samples."""
    schema = "metric string, labels map<string,string>, value double"
    (
        spark.createDataFrame(rows, schema)
        .withColumns({"run_id": F.lit(run_id), "ts": F.lit(now).cast("timestamp_ntz")})
        .coalesce(1)
        .write.mode("append")
        .parquet(path)
    )
