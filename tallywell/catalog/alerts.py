"""Queries of the alerts, of absence and of growth carried to the borders of windows."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import query, sql
from tallywell.operators import alerts as A
from tallywell.operators import counters as C
from tallywell.operators import monitoring as M
from tallywell.operators import series as T
from tallywell.sources import star

AS_OF = datetime(2024, 2, 1, 6, 0)
SINCE = datetime(2024, 1, 1)
_NOW = A.as_micros(AS_OF)

# One row per instant of a series, and the growth and number of samples so far.
_HISTORY = " UNION ALL ".join(
    f"SELECT {metric} AS metric, {instance} AS instance, {stage} AS etapa, {tick} AS tick, {value} AS value, sample_id FROM samples WHERE {kind}"
    for kind, metric, instance, stage, tick, value in star.history_selects()
)
_EVENTS = "SELECT metric, '' AS instance, micros AS tick, value, sample_id FROM samples"


def _counted(source: str) -> str:
    return f"""SELECT *, sum(growth) OVER (PARTITION BY metric, instance ORDER BY tick) AS grown,
            row_number() OVER (PARTITION BY metric, instance ORDER BY tick) AS number,
            lead(tick) OVER (PARTITION BY metric, instance ORDER BY tick) AS next_at
        FROM (SELECT *, CASE WHEN before IS NULL THEN 0 WHEN value >= before THEN value - before ELSE value END AS growth
            FROM (SELECT *, lag(value) OVER (PARTITION BY metric, instance ORDER BY tick) AS before
                FROM (SELECT * FROM ({source}) QUALIFY row_number() OVER (PARTITION BY metric, instance, tick ORDER BY sample_id DESC) = 1)))"""


def _windows(instants: str, counted: str, window: int) -> str:
    """Growth over the windows that end at instants, with at least two samples."""
    reach = "CASE WHEN 10 * {0} * (samples - 1) >= 11 * sampled THEN sampled / (2.0 * (samples - 1)) ELSE CAST({0} AS DOUBLE) END"
    return f"""SELECT *, g * ((sampled + CASE WHEN g > 0 AND first_value >= 0 AND sampled * CAST(first_value AS DOUBLE) / g < to_start
                THEN sampled * CAST(first_value AS DOUBLE) / g ELSE to_start END + to_end) / sampled) AS increase
        FROM (SELECT *, CAST(growth AS DOUBLE) AS g, {reach.format("near_start")} AS to_start, {reach.format("near_end")} AS to_end
            FROM (SELECT i.*, z.number - a.number + 1 AS samples, z.grown - a.grown AS growth, z.tick - a.tick AS sampled,
                    a.tick - (i.tick - {window}) AS near_start, i.tick - z.tick AS near_end, a.value AS first_value
                FROM ({instants}) i
                ASOF JOIN ({counted}) z ON i.metric = z.metric AND i.instance = z.instance AND i.tick >= z.tick
                ASOF JOIN ({counted}) a ON i.metric = a.metric AND i.instance = a.instance AND i.tick - {window} + 1 <= a.tick)
            WHERE samples >= 2)"""


def _rounded(value: str, digits: int) -> str:
    unit = "0." + "0" * (digits - 1) + "1"
    return f"CAST(CAST(floor({value} * 1{'0' * digits} + 0.5) AS DECIMAL(22,0)) * CAST({unit} AS DECIMAL({digits + 1},{digits})) AS DECIMAL(28,{digits}))"


def _at_samples(window: int) -> str:
    # Samples of one instant share one row, that of the last of them.
    return _windows(f"SELECT metric, instance, tick, sample_id FROM ({_counted(_EVENTS)})", _counted(_EVENTS), window)


@query("extrapolated_increase", sql(
    f"SELECT metric, make_timestamp(tick) AS ts, sample_id, {_rounded('increase', 4)} AS increase FROM ({_at_samples(M.DAY // 4)})", "samples"))
def extrapolated_increase(spark: SparkSession, folder: str) -> DataFrame:
    return C.extrapolated_increase(star.metric_samples(spark, folder), ["metric"], M.DAY // 4)


@query("extrapolated_rate", sql(
    f"SELECT metric, make_timestamp(tick) AS ts, sample_id, {_rounded('increase / 3600.0', 6)} AS rate FROM ({_at_samples(M.HOUR)})", "samples"))
def extrapolated_rate(spark: SparkSession, folder: str) -> DataFrame:
    return C.extrapolated_rate(star.metric_samples(spark, folder), ["metric"], M.HOUR)


def _absent(source: str, lookback: int, since: str) -> str:
    """Spans of microseconds in which the series of a source (instance, tick) have no valid sample."""
    return f"""SELECT * FROM (
        SELECT instance, greatest(tick + {lookback * T.MICROS}, {since}) AS start,
            coalesce(lead(tick) OVER (PARTITION BY instance ORDER BY tick), {_NOW}) AS stop FROM ({source}) WHERE tick < {_NOW}
        UNION ALL SELECT instance, {since}, min(tick) FROM ({source}) WHERE tick < {_NOW} GROUP BY instance) WHERE start < stop"""


@query("absent_spans", sql(
    f"""SELECT instance, make_timestamp(start) AS since_ts, make_timestamp(stop) AS until_ts, stop = {_NOW} AS is_active
    FROM ({_absent("SELECT DISTINCT instance, micros AS tick FROM samples", 86400, str(A.as_micros(SINCE)))}
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), {A.as_micros(SINCE)}, {_NOW} FROM customer
        WHERE c_custkey NOT IN (SELECT user_id FROM events))""", "samples"))
def absent_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Every time in which a customer had no event for a day, those without any event included."""
    expected = star.table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("instance"))
    return A.absent_spans(star.metric_samples(spark, folder), ["instance"], SINCE, AS_OF, 86400, expected)


@query("sustained_value", sql(
    f"""SELECT metric, make_timestamp(min(start)) AS since, make_timestamp(max(stop)) AS until, max(stop) = {_NOW} AS is_active FROM (
        SELECT *, sum(broke) OVER (PARTITION BY metric ORDER BY start) AS span FROM (
            SELECT metric, tick AS start, coalesce(next_at, {_NOW}) AS stop,
                CASE WHEN lag(value) OVER (PARTITION BY metric ORDER BY tick) > 20 THEN 0 ELSE 1 END AS broke, value
            FROM ({_counted(_EVENTS)})) WHERE value > 20)
    GROUP BY metric, span HAVING max(stop) - min(start) >= 7200000000""", "samples"))
def sustained_value(spark: SparkSession, folder: str) -> DataFrame:
    """Values over 20 that stood for two hours, each until the next sample."""
    return A.sustained(star.metric_samples(spark, folder), ["metric"], F.col("value") > 20, 7200, AS_OF)


def _grid(metric: str, window: int) -> str:
    step = A.EVALUATION_SECONDS * T.MICROS
    first = f"((tick + {step - 1}) // {step}) * {step}"
    return f"""SELECT metric, instance, unnest(range({first}, least(coalesce(next_at, {_NOW}), tick + {window}, {_NOW}), {step})) AS tick
        FROM counted WHERE metric = '{metric}'"""


def _evaluated(alert: str, metric: str, window: int, condition: str) -> str:
    return f"""SELECT '{alert}' AS alert, instance, tick AS start, least(tick + {A.EVALUATION_SECONDS * T.MICROS}, {_NOW}) AS stop
        FROM ({_windows(_grid(metric, window), "SELECT * FROM counted", window)}) WHERE {condition}"""


def _held(alert: str, metric: str, condition: str, source: str = "valid") -> str:
    return f"SELECT '{alert}', instance, start, stop FROM {source} WHERE metric = '{metric}' AND {condition}"


_LOOKBACK = A.LOOKBACK_SECONDS * T.MICROS
_WEEK = 7 * M.DAY
_AGED = f"CAST(value AS BIGINT) * 1000000 + {M.MAX_STALENESS_SECONDS * T.MICROS} + 1"
_LIMITS = " ".join(f"WHEN '{alert}' THEN {seconds}" for alert, seconds in A.ALERT_SECONDS.items())


@query("alert_rules", sql(
    f"""WITH history AS ({_HISTORY}), counted AS ({_counted(f"SELECT * FROM history WHERE tick < {_NOW} AND etapa <> 'ingesta'")}),
    valid AS (SELECT metric, instance, tick AS start, coalesce(next_at, {_NOW}) AS stop, value FROM counted),
    scraped AS (SELECT metric, instance, start, least(stop, start + {_LOOKBACK}) AS stop, value FROM valid),
    changes AS (SELECT tick, sum(part) AS part, sum(one) AS one FROM (
        SELECT tick, value AS part, 1 AS one FROM counted WHERE metric = '{M.M_ROWS}'
        UNION ALL SELECT tick + {_WEEK}, -value, -1 FROM counted WHERE metric = '{M.M_ROWS}') WHERE tick < {_NOW} GROUP BY tick),
    totals AS (SELECT tick, sum(part) OVER (ORDER BY tick) AS total, sum(one) OVER (ORDER BY tick) AS n,
        coalesce(lead(tick) OVER (ORDER BY tick), {_NOW}) AS stop FROM changes),
    met AS (
        {_evaluated("TareasDeAirflowFallando", A.M_FAILURES, M.HOUR, "increase > 3")}
        UNION ALL {_evaluated("ProgramadorSinLatido", A.M_HEARTBEAT, 300 * T.MICROS, "growth = 0")}
        UNION ALL SELECT 'ProgramadorSinLatido', instance, start, stop FROM ({_absent(
            f"SELECT instance, tick FROM counted WHERE metric = '{A.M_HEARTBEAT}'", A.LOOKBACK_SECONDS, "(SELECT min(tick) FROM counted)")})
        UNION ALL {_held("PipelineFallo", M.M_SUCCESS, "value = 0")}
        UNION ALL SELECT 'DatosDesactualizados', instance, greatest(start, {_AGED}), stop FROM valid
            WHERE metric = '{M.M_LAST_SUCCESS}' AND greatest(start, {_AGED}) < stop
        UNION ALL {_held("CalidadDeDatosDegradada", M.M_REJECT_PCT, "value > 10")}
        UNION ALL {_held("PipelineDemasiadoLento", M.M_SECONDS, "value > 900")}
        UNION ALL {_held("ServicioCaido", A.M_UP, "value = 0", "scraped")}
        UNION ALL SELECT 'CaidaAbruptaDeVolumen', '', t.tick, t.stop FROM totals t
            ASOF JOIN (SELECT tick, value FROM counted WHERE metric = '{M.M_ROWS}') c ON t.tick >= c.tick WHERE n > 0 AND value * n < 0.5 * total
        UNION ALL SELECT 'AlmacenSinConexionesDisponibles', c.instance, greatest(c.start, w.start), least(c.stop, w.stop)
            FROM scraped c JOIN scraped w ON c.start < w.stop AND w.start < c.stop
            WHERE c.metric = '{A.M_CONNECTIONS}' AND w.metric = '{A.M_MAX_CONNECTIONS}' AND c.value > 0.8 * w.value AND w.value > 0),
    spans AS (SELECT alert, instance, min(start) AS start, max(stop) AS stop FROM (
        SELECT *, sum(broke) OVER (PARTITION BY alert, instance ORDER BY start, stop) AS span FROM (
            SELECT *, CASE WHEN lag(stop) OVER (PARTITION BY alert, instance ORDER BY start, stop) >= start THEN 0 ELSE 1 END AS broke FROM met))
        GROUP BY alert, instance, span)
    SELECT alert, instance, make_timestamp(start) AS since, make_timestamp(stop) AS until, make_timestamp(fires) AS fires_at, stop = {_NOW} AS is_active
    FROM (SELECT *, start + (CASE alert {_LIMITS} END) * 1000000 AS fires FROM spans) WHERE fires <= stop""", "samples"))
def alert_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All nine alerts over events under the names of metrics."""
    return A.alert_rules(star.metric_history(spark, folder), ["instance"], AS_OF)
