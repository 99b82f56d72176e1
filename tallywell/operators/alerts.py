"""Alerts evaluated in time: conditions hold over intervals, not only at samples.

A sample is valid from its instant until the next one of its series, or until the instant
of evaluation; samples that are scraped rather than pushed stay valid for a lookback only.
A condition on the value holds for the whole interval; one that compares it with the clock
starts to hold inside it, at an instant that follows from the value. Adjoining intervals
are joined to spans, and a span fires once it has lasted as long as its rule asks.

All instants are microseconds; intervals hold their start and not their end.
"""

from collections.abc import Sequence
from datetime import UTC, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.operators import counters as C
from tallywell.operators import monitoring as M
from tallywell.operators import series as T
from tallywell.operators.ranges import in_ranges
from tallywell.session import materialize

HOUR_CHUNK = M.HOUR

#: Pieces of time that are searched together, and the instant before all others.
FAN = 256
_BEGIN = -(1 << 60)

# How long a scraped sample stays valid, and how often windows are evaluated.
LOOKBACK_SECONDS = 300
EVALUATION_SECONDS = 30

# The alerts and the seconds that each condition has to hold.
ALERT_SECONDS = {
    "PipelineFallo": 60,
    "DatosDesactualizados": 600,
    "CalidadDeDatosDegradada": 300,
    "PipelineDemasiadoLento": 120,
    "CaidaAbruptaDeVolumen": 900,
    "ServicioCaido": 120,
    "AlmacenSinConexionesDisponibles": 300,
    "TareasDeAirflowFallando": 300,
    "ProgramadorSinLatido": 300,
}
# Metrics of services, and the stage whose volume is watched.
M_UP, M_CONNECTIONS, M_MAX_CONNECTIONS = "up", "pg_stat_activity_count", "pg_settings_max_connections"
M_FAILURES, M_HEARTBEAT = "airflow_ti_failures", "airflow_scheduler_heartbeat"
VOLUME_STAGE = "agregacion"
VALUE_ALERTS = {
    M.M_SUCCESS: "PipelineFallo",
    M.M_LAST_SUCCESS: "DatosDesactualizados",
    M.M_REJECT_PCT: "CalidadDeDatosDegradada",
    M.M_SECONDS: "PipelineDemasiadoLento",
    M_UP: "ServicioCaido",
}


def as_micros(instant: datetime) -> int:
    since = instant.replace(tzinfo=instant.tzinfo or UTC) - datetime(1970, 1, 1, tzinfo=UTC)
    return (since.days * 86_400 + since.seconds) * T.MICROS + since.microseconds


def as_timestamp(micros: Column) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def validity(samples: DataFrame, by: Sequence[str], as_of: datetime, lookback: Column | None = None) -> DataFrame:
    """``start`` and ``stop`` of the time in which each sample is the value of its series.

    ``lookback`` (seconds) may depend on the labels; where it is null, a sample lasts until the next.
    """
    now = as_micros(as_of)
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at")).where(F.col("at") < now)
    following = T.with_next(T.one_per_instant(timed, by, "at", "sample_id"), by, "at", "sample_id", ["at"], HOUR_CHUNK)
    stop = F.coalesce("next.at", F.lit(now))
    if lookback is not None:
        stop = F.least(stop, F.col("at") + lookback * T.MICROS)
    # least() passes over nulls.
    return following.select(*by, F.col("at").alias("start"), stop.alias("stop"), "value")


def spans(intervals: DataFrame, by: Sequence[str], as_of: datetime) -> DataFrame:
    """Adjoining intervals joined: ``start``, ``stop`` and ``is_active`` (it lasts until ``as_of``)."""
    ordered = intervals.withColumn("tie", F.col("stop"))
    paired = T.with_previous(ordered, by, "start", "tie", ["stop"], HOUR_CHUNK)
    broken = paired.withColumn("broke", F.when(F.col("previous.stop") >= F.col("start"), 0).otherwise(1)).drop("previous", "tie")
    numbered = T.running_total(broken, by, "start", {"broke": "span"}, HOUR_CHUNK)
    joined = numbered.groupBy(*by, "span").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("span")
    return joined.withColumn("is_active", F.col("stop") == as_micros(as_of))


def sustained(samples: DataFrame, by: Sequence[str], condition: Column, seconds: int, as_of: datetime, lookback: Column | None = None) -> DataFrame:
    """MN9: the spans in which the valid value of a series met a condition on ``value``, at least so long.

    A value stands until the next sample or ``as_of``, so one sample can sustain a condition.
    """
    met = spans(validity(samples, by, as_of, lookback).where(condition).drop("value"), by, as_of)
    lasted = met.where(F.col("stop") - F.col("start") >= seconds * T.MICROS)
    return lasted.select(*by, as_timestamp(F.col("start")).alias("since"), as_timestamp(F.col("stop")).alias("until"), "is_active")


def absent_spans(
    samples: DataFrame, by: Sequence[str], since: datetime, as_of: datetime, lookback: int = LOOKBACK_SECONDS,
    expected: DataFrame | None = None,
) -> DataFrame:
    """MN10: the spans between two instants in which a series has no sample that is valid.

    A sample counts for ``lookback`` seconds from its own instant. Series are those of
    ``expected`` and those that have any sample before ``as_of``; without ``by`` all samples are
    one series. ``since_ts`` and ``until_ts`` bound each span, ``is_active`` says that it goes on.
    """
    begin, end = as_micros(since), as_micros(as_of)
    labelled = samples.fillna("", subset=list(by)) if by else samples
    held = labelled.select(*by, T.micros("ts").alias("at")).where(F.col("at") < end).groupBy(*by, "at").agg(F.max(F.lit(0)).alias("tie"))
    held = held.select(*by, "at", "tie", (F.col("at") + lookback * T.MICROS).alias("stop"))
    gaps = T.with_next(held, by, "at", "tie", ["at"], HOUR_CHUNK)
    gaps = gaps.select(*by, F.greatest("stop", F.lit(begin)).alias("start"), F.coalesce("next.at", F.lit(end)).alias("stop"))
    first = held.groupBy(*by).agg(F.min("at").alias("first"))
    if expected is not None:
        named = expected.select(*by).fillna("", subset=list(by)).distinct().unionByName(first.select(*by)).distinct()
        first = named.join(first, list(by), "left")
    ahead = first.select(*by, F.lit(begin).alias("start"), F.coalesce("first", F.lit(end)).alias("stop"))
    found = gaps.unionByName(ahead).where("start < stop")
    return found.select(*by, as_timestamp(F.col("start")).alias("since_ts"), as_timestamp(F.col("stop")).alias("until_ts"), (F.col("stop") == end).alias("is_active"))


def below_trailing_mean(samples: DataFrame, by: Sequence[str], as_of: datetime, window: int = 7 * M.DAY, factor: str = M.VOLUME_DROP_FACTOR) -> DataFrame:
    """The intervals in which a series is below a fraction of the mean of its samples in the trailing window.

    The mean changes when a sample enters the window and when one leaves it.
    """
    now = as_micros(as_of)
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at")).where(F.col("at") < now)
    held = materialize(T.one_per_instant(timed, by, "at", "sample_id"), "volumes")
    change = [F.struct(F.col("at").alias("at"), F.col("value").alias("part"), F.lit(1).alias("one")),
              F.struct((F.col("at") + window).alias("at"), (-F.col("value")).alias("part"), F.lit(-1).alias("one"))]
    changes = held.select(*by, F.inline(F.array(*change))).where(F.col("at") < now)
    changes = changes.groupBy(*by, "at").agg(F.sum("part").alias("part"), F.sum("one").alias("one"))
    totals = T.running_total(changes, by, "at", {"part": "window_sum", "one": "window_count"}, HOUR_CHUNK)
    valued = T.as_of(totals.drop("part", "one"), held, by, "at", ["value"], "latest", chunk_micros=HOUR_CHUNK)
    lasting = T.with_next(valued.withColumn("tie", F.lit(0)), by, "at", "tie", ["at"], HOUR_CHUNK)
    below = F.col("latest.value") * F.col("window_count") < F.lit(factor).cast("decimal(4,2)") * F.col("window_sum")
    intervals = lasting.where((F.col("window_count") > 0) & below)
    return intervals.select(*by, F.col("at").alias("start"), F.coalesce("next.at", F.lit(now)).alias("stop"))


def evaluated_windows(samples: DataFrame, by: Sequence[str], as_of: datetime, window: Column, condition: Column) -> DataFrame:
    """The intervals between evaluations for which a condition on the growth of a counter held.

    Evaluations are the multiples of the evaluation interval at which the window holds a
    sample: each sample brings those from its own instant to that of the next one. ``window``
    (microseconds) may depend on the labels.
    """
    now, step = as_micros(as_of), EVALUATION_SECONDS * T.MICROS
    history = materialize(C.counted(samples.where(T.micros("ts") < now), by, M.HOUR), "counted")
    following = T.with_next(history.select(*by, "at", "number"), by, "at", "number", ["at"], HOUR_CHUNK)
    first = F.col("at") + F.pmod(-F.col("at"), F.lit(step))
    last = F.least(F.coalesce("next.at", F.lit(now)), F.col("at") + window, F.lit(now)) - 1
    instants = following.where(first <= last).select(*by, F.explode(F.sequence(first, last, F.lit(step))).alias("at"))
    found = C.window_growth(instants, history, by, window, HOUR_CHUNK).where(condition)
    return found.select(*by, F.col("at").alias("start"), F.least(F.col("at") + step, F.lit(now)).alias("stop"))


def _limits(one: DataFrame, by: Sequence[str]) -> DataFrame:
    """``position`` (from 0), ``at``, ``until`` and ``whole`` of pieces that cover all time, in order.

    ``whole`` is the least positive value of the intervals of ``one`` that hold there, null
    where none does. Intervals of a series do not overlap.
    """
    series = ["side", *by]
    # Of equal intervals the greatest value counts, as one of its series.
    named = one.withColumn("side", F.lit("")).groupBy("start", "stop").agg(F.max("value").alias("value"), F.min(F.struct(*series)).alias("label"))
    held = materialize(named.select("label.*", F.col("start").alias("at"), "stop", "value"), "limits")
    labels = held.agg(F.collect_set(F.struct(*series))).scalar()
    bounds = held.select(F.explode(F.array("at", "stop")).alias("at")).distinct()
    asked = bounds.select("at", F.inline(labels))
    found = T.as_of(asked, held, series, "at", ["stop", "value"], "last")
    valid = F.when((F.col("last.stop") > F.col("at")) & (F.col("last.value") > 0), F.col("last.value"))
    pieces = found.groupBy("at").agg(F.min(valid).alias("whole"))
    begin = one.sparkSession.range(1).select(F.lit(_BEGIN).alias("at"), F.lit(None).cast(pieces.schema["whole"].dataType).alias("whole"))
    placed = in_ranges(pieces.unionByName(begin), [F.col("at")], {}, "position").withColumn("tie", F.lit(0))
    lasting = T.with_next(placed, [], "at", "tie", ["at"])
    return materialize(lasting.select((F.col("position") - 1).cast("long").alias("position"), "at", F.col("next.at").alias("until"), "whole"), "pieces")


def _levels(pieces: DataFrame) -> list[DataFrame]:
    """``group, nodes``: pieces in groups of ``FAN``, their groups in groups, and so on up to one; a group counts by its greatest ``whole``, or null."""
    nodes, levels = pieces, []
    while True:
        node = F.struct("position", "at", "until", "whole")
        groups = nodes.groupBy(F.floor(F.col("position") / FAN).alias("group")).agg(F.sort_array(F.collect_list(node)).alias("nodes"))
        levels.append(groups := materialize(groups, "level"))
        if groups.count() <= 1:
            return levels
        greatest = F.when(F.forall("nodes", lambda n: n["whole"].isNotNull()), F.array_max(F.transform("nodes", lambda n: n["whole"])))
        none = F.lit(None).cast("long")
        nodes = groups.select(F.col("group").alias("position"), none.alias("at"), none.alias("until"), greatest.alias("whole"))


def _nearest_break(asked: DataFrame, levels: list[DataFrame], ahead: bool, limit: str, name: str) -> DataFrame:
    """Add ``name``: the first (or last) piece from ``low`` to ``high`` whose share the value does not pass, or null.

    The search climbs from the group of one end until a node has such a piece, and goes down
    to it, so each row meets one group per level and step.
    """

    def look(state: DataFrame, k: int, wanted: Column, seek: Column | None) -> DataFrame:
        """One group of a level; rows that want none are spread."""
        spread = -1 - F.pmod(F.xxhash64("low", "high", "value"), F.lit(997))
        met = state.withColumn("group", F.coalesce(wanted, spread)).join(levels[k], "group", "left")
        size = FAN**k
        inside = [F.floor(F.col("low") / size), F.floor(F.col("high") / size)]
        if seek is not None:
            inside[0 if ahead else 1] = seek

        def breaks(n: Column) -> Column:
            passed = F.col("value") > F.lit(limit).cast("decimal(4,2)") * n["whole"]
            return n["position"].between(*inside) & ~F.coalesce(passed, F.lit(False))

        return met.withColumn("hit", F.get(F.filter("nodes", breaks), F.lit(0)) if ahead else F.get(F.reverse(F.filter("nodes", breaks)), F.lit(0))).drop("group", "nodes")

    state = asked.withColumns({"seek": F.col("low" if ahead else "high"), name: F.lit(None).cast(levels[0].schema["nodes"].dataType.elementType), "depth": F.lit(-1)})
    for k in range(len(levels)):
        size = FAN**k
        open_ = (F.col("depth") < 0) & F.col("seek").between(F.floor(F.col("low") / size), F.floor(F.col("high") / size))
        state = look(state, k, F.when(open_, F.floor(F.col("seek") / FAN)), F.col("seek"))
        group = F.floor(F.col("seek") / FAN)
        hit = F.col("hit").isNotNull()
        state = state.withColumns({name: F.coalesce("hit", name), "depth": F.when(hit, F.lit(k)).otherwise(F.col("depth")), "seek": group + (1 if ahead else -1)}).drop("hit")
    for k in range(len(levels) - 1, 0, -1):
        here = F.col("depth") == k
        state = look(state, k - 1, F.when(here, F.col(name)["position"]), None)
        state = state.withColumns({name: F.when(here, F.col("hit")).otherwise(F.col(name)), "depth": F.when(here, F.when(F.col("hit").isNotNull(), F.lit(k - 1)).otherwise(F.lit(-1))).otherwise(F.col("depth"))}).drop("hit")
    return state.drop("seek", "depth")


def share_of_single(many: DataFrame, one: DataFrame, by: Sequence[str], limit: str = M.CONNECTION_SHARE_ALERT) -> DataFrame:
    """The intervals in which a series is above a share of the single series valid at the same time.

    Of each interval of ``many`` the part up to its first break and the part from its last
    break on are given: what lies between two breaks touches no other interval, and is
    shorter than the interval, so than the lookback. So there are two rows per interval at
    most, however many values of ``one`` it spans.
    """
    pieces = _limits(one, by)
    levels = _levels(pieces)
    asked = many.select(*by, F.col("start").alias("at"), "start", "stop", "value")
    asked = T.as_of(asked, pieces, [], "at", ["position"], "lower").withColumn("at", F.col("stop") - 1)
    asked = T.as_of(asked, pieces, [], "at", ["position"], "upper")
    asked = materialize(asked.select(*by, "start", "stop", "value", F.col("lower.position").alias("low"), F.col("upper.position").alias("high")), "asked")
    found = _nearest_break(_nearest_break(asked, levels, True, limit, "first"), levels, False, limit, "last")
    whole = F.array(F.struct("start", "stop"))
    ahead = F.struct("start", F.col("first.at").alias("stop"))
    behind = F.struct(F.col("last.until").alias("start"), "stop")
    parts = F.when(F.col("first").isNull(), whole).otherwise(F.array(ahead, behind))
    return found.select(*by, F.inline(parts)).where("start < stop")


def alert_rules(samples: DataFrame, series: Sequence[str], as_of: datetime, since: datetime | None = None, stage: str = "etapa") -> DataFrame:
    """The nine alerts up to ``as_of``: one row per span in which one fires.

    ``samples`` has ``metric``, the labels named by ``series``, the label ``stage``, ``ts``,
    ``sample_id`` and ``value``. Columns: ``alert``, the labels, ``since`` and ``until`` of the
    condition, ``fires_at`` and ``is_active``. The scheduler counts as silent from ``since`` on,
    or from the first sample of any metric.
    """
    by = list(series)
    keys = ["metric", *by]
    samples = samples.where(T.micros("ts") < as_micros(as_of)).fillna("", subset=by)
    metric, value = F.col("metric"), F.col("value")

    scraped = F.when(metric.isin(M_UP, M_CONNECTIONS, M_MAX_CONNECTIONS), LOOKBACK_SECONDS)
    valued = samples.where(metric.isin(*VALUE_ALERTS, M_CONNECTIONS, M_MAX_CONNECTIONS))
    valid = materialize(validity(valued, keys, as_of, scraped), "valid")
    # A success is too old from an instant inside its interval, unless that has begun later.
    success = metric == M.M_LAST_SUCCESS
    too_old = (value * T.MICROS).cast("decimal(38,0)").cast("long") + M.MAX_STALENESS_SECONDS * T.MICROS + 1
    start = F.when(success, F.greatest("start", too_old)).otherwise(F.col("start"))
    bad = (metric.isin(M.M_SUCCESS, M_UP) & (value == 0)) | success
    bad = bad | ((metric == M.M_REJECT_PCT) & (value > M.REJECT_PCT_ALERT)) | ((metric == M.M_SECONDS) & (value > M.STAGE_SECONDS_ALERT))
    alert = F.element_at(F.create_map(*[F.lit(x) for pair in VALUE_ALERTS.items() for x in pair]), metric)
    by_value = valid.where(bad).select(alert.alias("alert"), *by, start.alias("start"), "stop").where("start < stop")

    crowded = share_of_single(valid.where(metric == M_CONNECTIONS), valid.where(metric == M_MAX_CONNECTIONS), by)

    window = F.when(metric == M_FAILURES, M.HOUR).otherwise(LOOKBACK_SECONDS * T.MICROS)
    grown = F.when(metric == M_FAILURES, F.col("increase") > M.FAILURES_PER_HOUR_ALERT).otherwise(F.col("growth") == 0)
    counters = evaluated_windows(samples.where(metric.isin(M_FAILURES, M_HEARTBEAT)), keys, as_of, window, grown)
    counters = counters.select(F.when(metric == M_FAILURES, "TareasDeAirflowFallando").otherwise("ProgramadorSinLatido").alias("alert"), *by, "start", "stop")

    begin = since or samples.agg(F.min("ts")).first()[0] or as_of
    silent = absent_spans(samples.where(metric == M_HEARTBEAT), [], begin, as_of, LOOKBACK_SECONDS)
    silent = silent.select(*[F.lit("").alias(c) for c in by], T.micros("since_ts").alias("start"), T.micros("until_ts").alias("stop"))
    fallen = below_trailing_mean(samples.where((metric == M.M_ROWS) & (F.col(stage) == VOLUME_STAGE)), by, as_of)

    named = {"AlmacenSinConexionesDisponibles": crowded, "ProgramadorSinLatido": silent, "CaidaAbruptaDeVolumen": fallen}
    told = [by_value, counters, *[frame.select(F.lit(name).alias("alert"), *by, "start", "stop") for name, frame in named.items()]]
    joined = spans(materialize(reduce(DataFrame.unionByName, told), "conditions"), ["alert", *by], as_of)
    limits = F.create_map(*[F.lit(x) for pair in ALERT_SECONDS.items() for x in pair])
    fires = F.col("start") + F.element_at(limits, F.col("alert")) * T.MICROS
    fired = joined.withColumn("fires_at", fires).where("fires_at <= stop")
    return fired.select("alert", *by, as_timestamp(F.col("start")).alias("since"), as_timestamp(F.col("stop")).alias("until"), as_timestamp(F.col("fires_at")).alias("fires_at"), "is_active")


def recorded_samples(table: DataFrame) -> DataFrame:
    """The table that ``append_metrics`` writes as samples: all labels as one text ``labels``, and ``etapa`` on its own."""
    label = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return table.select(
        "metric", F.concat_ws(",", label).alias("labels"), F.col("labels")["etapa"].alias("etapa"), "ts",
        F.xxhash64("run_id").alias("sample_id"), F.col("value").cast("decimal(28,4)").alias("value"),
    )
