"""Series operators against brute force, across chunk sizes, ties and a hot series."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywell.operators import monitoring as M
from tallywell.operators import series as T

START = datetime(2024, 1, 1)
SCHEMA = "metric string, ts timestamp_ntz, value decimal(18,4), sample_id bigint"


def samples(spark, seed=1, n=400, spread=5000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        metric = "hot" if rng.random() < 0.7 else rng.choice(["a", "b"])
        second = rng.randrange(spread)
        rows.append((metric, START + timedelta(seconds=second), Decimal(rng.randrange(100)), i))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def by_series(rows):
    out = {}
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[3])):
        out.setdefault(row[0], []).append(row)
    return out


CHUNKS = [10 * T.MICROS, 600 * T.MICROS, 10**6 * T.MICROS]


@pytest.mark.parametrize("chunk", CHUNKS)
def test_running_total(spark, chunk):
    rows, df = samples(spark)
    out = T.running_total(df.withColumn("at", T.micros("ts")), ["metric"], "at", {"value": "total"}, chunk)
    got = {r.sample_id: r.total for r in out.collect()}
    assert len(got) == len(rows)
    for series in by_series(rows).values():
        for row in series:
            assert got[row[3]] == sum(r[2] for r in series if r[1] <= row[1])


@pytest.mark.parametrize("chunk", CHUNKS)
def test_trailing_sum(spark, chunk):
    rows, df = samples(spark)
    timed = df.withColumns({"at": T.micros("ts"), "part": F.col("value")})
    out = T.trailing_sum(timed, ["metric"], "at", F.col("at") + 300 * T.MICROS, {"part": "total"}, chunk)
    got = {r.sample_id: r.total for r in out.collect()}
    assert len(got) == len(rows)
    for series in by_series(rows).values():
        for row in series:
            since = row[1] - timedelta(seconds=300)
            assert got[row[3]] == sum(r[2] for r in series if since <= r[1] <= row[1])


@pytest.mark.parametrize("chunk", CHUNKS)
def test_previous_and_earlier_values(spark, chunk):
    rows, df = samples(spark)
    timed = df.withColumn("at", T.micros("ts"))
    previous = {
        r.sample_id: r.previous.value if r.previous else None
        for r in T.with_previous(timed, ["metric"], "at", "sample_id", ["value"], chunk).collect()
    }
    earlier = {
        r.sample_id: r.old_value
        for r in T.value_before(timed, ["metric"], "at", "sample_id", "value", 60 * T.MICROS, "old_value", chunk).collect()
    }
    assert len(previous) == len(earlier) == len(rows)
    for series in by_series(rows).values():
        for i, row in enumerate(series):
            assert previous[row[3]] == (series[i - 1][2] if i else None)
            old = [r[2] for r in series if r[1] <= row[1] - timedelta(seconds=60)]
            assert earlier[row[3]] == (old[-1] if old else None)


def test_a_missing_label_is_a_series_of_its_own(spark):
    df = spark.createDataFrame([(None, START, Decimal(1), 1), (None, START + timedelta(seconds=5), Decimal(2), 2)], SCHEMA)
    out = T.running_total(df.withColumn("at", T.micros("ts")), ["metric"], "at", {"value": "total"})
    assert sorted(r.total for r in out.collect()) == [1, 3]


def test_counter_with_restart(spark):
    values = [10, 15, 3, 8, 9]
    rows = [("c", START + timedelta(minutes=10 * i), Decimal(v), i) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, SCHEMA)
    hour = {r.sample_id: float(r.increase) for r in M.counter_increase(df, ["metric"]).collect()}
    assert hour == {0: 0.0, 1: 5.0, 2: 8.0, 3: 13.0, 4: 14.0}
    short = {r.sample_id: float(r.increase) for r in M.counter_increase(df, ["metric"], 600 * T.MICROS).collect()}
    assert short == {0: 0.0, 1: 5.0, 2: 3.0, 3: 5.0, 4: 1.0}
    none = M.counter_increase(df, ["metric"], 60 * T.MICROS)
    assert none.where("increase != 0").count() == 0


def test_volume_drop(spark):
    rows = [("v", START + timedelta(days=i), Decimal(v), i) for i, v in enumerate([100, 100, 100, 40, 100])]
    out = M.volume_drop(spark.createDataFrame(rows, SCHEMA), ["metric"]).collect()
    assert [(r.sample_id, float(r.trailing_mean)) for r in out] == [(3, 85.0)]


def test_sustained_condition(spark):
    values = [1, 0, 0, 0, 1, 0, 1]
    rows = [("up", START + timedelta(minutes=i), Decimal(v), i) for i, v in enumerate(values)]
    out = M.sustained_condition(spark.createDataFrame(rows, SCHEMA), ["metric"], F.col("value") == 0, 120).collect()
    assert [(r.since, r.until, r.samples) for r in out] == [(START + timedelta(minutes=1), START + timedelta(minutes=3), 3)]


def test_latest_and_thresholds(spark):
    rows = [("a", START, Decimal(5), 1), ("a", START + timedelta(1), Decimal(0), 2), ("b", START, Decimal(1), 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r.metric for r in M.threshold_alerts(df, ["metric"], "==", F.lit(0)).collect()] == ["a"]
    assert [r.metric for r in M.top_metrics(df, ["metric"], 1).collect()] == ["b"]
    stale = M.staleness(df, ["metric"], START + timedelta(days=1, seconds=93_601)).orderBy("metric").collect()
    assert [(r.metric, r.is_stale) for r in stale] == [("a", True), ("b", True)]
    fresh = M.staleness(df, ["metric"], START + timedelta(seconds=93_600)).where("metric = 'b'").first()
    assert (fresh.age_seconds, fresh.is_stale) == (93_600, False)
    expected = spark.createDataFrame([("a",), ("z",)], "metric string")
    assert [r.metric for r in M.absent_series(expected, df, ["metric"]).collect()] == ["z"]


def test_relabel(spark):
    names = {
        "airflow.dagrun.duration.success.daily": ("airflow_dagrun_duracion_exitosa_segundos", {"grafo": "daily", "resultado": "exitosa"}),
        "airflow.dag.daily.load.duration": ("airflow_tarea_duracion_segundos", {"grafo": "daily", "tarea": "load"}),
        "airflow.ti.finish.daily.load.failed": ("airflow_tarea_finalizada_total", {"grafo": "daily", "tarea": "load", "estado": "failed"}),
        "airflow.scheduler_heartbeat": ("airflow_scheduler_heartbeat", {}),
        "airflow.dag.daily.load": ("airflow_dag_daily_load", {}),
        "airflow.dag..load.duration": ("airflow_dag__load_duration", {}),
        "airflow.dagrun.duration.success.daily.more": ("airflow_dagrun_duration_success_daily_more", {}),
        "airflow.executor.open_slots": ("airflow_ranuras_libres", {}),
        "airflow.": ("airflow.", {}),
        "": ("", {}),
        "airflow.other.thing-x": ("airflow_other_thing_x", {}),
        "unknown": ("unknown", {}),
    }
    out = M.relabel_metrics(spark.createDataFrame([(n,) for n in names], "metric string")).collect()
    assert {r.metric: (r.metric_name, r.labels) for r in out} == names
    nothing = M.relabel_metrics(spark.createDataFrame([(None,)], "metric string")).first()
    assert nothing.metric_name is None and nothing.labels == {}


def test_watch_metrics():
    rows = {(r["metric"], r["labels"].get("tabla")): r["value"] for r in M.watch_metrics({"a.b": 3}, 2, 0.0)}
    assert rows[(M.M_TABLE_ROWS, "a_b")] == 3 and rows[(M.M_WATCH_DONE, None)] == 1
    assert M.watch_metrics({"a.b": 3}, None, None)[-1]["value"] == 0


def test_published_tables(spark):
    days = spark.sql("select date'2010-01-01' sale_date, cast(5 as decimal(28,2)) total_revenue")
    assert M.published_coverage(days).first().ok and not M.published_coverage(days.limit(0)).first().ok
    assert {r.table_name: r.ok for r in M.table_volumes({"x": days, "y": days.limit(0)}).collect()} == {"x": True, "y": False}
    detail = spark.sql("select cast(4.5 as decimal(18,2)) line_revenue")
    off = M.layer_coherence(detail, days).first()
    assert not off.ok and off.difference == Decimal("0.50")
