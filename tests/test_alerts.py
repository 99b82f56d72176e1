"""Alerts evaluated in time, absence and carried-out growth: cases by hand and brute force."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywell.operators import alerts as A
from tallywell.operators import counters as C
from tallywell.operators import monitoring as M
from tallywell.operators import series as T

START = datetime(2024, 3, 1, 4, 0)
SCHEMA = "metric string, labels string, etapa string, ts timestamp_ntz, value decimal(28,4), sample_id long"
MICRO = timedelta(microseconds=1)


def frame(spark, rows):
    """Samples from (metric, labels, seconds after the start, value)."""
    full = [(m, label, label.removeprefix("etapa="), START + timedelta(seconds=s), Decimal(v), k) for k, (m, label, s, v) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def fired(spark, rows, after, since=None):
    """By alert and labels, the seconds (since, fires at, until) and whether it goes on; silence of the scheduler left out."""
    found = A.alert_rules(frame(spark, rows), ["labels"], START + timedelta(seconds=after), since).collect()
    seconds = lambda t: (t - START).total_seconds()
    out = {}
    for r in found:
        out.setdefault((r.alert, r.labels), []).append((seconds(r.since), seconds(r.fires_at), seconds(r.until), r.is_active))
    return {k: sorted(v) for k, v in out.items()}


BEATS = [(A.M_HEARTBEAT, "", s, s) for s in range(0, 200_000, 250)]


def recorded(spark, path, runs, as_of):
    """Alerts over the table that runs write: (instant, success, reject percentage, seconds of ingestion)."""
    for k, (now, success, rejected, seconds) in enumerate(runs):
        stats = {"rule": 0, "reject_pct": rejected}
        kpis = {"total_revenue": 1, "distinct_products": 1, "days_covered": 1}
        rows = M.run_metrics(stats, ["rule"], {"ingesta": (10, seconds), "agregacion": (10, 1.0)}, kpis, success, now)
        M.append_metrics(spark, rows, path, f"run{k}", now)
    samples = A.recorded_samples(spark.read.parquet(path))
    return sorted(tuple(r) for r in A.alert_rules(samples, ["labels"], as_of).collect() if r.alert != "ProgramadorSinLatido")


def test_recorded_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("TZ", "UTC")
    from datetime import UTC

    day = timedelta(days=1)
    # A failed run fires after a minute and until the next one.
    first, second = START, START + day
    runs = [(first.replace(tzinfo=UTC), False, 1.0, 5.0), (second.replace(tzinfo=UTC), True, 1.0, 5.0)]
    found = recorded(spark, str(tmp_path / "failed"), runs, second + timedelta(hours=1))
    assert found == [("PipelineFallo", "", first, second, first + timedelta(seconds=60), False)]
    # A pipeline that has been silent for 26 hours and ten minutes.
    runs = [(first.replace(tzinfo=UTC), True, 1.0, 5.0)]
    turned = first + timedelta(seconds=93_600) + MICRO
    as_of = turned + timedelta(seconds=600)
    assert recorded(spark, str(tmp_path / "silent"), runs, as_of) == [("DatosDesactualizados", "", turned, as_of, as_of, True)]
    assert recorded(spark, str(tmp_path / "late"), runs, as_of - MICRO) == []
    # One bad and slow run, told by its labels.
    runs = [(first.replace(tzinfo=UTC), True, 11.0, 901.0)]
    now = first + timedelta(hours=1)
    assert recorded(spark, str(tmp_path / "bad"), runs, now) == [
        ("CalidadDeDatosDegradada", "", first, now, first + timedelta(seconds=300), True),
        ("PipelineDemasiadoLento", "etapa=ingesta", first, now, first + timedelta(seconds=120), True),
    ]


def test_values_that_recover_do_not_fire(spark):
    rows = BEATS + [(M.M_SUCCESS, "", 0, 0), (M.M_SUCCESS, "", 59, 1), (M.M_SUCCESS, "", 100, 0), (M.M_SUCCESS, "", 130, 0), (M.M_SUCCESS, "", 160, 1)]
    assert fired(spark, rows, 10_000) == {("PipelineFallo", ""): [(100, 160, 160, False)]}


def test_scraped_services(spark):
    up = [(A.M_UP, "a", s, 0) for s in range(0, 121, 15)] + [(A.M_UP, "a", 135, 1)]
    # The last sample of a service counts for five minutes, then nobody knows.
    gone = [(A.M_UP, "b", 1000, 0)]
    assert fired(spark, BEATS + up + gone, 20_000) == {("ServicioCaido", "a"): [(0, 120, 135, False)], ("ServicioCaido", "b"): [(1000, 1120, 1300, False)]}


def test_connections_against_their_limit(spark):
    many = [(A.M_CONNECTIONS, x, s, v) for s in range(0, 1000, 20) for x, v in (("x", 81), ("y", 80))]
    one = [(A.M_MAX_CONNECTIONS, "", s, 100 if s < 610 else 200) for s in range(10, 1000, 20)]
    assert fired(spark, BEATS + many + one, 20_000) == {("AlmacenSinConexionesDisponibles", "x"): [(10, 310, 610, False)]}


@pytest.mark.parametrize("fan", [2, 256])
def test_share_of_single_by_brute_force(spark, monkeypatch, fan):
    """The first and last break of each interval, where the other side has gaps, zeros and a second series."""
    monkeypatch.setattr(A, "FAN", fan, raising=False)
    rng = random.Random(5)
    many, one = [], []
    for label in "xyz":
        at = 0
        while at < 400:
            stop = at + rng.randint(1, 60)
            many.append((label, at, stop, Decimal(rng.choice([40, 70, 85, 200]))))
            at = stop + rng.choice([0, 0, 9])
    for label, first in (("", 20), ("b", 200)):
        at = first
        while at < 390:
            stop = at + rng.randint(1, 4)
            one.append((label, at, stop, Decimal(rng.choice([0, 100, 100, 100, 90]) if label == "" else 120)))
            at = stop + rng.choice([0] * 8 + [3])
    schema = "labels string, start long, stop long, value decimal(28,4)"
    found = A.share_of_single(spark.createDataFrame(many, schema), spark.createDataFrame(one, schema), ["labels"])
    expected = []
    same = {}
    for _, a, z, w in one:
        same[a, z] = max(w, same.get((a, z), w))
    for label, start, stop, v in many:
        met = [any(a <= t < z and w > 0 and v > Decimal("0.8") * w for (a, z), w in same.items()) for t in range(start, stop)]
        if all(met):
            expected.append((label, start, stop))
            continue
        first, last = met.index(False), len(met) - met[::-1].index(False)
        expected += [(label, start, start + first)] * (first > 0) + [(label, start + last, stop)] * (start + last < stop)
    assert sorted((r.labels, r.start, r.stop) for r in found.collect()) == sorted(expected)


def test_volume_of_the_watched_stage(spark):
    day = 86_400
    volumes = [100, 100, 100, 40, 100, 40, 40, 40, 40, 40, 40]
    rows = [(M.M_ROWS, f"etapa={e}", k * day, v) for k, v in enumerate(volumes) for e in ("agregacion", "ingesta")]
    found = fired(spark, rows, 11 * day)[("CaidaAbruptaDeVolumen", "etapa=agregacion")]
    # Below half of the mean at day 3, and at day 5 (40 of 80) not.
    assert found == [(3 * day, 3 * day + 900, 4 * day, False)]
    assert ("CaidaAbruptaDeVolumen", "etapa=ingesta") not in fired(spark, rows, 11 * day)
    # A mean that changes as an old sample leaves: 30 of (10 + 30) / 2 until the 10 has left... never below;
    # 30 after 200 and 10: mean 80, below; when 200 leaves, mean 20, over.
    rows = [(M.M_ROWS, "etapa=agregacion", s, v) for s, v in ((0, 200), (day, 10), (2 * day, 30))]
    found = fired(spark, rows, 9 * day)[("CaidaAbruptaDeVolumen", "etapa=agregacion")]
    assert found == [(day, day + 900, 7 * day, False)]


def test_silent_scheduler(spark):
    rows = [(A.M_HEARTBEAT, "", s, s) for s in range(600, 2000, 100)] + [(M.M_SUCCESS, "", 0, 1)]
    found = fired(spark, rows, 5000)
    assert found == {("ProgramadorSinLatido", ""): [(0, 300, 600, False), (1900 + 300, 2500, 5000, True)]}
    still = [(A.M_HEARTBEAT, "", s, min(s, 1000)) for s in range(0, 3000, 50)]
    begin, fires, until, active = fired(spark, still, 3000)[("ProgramadorSinLatido", "")][0]
    # From the first evaluation whose five minutes show no growth.
    assert 1250 <= begin <= 1330 and fires == begin + 300 and active and until == 3000
    assert fired(spark, [(M.M_SUCCESS, "", 0, 1)], 400)[("ProgramadorSinLatido", "")] == [(0, 300, 400, True)]


def test_nothing_recorded(spark):
    assert A.alert_rules(frame(spark, []), ["labels"], START).count() == 0
    assert fired(spark, [], 400, START) == {("ProgramadorSinLatido", ""): [(0, 300, 400, True)]}


def test_failing_tasks(spark):
    """Four failures within an hour; three that samples show, carried to the borders, are still over three."""
    failures = (0, 600, 1200, 1800, 20_000)
    rows = [(A.M_FAILURES, "", s, sum(f <= s for f in failures)) for s in range(-3600, 30_000, 30)]
    found = fired(spark, rows + BEATS, 30_000)
    (begin, fires, until, active), = found[("TareasDeAirflowFallando", "")]
    assert 1770 <= begin <= 1830 and fires == begin + 300 and 4140 <= until <= 4230 and not active


def plain_increase(points, end, window):
    """(growth, extrapolated growth) of (seconds, value) points in (end - window, end], or None."""
    inside = [(s, v) for s, v in points if end - window < s <= end]
    if len(inside) < 2:
        return None
    growth = sum(b - a if b >= a else b for (_, a), (_, b) in zip(inside, inside[1:]))
    sampled = inside[-1][0] - inside[0][0]
    mean = sampled / (len(inside) - 1)
    to_start, to_end = inside[0][0] - (end - window), end - inside[-1][0]
    to_start = mean / 2 if to_start >= 1.1 * mean else to_start
    to_end = mean / 2 if to_end >= 1.1 * mean else to_end
    if growth > 0:
        to_start = min(to_start, sampled * inside[0][1] / growth)
    return growth, growth * (sampled + to_start + to_end) / sampled


@pytest.mark.parametrize("chunk", [60 * T.MICROS, 10**6 * T.MICROS])
def test_extrapolated_growth(spark, chunk):
    rng = random.Random(3)
    rows, at = [], {"hot": 0, "a": 0}
    for _ in range(300):
        metric = "hot" if rng.random() < 0.8 else "a"
        at[metric] += rng.choice([1, 7, 15, 40, 300])
        rows.append((metric, "", at[metric], rng.randrange(50)))
    points = {m: [(s, v) for n, _, s, v in rows if n == m] for m in at}
    found = C.extrapolated_increase(frame(spark, rows), ["metric"], 120 * T.MICROS, chunk).collect()
    got = {(r.metric, (r.ts - START).total_seconds()): float(r.increase) for r in found}
    expected = {(m, s): e for m in at for s, _ in points[m] if (e := plain_increase(points[m], s, 120))}
    assert got.keys() == expected.keys() and len(got) > 100
    for key, (_, value) in expected.items():
        assert got[key] == pytest.approx(value, abs=1e-4)
    rates = C.extrapolated_rate(frame(spark, rows), ["metric"], 120 * T.MICROS, chunk).collect()
    assert {(r.metric, (r.ts - START).total_seconds()): float(r.rate) for r in rates} == pytest.approx({k: v / 120 for k, (_, v) in expected.items()}, abs=1e-5)


def test_copies_of_an_instant_count_once(spark):
    rows = [("c", "", 0, 5), ("c", "", 0, 7), ("c", "", 60, 9)]
    found = C.extrapolated_increase(frame(spark, rows), ["metric"], 60 * T.MICROS + 1).collect()
    assert [(r.sample_id, float(r.increase)) for r in found] == [(2, pytest.approx(2 * (60 + 1e-6) / 60, abs=1e-4))]


def test_absent_spans(spark):
    rows = [("m", "a", s, 1) for s in (100, 150, 900, 900)] + [("m", "b", 2000, 1)]
    expected = spark.createDataFrame([("c",), ("a",), (None,)], "labels string")
    found = A.absent_spans(frame(spark, rows), ["labels"], START, START + timedelta(seconds=1000), 300, expected).collect()
    got = sorted((r.labels, (r.since_ts - START).total_seconds(), (r.until_ts - START).total_seconds(), r.is_active) for r in found)
    assert got == [("", 0, 1000, True), ("a", 0, 100, False), ("a", 450, 900, False), ("c", 0, 1000, True)]


def test_one_sample_sustains_a_condition(spark):
    rows = [("a", "x", 0, 5), ("a", "x", 100, 0), ("b", "x", 0, 5), ("b", "x", 50, 6), ("b", "x", 90, 1), ("c", "x", 10, 7)]
    found = A.sustained(frame(spark, rows), ["metric"], F.col("value") >= 5, 90, START + timedelta(seconds=101)).collect()
    got = sorted((r.metric, (r.since - START).total_seconds(), (r.until - START).total_seconds(), r.is_active) for r in found)
    assert got == [("a", 0, 100, False), ("b", 0, 90, False), ("c", 10, 101, True)]
    short = A.sustained(frame(spark, rows), ["metric"], F.col("value") >= 5, 90, START + timedelta(seconds=101), F.lit(60))
    assert [(r.metric, (r.until - START).total_seconds()) for r in short.collect()] == [("b", 90)]
