"""End to end: 30 good lines and three bad ones."""

import json
from datetime import timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from frames import csv_text

from tallywell.errors import QualityError
from tallywell.operators import monitoring as M
from tallywell.operators.checks import run_checks, source_checks
from tallywell.operators.quality import Limits
from tallywell.plans import analytics, daily_run, watch
from tallywell.session import shared_dir
from tallywell.sinks.files import read_result

LOOSE = Limits(max_reject_pct=20.0)


def source(tmp_path, bad=True):
    rows = [
        (f"4894{day:02d}", code, "TEXT", units, f"2009-12-{day:02d} 10:00:00", "2.0", "13085.0", "UNITED KINGDOM")
        for day in range(1, 11)
        for code, units in (("22086", 10), ("85048", 20), ("84879", 30))
    ]
    if bad:
        rows += [
            ("1", "22086", "T", -5, "2009-12-11 10:00:00", "2.0", "13085.0", "UNITED KINGDOM"),
            ("2", "AJUSTE", "T", 1, "2009-12-11 10:00:00", "90000", "13085.0", "UNITED KINGDOM"),
            ("3", "", "T", 1, "2009-12-11 10:00:00", "2.0", "13085.0", "UNITED KINGDOM"),
        ]
    path = tmp_path / "in.csv"
    path.write_text(csv_text(rows))
    return str(path)


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    report = daily_run.run(
        spark, source(base), str(base / "out"), LOOSE, load_warehouse=True, raw_database="raw_e2e",
        database_location=str(base / "db"), run_id="r1",
    )
    return base, report


def test_steps_are_deleted_however_the_run_ends(spark, tmp_path):
    root = Path(shared_dir(spark))
    before = set(root.rglob("daily_run/*"))
    daily_run.run(spark, source(tmp_path), str(tmp_path / "out"), LOOSE)
    with pytest.raises(QualityError):
        daily_run.run(spark, source(tmp_path), str(tmp_path / "strict"), Limits(max_reject_pct=1.0))
    assert set(root.rglob("daily_run/*")) == before


def test_totals(done):
    _, report = done
    assert {k: report["validation"][k] for k in ("input_rows", "valid_rows", "rejected_rows")} == {
        "input_rows": 33, "valid_rows": 30, "rejected_rows": 3
    }
    kpis = report["kpis"]
    assert (kpis["total_revenue"], kpis["units_sold"], kpis["distinct_products"], kpis["days_covered"]) == (Decimal("1200.00"), 600, 3, 10)
    assert daily_run.run_summary(report)["loaded"] == {"sales_detail": 30, "product_date_revenue": 30, "daily_summary": 10}
    assert len(report["preview"]) == 10


def test_files(spark, done):
    base, report = done
    out = base / "out"
    assert (out / "sales_detail" / "year=2009" / "month=12").is_dir()
    assert read_result(spark, str(out / "product_date_revenue")).count() == 30
    assert spark.read.option("header", True).csv(str(out / "product_ranking_csv")).count() == 3
    quarantine = spark.read.option("header", True).csv(report["quarantine"])
    assert sorted(r.reject_reason for r in quarantine.collect()) == ["cantidad_minima", "columnas_obligatorias_sin_nulos", "precio_en_rango"]
    written = json.loads(next((out / "reports" / "report_latest").glob("*.txt")).read_text())
    assert written["run_id"] == "r1"


def test_metrics(spark, done):
    base, _ = done
    rows = {
        (r.metric, tuple(r.labels.values())): r.value
        for r in spark.read.parquet(str(base / "out" / "run_metrics")).where("run_id = 'r1'").collect()
    }
    assert rows[(M.M_ROWS, ("ingesta",))] == 33 and rows[(M.M_ROWS, ("validacion",))] == 30
    assert rows[(M.M_REJECTED, ("cantidad_minima",))] == 1 and rows[(M.M_SUCCESS, ())] == 1
    assert rows[(M.M_REVENUE, ())] == 1200.0 and (M.M_LAST_SUCCESS, ()) in rows


def test_second_run_gives_the_same(spark, done):
    base, _ = done
    daily_run.run(spark, str(base / "in.csv"), str(base / "out"), LOOSE, run_id="r2")
    assert read_result(spark, str(base / "out" / "sales_detail")).count() == 30


def test_analyses_and_warehouse(spark, done):
    base, report = done
    rows = analytics.run_analyses(spark, report["outputs"]["sales_detail"], str(base / "analyses"))
    assert rows == {"monthly_ranking": 3, "daily_trend": 10, "country_concentration": 1}
    last = spark.table("raw_e2e.sales_detail").selectExpr("cast(max(sale_date) as timestamp_ntz) d").first().d
    loaded, checks = analytics.build_warehouse(
        spark, "raw_e2e.sales_detail", "published_e2e", str(base / "pub"), as_of=last + timedelta(hours=20)
    )
    assert {n: r.rows for n, r in loaded.items()} == {
        "product_date_revenue": 30, "daily_summary": 10, "product_ranking": 3, "country_sales": 1
    }
    assert len(checks) == 47 and all(c["status"] == "pass" for c in checks)
    stale = source_checks({"sales_detail": spark.table("raw_e2e.sales_detail")}, last + timedelta(hours=73))
    assert {c["check"]: c["status"] for c in run_checks(stale)}["source_freshness_error"] == "fail"


def test_the_watch_writes_its_rows_even_if_a_check_fails(spark, done, tmp_path):
    raw = spark.table("raw_e2e.sales_detail")
    published = {n: spark.table(f"published_e2e.{n}") for n in ("daily_summary", "product_date_revenue")}
    found = watch.watch_warehouse(spark, raw, published, str(tmp_path / "m"))
    assert found["volumes"] == {"daily_summary": 10, "product_date_revenue": 30} and found["days"] == 10
    with pytest.raises(QualityError, match="tables without rows"):
        watch.watch_warehouse(spark, raw, published | {"daily_summary": published["daily_summary"].limit(0)}, str(tmp_path / "m"))
    with pytest.raises(QualityError, match="differ"):
        watch.watch_warehouse(spark, raw.limit(3), published, str(tmp_path / "m"))
    done_marks = spark.read.parquet(str(tmp_path / "m")).where("metric = 'almacen_vigilancia_completada'").orderBy("ts")
    assert [r.value for r in done_marks.collect()] == [1.0, 0.0, 1.0]


def test_parquet_source_gives_the_same(spark, done, tmp_path):
    base, report = done
    path = str(tmp_path / "in.parquet")
    text = spark.read.option("header", True).csv(str(base / "in.csv"))
    text.unionByName(text.limit(1)).write.parquet(path)
    again = daily_run.run(spark, path, str(tmp_path / "o"), LOOSE)
    assert again["kpis"] == report["kpis"] and again["validation"]["sin_duplicados_exactos"] == 1


def test_row_cap(spark, tmp_path):
    report = daily_run.run(spark, source(tmp_path, bad=False), str(tmp_path / "o"), LOOSE, max_rows=15)
    assert report["validation"]["input_rows"] == 15 and report["quarantine"] is None


def test_gate_keeps_evidence_and_publishes_nothing(spark, tmp_path):
    with pytest.raises(QualityError):
        daily_run.run(spark, source(tmp_path), str(tmp_path / "o"), Limits(max_reject_pct=5.0), run_id="bad")
    assert (tmp_path / "o" / "quarantine" / "run_id=bad").is_dir()
    assert not (tmp_path / "o" / "product_date_revenue").exists()


def test_exit_codes(spark, tmp_path):
    path = source(tmp_path)
    assert daily_run.exit_code(spark, path, str(tmp_path / "a"), limits=LOOSE) == 0
    assert daily_run.exit_code(spark, path, str(tmp_path / "b"), limits=Limits(max_reject_pct=5.0)) == 1
    assert daily_run.exit_code(spark, str(tmp_path / "none.csv"), str(tmp_path / "c")) == 1
    assert daily_run.exit_code(spark, path, str(tmp_path / "d"), unknown_option=1) == 2
    failed = spark.read.parquet(str(tmp_path / "b" / "run_metrics")).collect()
    assert [(r.metric, r.value) for r in failed] == [(M.M_SUCCESS, 0.0)]


def test_a_number_in_the_date_column_is_one_rejected_line(spark, tmp_path):
    path = tmp_path / "in.csv"
    good = [f"{k},22086,A,6,2010-01-02 03:04,2.50,7,UK" for k in range(1, 40)]
    path.write_text("\n".join(["Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country", *good, "99,22087,B,6,17850,2.50,7,UK"]))
    report = daily_run.run(spark, str(path), str(tmp_path / "out"))
    assert (report["validation"]["input_rows"], report["validation"]["rejected_rows"]) == (40, 1)
    assert report["quarantine"] and report["kpis"]["units_sold"] == 39 * 6
