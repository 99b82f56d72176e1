from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from frames import VALID, lines, priced
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.functions.calendar import add_calendar, add_calendar_wh
from tallywell.functions.vocabulary import with_spanish_names
from tallywell.operators import countries as K
from tallywell.operators import rankings as A
from tallywell.operators import revenue as R
from tallywell.operators import trends as T
from tallywell.operators.ranges import in_ranges
from tallywell.plans.layers import PRODUCT_DATE_COLUMNS, daily_summary_wh, enrich_sales, prepare_sales, revenue_by_product_date_wh


def test_line_revenue(spark):
    assert [float(r.line_revenue) for r in priced(spark).collect()] == [25.0, 30.0, 50.0, 5.0, 80.0]


def test_revenue_is_rounded_per_line(spark):
    row = ("1", "a", "X", 3, VALID[0][4], "1.9999", 1, "FRANCE")
    assert priced(spark, [row]).first().line_revenue == Decimal("6.00")


def test_missing_inputs(spark):
    with pytest.raises(KeyError, match="unit_price"):
        R.add_line_revenue(lines(spark, VALID).drop("unit_price"))
    with pytest.raises(KeyError, match="line_revenue"):
        R.revenue_by_product_date(lines(spark, VALID))


def test_revenue_by_product_date(spark):
    rows = R.revenue_by_product_date(priced(spark)).collect()
    assert len(rows) == 4
    first = rows[0]
    assert (first.sale_date, first.product_id) == (date(2009, 12, 1), "22086")
    assert (first.total_revenue, first.units_sold, first.invoice_lines, first.distinct_invoices) == (Decimal("75.00"), 30, 2, 2)
    assert [r.product_id for r in rows] == ["22086", "85048", "84879", "21232"]


def test_aggregation_neither_creates_nor_loses_money(spark):
    detail = priced(spark)
    total = detail.agg(F.sum("line_revenue")).first()[0]
    aggregate = R.revenue_by_product_date(detail)
    assert aggregate.agg(F.sum("total_revenue")).first()[0] == total
    assert R.daily_summary(aggregate).agg(F.sum("total_revenue")).first()[0] == total
    assert K.country_totals(detail).agg(F.sum("total_revenue")).first()[0] == total


def test_null_keys_keep_their_group(spark):
    rows = [*VALID, ("1", None, "X", 1, VALID[0][4], "1.00", 1, "FRANCE")]
    aggregate = R.revenue_by_product_date(priced(spark, rows))
    assert aggregate.where("product_id is null").first().total_revenue == Decimal("1.00")
    assert R.product_totals(aggregate).where("product_id is null").count() == 0


def test_modal_description(spark):
    names = ["NOMBRE BUENO", "NOMBRE BUENO", "nombre con error", None, None, None]
    rows = [(str(i), "22086", n, 1, VALID[0][4], "1.00", 1, "FRANCE") for i, n in enumerate(names)]
    assert R.revenue_by_product_date(priced(spark, rows)).first().product_description == "NOMBRE BUENO"


def test_modal_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a")], "k string, v string")
    assert R.modal_value(df, ["k"], "v", "m").first().m == "a"


def test_daily_summary(spark):
    days = R.daily_summary(R.revenue_by_product_date(priced(spark))).orderBy("sale_date").collect()
    assert [float(d.total_revenue) for d in days] == [105.0, 85.0]
    assert days[0].distinct_products == 2 and days[0].revenue_per_product == Decimal("52.50")
    empty = R.daily_summary(R.revenue_by_product_date(priced(spark).limit(0)))
    assert empty.count() == 0 and "revenue_per_product" in empty.columns


def test_product_ranking(spark):
    rows = A.product_ranking(R.revenue_by_product_date(priced(spark))).collect()
    assert [(r.position, r.product_id, float(r.total_revenue)) for r in rows] == [
        (1, "84879", 80.0), (2, "22086", 75.0), (3, "85048", 30.0), (4, "21232", 5.0)
    ]
    assert float(rows[0].share_pct) == 42.105 and float(rows[-1].cumulative_share_pct) == 100.0
    top = A.product_ranking(R.revenue_by_product_date(priced(spark)), 2).collect()
    assert [float(r.share_pct) for r in top] == [42.105, 39.474]


def test_ranking_without_revenue_has_null_shares(spark):
    rows = [("1", "a", "X", 0, VALID[0][4], "1.00", 1, "FRANCE")]
    assert A.product_ranking(R.revenue_by_product_date(priced(spark, rows))).first().share_pct is None


def test_monthly_ranking(spark):
    rows = [*VALID, ("9", "22086", "P", 1, datetime(2010, 1, 5), "7.00", 1, "FRANCE")]
    ranking = A.monthly_ranking(priced(spark, rows), 2).collect()
    assert [(r.year_month, r.position, r.product_id) for r in ranking] == [
        ("2009-12", 1, "84879"), ("2009-12", 2, "22086"), ("2010-01", 1, "22086")
    ]
    assert float(ranking[0].share_pct) == 42.105 and float(ranking[2].share_pct) == 100.0


def test_calendar_and_row_averages_differ_on_gaps(spark):
    days = [(date(2010, 1, 1), "10.00"), (date(2010, 1, 2), "20.00"), (date(2010, 1, 20), "60.00")]
    daily = spark.createDataFrame([(d, Decimal(v)) for d, v in days], "sale_date date, total_revenue decimal(28,2)")
    out = T.moving_avg_rows(T.moving_avg_calendar(daily)).orderBy("sale_date").collect()
    assert [float(r.moving_avg) for r in out] == [10.0, 15.0, 60.0]
    assert [float(r.moving_avg_7d) for r in out] == [10.0, 15.0, 30.0]
    gap = T.series_gaps(daily).collect()
    assert [(g.previous_date, g.days_without_sales) for g in gap] == [(date(2010, 1, 2), 18)]
    change = T.day_over_day(T.cumulative_revenue(daily)).orderBy("sale_date").collect()
    assert [r.change_vs_previous for r in change] == [None, Decimal("10.00"), Decimal("40.00")]
    assert float(change[-1].cumulative_revenue) == 90.0


def test_country_concentration(spark):
    rows = K.country_concentration(priced(spark)).collect()
    assert [(r.country, float(r.total_revenue), float(r.cumulative_share_pct)) for r in rows] == [
        ("UNITED KINGDOM", 105.0, 55.263), ("FRANCE", 85.0, 100.0)
    ]
    assert K.country_concentration(priced(spark).drop("country")).count() == 0


def test_weekends_by_both_conventions(spark):
    df = spark.sql("select explode(array(date'2009-12-05', date'2009-12-06', date'2009-12-07')) sale_date")
    df = df.withColumn("event_ts", F.col("sale_date").cast("timestamp_ntz"))
    daily, warehouse = add_calendar(df).collect(), add_calendar_wh(df).collect()
    assert [r.is_weekend for r in daily] == [r.is_weekend for r in warehouse] == [True, True, False]
    assert [r.weekday for r in daily] == [5, 6, 0] and [r.day_of_week for r in warehouse] == [6, 0, 1]


def test_warehouse_tables(spark):
    rows = [*VALID, ("9", "POST", " ", 1, VALID[0][4], "7.00", None, None)]
    enriched = enrich_sales(prepare_sales(priced(spark, rows)))
    row = enriched.where("product_id = 'POST'").first()
    assert (row.is_admin_concept, row.has_no_customer, row.country, row.description) == (True, True, "DESCONOCIDO", None)
    assert (row.hour_band, row.amount_segment, row.volume_segment) == ("temprano", "baja", "unitaria")
    table = revenue_by_product_date_wh(enriched)
    assert table.count() == 5
    best = table.where("product_id = '22086'").first()
    assert (best.revenue_per_invoice, best.revenue_per_unit, best.main_country) == (Decimal("37.50"), Decimal("2.50"), "UNITED KINGDOM")
    day = daily_summary_wh(enriched).first()
    assert (day.admin_revenue, day.mean_ticket, day.distinct_invoices) == (Decimal("7.00"), Decimal("37.33"), 3)
    markets = {r.country: r.market_type for r in K.country_sales_wh(enriched).collect()}
    assert markets == {"UNITED KINGDOM": "mercado local", "FRANCE": "exportacion", "DESCONOCIDO": "sin identificar"}
    ranking = A.product_ranking_wh(enriched, 3).collect()
    assert [r.position for r in ranking] == [1, 2, 3] and float(ranking[0].share_pct) == 40.6091
    assert A.pareto_count(A.product_ranking_wh(enriched)).first().products == 2


def test_product_totals_count_distinct_values_without_repeating_lines(spark):
    rows = [("1", "A", 1, "FR", 1), ("1", "A", 1, "FR", 1), ("2", "A", None, "FR", 2), ("3", "A", 2, None, 2),
            (None, "A", 2, "ES", None), ("4", None, None, None, None), ("4", "B", None, None, 5)]
    df = spark.createDataFrame(rows, "invoice_id string, product_id string, customer_id long, country string, d int")
    df = df.select(
        "*", F.date_add(F.lit("2020-01-01").cast("date"), F.col("d")).alias("sale_date"), F.lit(2).alias("quantity"),
        F.when(F.col("invoice_id") != "2", F.lit("1.50")).cast(S.MONEY).alias("unit_price"),
        F.lit("3.00").cast(S.MONEY).alias("line_revenue"), (F.col("product_id") == "B").alias("is_admin_concept"),
    )
    totals = A.product_totals_wh(df)
    found = {r.product_id: r for r in totals.collect()}
    assert len(found) == totals.count() == 3
    day = date(2020, 1, 1)
    assert tuple(found["A"]) == (
        "A", Decimal("15.00"), 10, 3, 2, 2, 2, day + timedelta(1), day + timedelta(2), Decimal("1.50"), False)
    assert tuple(found[None]) == (None, Decimal("3.00"), 2, 1, 0, 0, 0, None, None, Decimal("1.50"), None)
    assert tuple(found["B"])[3:7] == (1, 1, 0, 0) and found["B"].is_admin_concept
    assert "Expand" not in totals._jdf.queryExecution().optimizedPlan().toString()


def test_the_ordered_table_is_made_once(spark):
    enriched = enrich_sales(prepare_sales(priced(spark, VALID)))
    table = revenue_by_product_date_wh(enriched.select(*PRODUCT_DATE_COLUMNS))
    assert table.collect() == sorted(table.collect(), key=lambda r: (r.sale_date, -r.total_revenue, r.product_id))
    unordered = revenue_by_product_date_wh(enriched, ordered=False)
    assert sorted(table.collect(), key=repr) == sorted(unordered.collect(), key=repr)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" in plan and "Aggregate" not in plan


def test_product_totals_have_the_modal_description_of_each_product(spark):
    rows = [("A", "x"), ("A", "y"), ("A", "y"), ("A", None), ("A", None), ("A", None), ("B", "z"), ("B", "w"), ("C", None), (None, "v"), (None, "v"), (None, "u")]
    df = spark.createDataFrame(rows, "product_id string, description string").select(
        "*", F.lit("1").alias("invoice_id"), F.lit(1).alias("customer_id"), F.lit("FR").alias("country"),
        F.lit("2020-01-01").cast("date").alias("sale_date"), F.lit(2).alias("quantity"), F.lit("1.50").cast(S.MONEY).alias("unit_price"),
        F.lit("3.00").cast(S.MONEY).alias("line_revenue"), F.lit(False).alias("is_admin_concept"),
    )
    found = {r.product_id: r for r in A.product_totals_wh(df).collect()}
    assert {k: r.product_description for k, r in found.items()} == {"A": "y", "B": "w", "C": None, None: "v"}
    assert found["A"].units_sold == 12 and found[None].total_revenue == Decimal("9.00") and len(found) == 4


def test_spanish_names(spark):
    out = with_spanish_names(R.revenue_by_product_date(priced(spark)))
    assert out.columns[:4] == ["fecha", "producto_id", "ingreso_total", "unidades_vendidas"]


def test_running_sums_over_ranges(spark):
    rows = [(k, None if k % 7 == 0 else (k * 37) % 11) for k in range(500)]
    df = spark.createDataFrame(rows, "k int, v long")
    found = in_ranges(df, [F.desc_nulls_last("v"), F.asc("k")], {"v": "running"}, "position").collect()
    expected, total = {}, None
    for place, (k, v) in enumerate(sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0])), 1):
        total = total if v is None else (total or 0) + v
        expected[k] = (total, place)
    assert {r.k: (r.running, r.position) for r in found} == expected
    assert in_ranges(df.limit(0), [F.asc("k")], {"v": "running"}, "position").count() == 0
