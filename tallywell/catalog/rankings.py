"""Queries of rankings, daily series and countries."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import percent, query, ratio, sql
from tallywell.catalog.revenue import PRODUCTS, WH, aggregate, enriched
from tallywell.operators import countries as K
from tallywell.operators import rankings as A
from tallywell.operators import trends as T
from tallywell.plans.analytics import month_count
from tallywell.plans.layers import daily_summary_wh, revenue_by_product_date_wh
from tallywell.session import materialize
from tallywell.sources import star

MONTHLY_DETAIL = ("sale_date", "product_id", "invoice_id", "description")
DAILY_DETAIL = ("sale_date", "product_id", "invoice_id")

MONTH_BASE = """SELECT strftime(sale_date, '%Y-%m') AS year_month, product_id,
    CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold,
    count(DISTINCT invoice_id) AS distinct_invoices, min(description) AS product_description
    FROM valid GROUP BY 1, 2"""
MONTHLY = f"""SELECT year_month, CAST(position AS INTEGER) AS position, product_id, product_description,
    total_revenue, units_sold, distinct_invoices, {percent("total_revenue", "month_revenue", 3)} AS share_pct
    FROM (SELECT *, row_number() OVER (PARTITION BY year_month ORDER BY total_revenue DESC, product_id) AS position,
        sum(total_revenue) OVER (PARTITION BY year_month) AS month_revenue FROM ({MONTH_BASE}))
    WHERE position <= 10"""


def _monthly_detail(spark: SparkSession, folder: str) -> DataFrame:
    return star.valid_lines(spark, folder, MONTHLY_DETAIL)


@query("month_product_base", sql(MONTH_BASE, "valid"))
def month_product_base(spark: SparkSession, folder: str) -> DataFrame:
    return A.month_product_base(_monthly_detail(spark, folder))


@query("month_totals", sql(
    "SELECT strftime(sale_date, '%Y-%m') AS year_month, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS month_revenue "
    "FROM valid GROUP BY 1", "valid"))
def month_totals(spark: SparkSession, folder: str) -> DataFrame:
    return A.month_totals(star.valid_lines(spark, folder, ("sale_date",)))


@query("monthly_ranking", sql(MONTHLY, "valid"))
def monthly_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return A.monthly_ranking(_monthly_detail(spark, folder))


@query("month_count", sql("SELECT count(DISTINCT strftime(sale_date, '%Y-%m')) AS months FROM valid", "valid"))
def months(spark: SparkSession, folder: str) -> DataFrame:
    return month_count(A.monthly_ranking(_monthly_detail(spark, folder), ordered=False))


@query("product_ranking", sql(
    f"""SELECT CAST(row_number() OVER (ORDER BY total_revenue DESC, product_id) AS INTEGER) AS position, product_id,
        total_revenue, units_sold, days_with_sales, product_description, share_pct,
        CAST(sum(share_pct) OVER (ORDER BY total_revenue DESC, product_id ROWS UNBOUNDED PRECEDING)
            AS DECIMAL(32,3)) AS cumulative_share_pct
    FROM (SELECT p.*, {percent("total_revenue", "grand", 3)} AS share_pct
        FROM ({PRODUCTS}) p, (SELECT sum(total_revenue) AS grand FROM aggregate)
        ORDER BY total_revenue DESC, product_id LIMIT 25)""", "aggregate"))
def product_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return A.product_ranking(aggregate(spark, folder), 25)


TOTALS_WH = f"""SELECT product_id, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT invoice_id) AS distinct_invoices,
    count(DISTINCT sale_date) AS days_with_sales, count(DISTINCT customer_id) AS distinct_customers,
    count(DISTINCT country) AS distinct_countries, min(sale_date) AS first_sale, max(sale_date) AS last_sale,
    {ratio("sum(unit_price)", "count(unit_price)", 2)} AS mean_unit_price, bool_or(is_admin_concept) AS is_admin_concept
    FROM enriched GROUP BY product_id"""
RANKING_WH = f"""SELECT product_id, product_description, total_revenue, units_sold, distinct_invoices, days_with_sales,
        distinct_customers, distinct_countries, first_sale, last_sale, mean_unit_price, is_admin_concept,
        CAST(position AS INTEGER) AS position, {percent("total_revenue", "grand", 4)} AS share_pct,
        {percent("running", "grand", 4)} AS cumulative_share_pct,
        {ratio("total_revenue", "days_with_sales", 2)} AS revenue_per_day
    FROM (SELECT t.*, row_number() OVER w AS position, sum(total_revenue) OVER () AS grand,
            sum(total_revenue) OVER (w ROWS UNBOUNDED PRECEDING) AS running
        FROM ({TOTALS_WH}) t WINDOW w AS (ORDER BY total_revenue DESC, product_id))
    LEFT JOIN product_names USING (product_id) WHERE position <= 50"""


@query("product_totals_wh", sql(
    f"""SELECT t.product_id, n.description AS product_description, t.* EXCLUDE (product_id) FROM ({TOTALS_WH}) t
    LEFT JOIN (SELECT product_id, description FROM (SELECT product_id, description,
        row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, description) AS place
        FROM enriched WHERE description IS NOT NULL GROUP BY product_id, description) WHERE place = 1) n
        ON t.product_id IS NOT DISTINCT FROM n.product_id""", "enriched"))
def product_totals_wh(spark: SparkSession, folder: str) -> DataFrame:
    return A.product_totals_wh(materialize(enriched(spark, folder).select(*A.TOTALS_COLUMNS, "description"), "totals_lines"))


@query("product_ranking_wh", sql(RANKING_WH, "enriched", "product_names"))
def product_ranking_wh(spark: SparkSession, folder: str) -> DataFrame:
    return A.product_ranking_wh(enriched(spark, folder))


@query("pareto_count", sql(
    f"""SELECT count(*) AS products FROM (SELECT {percent("running", "grand", 4)} AS share FROM (
        SELECT sum(total_revenue) OVER () AS grand,
            sum(total_revenue) OVER (ORDER BY total_revenue DESC, product_id ROWS UNBOUNDED PRECEDING) AS running
        FROM (SELECT product_id, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue FROM enriched GROUP BY product_id)))
    WHERE share <= 80""", "enriched"))
def pareto_count(spark: SparkSession, folder: str) -> DataFrame:
    return A.pareto_count(A.product_revenue(enriched(spark, folder)))


@query("top_k", sql(
    f"SELECT sale_date, product_id, total_revenue, units_sold FROM ({WH}) ORDER BY total_revenue DESC, sale_date, product_id LIMIT 10",
    "enriched"))
def top_k(spark: SparkSession, folder: str) -> DataFrame:
    table = revenue_by_product_date_wh(enriched(spark, folder), ordered=False)
    best = A.top_k(table, 10, "total_revenue", "sale_date", "product_id")
    return best.select("sale_date", "product_id", "total_revenue", "units_sold")


# Daily series.

DAILY_BASE = """SELECT sale_date, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT invoice_id) AS distinct_invoices,
    count(DISTINCT product_id) AS distinct_products FROM valid GROUP BY sale_date"""
COUNTRY_DAYS = """SELECT sale_date, country, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue
    FROM valid GROUP BY sale_date, country"""


def country_days(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("sale_date", "country"))
    return detail.groupBy("sale_date", "country").agg(F.sum("line_revenue").alias("total_revenue"))


@query("daily_base", sql(DAILY_BASE, "valid"))
def daily_base(spark: SparkSession, folder: str) -> DataFrame:
    return T.daily_base(star.valid_lines(spark, folder, DAILY_DETAIL))


_CALENDAR = "RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW"
_ROWS = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"


def _mean_over(frame: str, by: str = "") -> str:
    window = f"OVER ({by} ORDER BY sale_date {frame})"
    return ratio(f"sum(total_revenue) {window}", f"count(total_revenue) {window}", 2)


@query("daily_trend", sql(
    f"""SELECT *, {_mean_over(_CALENDAR)} AS moving_avg,
        CAST(sum(total_revenue) OVER (ORDER BY sale_date) AS DECIMAL(28,2)) AS cumulative_revenue
    FROM ({DAILY_BASE})""", "valid"))
def daily_trend(spark: SparkSession, folder: str) -> DataFrame:
    return T.daily_trend(star.valid_lines(spark, folder, DAILY_DETAIL))


@query("moving_avg_calendar", sql(
    f"SELECT *, {_mean_over(_CALENDAR, 'PARTITION BY country')} AS moving_avg FROM ({COUNTRY_DAYS})", "valid"))
def moving_avg_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return T.moving_avg_calendar(country_days(spark, folder), by=["country"])


@query("moving_avg_rows", sql(
    f"SELECT *, {_mean_over(_ROWS, 'PARTITION BY country')} AS moving_avg_7d FROM ({COUNTRY_DAYS})", "valid"))
def moving_avg_rows(spark: SparkSession, folder: str) -> DataFrame:
    return T.moving_avg_rows(country_days(spark, folder), by=["country"])


@query("cumulative_revenue", sql(
    f"""SELECT *, CAST(sum(total_revenue) OVER (PARTITION BY country ORDER BY sale_date) AS DECIMAL(28,2))
        AS cumulative_revenue FROM ({COUNTRY_DAYS})""", "valid"))
def cumulative_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return T.cumulative_revenue(country_days(spark, folder), by=["country"])


@query("day_over_day", sql(
    f"""SELECT *, CAST(total_revenue - lag(total_revenue) OVER (PARTITION BY country ORDER BY sale_date)
        AS DECIMAL(28,2)) AS change_vs_previous FROM ({COUNTRY_DAYS})""", "valid"))
def day_over_day(spark: SparkSession, folder: str) -> DataFrame:
    return T.day_over_day(country_days(spark, folder), by=["country"])


@query("latest_days", sql(f"SELECT * FROM ({DAILY_BASE}) ORDER BY sale_date DESC LIMIT 15", "valid"))
def latest_days(spark: SparkSession, folder: str) -> DataFrame:
    return A.latest_days(T.daily_base(star.valid_lines(spark, folder, DAILY_DETAIL)), 15)


GAPS = f"""SELECT country, previous_date, sale_date AS next_date,
    CAST(sale_date - previous_date AS INTEGER) AS days_without_sales
    FROM (SELECT *, lag(sale_date) OVER (PARTITION BY country ORDER BY sale_date) AS previous_date FROM ({COUNTRY_DAYS}))
    WHERE sale_date - previous_date > 10"""


@query("series_gaps", sql(GAPS, "valid"))
def series_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return T.series_gaps(country_days(spark, folder), by=["country"])


DAILY_WH = f"""SELECT *, {_mean_over(_ROWS)} AS moving_avg_7d,
        CAST(sum(total_revenue) OVER (ORDER BY sale_date) AS DECIMAL(28,2)) AS cumulative_revenue,
        CAST(total_revenue - lag(total_revenue) OVER (ORDER BY sale_date) AS DECIMAL(28,2)) AS change_vs_previous
    FROM (SELECT sale_date, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
        CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS invoice_lines,
        count(DISTINCT invoice_id) AS distinct_invoices, count(DISTINCT product_id) AS distinct_products,
        count(DISTINCT customer_id) AS distinct_customers, count(DISTINCT country) AS distinct_countries,
        max(year) AS year, max(month) AS month, max(year_month) AS year_month, max(day_of_week) AS day_of_week,
        bool_or(is_weekend) AS is_weekend,
        CAST(sum(CASE WHEN is_admin_concept THEN line_revenue ELSE 0 END) AS DECIMAL(28,2)) AS admin_revenue,
        {ratio("sum(line_revenue)", "count(DISTINCT invoice_id)", 2)} AS mean_ticket,
        {ratio("sum(line_revenue)", "count(DISTINCT product_id)", 2)} AS revenue_per_product,
        {ratio("sum(quantity)", "count(DISTINCT invoice_id)", 2, 0)} AS units_per_invoice
    FROM enriched GROUP BY sale_date)"""


@query("daily_summary_wh", sql(DAILY_WH, "enriched"))
def daily_wh(spark: SparkSession, folder: str) -> DataFrame:
    return daily_summary_wh(enriched(spark, folder))


# Countries.

COUNTRY_TOTALS = """SELECT country, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
    count(DISTINCT invoice_id) AS distinct_invoices, count(DISTINCT product_id) AS distinct_products
    FROM valid GROUP BY country"""
_COUNTRY_DETAIL = ("country", "invoice_id", "product_id")


@query("country_totals", sql(COUNTRY_TOTALS, "valid"))
def country_totals(spark: SparkSession, folder: str) -> DataFrame:
    return K.country_totals(star.valid_lines(spark, folder, _COUNTRY_DETAIL))


@query("country_concentration", sql(
    f"""SELECT *, CAST(sum(share_pct) OVER (ORDER BY total_revenue DESC, country ROWS UNBOUNDED PRECEDING)
            AS DECIMAL(32,3)) AS cumulative_share_pct
    FROM (SELECT *, {percent("total_revenue", "sum(total_revenue) OVER ()", 3)} AS share_pct
        FROM ({COUNTRY_TOTALS}))""", "valid"))
def country_concentration(spark: SparkSession, folder: str) -> DataFrame:
    return K.country_concentration(star.valid_lines(spark, folder, _COUNTRY_DETAIL))


COUNTRY_WH = """SELECT country, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS invoice_lines,
    count(DISTINCT invoice_id) AS distinct_invoices, count(DISTINCT product_id) AS distinct_products,
    count(DISTINCT customer_id) AS distinct_customers, count(DISTINCT sale_date) AS days_with_sales,
    min(sale_date) AS first_sale, max(sale_date) AS last_sale FROM enriched GROUP BY country"""
COUNTRY_SALES = f"""SELECT *, CAST(row_number() OVER (ORDER BY total_revenue DESC, country) AS INTEGER) AS position,
    {ratio("total_revenue", "distinct_invoices", 2)} AS mean_ticket,
    {percent("total_revenue", "sum(total_revenue) OVER ()", 4)} AS share_pct,
    CASE country WHEN 'UNITED KINGDOM' THEN 'mercado local' WHEN 'DESCONOCIDO' THEN 'sin identificar'
        ELSE 'exportacion' END AS market_type
    FROM ({COUNTRY_WH})"""


@query("country_totals_wh", sql(COUNTRY_WH, "enriched"))
def country_totals_wh(spark: SparkSession, folder: str) -> DataFrame:
    return K.country_totals_wh(enriched(spark, folder))


@query("country_sales_wh", sql(COUNTRY_SALES, "enriched"))
def country_sales_wh(spark: SparkSession, folder: str) -> DataFrame:
    return K.country_sales_wh(enriched(spark, folder))
