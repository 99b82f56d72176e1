"""Queries of the product-date aggregate and what follows from it."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import query, ratio, sql
from tallywell.functions import numbers as N
from tallywell.functions.vocabulary import with_spanish_names
from tallywell.operators import revenue as R
from tallywell.operators.profile import preview_rows
from tallywell.plans.layers import PRODUCT_DATE_COLUMNS, enrich_sales, prepare_sales, revenue_by_product_date_wh
from tallywell.session import materialize
from tallywell.sources import star

DETAIL = ("sale_date", "product_id", "invoice_id", "description")
AGG = "sale_date, product_id, total_revenue, units_sold, invoice_lines, distinct_invoices, mean_unit_price, product_description"


def aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return R.revenue_by_product_date(star.valid_lines(spark, folder, DETAIL), ordered=False)


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_sales(prepare_sales(star.valid_lines(spark, folder)))


@query("revenue_by_product_date", sql(f"SELECT {AGG} FROM aggregate ORDER BY sale_date, total_revenue DESC, product_id", "aggregate"))
def revenue_by_product_date(spark: SparkSession, folder: str) -> DataFrame:
    return R.revenue_by_product_date(star.valid_lines(spark, folder, DETAIL))


@query("spanish_names", sql(
    "SELECT sale_date AS fecha, product_id AS producto_id, total_revenue AS ingreso_total, units_sold AS unidades_vendidas, "
    "invoice_lines AS lineas_de_factura, distinct_invoices AS facturas_distintas, "
    "mean_unit_price AS precio_unitario_promedio, product_description AS descripcion_producto FROM aggregate", "aggregate"))
def spanish_names(spark: SparkSession, folder: str) -> DataFrame:
    return with_spanish_names(aggregate(spark, folder))


WH = f"""SELECT b.*, n.description AS product_description, c.country AS main_country FROM (
    SELECT sale_date, product_id, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
        CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS invoice_lines,
        count(DISTINCT invoice_id) AS distinct_invoices, count(DISTINCT customer_id) AS distinct_customers,
        {ratio("sum(unit_price)", "count(unit_price)", 2)} AS mean_unit_price,
        min(unit_price) AS min_unit_price, max(unit_price) AS max_unit_price,
        max(year) AS year, max(month) AS month, max(year_month) AS year_month,
        bool_or(is_weekend) AS is_weekend, bool_or(is_admin_concept) AS is_admin_concept,
        {ratio("sum(line_revenue)", "count(DISTINCT invoice_id)", 2)} AS revenue_per_invoice,
        {ratio("sum(line_revenue)", "sum(quantity)", 2)} AS revenue_per_unit
    FROM enriched GROUP BY sale_date, product_id) b
    LEFT JOIN (SELECT sale_date, product_id, description FROM (SELECT sale_date, product_id, description,
        row_number() OVER (PARTITION BY sale_date, product_id ORDER BY count(*) DESC, description) AS place
        FROM enriched WHERE description IS NOT NULL GROUP BY sale_date, product_id, description) WHERE place = 1) n
        ON b.sale_date = n.sale_date AND b.product_id = n.product_id
    LEFT JOIN (SELECT sale_date, product_id, country FROM (SELECT sale_date, product_id, country,
        row_number() OVER (PARTITION BY sale_date, product_id ORDER BY count(*) DESC, country) AS place
        FROM enriched GROUP BY sale_date, product_id, country) WHERE place = 1) c
        ON b.sale_date = c.sale_date AND b.product_id = c.product_id"""


@query("revenue_by_product_date_wh", sql(WH, "enriched"))
def by_product_date_wh(spark: SparkSession, folder: str) -> DataFrame:
    lines = enriched(spark, folder).select(*PRODUCT_DATE_COLUMNS)
    return revenue_by_product_date_wh(materialize(lines, "product_date_lines"))


DAILY = f"""SELECT sale_date, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(quantity) AS BIGINT) AS units_sold, count(DISTINCT product_id) AS distinct_products,
    {ratio("sum(line_revenue)", "count(DISTINCT product_id)", 2)} AS revenue_per_product
    FROM valid GROUP BY sale_date"""


@query("daily_summary", sql(DAILY, "valid"))
def daily_summary(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("sale_date", "product_id"))
    return R.daily_summary(R.revenue_by_product_date(detail, ordered=False))


PRODUCTS = """SELECT a.product_id, CAST(sum(total_revenue) AS DECIMAL(28,2)) AS total_revenue,
    CAST(sum(units_sold) AS BIGINT) AS units_sold, count(*) AS days_with_sales,
    min(product_description) AS product_description FROM aggregate a GROUP BY a.product_id"""


@query("product_totals", sql(PRODUCTS, "aggregate"))
def product_totals(spark: SparkSession, folder: str) -> DataFrame:
    return R.product_totals(aggregate(spark, folder))


@query("modal_value", sql("SELECT * FROM product_names", "product_names"))
def modal_value(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("product_id", "description"))
    return R.modal_value(detail, ["product_id"], "description", "product_description")


@query("modal_value_by_two_keys", sql(
    """SELECT country, year, product_id FROM (SELECT country, year, product_id, row_number() OVER (
        PARTITION BY country, year ORDER BY count(*) DESC, product_id) AS place
        FROM (SELECT *, CAST(year(sale_date) AS INTEGER) AS year FROM valid) GROUP BY country, year, product_id)
    WHERE place = 1""", "valid"))
def modal_product(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("country", "sale_date", "product_id"))
    return R.modal_value(detail.withColumn("year", F.year("sale_date")), ["country", "year"], "product_id", "product_id")


@query("attach_description", sql(
    """SELECT c.*, product_description FROM (SELECT product_id, count(DISTINCT country) AS distinct_countries
        FROM valid GROUP BY product_id) c LEFT JOIN product_names n ON c.product_id = n.product_id""", "product_names"))
def attach_description(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("product_id", "description", "country"))
    counts = detail.groupBy("product_id").agg(F.countDistinct("country").alias("distinct_countries"))
    return R.attach_description(counts, detail)


@query("derived_ratios", sql(
    f"""SELECT product_id, {ratio("sum(line_revenue)", "count(*) FILTER (WHERE country IS NULL)", 2)} AS per_unnamed_line,
        CAST(sum(line_revenue) AS DECIMAL(18,2)) AS amount
    FROM lines GROUP BY product_id""", "lines"))
def derived_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """Denominators of zero give null, negative amounts round away from zero."""
    lines = R.add_line_revenue(star.sales_lines(spark, folder, ("product_id", "country", "quantity", "unit_price")))
    total, unnamed = F.sum("line_revenue"), F.count_if(F.col("country").isNull())
    return lines.groupBy("product_id").agg(
        N.ratio(total, unnamed, 2).alias("per_unnamed_line"), N.money(total).alias("amount")
    )


@query("distinct_keys", sql("SELECT DISTINCT invoice_id FROM valid", "valid"))
def distinct_keys(spark: SparkSession, folder: str) -> DataFrame:
    return R.distinct_keys(star.valid_lines(spark, folder, ("invoice_id",)), "invoice_id")


@query("preview_rows", sql(
    f"SELECT {', '.join(f'CAST({c.strip()} AS VARCHAR) AS {c.strip()}' for c in AGG.split(','))} FROM "
    "(SELECT * FROM aggregate ORDER BY sale_date, total_revenue DESC, product_id LIMIT 10)", "aggregate"))
def preview(spark: SparkSession, folder: str) -> DataFrame:
    return preview_rows(R.revenue_by_product_date(star.valid_lines(spark, folder, DETAIL)))
