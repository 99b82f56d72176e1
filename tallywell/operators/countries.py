"""Revenue by country."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions import numbers as N
from tallywell.functions.segments import add_market_type
from tallywell.operators.ranges import in_ranges
from tallywell.schema import TOTAL

CONCENTRATION_SCHEMA = (
    "country string, total_revenue decimal(28,2), distinct_invoices bigint, distinct_products bigint, "
    "share_pct decimal(22,3), cumulative_share_pct decimal(32,3)"
)


def country_totals(detail: DataFrame) -> DataFrame:
    """AG9: revenue and distinct counts per country."""
    return detail.groupBy("country").agg(
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
        F.countDistinct("invoice_id").alias("distinct_invoices"),
        F.countDistinct("product_id").alias("distinct_products"),
    )


def country_concentration(detail: DataFrame) -> DataFrame:
    """WN11: share per country; the cumulative share adds the rounded shares.

    Without a country column the result is empty.
    """
    if "country" not in detail.columns:
        return detail.sparkSession.createDataFrame([], CONCENTRATION_SCHEMA)
    grand_total = detail.agg(F.sum("line_revenue")).scalar()
    order = [F.desc("total_revenue"), F.asc("country")]
    shares = country_totals(detail).withColumn("share_pct", N.percent(F.col("total_revenue"), grand_total, 3))
    return in_ranges(shares, order, {"share_pct": "cumulative_share_pct"}).orderBy(*order)


def country_totals_wh(enriched: DataFrame) -> DataFrame:
    """AG10: nine measures per country."""
    return enriched.groupBy("country").agg(
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.count("*").alias("invoice_lines"),
        F.countDistinct("invoice_id").alias("distinct_invoices"),
        F.countDistinct("product_id").alias("distinct_products"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.countDistinct("sale_date").alias("days_with_sales"),
        F.min("sale_date").alias("first_sale"),
        F.max("sale_date").alias("last_sale"),
    )


def country_sales_wh(enriched: DataFrame) -> DataFrame:
    """WN12: published country table."""
    grand_total = enriched.agg(F.sum("line_revenue")).scalar()
    order = [F.desc("total_revenue"), F.asc("country")]
    ranked = (
        in_ranges(country_totals_wh(enriched), order, {}, "position")
        .withColumn("mean_ticket", N.ratio(F.col("total_revenue"), F.col("distinct_invoices"), 2))
        .withColumn("share_pct", N.percent(F.col("total_revenue"), grand_total, 4))
    )
    return add_market_type(ranked).orderBy("position")
