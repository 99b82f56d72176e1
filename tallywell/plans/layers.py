"""Warehouse layers: prepared detail, enriched detail, published tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.functions import numbers as N
from tallywell.functions.calendar import add_calendar_wh, add_hour_band
from tallywell.functions.segments import (
    add_amount_segment,
    add_volume_segment,
    flag_admin_code,
    flag_no_customer,
)
from tallywell.operators.countries import country_sales_wh
from tallywell.operators.rankings import product_ranking_wh
from tallywell.operators.revenue import modal_value
from tallywell.operators.trends import cumulative_revenue, day_over_day, moving_avg_rows
from tallywell.session import materialize


def prepare_sales(detail: DataFrame) -> DataFrame:
    """PRJ7-PRJ9: normalised text and types, two-digit money, two flags."""
    normal = detail.select(
        F.upper(F.trim("invoice_id")).alias("invoice_id"),
        F.upper(F.trim("product_id")).alias("product_id"),
        F.nullif(F.trim("description"), F.lit("")).alias("description"),
        F.upper(F.trim(F.coalesce("country", F.lit(S.UNKNOWN_COUNTRY)))).alias("country"),
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("sale_date").cast("date").alias("sale_date"),
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("quantity").cast("int").alias("quantity"),
        N.money(F.col("unit_price")).alias("unit_price"),
        N.money(F.col("line_revenue")).alias("line_revenue"),
    )
    return flag_no_customer(flag_admin_code(normal))


def enrich_sales(prepared: DataFrame) -> DataFrame:
    """PRJ10-PRJ13: calendar, hour band and segments."""
    return (
        prepared.transform(add_calendar_wh)
        .transform(add_hour_band)
        .transform(add_amount_segment)
        .transform(add_volume_segment)
    )


PRODUCT_DATE_COLUMNS = (
    "sale_date",
    "product_id",
    "line_revenue",
    "quantity",
    "invoice_id",
    "customer_id",
    "unit_price",
    "description",
    "country",
)


def revenue_by_product_date_wh(enriched: DataFrame, ordered: bool = True) -> DataFrame:
    """AG2: published product-date table.

    Calendar columns follow from the date and the admin flag from the product,
    so both are derived after the aggregation and not carried through it. The
    two modes come out partitioned by the same keys as the base, so their joins
    need no shuffle of their own. The rules let no null key reach this layer. The detail is
    read three times, so it should be written, or cheap to make. A table that is to be ordered
    is written first, as its rows would else be made twice, once to find the ranges.
    """
    keys = ["sale_date", "product_id"]
    base = enriched.groupBy(*keys).agg(
        F.sum("line_revenue").cast(S.TOTAL).alias("total_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.count("*").alias("invoice_lines"),
        F.countDistinct("invoice_id").alias("distinct_invoices"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        N.mean(F.sum("unit_price"), F.count("unit_price"), 2).alias("mean_unit_price"),
        F.min("unit_price").alias("min_unit_price"),
        F.max("unit_price").alias("max_unit_price"),
    )
    names = modal_value(enriched, keys, "description", "product_description")
    countries = modal_value(enriched, keys, "country", "main_country")
    table = flag_admin_code(base.join(names, keys, "left").join(countries, keys, "left"))
    table = table.select(
        *base.columns,
        F.year("sale_date").alias("year"),
        F.month("sale_date").alias("month"),
        F.date_format("sale_date", "yyyy-MM").alias("year_month"),
        (F.dayofweek("sale_date") - 1).isin(0, 6).alias("is_weekend"),
        "is_admin_concept",
        "product_description",
        "main_country",
        N.ratio(F.col("total_revenue"), F.col("distinct_invoices"), 2).alias("revenue_per_invoice"),
        N.ratio(F.col("total_revenue"), F.col("units_sold"), 2).alias("revenue_per_unit"),
    )
    if not ordered:
        return table
    return materialize(table, "product_date").orderBy("sale_date", F.desc("total_revenue"), "product_id")


def daily_summary_wh(enriched: DataFrame) -> DataFrame:
    """AG5 with WN4-WN6: published daily table."""
    admin = F.when(F.col("is_admin_concept"), F.col("line_revenue")).otherwise(F.lit(0).cast(S.MONEY))
    days = enriched.groupBy("sale_date").agg(
        F.sum("line_revenue").cast(S.TOTAL).alias("total_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.count("*").alias("invoice_lines"),
        F.countDistinct("invoice_id").alias("distinct_invoices"),
        F.countDistinct("product_id").alias("distinct_products"),
        F.countDistinct("customer_id").alias("distinct_customers"),
        F.countDistinct("country").alias("distinct_countries"),
        F.sum(admin).cast(S.TOTAL).alias("admin_revenue"),
    )
    day = F.col("sale_date")
    days = days.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "year_month": F.date_format(day, "yyyy-MM"),
            "day_of_week": F.dayofweek(day) - 1,
            "is_weekend": (F.dayofweek(day) - 1).isin(0, 6),
            "mean_ticket": N.ratio(F.col("total_revenue"), F.col("distinct_invoices"), 2),
            "revenue_per_product": N.ratio(F.col("total_revenue"), F.col("distinct_products"), 2),
            "units_per_invoice": N.ratio(F.col("units_sold"), F.col("distinct_invoices"), 2),
        }
    )
    return (
        days.transform(moving_avg_rows)
        .transform(cumulative_revenue)
        .transform(day_over_day)
        .orderBy("sale_date")
    )


PUBLISHED = {
    "product_date_revenue": revenue_by_product_date_wh,
    "daily_summary": daily_summary_wh,
    "product_ranking": product_ranking_wh,
    "country_sales": country_sales_wh,
}
