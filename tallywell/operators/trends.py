"""Daily series. Every window below runs over one row per day (and key), so its
size is bounded by the calendar and not by the sales."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions import numbers as N
from tallywell.schema import TOTAL


def daily_base(detail: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """AG4: revenue, units and distinct counts per day (and key)."""
    return detail.groupBy("sale_date", *by).agg(
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.countDistinct("invoice_id").alias("distinct_invoices"),
        F.countDistinct("product_id").alias("distinct_products"),
    )


def _series(by: Sequence[str]):
    return Window.partitionBy(*by).orderBy("sale_date")


def _framed_mean(window) -> Column:
    return N.mean(F.sum("total_revenue").over(window), F.count("total_revenue").over(window), 2)


def moving_avg_calendar(daily: DataFrame, days: int = 7, by: Sequence[str] = (), name: str = "moving_avg") -> DataFrame:
    """WN3: mean over the last ``days`` calendar days, absent days not counted."""
    window = (
        Window.partitionBy(*by).orderBy(F.unix_date("sale_date")).rangeBetween(-(days - 1), 0)
    )
    return daily.withColumn(name, _framed_mean(window))


def moving_avg_rows(daily: DataFrame, rows: int = 7, by: Sequence[str] = (), name: str = "moving_avg_7d") -> DataFrame:
    """WN4: mean over the last ``rows`` days that had sales."""
    return daily.withColumn(name, _framed_mean(_series(by).rowsBetween(-(rows - 1), 0)))


def cumulative_revenue(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """WN5: running total."""
    window = _series(by).rowsBetween(Window.unboundedPreceding, 0)
    return daily.withColumn("cumulative_revenue", F.sum("total_revenue").over(window).cast(TOTAL))


def day_over_day(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """WN6: change against the previous day with sales."""
    change = F.col("total_revenue") - F.lag("total_revenue").over(_series(by))
    return daily.withColumn("change_vs_previous", change.cast(TOTAL))


def daily_trend(detail: DataFrame, days: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """WN3/WN5: the daily series with calendar average and running total."""
    daily = daily_base(detail, by)
    return cumulative_revenue(moving_avg_calendar(daily, days, by), by).orderBy("sale_date", *by)


def series_gaps(daily: DataFrame, longest: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """WN13: spans without sales longer than ``longest`` days."""
    before = F.lag("sale_date").over(_series(by))
    return (
        daily.withColumn("previous_date", before)
        .where(F.col("previous_date").isNotNull())
        .select(
            *by,
            "previous_date",
            F.col("sale_date").alias("next_date"),
            F.datediff("sale_date", "previous_date").alias("days_without_sales"),
        )
        .where(F.col("days_without_sales") > longest)
        .orderBy(F.desc("days_without_sales"), "previous_date", *by)
    )
