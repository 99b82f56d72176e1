"""Calendar columns. The two conventions for the day of the week stay apart."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.schema import HOUR_BANDS


def add_calendar(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """PRJ6: calendar of the daily run; Monday is 0, the weekend is {5, 6}."""
    if date not in df.columns:
        raise KeyError(f"column {date} is needed to derive the calendar")
    day = F.col(date)
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "year_month": F.date_format(day, "yyyy-MM"),
            "weekday": F.weekday(day),
            "is_weekend": F.coalesce(F.weekday(day).isin(5, 6), F.lit(False)),
        }
    )


def add_calendar_wh(df: DataFrame, date: str = "sale_date", moment: str = "event_ts") -> DataFrame:
    """PRJ10: warehouse calendar; Sunday is 0, the weekend is {0, 6}."""
    day = F.col(date)
    day_of_week = F.dayofweek(day) - 1
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "day": F.dayofmonth(day),
            "day_of_week": day_of_week,
            "hour_of_day": F.hour(F.col(moment)),
            "year_month": F.date_format(day, "yyyy-MM"),
            "month_start": F.trunc(day, "month"),
            "week_start": F.trunc(day, "week"),
            "is_weekend": F.coalesce(day_of_week.isin(0, 6), F.lit(False)),
        }
    )


def add_hour_band(df: DataFrame, moment: str = "event_ts") -> DataFrame:
    """PRJ11: part of the trading day."""
    early, morning, afternoon, late = HOUR_BANDS
    hour = F.hour(F.col(moment))
    return df.withColumn(
        "hour_band",
        F.when(hour < 10, early).when(hour < 13, morning).when(hour < 16, afternoon).otherwise(late),
    )
