"""Input profiles, one pass each."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def profile_input(df: DataFrame) -> DataFrame:
    """AG13: rows, nulls per column, date range and distinct ids, one row."""
    measures = [F.count(F.lit(1)).alias("total_rows"), F.lit(len(df.columns)).alias("columns")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in df.columns]
    if "sale_date" in df.columns:
        measures += [F.min("sale_date").alias("first_date"), F.max("sale_date").alias("last_date")]
    measures += [
        F.countDistinct(c).alias(f"distinct_{c}")
        for c in ("product_id", "invoice_id", "customer_id", "country")
        if c in df.columns
    ]
    return df.agg(*measures)


def profile_sample(df: DataFrame) -> DataFrame:
    """AG14: size, distinct keys and time range of a sample, one row."""
    return df.agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct("invoice_id").alias("invoices"),
        F.countDistinct("product_id").alias("products"),
        F.countDistinct("country").alias("countries"),
        F.min("event_ts").alias("first_ts"),
        F.max("event_ts").alias("last_ts"),
    )


def preview_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """ST6: the first rows as text for the run report."""
    return df.limit(n).select(*[F.col(c).cast("string").alias(c) for c in df.columns])
