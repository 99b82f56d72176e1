"""Revenue per product and date, and the totals built on it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions import numbers as N
from tallywell.schema import MONEY, TOTAL


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns {missing}")


def add_line_revenue(df: DataFrame) -> DataFrame:
    """PRJ5: quantity x price, rounded per line before any sum."""
    require(df, "quantity", "unit_price")
    return df.withColumn(
        "line_revenue", F.round(F.col("quantity") * F.col("unit_price"), 2).cast(MONEY)
    )


def modal_value(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """AG11: most frequent non-null value per key, the smallest one on a tie.

    The values are counted first, so a key with a third of all rows reaches the
    second step as one row per distinct value.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("times"))
    winner = F.min(F.struct((-F.col("times")).alias("order"), F.col(value).alias("value")))
    return (
        counted.groupBy(*keys)
        .agg(winner.alias("winner"))
        .select(*keys, F.col("winner.value").alias(name))
    )


def attach_description(aggregate: DataFrame, detail: DataFrame) -> DataFrame:
    """JN2: add the modal description of each product over all dates."""
    descriptions = modal_value(detail, ["product_id"], "description", "product_description")
    return aggregate.join(descriptions, "product_id", "left")


def revenue_by_product_date(detail: DataFrame, ordered: bool = True) -> DataFrame:
    """AG1: one row per date and product; null keys keep their own group."""
    require(detail, "sale_date", "product_id", "line_revenue", "quantity")
    measures = [
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
        F.count("*").alias("invoice_lines"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_count"),
    ]
    if "invoice_id" in detail.columns:
        measures.append(F.countDistinct("invoice_id").alias("distinct_invoices"))
    aggregate = detail.groupBy("sale_date", "product_id").agg(*measures)
    aggregate = aggregate.withColumn(
        "mean_unit_price", N.mean(F.col("price_sum"), F.col("price_count"), 4, scale=4)
    ).drop("price_sum", "price_count")
    if "description" in detail.columns:
        aggregate = attach_description(aggregate, detail)
    aggregate = aggregate.select(
        "sale_date", "product_id", *[c for c in aggregate.columns if c not in ("sale_date", "product_id")]
    )
    if ordered:
        aggregate = aggregate.orderBy(
            F.asc("sale_date"), F.desc("total_revenue"), F.asc("product_id")
        )
    return aggregate


def daily_summary(aggregate: DataFrame) -> DataFrame:
    """AG3: one row per date from the product-date aggregate.

    The rows are one per date and product, so counting products is a plain count.
    """
    days = (
        aggregate.where(F.col("sale_date").isNotNull())
        .groupBy("sale_date")
        .agg(
            F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
            F.sum("units_sold").alias("units_sold"),
            F.count("product_id").alias("distinct_products"),
        )
    )
    return days.withColumn(
        "revenue_per_product", N.ratio(F.col("total_revenue"), F.col("distinct_products"), 2)
    )


def product_totals(aggregate: DataFrame) -> DataFrame:
    """AG6: whole-period totals per product from the product-date aggregate."""
    measures = [
        F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("units_sold").alias("units_sold"),
        F.count("sale_date").alias("days_with_sales"),
    ]
    if "product_description" in aggregate.columns:
        measures.append(F.min("product_description").alias("product_description"))
    return aggregate.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(*measures)


def business_kpis(aggregate: DataFrame) -> DataFrame:
    """AG15: the figures of the run report, one row."""
    return aggregate.agg(
        F.sum("total_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("invoice_lines").alias("lines"),
        F.countDistinct("product_id").alias("distinct_products"),
        F.countDistinct("sale_date").alias("days_covered"),
        F.min("sale_date").alias("first_date"),
        F.max("sale_date").alias("last_date"),
        F.sum("units_sold").alias("units_sold"),
    ).withColumn("mean_ticket_per_line", N.ratio(F.col("total_revenue"), F.col("lines"), 2))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """SO3: the distinct values of one key."""
    return df.select(key).distinct()
