"""Row-local flags and segments of the warehouse layers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell import schema as S


def flag_admin_code(df: DataFrame, product: str = "product_id") -> DataFrame:
    """PRJ8: a code that does not start with five digits is no real article."""
    return df.withColumn(
        "is_admin_concept",
        F.coalesce(~F.col(product).rlike("^[0-9]{5}"), F.lit(True)),
    )


def flag_no_customer(df: DataFrame, customer: str = "customer_id") -> DataFrame:
    """PRJ9: a sale without a customer account."""
    return df.withColumn("has_no_customer", F.col(customer).isNull())


def add_amount_segment(df: DataFrame, amount: str = "line_revenue") -> DataFrame:
    """PRJ12: size of the line by amount."""
    value = F.col(amount)
    lowest, low, middle, high, highest = S.AMOUNT_SEGMENTS
    return df.withColumn(
        "amount_segment",
        F.when(value < 5, lowest)
        .when(value < 20, low)
        .when(value < 100, middle)
        .when(value < 500, high)
        .otherwise(highest),
    )


def add_volume_segment(df: DataFrame, units: str = "quantity") -> DataFrame:
    """PRJ13: size of the line by units."""
    value = F.col(units)
    single, retail, wholesale, bulk = S.VOLUME_SEGMENTS
    return df.withColumn(
        "volume_segment",
        F.when(value == 1, single).when(value <= 12, retail).when(value <= 100, wholesale).otherwise(bulk),
    )


def add_market_type(df: DataFrame, country: str = "country") -> DataFrame:
    """PRJ14: home market, unknown or export."""
    value = F.col(country)
    return df.withColumn(
        "market_type",
        F.when(value == S.HOME_COUNTRY, S.MARKET_HOME)
        .when(value == S.UNKNOWN_COUNTRY, S.MARKET_UNKNOWN)
        .otherwise(S.MARKET_EXPORT),
    )
