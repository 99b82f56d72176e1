"""Product rankings, one per convention; see the README for the differences."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.functions import numbers as N
from tallywell.operators.ranges import in_ranges
from tallywell.operators.revenue import modal_value, product_totals
from tallywell.schema import MONTHLY_RANKING_SIZE, PUBLISHED_RANKING_SIZE, TOTAL
from tallywell.session import materialize


def _by_revenue(key: str):
    return F.desc("total_revenue"), F.asc(key)


def top_k(df: DataFrame, k: int, measure: str, *tie_break: str) -> DataFrame:
    """ST2: the k largest rows; every task keeps k rows at most."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def latest_days(df: DataFrame, k: int, date: str = "sale_date") -> DataFrame:
    """ST3: the k latest rows by date."""
    return df.orderBy(F.desc(date)).limit(k)


def _with_month(detail: DataFrame) -> DataFrame:
    """The first day of the month groups faster than its text, made afterwards."""
    return detail.withColumn("month_start", F.trunc("sale_date", "month"))


def _year_month() -> Column:
    return F.date_format("month_start", "yyyy-MM").alias("year_month")


def _month_product_measures(detail: DataFrame) -> DataFrame:
    return (
        _with_month(detail)
        .groupBy("month_start", "product_id")
        .agg(
            F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
            F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
            F.countDistinct("invoice_id").alias("distinct_invoices"),
        )
    )


def _month_product_names(detail: DataFrame) -> DataFrame:
    return (
        _with_month(detail)
        .groupBy("month_start", "product_id")
        .agg(F.min("description").alias("product_description"))
    )


def month_product_base(detail: DataFrame) -> DataFrame:
    """AG8: totals per month and product."""
    measures, names = _month_product_measures(detail), _month_product_names(detail)
    return measures.join(names, ["month_start", "product_id"], "left").select(
        _year_month(), "product_id", "total_revenue", "units_sold", "distinct_invoices", "product_description"
    )


def month_totals(detail: DataFrame) -> DataFrame:
    """WN2: the revenue of each month, from the two columns it needs."""
    months = _with_month(detail).groupBy("month_start").agg(F.sum("line_revenue").cast(TOTAL).alias("month_revenue"))
    return months.select(_year_month(), "month_revenue")


def monthly_ranking(detail: DataFrame, n: int = MONTHLY_RANKING_SIZE, ordered: bool = True) -> DataFrame:
    """WN1: top n products of every month with their share of the month.

    The measures, a row per month and product, are written out: the rank and the
    totals of the months come from them. The rank filter sits directly above the rank,
    so each task passes on at most n rows per month. Only the leaders' lines are read
    again, for a description. Writing is done while the frame is built.
    """
    measures = materialize(_month_product_measures(detail), "month_measures")
    in_month = Window.partitionBy("month_start").orderBy(*_by_revenue("product_id"))
    leaders = measures.withColumn("position", F.row_number().over(in_month)).where(F.col("position") <= n)
    leaders = materialize(leaders, "month_leaders")
    keys = leaders.select(F.col("month_start").alias("m"), F.col("product_id").alias("p"))
    is_leader = F.col("month_start").eqNullSafe(F.col("m")) & F.col("product_id").eqNullSafe(F.col("p"))
    names = _month_product_names(_with_month(detail).join(keys, is_leader, "left_semi"))
    names = names.withColumnsRenamed({"month_start": "m", "product_id": "p"})
    totals = measures.groupBy(F.col("month_start").alias("total_month")).agg(F.sum("total_revenue").cast(TOTAL).alias("month_revenue"))
    ranking = (
        leaders.join(names, is_leader, "left")
        .join(totals, F.col("month_start").eqNullSafe(F.col("total_month")), "left")
        .withColumn("year_month", _year_month())
        .select(
            "year_month",
            "position",
            "product_id",
            "product_description",
            "total_revenue",
            "units_sold",
            "distinct_invoices",
            N.percent(F.col("total_revenue"), F.col("month_revenue"), 3).alias("share_pct"),
        )
    )
    return ranking.orderBy("year_month", "position") if ordered else ranking


def product_ranking(aggregate: DataFrame, n: int = 20) -> DataFrame:
    """WN10/WN15: top n products of the period; the cumulative share adds the
    rounded shares. Shares are null when the period has no revenue.

    Only the n leaders reach the windows.
    """
    leaders = top_k(product_totals(aggregate), n, "total_revenue", "product_id")
    # The shares are of all the revenue, a row without a product included.
    grand_total = aggregate.agg(F.sum("total_revenue")).scalar()
    in_order = Window.orderBy(*_by_revenue("product_id"))
    share = F.when(grand_total > 0, N.percent(F.col("total_revenue"), grand_total, 3))
    return (
        leaders.withColumn("share_pct", share)
        .withColumn("position", F.row_number().over(in_order))
        .withColumn(
            "cumulative_share_pct",
            F.sum("share_pct").over(in_order.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select("position", *leaders.columns, "share_pct", "cumulative_share_pct")
    )


def product_revenue(enriched: DataFrame) -> DataFrame:
    """The revenue of every product."""
    return enriched.groupBy("product_id").agg(F.sum("line_revenue").cast(TOTAL).alias("total_revenue"))


_DISTINCT_COUNTS = {
    "invoice_id": "distinct_invoices",
    "customer_id": "distinct_customers",
    "country": "distinct_countries",
}


def product_totals_wh(enriched: DataFrame) -> DataFrame:
    """AG7: whole-period measures per product from the enriched detail.

    Sums are made per product and date, where the dates are then single; invoices, customers
    and countries are made single on their own. So no line is repeated for a distinct count,
    and a hot product is spread by what is counted. The detail is read once for each of the
    four, so it should be written, or cheap to make. A detail with descriptions is read once
    more, for the modal one of each product, the rows without a product included.
    """
    days = enriched.groupBy("product_id", "sale_date").agg(
        F.sum("line_revenue").alias("line_revenue"),
        F.sum(F.col("quantity").cast("bigint")).alias("quantity"),
        F.sum("unit_price").alias("unit_price"),
        F.count("unit_price").alias("prices"),
        F.bool_or("is_admin_concept").alias("is_admin_concept"),
    )
    measures = days.groupBy("product_id").agg(
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"),
        F.sum("quantity").alias("units_sold"),
        F.count("sale_date").alias("days_with_sales"),
        F.min("sale_date").alias("first_sale"),
        F.max("sale_date").alias("last_sale"),
        N.mean(F.sum("unit_price"), F.sum("prices"), 2).alias("mean_unit_price"),
        F.bool_or("is_admin_concept").alias("is_admin_concept"),
    )
    counts = [
        enriched.select("product_id", column).distinct().groupBy("product_id").agg(F.count(column).alias(name))
        for column, name in _DISTINCT_COUNTS.items()
    ]
    pieces = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts, measures)
    # Each piece has one row per product, so all but one of the values are null.
    one = pieces.groupBy("product_id").agg(*[F.max(c).alias(c) for c in pieces.columns if c != "product_id"])
    described = "description" in enriched.columns
    if described:
        names = modal_value(enriched, ["product_id"], "description", "product_description")
        one = one.join(names.withColumnRenamed("product_id", "named"), F.col("product_id").eqNullSafe(F.col("named")), "left")
    return one.select(
        "product_id",
        *(["product_description"] if described else []),
        "total_revenue",
        "units_sold",
        "distinct_invoices",
        "days_with_sales",
        "distinct_customers",
        "distinct_countries",
        "first_sale",
        "last_sale",
        "mean_unit_price",
        "is_admin_concept",
    )


TOTALS_COLUMNS = (
    "product_id",
    "line_revenue",
    "quantity",
    "invoice_id",
    "sale_date",
    "customer_id",
    "country",
    "unit_price",
    "is_admin_concept",
)


def product_ranking_wh(enriched: DataFrame, n: int = PUBLISHED_RANKING_SIZE) -> DataFrame:
    """WN8/WN9: published ranking; the cumulative share is the running revenue
    over the grand total, rounded once.

    The revenue of every product is written out; the leaders and the grand total come
    from it. The leaders' lines are written out in turn, with the columns that the
    distinct counts and the modal description need. Both are done while the frame is built.
    """
    revenue = materialize(product_revenue(enriched), "product_revenue")
    leaders = top_k(revenue, n, "total_revenue", "product_id").select(F.col("product_id").alias("leader"))
    is_leader = F.col("product_id").eqNullSafe(F.col("leader"))
    lines = enriched.join(materialize(leaders, "leaders"), is_leader, "left_semi")
    lines = materialize(lines.select(*TOTALS_COLUMNS, "description"), "leader_lines")
    totals = product_totals_wh(lines.drop("description"))
    names = modal_value(lines, ["product_id"], "description", "product_description")
    grand_total = revenue.agg(F.sum("total_revenue")).scalar()
    in_order = Window.orderBy(*_by_revenue("product_id"))
    running = F.sum("total_revenue").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        totals.join(names, "product_id", "left")
        .withColumn("position", F.row_number().over(in_order))
        .withColumn("share_pct", N.percent(F.col("total_revenue"), grand_total, 4))
        .withColumn("cumulative_share_pct", N.percent(running, grand_total, 4))
        .withColumn("revenue_per_day", N.ratio(F.col("total_revenue"), F.col("days_with_sales"), 2))
        .select(
            "product_id",
            "product_description",
            "total_revenue",
            "units_sold",
            "distinct_invoices",
            "days_with_sales",
            "distinct_customers",
            "distinct_countries",
            "first_sale",
            "last_sale",
            "mean_unit_price",
            "is_admin_concept",
            "position",
            "share_pct",
            "cumulative_share_pct",
            "revenue_per_day",
        )
        .orderBy("position")
    )


def pareto_count(totals: DataFrame, share: int = 80) -> DataFrame:
    """ST4: how many products, by falling revenue, stay within a cumulative share.

    ``totals`` has a row per product with ``total_revenue``.
    """
    running = in_ranges(totals.select("product_id", "total_revenue"), _by_revenue("product_id"), {"total_revenue": "running"})
    grand_total = totals.agg(F.sum("total_revenue")).scalar()
    return running.where(N.percent(F.col("running"), grand_total, 4) <= share).agg(F.count("*").alias("products"))
