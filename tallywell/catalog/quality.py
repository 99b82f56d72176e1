"""Queries of the quality rules, profiles and output invariants."""

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import query, ratio, sql
from tallywell.operators import profile as P
from tallywell.operators import quality as Q
from tallywell.operators.dedup import flag_duplicates
from tallywell.operators.revenue import add_line_revenue, business_kpis, revenue_by_product_date
from tallywell.schema import DUPLICATE_KEYS
from tallywell.session import deal, materialize
from tallywell.sources import star
from tallywell.sources.typing import coerce_types

AS_OF = date(2004, 6, 30)
LIMITS = Q.Limits(as_of=AS_OF, max_reject_pct=99.0)
RULES = Q.build_rules(LIMITS, "ordinal")
SHOWN = ("invoice_id", "product_id", "quantity", "event_ts", "unit_price")
SHOWN_SQL = ", ".join(SHOWN)


def classified(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return Q.apply_rules(star.defective_lines(spark, folder, (*SHOWN, *extra, "ordinal")), RULES)


def _broken(predicate) -> "DataFrame":
    def run(spark: SparkSession, folder: str) -> DataFrame:
        lines = star.defective_lines(spark, folder, SHOWN)
        return lines.where(F.coalesce(predicate(lines), F.lit(True))).select(*SHOWN)

    return run


query("rule_null_keys", sql(
    f"SELECT {SHOWN_SQL} FROM defective WHERE product_id IS NULL OR quantity IS NULL OR event_ts IS NULL "
    "OR unit_price IS NULL", "defective"))(_broken(Q.null_keys))
query("rule_product", sql(
    f"SELECT {SHOWN_SQL} FROM defective WHERE product_id IS NULL OR trim(product_id) = ''", "defective"))(
    _broken(Q.blank_product))
query("rule_date", sql(
    f"SELECT {SHOWN_SQL} FROM defective WHERE event_ts IS NULL OR event_ts < TIMESTAMP '2000-01-01' "
    "OR event_ts >= TIMESTAMP '2004-07-01'", "defective"))(_broken(lambda df: Q.date_out_of_range(df, AS_OF)))
query("rule_quantity", sql(
    f"SELECT {SHOWN_SQL} FROM defective WHERE coalesce(quantity, 0) < 1", "defective"))(
    _broken(lambda df: Q.quantity_too_low(df, LIMITS.min_quantity)))
query("rule_price", sql(
    f"SELECT {SHOWN_SQL} FROM defective WHERE coalesce(unit_price, -1) NOT BETWEEN 0.01 AND 50000", "defective"))(
    _broken(lambda df: Q.price_out_of_range(df, LIMITS.min_price, LIMITS.max_price)))


@query("rule_duplicates", sql(
    f"SELECT {SHOWN_SQL}, delivery FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id, product_id, event_ts, "
    "quantity, unit_price ORDER BY delivery, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS copy "
    "FROM defective) WHERE copy > 1", "defective"))
def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    flagged = flag_duplicates(star.defective_lines(spark, folder, (*SHOWN, "ordinal")), DUPLICATE_KEYS, "ordinal")
    return flagged.where("is_duplicate").select(*SHOWN, F.col("ordinal.delivery").alias("delivery"))


@query("apply_rules", sql(f"SELECT {SHOWN_SQL}, reject_reason FROM classified", "classified"))
def apply_rules(spark: SparkSession, folder: str) -> DataFrame:
    return classified(spark, folder).select(*SHOWN, "reject_reason")


@query("valid_rows", sql(f"SELECT {SHOWN_SQL} FROM classified WHERE reject_reason IS NULL", "classified"))
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    return Q.valid_rows(classified(spark, folder)).select(*SHOWN)


@query("rejected_rows", sql(
    f"SELECT {SHOWN_SQL}, reject_reason FROM classified WHERE reject_reason IS NOT NULL", "classified"))
def rejected_rows(spark: SparkSession, folder: str) -> DataFrame:
    return Q.rejected_rows(classified(spark, folder)).select(*SHOWN, "reject_reason")


_NAMES = ", ".join(f"({i + 1}, '{r.name}')" for i, r in enumerate(RULES))


@query("rule_counts", sql(
    f"""SELECT CAST(n AS INTEGER) AS rule_order, rule, (SELECT count(*) FROM classified WHERE reject_reason = rule)
        AS rejected_rows FROM (VALUES {_NAMES}) r(n, rule)""", "classified"))
def rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    return Q.rule_counts(classified(spark, folder), RULES)


@query("reject_rate", sql(
    f"""SELECT count(*) AS input_rows, count(*) - count(reject_reason) AS valid_rows,
        count(reject_reason) AS rejected_rows, {ratio("count(reject_reason)", "count(*)", 4, 0, 0, 100)} AS reject_pct
    FROM classified""", "classified"))
def reject_rate(spark: SparkSession, folder: str) -> DataFrame:
    stats = Q.quality_stats(classified(spark, folder), RULES)
    return stats.select("input_rows", "valid_rows", "rejected_rows", "reject_pct")


@query("quality_gate", sql(
    "SELECT count(*) - count(reject_reason) AS valid_rows, true AS passed FROM classified", "classified"))
def quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    stats = materialize(Q.quality_stats(classified(spark, folder), RULES), "stats")
    Q.quality_gate(stats.first().asDict(), RULES, LIMITS.max_reject_pct)
    return stats.select("valid_rows", F.lit(True).alias("passed"))


@query("reason_counts", sql(
    f"""SELECT reject_reason, count(*) AS rejected_rows,
        {ratio("count(*)", "any_value(total)", 1, 0, 0, 100)} AS share_pct
    FROM classified, (SELECT count(reject_reason) AS total FROM classified)
    WHERE reject_reason IS NOT NULL GROUP BY reject_reason""", "classified"))
def reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    return Q.reason_counts(Q.rejected_rows(materialize(classified(spark, folder).select("reject_reason"), "reasons")))


@query("verify_aggregate", sql(
    """SELECT count(*) AS aggregate_rows, CAST(0 AS BIGINT) AS repeated_keys,
        count(*) FILTER (WHERE revenue < 0) AS negative_revenue, count(*) FILTER (WHERE revenue IS NULL) AS null_revenue
    FROM (SELECT sum(line_revenue) AS revenue FROM lines GROUP BY sale_date, product_id)""", "lines"))
def verify_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    """Dates and products hardly repeat, so tasks combine little and hold a group per line:
    the lines are dealt to small shares first, those of one key to several."""
    columns = ("sale_date", "product_id", "quantity", "unit_price")
    lines = add_line_revenue(deal(star.sales_lines(spark, folder, columns), *columns))
    return Q.aggregate_invariants(revenue_by_product_date(lines, ordered=False))


@query("profile_input", sql(
    "SELECT count(*) AS total_rows, CAST(9 AS INTEGER) AS columns, "
    + ", ".join(f"count(*) - count({c}) AS nulls_{c}" for c in star.SALES_COLUMNS)
    + ", min(sale_date) AS first_date, max(sale_date) AS last_date, "
    + ", ".join(f"count(DISTINCT {c}) AS distinct_{c}" for c in ("product_id", "invoice_id", "customer_id", "country"))
    + """ FROM (SELECT * REPLACE (CASE WHEN l_returnflag <> 'R' THEN event_ts END AS event_ts,
        CASE WHEN l_returnflag <> 'R' THEN sale_date END AS sale_date) FROM sales)""", "sales"))
def profile_input(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the lines has a number where its date should be."""
    lines = star.sales_lines(spark, folder, (*star.SALES_COLUMNS, "l_returnflag"))
    shifted = F.when(F.col("l_returnflag") == "R", "17850").otherwise(F.col("event_ts").cast("string"))
    return P.profile_input(coerce_types(lines.withColumn("event_ts", shifted).drop("sale_date", "l_returnflag")).select(*star.SALES_COLUMNS))


@query("profile_sample", sql(
    "SELECT count(*) AS lines, count(DISTINCT invoice_id) AS invoices, count(DISTINCT product_id) AS products, "
    "count(DISTINCT country) AS countries, min(event_ts) AS first_ts, max(event_ts) AS last_ts FROM sales", "sales"))
def profile_sample(spark: SparkSession, folder: str) -> DataFrame:
    return P.profile_sample(
        star.sales_lines(spark, folder, ("invoice_id", "product_id", "country", "event_ts"))
    )


@query("business_kpis", sql(
    f"""SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue, count(*) AS lines,
        count(DISTINCT product_id) AS distinct_products, count(DISTINCT sale_date) AS days_covered,
        min(sale_date) AS first_date, max(sale_date) AS last_date, CAST(sum(quantity) AS BIGINT) AS units_sold,
        {ratio("sum(line_revenue)", "count(*)", 2)} AS mean_ticket_per_line FROM valid""", "valid"))
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("sale_date", "product_id"))
    return business_kpis(revenue_by_product_date(detail, ordered=False))
