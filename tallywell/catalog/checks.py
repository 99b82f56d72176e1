"""Queries of the data tests, over inputs that break them."""

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import query, sql
from tallywell.catalog.rankings import GAPS, RANKING_WH, country_days
from tallywell.catalog.revenue import enriched
from tallywell.operators import checks as C
from tallywell.operators.rankings import product_ranking_wh
from tallywell.operators.revenue import add_line_revenue
from tallywell.schema import TOTAL
from tallywell.sources import star

AS_OF = datetime(2001, 11, 6, 12, 0)


def all_lines(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Returns included, so revenue and units may be negative."""
    return add_line_revenue(star.sales_lines(spark, folder, (*columns, "quantity", "unit_price")))


def totals_by(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.sum("line_revenue").cast(TOTAL).alias("total_revenue"), F.sum("quantity").alias("units_sold")
    )


@query("check_not_null", sql("SELECT invoice_id, product_id, customer_id FROM sales WHERE customer_id IS NULL", "sales"))
def not_null(spark: SparkSession, folder: str) -> DataFrame:
    return C.check_not_null(star.sales_lines(spark, folder, ("invoice_id", "product_id", "customer_id")), "customer_id")


@query("check_unique", sql(
    "SELECT invoice_id, product_id, count(*) AS occurrences FROM sales GROUP BY 1, 2 HAVING count(*) > 1", "sales"))
def unique(spark: SparkSession, folder: str) -> DataFrame:
    return C.check_unique(star.sales_lines(spark, folder, ("invoice_id", "product_id")), "invoice_id", "product_id")


@query("check_accepted_values", sql(
    "SELECT country, count(*) AS occurrences FROM sales WHERE country NOT IN ('UNITED KINGDOM', 'NATION_2') GROUP BY 1",
    "sales"))
def accepted(spark: SparkSession, folder: str) -> DataFrame:
    return C.check_accepted_values(star.sales_lines(spark, folder, ("country",)), "country", ("UNITED KINGDOM", "NATION_2"))


@query("check_freshness", sql(
    """SELECT latest, age // 3600 AS age_hours, CASE WHEN latest IS NULL OR age > 72 * 3600 THEN 'error'
        WHEN age > 26 * 3600 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT latest, date_diff('second', CAST(latest AS TIMESTAMP), TIMESTAMP '2001-11-06 12:00:00')
        AS age FROM (SELECT max(sale_date) AS latest FROM valid))""", "valid"))
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    return C.check_freshness(star.valid_lines(spark, folder, ("sale_date",)), AS_OF)


@query("check_freshness_part_hours", sql(
    """SELECT latest, age // 3600 AS age_hours, CASE WHEN age > 72 * 3600 THEN 'error'
        WHEN age > 26 * 3600 THEN 'warn' ELSE 'pass' END AS status
    FROM (SELECT max(event_ts) AS latest FROM valid), (SELECT unnest([95400, 261000]) AS age)""", "valid"))
def freshness_part_hours(spark: SparkSession, folder: str) -> DataFrame:
    """Half an hour over each limit: 26 h 30 min and 72 h 30 min after the last line."""
    lines = star.valid_lines(spark, folder, ("event_ts",))
    latest = lines.agg(F.max("event_ts").alias("latest")).first()["latest"]
    found = [C.check_freshness(lines, latest + timedelta(seconds=s), "event_ts") for s in (95400, 261000)]
    return found[0].unionByName(found[1])


_TOTALS = """SELECT detail_total, aggregate_total, CAST(abs(detail_total - aggregate_total) AS DECIMAL(29,2)) AS difference
    FROM (SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) AS detail_total FROM lines),
        (SELECT CAST(sum(line_revenue) AS DECIMAL(28,2)) AS aggregate_total FROM valid)"""


def _totals(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    aggregate = totals_by(star.valid_lines(spark, folder, ("product_id",)), "product_id")
    return all_lines(spark, folder), aggregate


@query("reconcile_totals", sql(_TOTALS, "lines", "valid"))
def reconcile_totals(spark: SparkSession, folder: str) -> DataFrame:
    return C.reconcile_totals(*_totals(spark, folder))


@query("totals_agree", sql(f"SELECT * FROM ({_TOTALS}) WHERE difference > 0.01", "lines", "valid"))
def totals_agree(spark: SparkSession, folder: str) -> DataFrame:
    return C.totals_agree(*_totals(spark, folder))


_BY_DAY = """SELECT coalesce(d.sale_date, s.sale_date) AS sale_date, detail_amount, summary_amount,
    CAST(abs(coalesce(detail_amount, 0) - coalesce(summary_amount, 0)) AS DECIMAL(29,2)) AS difference
    FROM (SELECT sale_date, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS detail_amount FROM valid
        WHERE quantity > 3 GROUP BY 1) d
    FULL OUTER JOIN (SELECT sale_date, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS summary_amount FROM valid
        WHERE unit_price > 5000 GROUP BY 1) s ON d.sale_date = s.sale_date"""


def _by_day(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Two sides that differ: small quantities miss in one, low prices in the other."""
    lines = star.valid_lines(spark, folder, ("sale_date",))
    summary = totals_by(lines.where(F.col("unit_price") > 5000), "sale_date")
    return lines.where(F.col("quantity") > 3), summary


@query("reconcile_by_key", sql(_BY_DAY, "valid"))
def reconcile_by_key(spark: SparkSession, folder: str) -> DataFrame:
    return C.reconcile_by_key(*_by_day(spark, folder))


@query("daily_totals_agree", sql(f"SELECT * FROM ({_BY_DAY}) WHERE difference > 0.01", "valid"))
def daily_totals_agree(spark: SparkSession, folder: str) -> DataFrame:
    return C.daily_totals_agree(*_by_day(spark, folder))


_KEYS = {"product_date_revenue": "product_id", "daily_summary": "sale_date", "country_sales": "country"}


@query("negative_measures", sql(
    " UNION ALL ".join(
        f"""SELECT '{model}' AS model, CAST({key} AS VARCHAR) AS key, CAST(sum(line_revenue) AS DECIMAL(28,2))
            AS total_revenue, CAST(sum(quantity) AS BIGINT) AS units_sold FROM lines GROUP BY {key}
            HAVING sum(line_revenue) < 0 OR sum(quantity) < 0"""
        for model, key in _KEYS.items()
    ), "lines"))
def negative_measures(spark: SparkSession, folder: str) -> DataFrame:
    return C.negative_measures(
        {model: (totals_by(all_lines(spark, folder, key), key), key) for model, key in _KEYS.items()}
    )


@query("ranking_is_coherent", sql(
    f"""SELECT * FROM (SELECT position, product_id, share_pct, cumulative_share_pct, previous_cumulative,
        CASE WHEN share_pct < 0 OR share_pct > 100 THEN 'participacion individual fuera de rango'
            WHEN cumulative_share_pct < 0 OR cumulative_share_pct > 100.01 THEN 'participacion acumulada fuera de rango'
            WHEN cumulative_share_pct < previous_cumulative THEN 'la participacion acumulada decrece' END AS reason
        FROM (SELECT *, lag(cumulative_share_pct) OVER (ORDER BY position) AS previous_cumulative
            FROM (SELECT CAST(51 - position AS INTEGER) AS position, product_id, share_pct, cumulative_share_pct
                FROM ({RANKING_WH})))) WHERE reason IS NOT NULL""", "enriched", "product_names"))
def ranking_is_coherent(spark: SparkSession, folder: str) -> DataFrame:
    ranking = product_ranking_wh(enriched(spark, folder))
    return C.ranking_is_coherent(ranking.withColumn("position", 51 - F.col("position")))


@query("no_long_gaps", sql(GAPS, "valid"))
def no_long_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return C.no_long_gaps(country_days(spark, folder), by=["country"])
