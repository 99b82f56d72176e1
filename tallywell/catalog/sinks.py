"""Queries of the sinks: write, then read what was written."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog import quality as Q
from tallywell.catalog.base import query, sql
from tallywell.catalog.checks import all_lines, totals_by
from tallywell.catalog.rankings import COUNTRY_SALES, MONTHLY, country_days
from tallywell.catalog.revenue import AGG, aggregate
from tallywell.functions.calendar import add_calendar
from tallywell.operators import checks as C
from tallywell.operators.quality import quality_stats, rejected_rows
from tallywell.operators.rankings import monthly_ranking
from tallywell.session import new_path
from tallywell.sinks import files as S
from tallywell.sinks import warehouse as W
from tallywell.sources import star

DETAIL = ("invoice_id", "product_id", "sale_date")


def _detail(spark: SparkSession, folder: str) -> DataFrame:
    return add_calendar(star.valid_lines(spark, folder, DETAIL)).select(*DETAIL, "line_revenue", "year", "month")


_PARTITIONED = """SELECT invoice_id, product_id, sale_date, line_revenue, CAST(year(sale_date) AS INTEGER) AS year,
    CAST(month(sale_date) AS INTEGER) AS month FROM valid"""


@query("write_parquet", sql(_PARTITIONED, "valid"))
def write_parquet(spark: SparkSession, folder: str) -> DataFrame:
    """Written twice to show that a repeated run replaces its output."""
    path = new_path(spark, "detail")
    for _ in range(2):
        S.write_parquet(_detail(spark, folder), path, ["year", "month"])
    return S.read_result(spark, path)


@query("replace_partitions", sql(_PARTITIONED, "valid"))
def replace_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "detail")
    detail = _detail(spark, folder)
    S.write_parquet(detail, path, ["year", "month"])
    S.replace_partitions(detail.where(F.col("year") == 1997), path, ["year", "month"])
    return S.read_result(spark, path)


@query("write_csv", sql(f"SELECT {AGG} FROM aggregate", "aggregate"))
def write_csv(spark: SparkSession, folder: str) -> DataFrame:
    result = aggregate(spark, folder)
    path = S.write_csv(result, new_path(spark, "aggregate_csv"))
    return spark.read.schema(result.schema).option("header", True).option("escape", '"').csv(path)


@query("write_quarantine", sql(
    "SELECT invoice_id, product_id, reject_reason, '1' AS run_id FROM classified WHERE reject_reason IS NOT NULL", "classified"))
def write_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rejected = rejected_rows(Q.classified(spark, folder)).select("invoice_id", "product_id", "reject_reason")
    base = new_path(spark, "quarantine")
    S.write_quarantine(rejected, base, "1")
    read = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(base)
    return read.withColumn("run_id", F.col("run_id").cast("string"))


@query("write_report", sql(
    "SELECT 'r1' AS run_id, count(*) AS input_rows, count(reject_reason) AS rejected_rows FROM classified", "classified"))
def write_report(spark: SparkSession, folder: str) -> DataFrame:
    stats = quality_stats(Q.classified(spark, folder), Q.RULES).first().asDict()
    base = new_path(spark, "reports")
    S.write_report(spark, {"run_id": "r1", "validation": stats}, base, "r1")
    schema = "run_id string, validation struct<input_rows: bigint, rejected_rows: bigint>"
    return spark.read.schema(schema).json(f"{base}/report_latest").select(
        "run_id", "validation.input_rows", "validation.rejected_rows"
    )


@query("write_small_parquet", sql(MONTHLY, "valid"))
def write_small_parquet(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("sale_date", "product_id", "invoice_id", "description"))
    return S.read_result(spark, S.write_small_parquet(monthly_ranking(detail), new_path(spark, "ranking")))


def _database(spark: SparkSession, kind: str) -> tuple[str, str]:
    name = f"{kind}_{uuid.uuid4().hex}"
    return name, new_path(spark, name)


@query("replace_table", sql(
    "SELECT product_id, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue, CAST(sum(quantity) AS BIGINT) "
    "AS units_sold, 'reloaded' AS mode FROM valid GROUP BY product_id", "valid"))
def replace_table(spark: SparkSession, folder: str) -> DataFrame:
    """Load all lines, then replace them by the valid ones in the same table."""
    name, location = _database(spark, "raw")
    W.ensure_database(spark, name, location)
    W.replace_table(totals_by(all_lines(spark, folder, "product_id"), "product_id"), f"{name}.products")
    again = totals_by(star.valid_lines(spark, folder, ("product_id",)), "product_id")
    result = W.replace_table(again.select("units_sold", "product_id", "total_revenue"), f"{name}.products")
    return spark.table(f"{name}.products").withColumn("mode", F.lit(result.mode))


@query("load_results", sql(
    "SELECT 'products' AS table_name, count(DISTINCT product_id) AS table_rows FROM valid UNION ALL "
    "SELECT 'days', count(DISTINCT sale_date) FROM valid", "valid"))
def load_results(spark: SparkSession, folder: str) -> DataFrame:
    name, location = _database(spark, "raw")
    detail = star.valid_lines(spark, folder, ("product_id", "sale_date"))
    W.load_results(
        spark, {"products": totals_by(detail, "product_id"), "days": totals_by(detail, "sale_date")}, name, location
    )
    counts = [
        spark.table(f"{name}.{t}").agg(F.count("*").alias("table_rows")).select(F.lit(t).alias("table_name"), "table_rows")
        for t in ("products", "days")
    ]
    return counts[0].unionByName(counts[1])


@query("build_layers", sql(COUNTRY_SALES, "enriched"))
def build_layers(spark: SparkSession, folder: str) -> DataFrame:
    raw, raw_location = _database(spark, "raw")
    W.ensure_database(spark, raw, raw_location)
    W.replace_table(star.valid_lines(spark, folder), f"{raw}.detail")
    published, location = _database(spark, "published")
    W.build_layers(spark, f"{raw}.detail", published, location)
    return spark.table(f"{published}.country_sales")


@query("store_failures", sql(
    """SELECT 'no_customer' AS "check", count(*) AS violations, 'fail' AS status FROM valid WHERE customer_id IS NULL
    UNION ALL SELECT 'price', count(*), 'pass' FROM valid WHERE unit_price < 0""", "valid"))
def store_failures(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("invoice_id", "customer_id"))
    base = new_path(spark, "checks")
    checks = [
        C.Check("no_customer", frame=detail, predicate=F.col("customer_id").isNull()),
        C.Check("price", frame=detail, predicate=F.col("unit_price") < 0),
    ]
    results = C.run_checks(checks, base)
    kept = spark.read.parquet(f"{base}/no_customer").agg(F.count("*").alias("violations"))
    failed = kept.select(F.lit("no_customer").alias("check"), "violations", F.lit(results[0]["status"]).alias("status"))
    passed = detail.where(F.col("unit_price") < 0).agg(F.count("*").alias("violations")).select(
        F.lit("price").alias("check"), "violations", F.lit(results[1]["status"]).alias("status")
    )
    return failed.unionByName(passed)
