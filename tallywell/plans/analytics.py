"""The distributed analyses over the written detail, and the warehouse build."""

from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywell.operators.checks import SOURCE_NOT_NULL, published_checks, run_checks, source_checks
from tallywell.operators.countries import country_concentration
from tallywell.operators.rankings import monthly_ranking
from tallywell.operators.trends import daily_trend
from tallywell.schema import MONTHLY_RANKING_SIZE
from tallywell.sinks.files import write_small_parquet
from tallywell.sinks.warehouse import build_layers, enriched_view
from tallywell.sources.files import read_detail


def month_count(ranking: DataFrame) -> DataFrame:
    """SO4: how many months a ranking covers."""
    return ranking.select("year_month").distinct().agg(F.count("*").alias("months"))


def run_analyses(
    spark: SparkSession, detail_path: str, destination: str, n: int = MONTHLY_RANKING_SIZE, days: int = 7
) -> dict[str, int]:
    """Write the monthly ranking, the daily trend and the country concentration.

    Each reads only its own columns of the detail, so nothing is cached; row
    counts are observed while writing and not computed again.
    """
    detail = read_detail(spark, detail_path)
    results = {
        "monthly_ranking": (monthly_ranking(detail, n, ordered=False), ["year_month", "position"]),
        "daily_trend": (daily_trend(detail, days), ["sale_date"]),
        "country_concentration": (country_concentration(detail), [F.desc("total_revenue"), "country"]),
    }
    rows = {}
    for name, (result, order) in results.items():
        seen = Observation()
        counted = result.observe(seen, F.count(F.lit(1)).alias("result_rows"))
        write_small_parquet(counted, f"{destination}/{name}", *order)
        rows[name] = seen.get["result_rows"]
    return rows


def build_warehouse(
    spark: SparkSession, source_table: str, database: str = "published", location: str | None = None,
    failures_path: str | None = None, as_of: datetime | None = None,
) -> tuple[dict, list[dict]]:
    """Build the published tables, then run every data test over them and over the loaded tables.

    The loaded tables are the detail and those of its database with the names of the daily
    run's results; ``as_of`` is the time that freshness is measured at, now by default.
    """
    loaded = build_layers(spark, source_table, database, location)
    published = {name: spark.table(f"{database}.{name}") for name in loaded}
    raw = source_table.rpartition(".")[0]
    names = {"sales_detail": source_table} | {n: f"{raw}.{n}" if raw else n for n in SOURCE_NOT_NULL if n != "sales_detail"}
    sources = {n: spark.table(t) for n, t in names.items() if spark.catalog.tableExists(t)}
    now = as_of or datetime.now(UTC).replace(tzinfo=None)
    checks = [*source_checks(sources, now), *published_checks(spark.table(enriched_view(database)), published)]
    return loaded, run_checks(checks, failures_path)
