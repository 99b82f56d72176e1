"""Data tests: each returns the rows that break a rule, none when all is well."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.operators.trends import series_gaps
from tallywell.session import materialize


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """CK1: rows without a value."""
    return df.where(F.col(column).isNull())


def check_unique(df: DataFrame, *columns: str) -> DataFrame:
    """CK2/SK12: keys that occur more than once; null keys are left out."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return (
        df.where(known)
        .groupBy(*columns)
        .agg(F.count("*").alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def check_accepted_values(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """CK3: values outside the accepted list, with their number of rows."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count("*").alias("occurrences"))
    )


def check_freshness(
    df: DataFrame, as_of: datetime, date: str = "sale_date", warn_hours: int = 26, error_hours: int = 72
) -> DataFrame:
    """CK4: age of the latest date in whole hours and its status, one row.

    The status compares seconds, so a part of an hour over a limit counts.
    """
    latest = df.agg(F.max(date).alias("latest"))
    ends = F.col("latest").cast("timestamp_ntz"), F.lit(as_of).cast("timestamp_ntz")
    seconds = F.timestamp_diff("SECOND", *ends)
    return latest.withColumn("age_hours", F.timestamp_diff("HOUR", *ends)).withColumn(
        "status",
        F.when(F.col("latest").isNull() | (seconds > 3600 * error_hours), "error")
        .when(seconds > 3600 * warn_hours, "warn")
        .otherwise("pass"),
    )


def reconcile_totals(
    detail: DataFrame, aggregate: DataFrame, detail_amount: str = "line_revenue", aggregate_amount: str = "total_revenue"
) -> DataFrame:
    """JN4/MN3: the two totals and their difference, one row.

    The second total is a scalar subquery, so no join is needed.
    """
    other = aggregate.agg(F.sum(aggregate_amount).cast(S.TOTAL)).scalar()
    return (
        detail.agg(F.sum(detail_amount).cast(S.TOTAL).alias("detail_total"))
        .withColumn("aggregate_total", other)
        .withColumn("difference", F.abs(F.col("detail_total") - F.col("aggregate_total")))
    )


def over_tolerance(df: DataFrame, tolerance: str = S.AMOUNT_TOLERANCE) -> DataFrame:
    """FLT5: rows whose difference is not explained by rounding."""
    return df.where(F.col("difference") > F.lit(tolerance).cast(S.MONEY))


def totals_agree(detail: DataFrame, aggregate: DataFrame, tolerance: str = S.AMOUNT_TOLERANCE) -> DataFrame:
    """CK5: adding up must neither create nor lose money."""
    return over_tolerance(reconcile_totals(detail, aggregate), tolerance)


def reconcile_by_key(detail: DataFrame, summary: DataFrame, key: str = "sale_date") -> DataFrame:
    """JN3: totals per key on both sides, keys of either side kept."""
    left = detail.groupBy(key).agg(F.sum("line_revenue").cast(S.TOTAL).alias("detail_amount"))
    right = summary.select(key, F.col("total_revenue").cast(S.TOTAL).alias("summary_amount"))
    zero = F.lit(0).cast(S.TOTAL)
    gap = F.coalesce("detail_amount", zero) - F.coalesce("summary_amount", zero)
    return left.join(right, key, "full_outer").withColumn("difference", F.abs(gap))


def daily_totals_agree(detail: DataFrame, summary: DataFrame, tolerance: str = S.AMOUNT_TOLERANCE) -> DataFrame:
    """CK6: the daily table agrees with the detail on every day."""
    return over_tolerance(reconcile_by_key(detail, summary), tolerance)


def negative_measures(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """CK7/SO1: negative revenue or units in any of the tables.

    ``tables`` maps a label to a frame and the name of its key column.
    """
    tagged = [
        df.where((F.col("total_revenue") < 0) | (F.col("units_sold") < 0)).select(
            F.lit(label).alias("model"),
            F.col(key).cast("string").alias("key"),
            F.col("total_revenue").cast(S.TOTAL).alias("total_revenue"),
            "units_sold",
        )
        for label, (df, key) in tables.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


# Reasons of an incoherent ranking.
SHARE_OUT_OF_RANGE = "participacion individual fuera de rango"
CUMULATIVE_OUT_OF_RANGE = "participacion acumulada fuera de rango"
CUMULATIVE_FALLS = "la participacion acumulada decrece"


def ranking_is_coherent(ranking: DataFrame) -> DataFrame:
    """CK8/WN14: shares within range and a cumulative share that never falls.

    The window runs over the rows of a ranking, whose size is its top n.
    """
    share, cumulative = F.col("share_pct"), F.col("cumulative_share_pct")
    before = F.col("previous_cumulative")
    reason = (
        F.when((share < 0) | (share > 100), SHARE_OUT_OF_RANGE)
        .when((cumulative < 0) | (cumulative > F.lit("100.01").cast("decimal(10,2)")), CUMULATIVE_OUT_OF_RANGE)
        .when(before.isNotNull() & (cumulative < before), CUMULATIVE_FALLS)
    )
    return (
        ranking.withColumn(
            "previous_cumulative", F.lag("cumulative_share_pct").over(Window.orderBy("position"))
        )
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("position", "product_id", "share_pct", "cumulative_share_pct", "previous_cumulative", "reason")
    )


def no_long_gaps(daily: DataFrame, longest: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """CK9: spans without sales that suggest a missing file; a warning only."""
    return series_gaps(daily, longest, by)


@dataclass(frozen=True)
class Check:
    """A named data test and what its failure means.

    A row-local test gives its frame and predicate instead of a query, so that
    all such tests of one frame share a single pass.
    """

    name: str
    violations: Callable[[], DataFrame] | None = None
    severity: str = "error"
    frame: DataFrame | None = None
    predicate: Column | None = None


def _count_row_tests(checks: Sequence[Check]) -> dict[str, int]:
    by_frame: dict[int, list[Check]] = {}
    for check in checks:
        if check.frame is not None:
            by_frame.setdefault(id(check.frame), []).append(check)
    counts: dict[str, int] = {}
    for group in by_frame.values():
        counters = [F.count_if(c.predicate).alias(c.name) for c in group]
        counts |= group[0].frame.agg(*counters).first().asDict()
    return counts


def run_checks(checks: Sequence[Check], path: str | None = None) -> list[dict]:
    """Run every test and keep the violating rows under ``path/<name>`` (SK11)."""
    counts = _count_row_tests(checks)
    results = []
    for check in checks:
        rows = counts.get(check.name)
        if rows != 0:
            found = check.violations() if check.violations else check.frame.where(check.predicate)
            if path is None:
                kept = materialize(found, check.name)
            else:
                found.write.mode("overwrite").parquet(f"{path}/{check.name}")
                kept = found.sparkSession.read.schema(found.schema).parquet(f"{path}/{check.name}")
            rows = kept.count()
        status = "pass" if rows == 0 else ("warn" if check.severity == "warn" else "fail")
        results.append({"check": check.name, "violations": rows, "status": status})
    return results


# The columns of the published tables that must not repeat.
UNIQUE_KEYS = {
    "daily_summary": (("sale_date",),),
    "product_ranking": (("position",), ("product_id",)),
    "country_sales": (("country",),),
    "product_date_revenue": (("sale_date", "product_id"),),
}


# The columns of the loaded tables that must not be null, and the keys.
SOURCE_NOT_NULL = {
    "sales_detail": ("product_id", "quantity", "sale_date", "unit_price", "line_revenue"),
    "product_date_revenue": ("sale_date", "product_id", "total_revenue"),
    "daily_summary": ("sale_date",),
}
SOURCE_UNIQUE = {"daily_summary": (("sale_date",),)}


def source_checks(sources: dict[str, DataFrame], as_of: datetime) -> list[Check]:
    """The data tests of the loaded tables that are there, and the freshness of the detail.

    Stale detail is a warning from 26 hours on and an error from 72.
    """
    checks = [
        Check(f"source_not_null_{t}_{c}", frame=sources[t], predicate=F.col(c).isNull())
        for t, columns in SOURCE_NOT_NULL.items()
        if t in sources
        for c in columns
    ]
    checks += [
        Check(f"source_unique_{t}_{'_'.join(k)}", lambda t=t, k=k: check_unique(sources[t], *k))
        for t, key_sets in SOURCE_UNIQUE.items()
        if t in sources
        for k in key_sets
    ]
    if "sales_detail" in sources:
        fresh = check_freshness(sources["sales_detail"], as_of)
        checks.append(Check("source_freshness_error", lambda: fresh.where("status = 'error'")))
        checks.append(Check("source_freshness_warn", lambda: fresh.where("status = 'warn'"), severity="warn"))
    return checks


def published_checks(enriched: DataFrame, published: dict[str, DataFrame]) -> list[Check]:
    """The data tests of the warehouse over its layers."""
    not_null = {
        "enriched": ("product_id", "sale_date", "quantity", "line_revenue", "year", "year_month"),
        "product_date_revenue": (
            "sale_date", "product_id", "total_revenue", "units_sold", "distinct_invoices", "invoice_lines",
        ),
        "daily_summary": ("sale_date", "total_revenue", "distinct_invoices"),
        "product_ranking": ("position", "product_id", "share_pct", "cumulative_share_pct"),
        "country_sales": ("country", "total_revenue"),
    }
    accepted = {
        ("enriched", "amount_segment"): S.AMOUNT_SEGMENTS,
        ("enriched", "volume_segment"): S.VOLUME_SEGMENTS,
        ("enriched", "hour_band"): S.HOUR_BANDS,
        ("country_sales", "market_type"): S.MARKET_TYPES,
    }
    frames = {"enriched": enriched, **published}
    checks = [
        Check(f"not_null_{t}_{c}", frame=frames[t], predicate=F.col(c).isNull())
        for t, columns in not_null.items()
        for c in columns
    ]
    checks += [
        Check(f"unique_{t}_{'_'.join(k)}", lambda t=t, k=k: check_unique(frames[t], *k))
        for t, key_sets in UNIQUE_KEYS.items()
        for k in key_sets
    ]
    checks += [
        Check(f"accepted_{t}_{c}", frame=frames[t], predicate=~F.col(c).isin(*v))
        for (t, c), v in accepted.items()
    ]
    by_product, by_day = published["product_date_revenue"], published["daily_summary"]
    ranking = published["product_ranking"]
    measured = {
        "product_date_revenue": (by_product, "product_id"),
        "daily_summary": (by_day, "sale_date"),
        "product_ranking": (ranking, "product_id"),
    }
    return [
        *checks,
        Check("totals_agree", lambda: totals_agree(enriched, by_product)),
        Check("daily_totals_agree", lambda: daily_totals_agree(enriched, by_day)),
        Check("negative_measures", lambda: negative_measures(measured)),
        Check("ranking_is_coherent", lambda: ranking_is_coherent(ranking)),
        Check("no_long_gaps", lambda: no_long_gaps(by_day), severity="warn"),
    ]
