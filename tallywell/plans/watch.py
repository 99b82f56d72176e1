"""The watch over the warehouse: coverage, volumes and coherence of what is published."""

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from tallywell.errors import QualityError
from tallywell.operators import monitoring as M


def watch_warehouse(
    spark: SparkSession, raw: DataFrame, published: dict[str, DataFrame], metrics_path: str, daily: str = "daily_summary", totals: str = "product_date_revenue"
) -> dict:
    """MN1-MN4: run the three checks, append their figures, then raise if one failed.

    The rows are written even if a check fails or breaks off; the mark of a completed watch
    is 1 only when every table has rows and the totals could be compared.
    """
    problems: list[str] = []
    found: dict = {}

    def attempt(name, check):
        try:
            found[name] = check()
        except Exception as error:
            problems.append(f"{name}: {error}")

    attempt("coverage", lambda: M.published_coverage(published[daily]).first())
    attempt("volumes", lambda: M.table_volumes(published).collect())
    attempt("coherence", lambda: M.layer_coherence(raw, published[totals]).first())

    if "coverage" in found and not found["coverage"]["ok"]:
        problems.append("no day is published")
    empty = sorted(r["table_name"] for r in found.get("volumes", ()) if not r["ok"])
    if empty:
        problems.append(f"tables without rows: {empty}")
    if "coherence" in found and not found["coherence"]["ok"]:
        problems.append(f"raw and published totals differ by {found['coherence']['difference']}")

    volumes = {r["table_name"]: r["table_rows"] for r in found.get("volumes", ())}
    days = found["coverage"]["days"] if "coverage" in found else None
    difference = found["coherence"]["difference"] if "coherence" in found else None
    rows = M.watch_metrics(volumes if not empty else None, days, None if difference is None else float(difference))
    now = datetime.now(UTC)
    M.append_metrics(spark, rows, metrics_path, now.strftime("%Y%m%d-%H%M%S"), now)
    if problems:
        raise QualityError("the watch over the warehouse found problems: " + "; ".join(problems))
    return {"volumes": volumes, "days": days, "difference": difference}
