"""The daily job: read, check, transform, verify, publish, report."""

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywell import __version__
from tallywell.errors import IngestError, QualityError
from tallywell.functions.calendar import add_calendar
from tallywell.operators import monitoring as M
from tallywell.operators import quality as Q
from tallywell.operators.profile import preview_rows, profile_input
from tallywell.operators.rankings import product_ranking
from tallywell.operators.revenue import add_line_revenue, business_kpis, daily_summary, revenue_by_product_date
from tallywell.schema import REPORT_RANKING_SIZE
from tallywell.session import materialize, new_path, remove_path
from tallywell.sinks import files as out
from tallywell.sinks.warehouse import load_results
from tallywell.sources.files import input_format, read_sales

EXIT_OK, EXIT_DATA_PROBLEM, EXIT_UNEXPECTED = 0, 1, 2

log = logging.getLogger(__name__)


@dataclass
class _Stages:
    """Rows and seconds of each stage of a run."""

    figures: dict[str, tuple[int | None, float | None]] = field(default_factory=dict)

    @contextmanager
    def timed(self, name: str) -> Iterator[None]:
        start = time.monotonic()
        try:
            yield
        finally:
            self.figures[name] = (self.figures.get(name, (None, None))[0], time.monotonic() - start)

    def rows(self, name: str, count: int) -> None:
        self.figures[name] = (count, self.figures.get(name, (None, None))[1])


def classify(typed: DataFrame, limits: Q.Limits, order_by: str, folder: str) -> tuple[DataFrame, dict]:
    """Write the lines with their reason once into a folder, counting every rule on the way."""
    rules = Q.build_rules(limits, order_by)
    observed = Observation()
    marked = Q.apply_rules(typed, rules).drop(order_by)
    marked = marked.withColumn("is_rejected", F.col("reject_reason").isNotNull())
    path = f"{folder}/classified"
    marked.observe(observed, *Q.count_columns(rules)).write.partitionBy("is_rejected").parquet(path)
    stats = dict(observed.get)
    total = stats["input_rows"]
    stats["reject_pct"] = round(stats["rejected_rows"] / total * 100, 4) if total else 0.0
    return typed.sparkSession.read.schema(marked.schema).parquet(path), stats


def run(
    spark: SparkSession,
    source: str,
    destination: str,
    limits: Q.Limits = Q.Limits(),
    max_rows: int | None = None,
    load_warehouse: bool = False,
    raw_database: str = "raw",
    database_location: str | None = None,
    file_format: str | None = None,
    run_id: str | None = None,
) -> dict:
    """Process one input and return the run report.

    Text is parsed once; Parquet is read in place, by column. Rejected
    rows are kept as evidence before the gate decides. Nothing reaches the
    destination of the results before the aggregate has been verified. Jobs that
    do not depend on each other are submitted together. The steps written on the
    way are deleted at the end, however the run ends.
    """
    run_id = run_id or datetime.now(UTC).strftime("%Y%m%d-%H%M%S")
    folder = new_path(spark, "daily_run")
    try:
        with ThreadPoolExecutor() as jobs:
            return _run(
                spark, jobs, folder, source, destination, limits, max_rows, file_format, run_id,
                (raw_database, database_location) if load_warehouse else None,
            )
    finally:
        remove_path(spark, folder)


def _run(
    spark: SparkSession,
    jobs: ThreadPoolExecutor,
    folder: str,
    source: str,
    destination: str,
    limits: Q.Limits,
    max_rows: int | None,
    file_format: str | None,
    run_id: str,
    warehouse: tuple[str, str | None] | None,
) -> dict:
    """The stages of a run. Leaving the pool of jobs waits for those submitted,
    so the quarantine is complete even when the gate stops the run."""
    stages = _Stages()
    rules = Q.build_rules(limits, "ordinal")
    report: dict = {
        "run_id": run_id,
        "version": __version__,
        "input": source,
        "started": datetime.now(UTC).isoformat(),
        "quarantine": None,
        "loaded": {},
    }

    with stages.timed("ingesta"):
        typed = read_sales(spark, source, file_format, max_rows, with_ordinal=True)
        if input_format(source, file_format) == "csv" or max_rows is not None:
            typed = materialize(typed, "typed", folder)

    with stages.timed("validacion"):
        profile = jobs.submit(lambda: profile_input(typed.drop("ordinal")).first().asDict())
        classified, stats = classify(typed, limits, "ordinal", folder)
        report["validation"] = stats
        quarantine = None
        if stats["rejected_rows"]:
            rejected = classified.where("is_rejected").drop("is_rejected")
            quarantine = jobs.submit(out.write_csv, rejected, f"{destination}/quarantine/run_id={run_id}")
    stages.rows("ingesta", stats["input_rows"])
    stages.rows("validacion", stats["valid_rows"])
    Q.quality_gate(stats, rules, limits.max_reject_pct)

    valid = classified.where(~F.col("is_rejected")).drop("is_rejected", "reject_reason")
    detail = valid.transform(add_line_revenue).transform(add_calendar)
    with stages.timed("transformacion"):
        aggregate = materialize(revenue_by_product_date(detail, ordered=False), "aggregate", folder)
        summary = daily_summary(aggregate)
        ranking = product_ranking(aggregate, REPORT_RANKING_SIZE)
    stages.rows("transformacion", stats["valid_rows"])

    with stages.timed("verificacion_salida"):
        verified = Q.verify_aggregate(aggregate)
        report["verification"] = verified
    stages.rows("agregacion", verified["aggregate_rows"])

    in_order = aggregate.orderBy("sale_date", F.desc("total_revenue"), "product_id")
    writes = {
        "sales_detail": lambda path: out.write_parquet(detail, path, ["year", "month"]),
        "product_date_revenue": lambda path: out.write_parquet(in_order, path),
        "product_date_revenue_csv": lambda path: out.write_csv(in_order, path),
        "daily_summary": lambda path: out.write_small_parquet(summary, path, "sale_date"),
        "product_ranking_csv": lambda path: out.write_csv(ranking, path),
    }
    with stages.timed("persistencia"):
        written = {name: jobs.submit(write, f"{destination}/{name}") for name, write in writes.items()}
        figures = jobs.submit(lambda: business_kpis(aggregate).first().asDict())
        first_rows = jobs.submit(lambda: preview_rows(in_order, 10).collect())
        report["outputs"] = {name: job.result() for name, job in written.items()}

    if warehouse:
        with stages.timed("carga_almacen"):
            tables = {"sales_detail": detail, "product_date_revenue": aggregate, "daily_summary": summary}
            loaded = load_results(spark, tables, *warehouse)
            report["loaded"] = {name: result.rows for name, result in loaded.items()}

    report["ingest"] = profile.result()
    report["kpis"] = kpis = figures.result()
    report["preview"] = [r.asDict() for r in first_rows.result()]
    if quarantine:
        report["quarantine"] = quarantine.result()
    finished = datetime.now(UTC)
    report["finished"] = finished.isoformat()
    metrics = M.run_metrics(stats, [r.name for r in rules], stages.figures, kpis, True, finished)
    M.append_metrics(spark, metrics, f"{destination}/run_metrics", run_id, finished)
    report["report"] = out.write_report(spark, report, f"{destination}/reports", run_id)
    return report


def run_summary(report: dict) -> dict:
    """SK5: the eight figures handed to the scheduler."""
    validation, kpis = report["validation"], report["kpis"]
    return {
        "run_id": report["run_id"],
        "input_rows": validation["input_rows"],
        "valid_rows": validation["valid_rows"],
        "reject_pct": validation["reject_pct"],
        "total_revenue": kpis["total_revenue"],
        "distinct_products": kpis["distinct_products"],
        "days_covered": kpis["days_covered"],
        "loaded": report["loaded"],
    }


def exit_code(spark: SparkSession, source: str, destination: str, **options) -> int:
    """Run and report as a process does: 0, 1 for a data problem, 2 otherwise.

    A failed run still leaves its success metric at zero.
    """
    try:
        run(spark, source, destination, **options)
        return EXIT_OK
    except (IngestError, QualityError) as error:
        log.error("the run over %s stopped: %s", source, error)
        code = EXIT_DATA_PROBLEM
    except Exception:
        log.exception("the run over %s failed", source)
        code = EXIT_UNEXPECTED
    now = datetime.now(UTC)
    failed = [M.metric_row(M.M_SUCCESS, 0)]
    M.append_metrics(spark, failed, f"{destination}/run_metrics", now.strftime("%Y%m%d-%H%M%S"), now)
    return code
