"""File sinks. Every write replaces its destination, so a run can be repeated."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.errors import PersistError
from tallywell.session import materialize, new_path, remove_path


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """SK1/SK2: zstd Parquet in hive partitions, destination replaced.

    With partitions the rows are first gathered by partition and spread within
    it, so a month of any size goes to many tasks and leaves few files.
    """
    out = df
    if partition_by:
        out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = out.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    try:
        writer.parquet(path)
    except Exception as error:
        raise PersistError(f"could not write Parquet to {path}: {error}") from error
    return path


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> str:
    """SK2: replace only the partitions that occur in ``df``."""
    (
        df.write.mode("overwrite")
        .option("compression", "zstd")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """SK3: UTF-8 CSV with header, blanks kept; a folder of part files."""
    options = {
        "header": True,
        "encoding": "UTF-8",
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    try:
        df.write.mode("overwrite").options(**options).csv(path)
    except Exception as error:
        raise PersistError(f"could not write CSV to {path}: {error}") from error
    return path


def write_quarantine(rejected: DataFrame, folder: str, run_id: str) -> str | None:
    """SK4: rejected rows as CSV of their run, nothing when there are none.

    The rows are written to the shared folder first, so that looking whether there are any
    does not classify all lines a second time.
    """
    spark = rejected.sparkSession
    step = new_path(spark, "quarantine_step")
    try:
        rows = materialize(rejected, "rejected", step)
        return None if rows.isEmpty() else write_csv(rows, f"{folder}/run_id={run_id}")
    finally:
        remove_path(spark, step)


def write_report(spark: SparkSession, report: dict, folder: str, run_id: str) -> str:
    """SK5: the run report as one JSON line, by run and as the latest."""
    import json

    line = json.dumps(report, ensure_ascii=False, default=str)
    frame = spark.createDataFrame([(line,)], "value string").coalesce(1)
    for name in (f"report_{run_id}", "report_latest"):
        frame.write.mode("overwrite").text(f"{folder}/{name}")
    return f"{folder}/report_{run_id}"


def write_small_parquet(df: DataFrame, path: str, *order_by: str | Column) -> str:
    """SK6: a small result (a ranking, a daily series) as one ordered file.

    The rows are gathered after the aggregation, which keeps all its tasks.
    """
    one = df.repartition(1)
    if order_by:
        one = one.sortWithinPartitions(*order_by)
    one.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def read_result(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: a written result, or an error that says it is not there."""
    try:
        return spark.read.parquet(path)
    except Exception as error:
        raise PersistError(f"no result can be read at {path}: {error}") from error
