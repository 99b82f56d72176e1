"""Positions and running sums over a whole ordered table, without one task for all of it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywell.session import materialize


def in_ranges(df: DataFrame, order: Sequence[Column], sums: dict[str, str], position: str | None = None) -> DataFrame:
    """Add the running sum of each column of ``sums`` under its name, and the ``position``, in a total order.

    Rows are dealt out by ranges of the order and written; a task adds up its range, and
    the sums of the ranges before, one row each, are added to it.
    """
    ranges = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    kinds = df.select(*[F.sum(c).alias(name) for c, name in sums.items()]).schema if sums else {}
    totals = [F.sum(c).alias(f"_{name}") for c, name in sums.items()] + [F.count("*").alias("_rows")]
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = ranges.groupBy("_range").agg(*totals)
    before = by_range.select("_range", *[F.sum(c).over(earlier).alias(c) for c in by_range.columns if c != "_range"])
    inside = Window.partitionBy("_range").orderBy(*order)
    here = inside.rowsBetween(Window.unboundedPreceding, 0)
    found = {}
    for c, name in sums.items():
        own, ahead = F.sum(c).over(here), F.col(f"_{name}")
        found[name] = F.coalesce(own + ahead, own, ahead).cast(kinds[name].dataType)
    if position:
        found[position] = (F.row_number().over(inside) + F.coalesce("_rows", F.lit(0))).cast("int")
    return ranges.join(before, "_range").withColumns(found).select(*df.columns, *found)
