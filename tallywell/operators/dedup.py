"""Exact duplicates, safe for a group of copies of any size."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: str, flag: str = "is_duplicate", among: Column | None = None
) -> DataFrame:
    """Mark every copy of a row but the first; null keys are equal.

    ``order_by`` is a column that orders the rows of one key (it may be a struct). With
    ``among``, a predicate that copies share, no other rows are counted or marked.

    The keys are counted with their first copy, combined before the shuffle, so that a
    key which a third of all rows have is one row per task. Only repeated keys stay, and
    every row is compared with the first copy of its key. How the two meet is left to
    the optimizer: the rows of a hot key are on the side that adaptive execution may
    split, while its single first copy is repeated for each part.
    """
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    counted = df if among is None else df.where(among)
    firsts = (
        counted.groupBy(*[F.col(k).alias(n) for k, n in named.items()])
        .agg(F.count("*").alias("_copies"), F.min(order_by).alias("_first"))
        .where(F.col("_copies") > 1)
        .drop("_copies")
    )
    same_key = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()])
    later_copy = F.coalesce(F.col(order_by) > F.col("_first"), F.lit(False))
    return df.join(firsts, same_key, "left").withColumn(flag, later_copy).select(*df.columns, flag)
