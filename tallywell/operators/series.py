"""Windows over long time series, split by time chunk.

A window partitioned by series alone would put the whole history of a busy
series in one task. Here each series is cut into chunks of time. What happened
before a chunk is carried in as one pre-aggregated row per chunk, so tasks hold
one chunk each, and only the short chunk table is windowed by series.

As in metric systems, a missing label equals an empty one, so series keys are
never null.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
CHUNK_MICROS = 60 * MICROS


def micros(ts: str) -> Column:
    """Integer microseconds of a timestamp without zone."""
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _labelled(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.fillna("", subset=list(by)) if by else df


def _chunked(df: DataFrame, by: Sequence[str], at: str, chunk_micros: int) -> DataFrame:
    return _labelled(df, by).withColumn("chunk", F.col(at) - F.pmod(F.col(at), F.lit(chunk_micros)))


def _carry(df: DataFrame, carried: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.join(carried, [*by, "chunk"])


def running_total(
    df: DataFrame, by: Sequence[str], at: str, values: dict[str, str], chunk_micros: int = CHUNK_MICROS
) -> DataFrame:
    """Running sums per series over ``at``; rows at the same instant share theirs.

    ``values`` maps each column to sum to the name of its running sum.
    """
    chunked = _chunked(df, by, at, chunk_micros)
    earlier = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = chunked.groupBy(*by, "chunk").agg(*[F.sum(v).alias(v) for v in values])
    carried = sums.select(
        *by, "chunk", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"carried_{v}") for v in values]
    )
    local = (
        Window.partitionBy(*by, "chunk").orderBy(at).rangeBetween(Window.unboundedPreceding, 0)
    )
    totals = {
        name: F.col(f"carried_{v}") + F.coalesce(F.sum(v).over(local), F.lit(0)) for v, name in values.items()
    }
    out = _carry(chunked, carried, by).withColumns(totals)
    return out.drop("chunk", *[f"carried_{v}" for v in values])


def trailing_sum(
    df: DataFrame,
    by: Sequence[str],
    enters: str,
    leaves: Column,
    values: dict[str, str],
    chunk_micros: int = CHUNK_MICROS,
) -> DataFrame:
    """Sums per series over the rows that have entered and not yet left.

    Each row counts from its ``enters`` instant up to and including ``leaves``.
    A row is added once on entering and subtracted once after leaving, so the
    sum needs a running total and no range join.
    """
    others = [c for c in df.columns if c not in (enters, *values)]
    step = [
        F.struct(F.col(enters).alias(enters), F.lit(True).alias("is_sample"), *values),
        F.struct(
            (leaves + 1).alias(enters), F.lit(False).alias("is_sample"), *[(-F.col(v)).alias(v) for v in values]
        ),
    ]
    changes = df.select(*others, F.inline(F.array(*step)))
    summed = running_total(changes, by, enters, values, chunk_micros)
    return summed.where("is_sample").drop("is_sample")


def with_previous(
    df: DataFrame, by: Sequence[str], at: str, tie: str, columns: Sequence[str], chunk_micros: int = CHUNK_MICROS
) -> DataFrame:
    """Add ``previous``, a struct of the columns of the sample before, per series."""
    chunked = _chunked(df, by, at, chunk_micros).withColumn("sample", F.struct(*columns))
    last = chunked.groupBy(*by, "chunk").agg(F.max_by("sample", F.struct(at, tie)).alias("last_sample"))
    carried = last.select(
        *by, "chunk", F.lag("last_sample").over(Window.partitionBy(*by).orderBy("chunk")).alias("carried")
    )
    local = F.lag("sample").over(Window.partitionBy(*by, "chunk").orderBy(at, tie))
    return (
        _carry(chunked, carried, by)
        .withColumn("previous", F.coalesce(local, F.col("carried")))
        .drop("chunk", "sample", "carried")
    )


def value_before(
    df: DataFrame, by: Sequence[str], at: str, tie: str, value: str, back_micros: int, name: str,
    chunk_micros: int = CHUNK_MICROS,
) -> DataFrame:
    """Add the last value of the series at or before ``at - back_micros``.

    Every sample also appears ``back_micros`` later as an old value, so the
    lookup is the last old value seen and needs no as-of join.
    """
    old_value = F.struct(F.col(value).alias("value"))
    nothing = F.lit(None).cast(df.select(old_value.alias("old")).schema["old"].dataType)
    now = df.withColumns({"is_sample": F.lit(1), "old": nothing})
    old = df.withColumns({at: F.col(at) + back_micros, "is_sample": F.lit(0), "old": old_value})
    both = _chunked(now.unionByName(old), by, at, chunk_micros)
    last = (
        both.groupBy(*by, "chunk")
        .agg(F.max_by("old", F.when(F.col("old").isNotNull(), F.struct(at, tie))).alias("last_old"))
    )
    earlier = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*by, "chunk", F.last("last_old", ignorenulls=True).over(earlier).alias("carried"))
    local = Window.partitionBy(*by, "chunk").orderBy(at, "is_sample", tie)
    seen = F.last("old", ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0))
    return (
        _carry(both, carried, by)
        .withColumn("found", F.coalesce(seen, F.col("carried")))
        .where(F.col("is_sample") == 1)
        .withColumn(name, F.col("found.value"))
        .drop("chunk", "is_sample", "old", "carried", "found")
    )


def with_next(
    df: DataFrame, by: Sequence[str], at: str, tie: str, columns: Sequence[str], chunk_micros: int = CHUNK_MICROS
) -> DataFrame:
    """Add ``next``, a struct of the columns of the sample after, per series."""
    turned = df.withColumns({"turned_at": -F.col(at), "turned_tie": -F.col(tie)})
    found = with_previous(turned, by, "turned_at", "turned_tie", columns, chunk_micros)
    return found.withColumnRenamed("previous", "next").drop("turned_at", "turned_tie")


def one_per_instant(df: DataFrame, by: Sequence[str], at: str, tie: str) -> DataFrame:
    """The last sample of each instant of a series; a missing label equals an empty one."""
    others = [c for c in df.columns if c not in (*by, at)]
    last = _labelled(df, by).groupBy(*by, at).agg(F.max_by(F.struct(*others), tie).alias("last"))
    return last.select(*by, at, "last.*")


def as_of(
    instants: DataFrame, samples: DataFrame, by: Sequence[str], at: str, columns: Sequence[str], name: str,
    ahead: bool = False, chunk_micros: int = CHUNK_MICROS,
) -> DataFrame:
    """Add to each instant a struct ``name`` of the last sample at or before it, or the first at or after it.

    ``samples`` has one row per instant of a series. Both are merged in order of time, so
    there is no join on a range. A null struct means that there is no such sample.
    """
    def placed(df: DataFrame, is_instant: bool) -> DataFrame:
        when = -F.col(at) if ahead else F.col(at)
        return _labelled(df, by).select(*by, when.alias("when"), F.lit(is_instant).alias("is_instant"), F.struct(*df.columns).alias("row"))

    held = placed(samples, False).withColumn("held", F.struct(*[F.col("row")[c].alias(c) for c in columns])).drop("row")
    asked = placed(instants, True)
    both = _chunked(held.unionByName(asked, allowMissingColumns=True), by, "when", chunk_micros)
    last = both.groupBy(*by, "chunk").agg(F.max_by("held", F.when(~F.col("is_instant"), F.col("when"))).alias("last_held"))
    earlier = Window.partitionBy(*by).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*by, "chunk", F.last("last_held", ignorenulls=True).over(earlier).alias("carried"))
    local = Window.partitionBy(*by, "chunk").orderBy("when", "is_instant").rowsBetween(Window.unboundedPreceding, 0)
    seen = _carry(both, carried, by).withColumn("held", F.coalesce(F.last("held", ignorenulls=True).over(local), "carried"))
    return seen.where("is_instant").select("row.*", F.col("held").alias(name))
