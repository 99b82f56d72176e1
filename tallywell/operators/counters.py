"""Growth of counters over trailing windows, carried out to the borders of the window.

A window holds the samples after its start up to and including its end. Between its first
and last sample a counter grows by what its samples show, falls being restarts; to the
borders it is taken to grow at the same pace: all the way to a border that is nearer than
1.1 mean distances of samples, half a mean distance otherwise, and backwards never further
than to a value of zero.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell.operators import series as T
from tallywell.session import materialize

# Fixed value: mean distances between samples up to which growth reaches a border, in tenths.
BORDER_TENTHS = 11


def counted(samples: DataFrame, by: Sequence[str], chunk_micros: int = T.CHUNK_MICROS) -> DataFrame:
    """One row per instant with the number of samples and the growth of the counter so far."""
    timed = samples.select(*by, "ts", "sample_id", "value", T.micros("ts").alias("at"))
    paired = T.with_previous(T.one_per_instant(timed, by, "at", "sample_id"), by, "at", "sample_id", ["value"], chunk_micros)
    before = F.col("previous.value")
    growth = F.when(before.isNull(), 0).when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    grown = paired.withColumns({"growth": growth.cast("decimal(20,4)"), "one": F.lit(1)}).drop("previous")
    return T.running_total(materialize(grown, "growth"), by, "at", {"growth": "grown", "one": "number"}, chunk_micros)


def window_growth(instants: DataFrame, history: DataFrame, by: Sequence[str], window: int | Column, chunk_micros: int = T.CHUNK_MICROS) -> DataFrame:
    """Add ``samples``, ``growth`` and ``increase`` over the window that ends at each instant ``at``.

    ``history`` comes from ``counted``. Instants with fewer than two samples in their window are left out.
    """
    columns = ["at", "value", "grown", "number"]
    last = T.as_of(instants, history, by, "at", columns, "last", chunk_micros=chunk_micros)
    start = last.withColumns({"ends": F.col("at"), "at": F.col("at") - window + 1})
    both = T.as_of(start, history, by, "at", columns, "first", ahead=True, chunk_micros=chunk_micros)
    both = both.withColumns({"at": F.col("ends"), "samples": F.col("last.number") - F.col("first.number") + 1}).drop("ends")
    both = both.where("samples >= 2")
    growth = F.col("last.grown") - F.col("first.grown")
    found = both.withColumns({"growth": growth.cast("decimal(28,4)"), "increase": _extrapolated(growth, window)})
    return found.drop("first", "last")


def _extrapolated(growth: Column, window: int | Column) -> Column:
    sampled = F.col("last.at") - F.col("first.at")
    steps = F.col("samples") - 1
    grown = growth.cast("double")

    def reach(distance: Column) -> Column:
        far = 10 * distance * steps >= BORDER_TENTHS * sampled
        return F.when(far, sampled / (2.0 * steps)).otherwise(distance.cast("double"))

    to_zero = F.when((grown > 0) & (F.col("first.value") >= 0), sampled * F.col("first.value").cast("double") / grown)
    to_start = F.least(reach(F.col("first.at") - (F.col("at") - window)), to_zero)
    to_end = reach(F.col("at") - F.col("last.at"))
    return grown * ((sampled + to_start + to_end) / sampled)


def _rounded(value: Column, digits: int) -> Column:
    """Half up, in whole numbers of the last digit."""
    unit = F.lit("1e-%d" % digits).cast(f"decimal({digits + 1},{digits})")
    return (F.floor(value * 10**digits + 0.5).cast("decimal(22,0)") * unit).cast(f"decimal(28,{digits})")


def extrapolated_increase(samples: DataFrame, by: Sequence[str], window: int, chunk_micros: int = T.CHUNK_MICROS) -> DataFrame:
    """MN8: growth over the window that ends at each sample, carried to its borders.

    Samples without another in their window have none and are left out.
    """
    history = materialize(counted(samples, by, chunk_micros), "counted")
    found = window_growth(history.select(*by, "at", "ts", "sample_id"), history, by, window, chunk_micros)
    return found.select(*by, "ts", "sample_id", _rounded(F.col("increase"), 4).alias("increase"))


def extrapolated_rate(samples: DataFrame, by: Sequence[str], window: int, chunk_micros: int = T.CHUNK_MICROS) -> DataFrame:
    """MN8: the same growth per second."""
    history = materialize(counted(samples, by, chunk_micros), "counted")
    found = window_growth(history.select(*by, "at", "ts", "sample_id"), history, by, window, chunk_micros)
    per_second = F.col("increase") / float(window // T.MICROS)
    return found.select(*by, "ts", "sample_id", _rounded(per_second, 6).alias("rate"))
