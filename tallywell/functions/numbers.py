"""Exact money, shares and means."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywell.schema import MONEY


def money(col: Column) -> Column:
    """PRJ15: an amount with two decimals."""
    return F.round(col, 2).cast(MONEY)


def ratio(numerator: Column, denominator: Column, digits: int, scale: int = 2) -> Column:
    """PRJ16/17: ``numerator / denominator``, null when the denominator is null
    or zero, rounded once. ``scale`` is the number of decimals of the operands."""
    return _quotient(numerator, denominator, digits, (20, scale), (20, scale))


def percent(part: Column, whole: Column, digits: int, scale: int = 2) -> Column:
    """Share of ``whole`` in per cent, rounded once."""
    return _quotient(part, whole, digits, (20, scale), (20, scale), 100)


def mean(total: Column, count: Column, digits: int, scale: int = 2) -> Column:
    """Mean from an exact sum and a count; ``avg`` on decimals rounds too early."""
    return _quotient(total, count, digits, (22, scale), (12, 0))


def _quotient(top: Column, bottom: Column, digits: int, of_top: tuple, of_bottom: tuple, times: int = 1) -> Column:
    """Decimal division. Operands beyond the usual precision are divided with eight
    digits more each, at the cost of later digits of the quotient (10 are left)."""

    def divide(top: Column, bottom: Column) -> Column:
        return F.round(F.try_divide(top, bottom) * times, digits).cast(f"decimal(22,{digits})")

    usual = [c.try_cast("decimal({},{})".format(*kind)) for c, kind in ((top, of_top), (bottom, of_bottom))]
    wide = [c.cast(f"decimal({kind[0] + 8},{kind[1]})") for c, kind in ((top, of_top), (bottom, of_bottom))]
    return F.when(usual[0].isNotNull() & usual[1].isNotNull(), divide(*usual)).otherwise(divide(*wide))
