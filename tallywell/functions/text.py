"""Text cleaning and permissive parsing of source values."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as blank at the ends of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHOLE = r"^([+-]?[0-9]+)(\.0*)?$"
# Date layouts tried in turn after the ISO one; month first wins when both fit.
_DATE_REWRITES = (
    (r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})", "$3-$1-$2"),
    (r"^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4})", "$3-$2-$1"),
    (r"^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})", "$1-$2-$3"),
    (r"^([0-9]{4})([0-9]{2})([0-9]{2})(?=$|[ T])", "$1-$2-$3"),
)
# Two-digit years: 69 to 99 are of the last century.
_SHORT_YEAR = r"^([0-9]{1,2}[/.-][0-9]{1,2}[/.-])([0-9]{2})(?![0-9])"
_MONTHS = "january february march april may june july august september october november december".split()
_MONTH_FIRST = r"^([A-Za-z]{3,9})\.? +([0-9]{1,2}),? +([0-9]{2}.*)$"
_DAY_FIRST = r"^([0-9]{1,2})[ -]([A-Za-z]{3,9})\.?,?[ -]([0-9]{2}.*)$"
_TWELVE_HOURS = r"(?i)^(.*[ T])([0-9]{1,2})(:[0-9]{2}(?::[0-9.]+)?) *([ap])\.?m\.?$"
# Numbers that are no date by themselves, signed or long years, and times without a day.
_NO_DATE = r"^([+-].*|[0-9]{1,7}|[0-9]{9,}|[0-9]{5,}[/. -].*|T?[0-9]{1,2}:.*)$"
_OFFSET = r":[0-9.]+ *(?:Z|[+-][0-9]{2}:?[0-9]{2})$"


def strip(col: Column) -> Column:
    """Remove blanks of any kind from both ends.

    Spark looks at every character to trim the right end, so it only does where one of the
    last three bytes may be of a blank; no blank has more.
    """
    left = F.ltrim(col.cast("string"), F.lit(BLANKS))
    end = F.substring(left.cast("binary"), -3, 3).cast("string")
    return F.when(F.rtrim(end, F.lit(BLANKS)) != end, F.rtrim(left, F.lit(BLANKS))).otherwise(left)


def clean_code(col: Column) -> Column:
    """Text as an identifier: stripped, upper case."""
    return F.upper(strip(col))


def _number_text(col: Column) -> Column:
    text = strip(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text)


def parse_whole_number(col: Column, type_name: str) -> Column:
    """A whole number or null; ``17850.0`` is whole, ``2.5`` and ``two`` are not.

    Casts are tried only on text of the right form: one that fails costs an
    exception per row.
    """
    text = strip(col.cast("string"))
    digits = F.regexp_extract(text, _WHOLE, 1)
    scientific = F.when(text.rlike(_NUMBER), text).try_cast("double")
    return F.when(digits != "", digits.try_cast(type_name)).when(
        scientific == F.floor(scientific), scientific.try_cast(type_name)
    )


def parse_decimal(col: Column, type_name: str) -> Column:
    """A decimal or null, never NaN or infinity."""
    return _number_text(col).try_cast(type_name)


def _month_number(name: Column) -> Column:
    """Number of an English month, whole or as its first three letters (or "sept"); null for other names."""
    names = {short: str(n) for n, month in enumerate(_MONTHS, 1) for short in (month, month[:3])} | {"sept": "9"}
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), F.lower(name))


def _usual_form(text: Column) -> Column:
    """Month names as numbers, years with four digits and hours up to 23; other text as it is."""
    first = [F.regexp_extract(text, _MONTH_FIRST, k) for k in (1, 2, 3)]
    second = [F.regexp_extract(text, _DAY_FIRST, k) for k in (2, 1, 3)]
    spelled = [F.concat(_month_number(name), F.lit("/"), day, F.lit("/"), rest) for name, day, rest in (first, second)]
    named = F.coalesce(*spelled, text)
    return bind(named, _long_year_and_clock)


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _long_year_and_clock(named: Column) -> Column:
    century = F.when(F.regexp_extract(named, _SHORT_YEAR, 2) >= "69", F.lit("19")).otherwise(F.lit("20"))
    dated = F.when(named.rlike(_SHORT_YEAR), F.regexp_replace(named, F.lit(_SHORT_YEAR), F.concat(F.lit("$1"), century, F.lit("$2")))).otherwise(named)
    hour = F.regexp_extract(dated, _TWELVE_HOURS, 2).try_cast("int")
    half = F.when(F.lower(F.regexp_extract(dated, _TWELVE_HOURS, 4)) == "p", F.lit(12)).otherwise(F.lit(0))
    clock = F.lpad((hour % 12 + half).cast("string"), 2, "0")
    whole = F.concat(F.regexp_extract(dated, _TWELVE_HOURS, 1), clock, F.regexp_extract(dated, _TWELVE_HOURS, 3))
    return F.when(hour.between(1, 12), whole).otherwise(dated)


def parse_timestamp(col: Column) -> Column:
    """A timestamp from mixed layouts, null when none fits.

    Layouts: ISO, day and month as numbers in either order (month first wins), years
    of two digits, month names, 12-hour clocks. A time with an offset becomes UTC.
    A bare number is a date with eight digits only, and years go from 1 to 9999, so
    that every value read can be shown and written anywhere.
    Casts of text in the usual layout come first, so that the others cost it nothing.
    """
    text = strip(col.cast("string"))

    def readings(text: Column, kind: str) -> list[Column]:
        dates = [F.regexp_replace(text, pattern, layout) for pattern, layout in _DATE_REWRITES]
        return [t.try_cast(kind) for t in (text, *dates)]

    def instant(text: Column) -> Column:
        return F.to_utc_timestamp(F.coalesce(*readings(text, "timestamp")), F.current_timezone()).cast("timestamp_ntz")

    def plain(text: Column) -> Column:
        return F.coalesce(*readings(text, "timestamp_ntz"))

    with_colon = F.regexp_replace(text, r" *([+-][0-9]{2}):?([0-9]{2})$", "$1:$2")
    with_seconds = F.regexp_replace(with_colon, r"([ T][0-9]{1,2}:[0-9]{2}) *(?=[+-]|Z)", "$1:00")
    usual = F.coalesce(plain(text), bind(_usual_form(text), plain))
    read = F.when(text.rlike(_OFFSET), bind(with_seconds, instant)).otherwise(usual)
    return bind(F.when(~text.rlike(_NO_DATE), read), lambda ts: F.when(F.year(ts).between(1, 9999), ts))
