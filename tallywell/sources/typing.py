"""Header names, required columns and permissive typing."""

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell import schema as S
from tallywell.errors import IngestError
from tallywell.functions import text as X


FIXED_TYPES = {(f.name, f.dataType) for f in S.INVOICE_LINE if f.dataType != T.StringType()}


def normalize_name(name: str) -> str:
    """PRJ1: one blank between words, none at the ends."""
    return " ".join(str(name).split())


def column_names(columns: list[str]) -> dict[str, str]:
    """PRJ2: the model name of every header; unknown ones become snake_case."""
    names = {}
    for column in columns:
        clean = normalize_name(column)
        names[column] = S.HEADER_ALIASES.get(clean, clean.lower().replace(" ", "_"))
    repeated = sorted(n for n, times in Counter(names.values()).items() if times > 1)
    if repeated:
        raise IngestError(f"several headers stand for the columns {repeated}: {sorted(columns)}")
    return names


def rename_columns(df: DataFrame) -> DataFrame:
    """PRJ2: rename by the alias table, keep every column."""
    return df.withColumnsRenamed(column_names(df.columns))


def require_columns(df: DataFrame) -> DataFrame:
    """PRJ3: fail when a required column is missing, naming missing and found."""
    missing = [c for c in S.REQUIRED_COLUMNS if c not in df.columns]
    if missing:
        raise IngestError(
            f"the input lacks the required columns {missing}; found {sorted(df.columns)}"
        )
    return df


def coerce_types(df: DataFrame) -> DataFrame:
    """PRJ4: fixed types for the known columns; what cannot be read becomes null.

    Columns that already have their type are left alone, all but text.
    """
    readers = {
        "event_ts": X.parse_timestamp,
        "quantity": lambda c: X.parse_whole_number(c, "int"),
        "unit_price": lambda c: X.parse_decimal(c, S.PRICE.simpleString()),
        "invoice_id": lambda c: X.clean_code(c.cast("string")),
        "product_id": lambda c: X.clean_code(c.cast("string")),
        "description": lambda c: X.clean_code(c.cast("string")),
        "country": lambda c: X.clean_code(c.cast("string")),
        "customer_id": lambda c: X.parse_whole_number(c, "bigint"),
    }
    ready = {f.name for f in df.schema if (f.name, f.dataType) in FIXED_TYPES}
    typed = df.withColumns(
        {c: read(F.col(c)) for c, read in readers.items() if c in df.columns and c not in ready}
    )
    if "event_ts" in typed.columns:
        typed = typed.withColumn("sale_date", F.col("event_ts").cast("date"))
    return typed
