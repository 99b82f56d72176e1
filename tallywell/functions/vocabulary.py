"""Output names in Spanish, for dashboards and saved queries that expect them."""

from pyspark.sql import DataFrame

from tallywell.schema import SPANISH_NAMES


def with_spanish_names(df: DataFrame) -> DataFrame:
    """Rename the known columns; all others keep their names."""
    return df.withColumnsRenamed({c: SPANISH_NAMES[c] for c in df.columns if c in SPANISH_NAMES})
