"""Warehouse tables: full-replace loads and layer materialisation."""

import logging
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.errors import LoadError
from tallywell.operators.checks import UNIQUE_KEYS, check_unique
from tallywell.plans.layers import PUBLISHED, enrich_sales, prepare_sales
from tallywell.session import materialize, remove_path

log = logging.getLogger(__name__)

CREATED = "created"
RELOADED = "reloaded"
RECREATED = "recreated"
SKIPPED = "skipped_empty"


@dataclass(frozen=True)
class LoadResult:
    table: str
    rows: int
    mode: str


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """SK9: create a database when it is not there."""
    where = f" LOCATION '{location}'" if location else ""
    try:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    except Exception as error:
        raise LoadError(f"could not create the database {name}: {error}") from error


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


#: Property of a table that names the folder its rows were in before the last load.
PREVIOUS = "previous_location"


@dataclass
class _Load:
    """New rows of a table that are written and checked, and how to show them."""

    table: str
    path: str
    rows: int
    old: str | None
    same: bool
    spark: SparkSession

    def point_at(self, path: str, previous: str | None) -> None:
        """Show the rows of a folder under the table's name."""
        if self.same:
            self.spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{path}'")
            self.spark.catalog.refreshTable(self.table)
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            self.spark.sql(f"CREATE TABLE {self.table} USING parquet LOCATION '{path}'")
        if previous:
            self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{PREVIOUS}' = '{previous}')")

    def result(self) -> LoadResult:
        return LoadResult(self.table, self.rows, SKIPPED if not self.rows else RELOADED if self.same else RECREATED if self.old else CREATED)


def _written(df: DataFrame, table: str, unique: Sequence[tuple[str, ...]]) -> _Load:
    """Write the new rows beside a table and check them; nothing that is shown changes."""
    spark = df.sparkSession
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    known = spark.table(table).schema if spark.catalog.tableExists(table) else None
    same = known is not None and set(known.names) == set(df.columns)
    if same:
        df = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in known])
    path = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        written = spark.read.schema(df.schema).parquet(path)
        rows = written.count()
        repeated = [k for k in unique if rows and not check_unique(written, *k).isEmpty()]
        if repeated:
            raise LoadError(f"{repeated} repeat")
        return _Load(table, path, rows, _location(spark, table) if known is not None else None, same, spark)
    except Exception:
        remove_path(spark, path)
        raise


def _previous(spark: SparkSession, table: str) -> str | None:
    """The folder that the last load left behind, if it is one that a load made."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PREVIOUS).first()
    made = re.compile(rf"/{re.escape(table.rpartition('.')[2])}-[0-9a-f]{{32}}/?$")
    return found["value"] if found and made.search(found["value"]) else None


def replace_tables(frames: dict[str, DataFrame], unique: dict[str, Sequence[tuple[str, ...]]] | None = None) -> dict[str, LoadResult]:
    """SK7/SK8: replace the whole content of several tables, all or none.

    All new rows are written first, to new folders beside the tables, and checked; only
    then are the tables pointed at them, which moves no rows. A load that fails in any way
    leaves all tables as they were: what was switched already is switched back. A frame that
    reads a table can replace it. With the same columns the table object stays, views on it
    remain valid and values are cast to its types, so that one that doesn't fit fails the
    load; with others it is made anew. ``unique`` names sets of columns that must not repeat
    (SK12). Empty inputs are skipped. The rows replaced stay until the next load, as readers
    may be in the middle of them; the ones before them are deleted then.
    """
    loads: list[_Load] = []
    switched: list[_Load] = []
    table = ""
    try:
        for table, df in frames.items():
            loads.append(_written(df, table, (unique or {}).get(table, ())))
        stale = {load.table: _previous(load.spark, load.table) for load in loads if load.rows}
        for load in loads:
            table = load.table
            if load.rows:
                if load.old and not load.same:
                    log.warning("columns of %s changed, it is made anew; build the layers again", table)
                switched.append(load)
                load.point_at(load.path, load.old)
    except Exception as error:
        for load in switched:
            if load.old:
                load.point_at(load.old, None)
            else:
                load.spark.sql(f"DROP TABLE IF EXISTS {load.table}")
        for load in loads:
            remove_path(load.spark, load.path)
        raise LoadError(f"could not load the table {table}: {error}") from error
    for load in loads:
        if not load.rows:
            remove_path(load.spark, load.path)
        elif stale[load.table]:
            remove_path(load.spark, stale[load.table])
    return {load.table: load.result() for load in loads}


def replace_table(df: DataFrame, table: str, unique: Sequence[tuple[str, ...]] = ()) -> LoadResult:
    """SK7: replace the whole content of one table, as ``replace_tables`` does."""
    return replace_tables({table: df}, {table: unique})[table]


def load_results(
    spark: SparkSession, results: dict[str, DataFrame], database: str = "raw", location: str | None = None
) -> dict[str, LoadResult]:
    """SK8: load the result tables, all or none; a warehouse out of reach stops no run."""
    try:
        ensure_database(spark, database, location)
    except LoadError as error:
        log.warning("the warehouse load is skipped: %s", error)
        return {}
    loaded = replace_tables({f"{database}.{name}": df for name, df in results.items()})
    return {name: loaded[f"{database}.{name}"] for name in results}


def build_layers(
    spark: SparkSession, source_table: str, database: str = "published", location: str | None = None
) -> dict[str, LoadResult]:
    """SK10: the enriched detail, written once, and the published tables made from it.

    The detail is the temporary view ``enriched_view(database)``. A published table
    with repeated keys is not shown.
    """
    enriched = materialize(enrich_sales(prepare_sales(spark.table(source_table))), "enriched_sales")
    enriched.createOrReplaceTempView(enriched_view(database))
    ensure_database(spark, database, location)
    frames = {f"{database}.{name}": build(enriched) for name, build in PUBLISHED.items()}
    loaded = replace_tables(frames, {f"{database}.{name}": UNIQUE_KEYS.get(name, ()) for name in PUBLISHED})
    return {name: loaded[f"{database}.{name}"] for name in PUBLISHED}


def enriched_view(database: str) -> str:
    """Name of the view of the enriched detail behind a database."""
    return f"enriched_sales_{database}"
