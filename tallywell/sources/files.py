"""CSV and Parquet readers with one entry point."""

import os
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell import schema as S
from tallywell.errors import IngestError
from tallywell.session import materialize
from tallywell.sources.delimiters import file_path, scan_headers, separators, text_lines
from tallywell.sources.records import records, splits_of
from tallywell.sources.typing import coerce_types, rename_columns, require_columns

# Name of the column with the text of a line whose number of fields is not the header's.
BAD_LINE = "_bad_line"
FORMATS = {".csv": "csv", ".txt": "csv", ".parquet": "parquet"}


def drop_overlong_rows(raw: DataFrame, delimiter: str) -> DataFrame:
    """SRC2: drop lines with too many fields; short lines stay, padded with null.

    Spark refuses a scan of the bad-line column alone, as in a plain count, so
    the filter touches the first field too.
    """
    fields = [c for c in raw.columns if c not in (BAD_LINE, "ordinal")]
    touched = F.coalesce(F.length(F.col(f"`{fields[0]}`")), F.lit(0)) >= 0
    found = separators(BAD_LINE, delimiter)
    return raw.where(touched & (F.col(BAD_LINE).isNull() | (found < len(fields)))).drop(BAD_LINE)


def read_csv_raw(
    spark: SparkSession,
    paths: str | list[str],
    delimiter: str,
    null_tokens: Sequence[str] = (),
    with_ordinal: bool = False,
    breaks: bool = False,
) -> DataFrame:
    """SRC1/SRC2: every column as text under its source header.

    Files are split across tasks. Where ``breaks`` says that quoted fields go on over
    several lines, lines are first put together to records, over splits too; a header
    stands on one line. The parser sees whole lines even when a query needs few columns:
    a pruned line has no wrong number of fields.
    """
    options = {"header": True, "sep": delimiter, "encoding": "UTF-8", "escape": '"', "columnPruning": False}
    headers = spark.read.options(**options).csv(paths).columns
    columns = [T.StructField(h, T.StringType()) for h in headers]
    schema = T.StructType([*columns, T.StructField(BAD_LINE, T.StringType())])
    lenient = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    if breaks:
        raw = _parsed_records(spark, paths, delimiter, schema, options | lenient)
        raw = raw if with_ordinal else raw.drop("ordinal")
    else:
        raw = spark.read.schema(schema).options(**options, **lenient, enforceSchema=True).csv(paths)
        if with_ordinal:
            raw = raw.select("*", text_ordinal().alias("ordinal"))
    raw = drop_overlong_rows(raw, delimiter)
    if null_tokens:
        raw = raw.withColumns(
            {h: F.when(~F.col(f"`{h}`").isin(*null_tokens), F.col(f"`{h}`")) for h in headers}
        )
    return raw


def _parsed_records(spark: SparkSession, paths: str | list[str], delimiter: str, schema: T.StructType, options: dict) -> DataFrame:
    """The records of files whose quoted fields have line breaks, without headers and blank lines."""
    lines = text_lines(spark, paths)
    splits = splits_of(lines, delimiter)
    found = records(lines, splits, delimiter)
    header = F.min(F.struct("split", F.col("filled").alias("row"))).alias("header")
    headers = splits.where("filled IS NOT NULL").groupBy("key", file_path("file").alias("path")).agg(header)
    headers = materialize(headers, "header_places")
    rows = found.where(F.trim("value") != "").join(headers, "key").where("header <> struct(split, row)")
    text = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k not in ("header", "columnPruning")}
    ddl = ", ".join("`{}` string".format(name.replace("`", "``")) for name in schema.fieldNames())
    parsed = rows.select(F.from_csv("value", ddl, text).alias("fields"), F.struct(F.col("path").alias("file"), "split", "row").alias("ordinal"))
    return parsed.select("fields.*", "ordinal")


def text_ordinal() -> Column:
    """Position of a line in its input: file, split, line of the split."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def parquet_ordinal() -> Column:
    """Position of a row in its input: file and row, the same in every scan."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def input_format(path: str, file_format: str | None = None) -> str:
    """The format asked for, or the one of the extension."""
    extension = os.path.splitext(path.rstrip("/"))[1].lower()
    chosen = file_format or FORMATS.get(extension)
    if chosen not in ("csv", "parquet"):
        raise IngestError(f"unsupported format {extension!r}; accepted are {sorted(FORMATS)}")
    return chosen


def read_sales_csv(
    spark: SparkSession,
    path: str | list[str],
    delimiter: str | None = None,
    null_tokens: Sequence[str] = (),
    with_ordinal: bool = False,
) -> DataFrame:
    """SRC1: typed invoice lines from delimited text; quoted fields may hold line breaks.

    Without a ``delimiter`` it is inferred per file from a scan of the text. Files are
    read together where delimiter, header and the use of line breaks agree, each group under
    its own header, and the groups are united by name; a header without the required columns
    is an error. The driver gets a row per group, and the paths only of several groups.
    """
    kinds = ["delimiter", "header", "breaks"]
    found = materialize(scan_headers(spark, path, delimiter), "headers")
    groups = found.groupBy(*kinds).agg(F.min("path").alias("path")).orderBy("path").collect()
    parts = []
    for group in groups:
        same = [F.col(k) == F.lit(group[k]) for k in kinds]
        paths = path if len(groups) == 1 else [r["path"] for r in found.where(same[0] & same[1] & same[2]).orderBy("path").collect()]
        raw = read_csv_raw(spark, paths, group["delimiter"], null_tokens, with_ordinal, group["breaks"])
        parts.append(coerce_types(require_columns(rename_columns(raw))))
    if not groups:
        parts = [coerce_types(require_columns(rename_columns(read_csv_raw(spark, path, delimiter or ",", null_tokens, with_ordinal))))]
    return union_inputs(parts)


def first_files(spark: SparkSession, path: str, n: int) -> list[str]:
    """The Parquet files, in order of their names, that hold the first n rows; n files at most.

    Rows are counted without their columns, which reads no more than the footers.
    """
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    counts = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("place"), file.alias("file")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("place")) - F.col("rows")
    needed = counts.withColumn("before", before).where(F.col("before") < n).orderBy("place")
    return [r["file"] for r in needed.select("file").collect()]


def read_sales_parquet(spark: SparkSession, path: str | list[str], with_ordinal: bool = False, base: str | None = None) -> DataFrame:
    """SRC4: typed invoice lines from Parquet with source or model headers.

    ``base`` is the folder whose layout gives partition columns to single files in it.
    """
    reader = spark.read.option("basePath", base) if base else spark.read
    raw = reader.parquet(*([path] if isinstance(path, str) else path))
    if with_ordinal:
        raw = raw.select("*", parquet_ordinal().alias("ordinal"))
    return coerce_types(require_columns(rename_columns(raw)))


def read_sales(
    spark: SparkSession,
    path: str,
    file_format: str | None = None,
    max_rows: int | None = None,
    **options,
) -> DataFrame:
    """SRC6: choose the reader by extension; every failure is an ``IngestError``.

    ``max_rows`` keeps the first rows of the input; of Parquet only the files that hold them are read.
    """
    chosen = input_format(path, file_format)
    try:
        ordered = options.pop("with_ordinal", False)
        read = read_sales_csv if chosen == "csv" else read_sales_parquet
        if chosen == "parquet" and max_rows:
            found = first_files(spark, path, max_rows)
            if found and not found[0].endswith(path):
                path, options = found, options | {"base": path}
        sales = read(spark, path, with_ordinal=ordered or max_rows is not None, **options)
        if max_rows is not None:
            sales = limit_rows(sales, max_rows, "ordinal")
            sales = sales if ordered else sales.drop("ordinal")
        empty = sales.isEmpty()
    except IngestError:
        raise
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise IngestError(f"the input {path} does not exist") from error
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            raise IngestError(f"the input {path} is empty") from error
        raise IngestError(f"the input {path} cannot be read: {error}") from error
    except Exception as error:
        raise IngestError(f"the input {path} cannot be read: {error}") from error
    if empty:
        raise IngestError(f"the input {path} has no data rows")
    return sales


def read_detail(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: written detail with decimal revenue and a plain date."""
    return spark.read.parquet(path).withColumns(
        {
            "line_revenue": F.col("line_revenue").cast(S.MONEY),
            "sale_date": F.to_date("sale_date"),
        }
    )


def limit_rows(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """SRC7: at most n rows, the first by ``order_by`` when given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC8: a declared warehouse table."""
    return spark.table(name)


def union_inputs(parts: Sequence[DataFrame]) -> DataFrame:
    """SRC9: same-shaped inputs as one, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sample_groups(df: DataFrame, key: str, n: int, seed: int = 42, order_by: str = "event_ts") -> DataFrame:
    """SRC10: all rows of n groups drawn by a seeded hash of their key."""
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))
    chosen = df.select(key).distinct().orderBy(draw, key).limit(n)
    return df.join(chosen, key, "left_semi").orderBy(order_by)
