"""Delimiter and header of each text file, from all of its lines."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.session import materialize
from tallywell.sources.records import opens_field, quoted_parts

# The delimiters tried, in order of preference.
CANDIDATES = (",", ";", "\t", "|")

#: A quoted field. A doubled quote closes and opens it; the loop gives nothing back, so
#: fields of any length need no stack.
QUOTED = r'"[^"]*+"'


def unquoted(line: str, parts: Column | None = None) -> Column:
    """A line without its quoted fields; only lines of more than two quotes are searched for them."""
    value = F.col(line)
    parts = quoted_parts(value) if parts is None else parts
    outside = F.concat(F.get(parts, F.lit(0)), F.get(parts, F.lit(2)))
    return F.when(F.size(parts) == 1, value).when(F.size(parts) == 3, outside).otherwise(F.regexp_replace(value, QUOTED, ""))


def separators(line: str, delimiter: str) -> Column:
    """How often a delimiter stands in a line outside quotes."""
    return _occurrences(unquoted(line), delimiter)


def _occurrences(text: Column, sign: str) -> Column:
    times = F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))
    return F.when(F.contains(text, F.lit(sign)), times).otherwise(F.lit(0))


def file_path(file: str) -> Column:
    """The path of a file that the scan names as a URI."""
    return F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))


def _placed_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, row, value`` of every line; the same rows have the same places in each scan of the frame."""
    text = spark.read.option("recursiveFileLookup", "true").text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"), "value")


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, split, value`` of every line, in order within a split; ``file`` is the URI of the scan."""
    return _placed_lines(spark, path).drop("row")


def scan_headers(spark: SparkSession, path: str | list[str], delimiter: str | None = None) -> DataFrame:
    """SRC3: ``path, delimiter, header, breaks`` of each file with a line that isn't blank.

    A delimiter scores one point per line on which it occurs as often as in the
    header, the first such line. Without any point the most frequent one of the header
    wins, and the comma when there is none. ``breaks`` says whether some quoted field goes on
    in another line. A ``delimiter`` that is given stands for all candidates.

    Tasks count their lines by how often each delimiter occurs, so the header can be scored
    afterwards. Only numbers are added up, which needs no sort of the lines; the text of the
    headers is picked by its place in a second look at the lines, which moves none of them.
    """
    candidates = CANDIDATES if delimiter is None else (delimiter,)
    value = F.col("value")
    placed = _placed_lines(spark, path)
    parts = F.col("parts")
    lines = placed.where(F.trim("value") != "").withColumn("parts", quoted_parts(value)).withColumn("unquoted", unquoted("value", parts))
    names = [f"times_{i}" for i in range(len(candidates))]
    opens = [f"open_{i}" for i in range(len(candidates))]
    times = [_occurrences(F.col("unquoted"), c).alias(n) for n, c in zip(names, candidates)]
    open_lines = [F.when(opens_field("value", c, parts), 1).otherwise(0).alias(n) for n, c in zip(opens, candidates)]
    counted = lines.select("file", "split", "row", *times, *open_lines)
    alike = counted.groupBy("file", "split", *names).agg(F.count("*").alias("lines"), F.min("row").alias("row"), *[F.sum(n).alias(n) for n in opens])
    alike = materialize(alike, "alike")
    place = F.struct("split", "row")
    first = alike.groupBy("file").agg(F.min_by(F.struct("split", "row", *names), place).alias("first"))
    points = [F.sum(F.when((F.col(n) > 0) & (F.col(n) == F.col("first")[n]), F.col("lines")).otherwise(0)).alias(f"points_{i}") for i, n in enumerate(names)]
    joined = alike.join(first.withColumnRenamed("file", "of"), F.col("file") == F.col("of"))
    scored = joined.groupBy("file").agg(F.first("first").alias("first"), *points, *[F.sum(n).alias(n) for n in opens])
    ranked = [
        F.struct(F.col(f"points_{i}").alias("points"), F.col("first")[n].alias("times"), F.lit(-i).alias("first"), F.lit(c).alias("delimiter"), (F.col(f"open_{i}") > 0).alias("breaks"))
        for i, (n, c) in enumerate(zip(names, candidates))
    ]
    best = scored.select("file", "first.split", "first.row", F.array_max(F.array(*ranked)).alias("best"))
    headers = placed.join(best, ["file", "split", "row"])
    return headers.select(file_path("file").alias("path"), "best.delimiter", F.col("value").alias("header"), "best.breaks")


def infer_delimiter(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC3: one row per file with its delimiter."""
    return scan_headers(spark, path).select("path", "delimiter")
