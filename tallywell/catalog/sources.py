"""Queries of the readers and of schema shaping."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell.catalog.base import query, sql
from tallywell.functions import calendar as C
from tallywell.functions import segments as G
from tallywell.operators.revenue import add_line_revenue
from tallywell.plans.layers import enrich_sales, prepare_sales
from tallywell.session import new_path
from tallywell.sinks.warehouse import ensure_database
from tallywell.sources import delimiters, files, star
from tallywell.sources.typing import coerce_types, rename_columns

LINE = star.SALES_COLUMNS
LINE_SQL = ", ".join(LINE)
HEADERS = ("Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country")


def raw_text(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    """The lines under source headers, as untidy text."""
    sales = star.sales_lines(spark, folder, (*LINE, *extra))
    return sales.select(
        F.concat(F.lit("  "), "invoice_id", F.lit(" ")).alias("Invoice"),
        F.lower("product_id").alias("StockCode"),
        F.lower("description").alias("Description"),
        F.col("quantity").cast("double").cast("string").alias("Quantity"),
        F.date_format("event_ts", "M/d/yyyy H:mm").alias("InvoiceDate"),
        F.col("unit_price").cast("string").alias("Price"),
        F.col("customer_id").cast("double").cast("decimal(18,1)").cast("string").alias("Customer ID"),
        F.initcap("country").alias("Country"),
        *extra,
    )


def write_text(df: DataFrame, path: str, sep: str) -> str:
    df.write.option("header", True).option("sep", sep).option("escape", '"').csv(path)
    return path


def write_by_delimiter(spark: SparkSession, folder: str) -> list[str]:
    """One folder per return flag, each with a delimiter of its own."""
    text = raw_text(spark, folder, "l_returnflag")
    base = new_path(spark, "mixed")
    return [
        write_text(text.where(F.col("l_returnflag") == flag).drop("l_returnflag"), f"{base}/{flag}", sep)
        for flag, sep in (("A", ";"), ("N", "\t"), ("R", "|"))
    ]


@query("read_sales_csv", sql(f"SELECT {LINE_SQL} FROM sales", "sales"))
def read_sales_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = write_text(raw_text(spark, folder), new_path(spark, "sales.csv"), ",")
    return files.read_sales(spark, path).select(*LINE)


@query("read_mixed_delimiters", sql(f"SELECT {LINE_SQL} FROM sales", "sales"))
def read_mixed_delimiters(spark: SparkSession, folder: str) -> DataFrame:
    return files.read_sales_csv(spark, write_by_delimiter(spark, folder)).select(*LINE)


def write_by_header(spark: SparkSession, folder: str) -> str:
    """One folder per return flag under one root: usual headers, another order, aliases in another order."""
    text = raw_text(spark, folder, "l_returnflag")
    root = new_path(spark, "headers")
    aliases = {"Invoice": "InvoiceNo", "Price": "UnitPrice", "Customer ID": "CustomerID"}
    for flag, columns in (("A", HEADERS), ("N", HEADERS[::-1]), ("R", (*HEADERS[3:], *HEADERS[:3]))):
        part = text.where(F.col("l_returnflag") == flag).select(*[F.col(f"`{c}`") for c in columns])
        write_text(part.withColumnsRenamed(aliases) if flag == "R" else part, f"{root}/{flag}", ",")
    return root


@query("read_mixed_headers", sql(f"SELECT {LINE_SQL} FROM sales", "sales"))
def read_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    root = write_by_header(spark, folder)
    return files.read_sales_csv(spark, [f"{root}/{flag}" for flag in "ANR"]).select(*LINE)


#: Lines of a compressed file, which one task reads.
LINES_PER_FILE = 100_000


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """Lines as they are, under the usual header, in compressed files of bounded size."""
    lines = df.select(line.alias(",".join(HEADERS)))
    options = {"header": True, "sep": "\x01", "quote": "", "escape": "", "compression": "gzip", "maxRecordsPerFile": LINES_PER_FILE}
    lines.write.options(**options).csv(path)


@query("read_long_fields", sql(
    "SELECT invoice_id, product_id, quantity, length(description) AS description_chars FROM (SELECT invoice_id, product_id, "
    "quantity, repeat('LONG, ', 500) || product_id AS description FROM sales WHERE l_returnflag <> 'A')", "sales"))
def read_long_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions of 3,000 characters with delimiters and quotes; some lines have fields too many."""
    text = raw_text(spark, folder, "l_returnflag").fillna("")
    long = F.concat(F.lit('"'), F.repeat(F.lit("long, "), 500), F.trim("StockCode"), F.lit('"'))
    fields = [long if h == "Description" else F.col(f"`{h}`") for h in HEADERS]
    line = F.when(F.col("l_returnflag") == "A", F.concat_ws(",", *fields, F.lit("too"), F.lit("many"))).otherwise(F.concat_ws(",", *fields))
    path = new_path(spark, "long.csv")
    write_lines(text, line, path)
    read = files.read_sales_csv(spark, path)
    return read.select("invoice_id", "product_id", "quantity", F.length("description").alias("description_chars"))


@query("read_line_breaks", sql(
    """SELECT invoice_id, product_id, quantity, unit_price, country,
        CASE l_returnflag WHEN 'A' THEN 'FIRST ' || product_id || chr(10) || chr(10) || 'A "SECOND", LINE'
            WHEN 'N' THEN 'PLAIN' ELSE '5" PIPE' END AS description FROM sales""", "sales"))
def read_line_breaks(spark: SparkSession, folder: str) -> DataFrame:
    """Quoted descriptions over three lines, among others."""
    text = raw_text(spark, folder, "l_returnflag")
    broken = F.concat(F.lit("first "), F.trim("StockCode"), F.lit('\n\na "second", line'))
    flag = F.col("l_returnflag")
    description = F.when(flag == "A", broken).when(flag == "N", "plain").otherwise('5" pipe')
    path = new_path(spark, "breaks")
    write_text(text.withColumn("Description", description).drop("l_returnflag"), path, ",")
    return files.read_sales_csv(spark, path).select("invoice_id", "product_id", "quantity", "unit_price", "country", "description")


@query(
    "infer_delimiter",
    "SELECT CASE l_returnflag WHEN 'A' THEN ';' WHEN 'N' THEN chr(9) ELSE '|' END AS delimiter, "
    "count(*) AS lines FROM lineitem GROUP BY 1",
)
def infer_delimiter(spark: SparkSession, folder: str) -> DataFrame:
    paths = write_by_delimiter(spark, folder)
    found = delimiters.infer_delimiter(spark, paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"))
    name = F.regexp_extract("path", r"([^/]+/[^/]+)$", 1)
    per_file = lines.where(~F.col("value").startswith("Invoice")).groupBy(name.alias("name")).agg(F.count("*").alias("n"))
    return (
        found.withColumn("name", name).join(per_file, "name")
        .groupBy("delimiter").agg(F.sum("n").alias("lines"))
    )


@query("drop_overlong_rows", sql(
    "SELECT invoice_id, product_id, quantity, unit_price, CASE WHEN l_returnflag <> 'N' THEN country END AS country "
    "FROM sales WHERE l_returnflag <> 'A'", "sales"))
def drop_overlong_rows(spark: SparkSession, folder: str) -> DataFrame:
    text = raw_text(spark, folder, "l_returnflag").fillna("")
    fields = [F.col(f"`{h}`") for h in HEADERS]
    ragged = (
        F.when(F.col("l_returnflag") == "A", F.concat_ws(",", *fields, F.lit("too"), F.lit("many")))
        .when(F.col("l_returnflag") == "N", F.concat_ws(",", *fields[:-1]))
        .otherwise(F.concat_ws(",", *fields))
    )
    path = new_path(spark, "ragged.csv")
    write_lines(text, ragged, path)
    return files.read_sales_csv(spark, path, delimiter=",").select(
        "invoice_id", "product_id", "quantity", "unit_price", "country"
    )


@query("read_sales_parquet", sql(f"SELECT {LINE_SQL} FROM sales", "sales"))
def read_sales_parquet(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "sales.parquet")
    raw_text(spark, folder).write.parquet(path)
    return files.read_sales(spark, path).select(*LINE)


@query("read_sales", sql(f"SELECT {LINE_SQL} FROM sales", "sales"))
def read_sales(spark: SparkSession, folder: str) -> DataFrame:
    path = write_text(raw_text(spark, folder), new_path(spark, "sales.txt"), ";")
    return files.read_sales(spark, path).select(*LINE)


@query("read_detail", sql("SELECT invoice_id, product_id, sale_date, line_revenue FROM valid", "valid"))
def read_detail(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "detail")
    detail = star.valid_lines(spark, folder, ("invoice_id", "product_id", "sale_date"))
    loose = detail.withColumns(
        {
            "line_revenue": F.col("line_revenue").cast("double"),
            "sale_date": F.col("sale_date").cast("timestamp_ntz"),
        }
    )
    loose.write.parquet(path)
    return files.read_detail(spark, path).select("invoice_id", "product_id", "sale_date", "line_revenue")


@query("limit_rows", sql(
    f"SELECT {LINE_SQL} FROM sales ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey LIMIT 1000", "sales"))
def limit_rows(spark: SparkSession, folder: str) -> DataFrame:
    return files.limit_rows(star.sales_lines(spark, folder), 1000, "ordinal").drop("ordinal")


@query("read_table", sql("SELECT invoice_id, product_id, sale_date, line_revenue FROM valid", "valid"))
def read_table(spark: SparkSession, folder: str) -> DataFrame:
    database = f"raw_{uuid.uuid4().hex}"
    ensure_database(spark, database, new_path(spark, database))
    detail = star.valid_lines(spark, folder, ("invoice_id", "product_id", "sale_date"))
    detail.write.format("parquet").saveAsTable(f"{database}.detail")
    return files.read_table(spark, f"{database}.detail").select("invoice_id", "product_id", "sale_date", "line_revenue")


@query("union_inputs", sql(
    "SELECT invoice_id, product_id, sale_date, CASE WHEN year(sale_date) <= 1998 THEN country END AS country FROM sales",
    "sales"))
def union_inputs(spark: SparkSession, folder: str) -> DataFrame:
    sales = star.sales_lines(spark, folder, ("invoice_id", "product_id", "sale_date", "country"))
    first = sales.where(F.year("sale_date") <= 1998)
    return files.union_inputs([first, sales.where(F.year("sale_date") > 1998).drop("country")])


@query("sample_groups", sql(
    f"SELECT {LINE_SQL} FROM sales WHERE invoice_id IN (SELECT invoice_id FROM (SELECT DISTINCT invoice_id FROM sales) "
    "ORDER BY md5(invoice_id || ':42'), invoice_id LIMIT 500)", "sales"))
def sample_groups(spark: SparkSession, folder: str) -> DataFrame:
    return files.sample_groups(star.sales_lines(spark, folder, LINE), "invoice_id", 500)


@query("rename_columns", sql(
    "SELECT invoice_id AS invoice_id, product_id, sale_date AS sales_day, line_revenue AS net_amount FROM valid", "valid"))
def rename(spark: SparkSession, folder: str) -> DataFrame:
    detail = star.valid_lines(spark, folder, ("invoice_id", "product_id", "sale_date"))
    return rename_columns(
        detail.select(
            F.col("invoice_id").alias(" InvoiceNo"), F.col("product_id").alias("StockCode "),
            F.col("sale_date").alias("Sales   Day"), F.col("line_revenue").alias("Net Amount"),
        )
    )


@query("coerce_types", sql(
    """SELECT invoice_id, product_id,
        CASE l_returnflag WHEN 'A' THEN CAST(abs(quantity) AS INTEGER) END AS quantity,
        CASE WHEN l_returnflag <> 'R' THEN event_ts END AS event_ts,
        CASE WHEN l_returnflag <> 'R' THEN sale_date END AS sale_date,
        CASE WHEN l_linestatus = 'F' THEN unit_price END AS unit_price,
        CASE WHEN l_linestatus = 'O' THEN customer_id END AS customer_id
    FROM sales""", "sales"))
def coerce(spark: SparkSession, folder: str) -> DataFrame:
    sales = star.sales_lines(
        spark, folder, ("invoice_id", "product_id", "quantity", "event_ts", "unit_price", "customer_id", "l_returnflag", "l_linestatus")
    )
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    units = F.abs("quantity").cast("string")
    text = sales.select(
        F.concat(F.lit(" "), "invoice_id").alias("invoice_id"),
        F.lower("product_id").alias("product_id"),
        F.when(flag == "A", F.concat(units, F.lit(".0"))).when(flag == "N", "diez")
        .otherwise(F.concat(units, F.lit(".5"))).alias("quantity"),
        F.when(flag == "A", F.date_format("event_ts", "M/d/yyyy H:mm:ss"))
        .when(flag == "N", F.col("event_ts").cast("string")).otherwise(F.when(status == "F", "13/45/2009").otherwise("17850")).alias("event_ts"),
        F.when(status == "F", F.col("unit_price").cast("string")).otherwise("sin precio").alias("unit_price"),
        F.when(status == "O", F.concat(F.col("customer_id").cast("string"), F.lit(".0"))).otherwise("NaN").alias("customer_id"),
    )
    return coerce_types(text)


@query("add_line_revenue", sql("SELECT invoice_id, product_id, quantity, unit_price, line_revenue FROM lines", "lines"))
def line_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return add_line_revenue(star.sales_lines(spark, folder, ("invoice_id", "product_id", "quantity", "unit_price")))


@query("add_calendar", sql(
    """SELECT invoice_id, product_id, sale_date, CAST(year(sale_date) AS INTEGER) AS year,
        CAST(month(sale_date) AS INTEGER) AS month, CAST(day(sale_date) AS INTEGER) AS day,
        strftime(sale_date, '%Y-%m') AS year_month, CAST((dayofweek(sale_date) + 6) % 7 AS INTEGER) AS weekday,
        dayofweek(sale_date) IN (0, 6) AS is_weekend FROM sales""", "sales"))
def calendar(spark: SparkSession, folder: str) -> DataFrame:
    return C.add_calendar(star.sales_lines(spark, folder, ("invoice_id", "product_id", "sale_date")))


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    return prepare_sales(star.valid_lines(spark, folder))


@query("prepare_sales", sql("SELECT * FROM prepared", "prepared"))
def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared(spark, folder)


@query("enrich_sales", sql("SELECT * FROM enriched", "enriched"))
def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich_sales(_prepared(spark, folder))


@query("flag_admin_code", sql(
    "SELECT product_id, NOT regexp_matches(product_id, '^[0-9]{5}') AS is_admin_concept FROM sales", "sales"))
def admin_code(spark: SparkSession, folder: str) -> DataFrame:
    return G.flag_admin_code(star.sales_lines(spark, folder, ("product_id",)))


@query("flag_no_customer", sql(
    "SELECT invoice_id, customer_id IS NULL AS has_no_customer FROM sales", "sales"))
def no_customer(spark: SparkSession, folder: str) -> DataFrame:
    return G.flag_no_customer(star.sales_lines(spark, folder, ("invoice_id", "customer_id"))).drop("customer_id")


@query("add_calendar_wh", sql(
    "SELECT event_ts, sale_date, year, month, day, day_of_week, hour_of_day, year_month, month_start, week_start, "
    "is_weekend FROM enriched", "enriched"))
def calendar_wh(spark: SparkSession, folder: str) -> DataFrame:
    return C.add_calendar_wh(star.valid_lines(spark, folder, ("event_ts", "sale_date"))).drop(
        "quantity", "unit_price", "line_revenue"
    )


@query("add_hour_band", sql("SELECT event_ts, hour_band FROM enriched", "enriched"))
def hour_band(spark: SparkSession, folder: str) -> DataFrame:
    return C.add_hour_band(star.valid_lines(spark, folder, ("event_ts",))).select("event_ts", "hour_band")


# The cuts lie far below a line of the test tables, so event values stand in for amounts.
@query("add_amount_segment", """SELECT line_revenue, CASE WHEN line_revenue < 5 THEN 'muy baja'
    WHEN line_revenue < 20 THEN 'baja' WHEN line_revenue < 100 THEN 'media' WHEN line_revenue < 500 THEN 'alta'
    ELSE 'muy alta' END AS amount_segment
    FROM (SELECT CAST(CAST(value AS DECIMAL(18,2)) * 4 AS DECIMAL(18,2)) AS line_revenue FROM events)""")
def amount_segment(spark: SparkSession, folder: str) -> DataFrame:
    amount = (F.col("value").cast("decimal(18,2)") * 4).cast("decimal(18,2)")
    return G.add_amount_segment(star.table(spark, folder, "events").select(amount.alias("line_revenue")))


@query("add_volume_segment", sql(
    """SELECT quantity, CASE WHEN quantity = 1 THEN 'unitaria' WHEN quantity <= 12 THEN 'minorista'
        WHEN quantity <= 100 THEN 'mayorista' ELSE 'volumen' END AS volume_segment
    FROM (SELECT CAST(sum(quantity) AS INTEGER) AS quantity FROM valid GROUP BY invoice_id)""", "valid"))
def volume_segment(spark: SparkSession, folder: str) -> DataFrame:
    baskets = star.valid_lines(spark, folder, ("invoice_id",)).groupBy("invoice_id").agg(
        F.sum("quantity").cast("int").alias("quantity")
    )
    return G.add_volume_segment(baskets.select("quantity"))


@query("add_market_type", sql(
    """SELECT country, CASE country WHEN 'UNITED KINGDOM' THEN 'mercado local'
        WHEN 'DESCONOCIDO' THEN 'sin identificar' ELSE 'exportacion' END AS market_type FROM prepared""", "prepared"))
def market_type(spark: SparkSession, folder: str) -> DataFrame:
    return G.add_market_type(_prepared(spark, folder).select("country"))
