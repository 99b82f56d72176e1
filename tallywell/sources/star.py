"""Invoice lines and metric samples derived from the star-schema test tables."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.operators.revenue import add_line_revenue

SALES_COLUMNS = tuple(S.INVOICE_LINE.fieldNames())


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sales_lines(
    spark: SparkSession,
    folder: str,
    columns: Sequence[str] = (*SALES_COLUMNS, "ordinal"),
    resent: bool = False,
) -> DataFrame:
    """Line items as invoice lines; only the tables the columns need are joined.

    The order side is joined with its customer first, so the wide and long line
    table is shuffled once for it. Returned lines have a negative quantity, line
    numbers stand for the hour, and every fiftieth part has a manual code.
    """
    wanted = set(columns)
    lines = table(spark, folder, "lineitem")
    order = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
    if resent:
        once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
        copies = F.when(F.col("l_linestatus") == "O", twice).otherwise(once)
        lines = lines.withColumn("delivery", F.explode(copies))
        order = ["delivery", *order]
    if "description" in wanted:
        part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if wanted & {"customer_id", "country"}:
        orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        if "country" in wanted:
            customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
            nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
            homes = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            orders = orders.join(homes, F.col("o_custkey") == F.col("c_custkey"), "left")
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    part_number = F.col("l_partkey").cast("string")
    units = F.col("l_quantity").cast("int")
    text = F.when(F.col("l_linestatus") == "F", F.col("p_name")).otherwise(
        F.concat_ws(" ", "p_name", "p_type")
    )
    moment = F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 2 + 5)
    expressions = {
        "invoice_id": F.col("l_orderkey").cast("string"),
        "product_id": F.when(
            F.col("l_partkey") % 50 == 0, F.concat(F.lit("M"), part_number)
        ).otherwise(F.lpad(part_number, F.greatest(F.lit(5), F.length(part_number)), "0")),
        "description": F.upper(F.when(F.col("l_tax") > 0, text)),
        "quantity": F.when(F.col("l_returnflag") == "R", -units).otherwise(units),
        "event_ts": moment,
        "sale_date": F.col("l_shipdate").cast("date"),
        "unit_price": F.col("l_extendedprice").cast("decimal(18,2)").cast(S.PRICE),
        "customer_id": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")),
        "country": F.when(F.col("n_nationkey") == 0, S.HOME_COUNTRY).when(
            F.col("n_nationkey") != 1, F.col("n_name")
        ),
        "ordinal": F.struct(*order),
    }
    return lines.select(*[expressions.get(c, F.col(c)).alias(c) for c in columns])


def resent_lines(
    spark: SparkSession, folder: str, columns: Sequence[str] = (*SALES_COLUMNS, "ordinal")
) -> DataFrame:
    """Invoice lines as received when the lines of open items were sent twice.

    The second copy comes later in the order of the input.
    """
    return sales_lines(spark, folder, columns, resent=True)


def defective_lines(
    spark: SparkSession, folder: str, columns: Sequence[str] = (*SALES_COLUMNS, "ordinal")
) -> DataFrame:
    """Invoice lines as received, four years later, with defects of every kind.

    Untaxed lines lose one value each, chosen by their discount.
    """
    marks = ("l_tax", "l_discount")
    lines = resent_lines(spark, folder, (*columns, *marks))
    defect = F.when(F.col("l_tax") == 0, F.col("l_discount"))

    def unless(discount: float, column: Column) -> Column:
        return F.when(defect.isNull() | (defect != discount), column)

    changed = {
        "product_id": F.when(defect == 0.01, F.lit("   ")).otherwise(unless(0.0, F.col("product_id"))),
        "event_ts": unless(0.02, F.col("event_ts") + F.expr("INTERVAL 4 YEARS")),
        "quantity": unless(0.03, F.col("quantity")),
        "unit_price": unless(0.04, F.col("unit_price")),
    }
    return lines.withColumns({c: changed[c] for c in columns if c in changed}).drop(*marks)


def valid_lines(spark: SparkSession, folder: str, columns: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Lines that pass the row-local quality rules, with their revenue."""
    needed = [*columns, *[c for c in ("quantity", "unit_price") if c not in columns]]
    lines = sales_lines(spark, folder, needed)
    price = F.col("unit_price")
    kept = lines.where(
        (F.col("quantity") >= S.MIN_QUANTITY)
        & price.between(F.lit(S.MIN_PRICE).cast(S.PRICE), F.lit(S.MAX_PRICE).cast(S.PRICE))
    )
    return add_line_revenue(kept)


def metric_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Events as samples: metric, job label, time, exact value and sample id."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("metric"),
        F.get_json_object("props", "$.k").alias("job"),
        F.col("user_id").cast("string").alias("instance"),
        F.col("ts"),
        F.col("value").cast("decimal(18,4)").alias("value"),
        F.col("event_id").alias("sample_id"),
    )


#: Metrics of a run and of services from events: kind of event, metric, label ``instance`` kept, stage,
#: factor by which time is pressed together, value (in SQL that Spark and DuckDB share).
HISTORY = (
    ("click", "pipeline_ventas_porcentaje_rechazo", True, "", 1, "value / 5"),
    ("click", "pipeline_ventas_ejecucion_exitosa", True, "", 1, "CASE WHEN value < 10 THEN 0 ELSE 1 END"),
    ("signup", "pipeline_ventas_ultima_ejecucion_exitosa_timestamp", True, "", 1, "floor(micros / 1000000) - floor(value)"),
    ("view", "pipeline_ventas_duracion_segundos", True, "", 1, "value * 10"),
    ("purchase", "pipeline_ventas_filas_procesadas", False, "agregacion", 1, "value"),
    ("view", "pipeline_ventas_filas_procesadas", False, "ingesta", 1, "value"),
    ("signup", "up", True, "", 1000, "CASE WHEN value < 40 THEN 0 ELSE 1 END"),
    ("purchase", "pg_stat_activity_count", True, "", 1000, "floor(value)"),
    ("view", "pg_settings_max_connections", False, "", 1000, "50 + floor(value / 4)"),
    ("error", "airflow_ti_failures", False, "", 30, "floor(value / 150)"),
    ("click", "airflow_scheduler_heartbeat", False, "", 10, "floor(value / 60)"),
)
HISTORY_START = 1_704_067_200_000_000


def history_selects() -> list[tuple[str, str, str, str, str, str]]:
    """Per metric: its source's filter and the SQL of its columns."""
    return [
        (
            f"metric = '{kind}'",
            f"'{metric}'",
            "instance" if kept else "''",
            f"'{stage}'",
            f"CAST(floor((micros - {HISTORY_START}) / {factor}) AS BIGINT) + {HISTORY_START}",
            f"CAST({value} AS DECIMAL(18,4))",
        )
        for kind, metric, kept, stage, factor, value in HISTORY
    ]


def metric_history(spark: SparkSession, folder: str) -> DataFrame:
    """Events as samples of the metrics that alerts watch: metric, instance, etapa, ts, value and sample id."""
    events = metric_samples(spark, folder).withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp")))
    parts = [
        events.where(kind).select(
            F.expr(metric).alias("metric"), F.expr(instance).alias("instance"), F.expr(stage).alias("etapa"),
            F.timestamp_micros(F.expr(at)).cast("timestamp_ntz").alias("ts"), F.expr(value).alias("value"), "sample_id",
        )
        for kind, metric, instance, stage, at, value in history_selects()
    ]
    return reduce(DataFrame.unionByName, parts)
