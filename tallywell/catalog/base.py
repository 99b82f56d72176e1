"""Registration of queries and the SQL fragments their oracles share."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, when SQL can express it, the SQL of its result."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def ratio(num: str, den: str, digits: int, num_scale: int = 2, den_scale: int = 0, times: int = 1) -> str:
    """SQL for ``times * num / den`` rounded half up in whole numbers."""
    n = f"CAST(({num}) * {10**num_scale} AS HUGEINT)"
    d = f"CAST(({den}) * {10**den_scale} AS HUGEINT)"
    up = times * 10 ** (den_scale + digits)
    down = 10**num_scale
    whole = f"((2 * abs({n}) * {up} + {d} * {down}) // (2 * {d} * {down}))"
    unit = "1" if digits == 0 else "0." + "0" * (digits - 1) + "1"
    return (
        f"CASE WHEN coalesce({den}, 0) = 0 THEN NULL ELSE CAST(CAST(sign({n}) AS INTEGER) "
        f"* CAST({whole} AS DECIMAL(30,0)) * CAST({unit} AS DECIMAL(8,{digits})) AS DECIMAL(22,{digits})) END"
    )


def percent(num: str, den: str, digits: int) -> str:
    return ratio(num, den, digits, 2, 2, 100)


_LINE = """
    CAST(l_orderkey AS VARCHAR) AS invoice_id,
    CASE WHEN l_partkey % 50 = 0 THEN 'M' || CAST(l_partkey AS VARCHAR)
         ELSE printf('%05d', l_partkey) END AS product_id,
    CASE WHEN l_tax > 0 THEN upper(CASE WHEN l_linestatus = 'F' THEN p_name
         ELSE p_name || ' ' || p_type END) END AS description,
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER)
         ELSE CAST(l_quantity AS INTEGER) END AS quantity,
    l_shipdate + to_hours(l_linenumber * 2 + 5) AS event_ts,
    CAST(l_shipdate AS DATE) AS sale_date,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(18,4)) AS unit_price,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS customer_id,
    CASE WHEN n_nationkey = 0 THEN 'UNITED KINGDOM' WHEN n_nationkey <> 1 THEN n_name END AS country
"""
_JOINS = """
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN customer ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
"""
_REVENUE = "CAST(quantity * unit_price AS DECIMAL(18,2)) AS line_revenue"

# Named subqueries in order of dependence.
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "sales": (
        f"SELECT {_LINE}, l_orderkey, l_linenumber, l_suppkey, l_partkey, l_returnflag, l_linestatus, "
        f"l_tax, l_discount FROM lineitem {_JOINS}",
        (),
    ),
    "resent": (
        "SELECT *, 1 AS delivery FROM sales UNION ALL "
        "SELECT *, 2 AS delivery FROM sales WHERE l_linestatus = 'O'",
        ("sales",),
    ),
    "defective": (
        """SELECT invoice_id,
            CASE WHEN l_tax = 0 AND l_discount = 0 THEN NULL
                 WHEN l_tax = 0 AND l_discount = 0.01 THEN '   ' ELSE product_id END AS product_id,
            description,
            CASE WHEN l_tax = 0 AND l_discount = 0.03 THEN NULL ELSE quantity END AS quantity,
            CASE WHEN l_tax = 0 AND l_discount = 0.02 THEN NULL
                 ELSE event_ts + INTERVAL 4 YEARS END AS event_ts,
            sale_date,
            CASE WHEN l_tax = 0 AND l_discount = 0.04 THEN NULL ELSE unit_price END AS unit_price,
            customer_id, country, delivery, l_orderkey, l_linenumber, l_suppkey, l_partkey
        FROM resent""",
        ("resent",),
    ),
    "classified": (
        """SELECT *, CASE
            WHEN product_id IS NULL OR quantity IS NULL OR event_ts IS NULL OR unit_price IS NULL
                THEN 'columnas_obligatorias_sin_nulos'
            WHEN trim(product_id) = '' THEN 'producto_identificable'
            WHEN event_ts < TIMESTAMP '2000-01-01' OR event_ts >= TIMESTAMP '2004-07-01'
                THEN 'fecha_dentro_de_rango'
            WHEN quantity < 1 THEN 'cantidad_minima'
            WHEN unit_price NOT BETWEEN 0.01 AND 50000 THEN 'precio_en_rango'
            WHEN copy > 1 THEN 'sin_duplicados_exactos' END AS reject_reason
        FROM (SELECT *, row_number() OVER (
            PARTITION BY invoice_id, product_id, event_ts, quantity, unit_price
            ORDER BY delivery, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS copy FROM defective)""",
        ("defective",),
    ),
    "valid": (
        f"SELECT *, {_REVENUE} FROM sales WHERE quantity >= 1 AND unit_price BETWEEN 0.01 AND 50000",
        ("sales",),
    ),
    "lines": (f"SELECT *, {_REVENUE} FROM sales", ("sales",)),
    "product_names": (
        """SELECT product_id, description AS product_description FROM (
            SELECT product_id, description, row_number() OVER (
                PARTITION BY product_id ORDER BY count(*) DESC, description) AS place
            FROM valid WHERE description IS NOT NULL GROUP BY product_id, description) WHERE place = 1""",
        ("valid",),
    ),
    "aggregate": (
        f"""SELECT a.*, product_description FROM (
            SELECT sale_date, product_id, CAST(sum(line_revenue) AS DECIMAL(28,2)) AS total_revenue,
                CAST(sum(quantity) AS BIGINT) AS units_sold, count(*) AS invoice_lines,
                count(DISTINCT invoice_id) AS distinct_invoices,
                {ratio("sum(unit_price)", "count(unit_price)", 4, 4)} AS mean_unit_price
            FROM valid GROUP BY sale_date, product_id) a
            LEFT JOIN product_names n ON a.product_id = n.product_id""",
        ("product_names",),
    ),
    "prepared": (
        """SELECT invoice_id, product_id, nullif(trim(description), '') AS description,
            coalesce(country, 'DESCONOCIDO') AS country, customer_id, sale_date, event_ts, quantity,
            CAST(unit_price AS DECIMAL(18,2)) AS unit_price, line_revenue,
            NOT regexp_matches(product_id, '^[0-9]{5}') AS is_admin_concept,
            customer_id IS NULL AS has_no_customer FROM valid""",
        ("valid",),
    ),
    "enriched": (
        """SELECT *, CAST(year(sale_date) AS INTEGER) AS year, CAST(month(sale_date) AS INTEGER) AS month,
            CAST(day(sale_date) AS INTEGER) AS day, CAST(dayofweek(sale_date) AS INTEGER) AS day_of_week,
            CAST(hour(event_ts) AS INTEGER) AS hour_of_day, strftime(sale_date, '%Y-%m') AS year_month,
            CAST(date_trunc('month', sale_date) AS DATE) AS month_start,
            CAST(date_trunc('week', sale_date) AS DATE) AS week_start,
            dayofweek(sale_date) IN (0, 6) AS is_weekend,
            CASE WHEN hour(event_ts) < 10 THEN 'temprano' WHEN hour(event_ts) < 13 THEN 'media manana'
                 WHEN hour(event_ts) < 16 THEN 'media tarde' ELSE 'tarde' END AS hour_band,
            CASE WHEN line_revenue < 5 THEN 'muy baja' WHEN line_revenue < 20 THEN 'baja'
                 WHEN line_revenue < 100 THEN 'media' WHEN line_revenue < 500 THEN 'alta'
                 ELSE 'muy alta' END AS amount_segment,
            CASE WHEN quantity = 1 THEN 'unitaria' WHEN quantity <= 12 THEN 'minorista'
                 WHEN quantity <= 100 THEN 'mayorista' ELSE 'volumen' END AS volume_segment
        FROM prepared""",
        ("prepared",),
    ),
    "samples": (
        """SELECT event_type AS metric, json_extract_string(props, '$.k') AS job,
            CAST(user_id AS VARCHAR) AS instance, ts, CAST(value AS DECIMAL(18,4)) AS value,
            event_id AS sample_id, epoch_us(ts) AS micros FROM events""",
        (),
    ),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    found: list[str] = []
    for name in names:
        for dependency in _needed(CTES[name][1]):
            if dependency not in found:
                found.append(dependency)
        if name not in found:
            found.append(name)
    return found


def sql(body: str, *ctes: str) -> str:
    """A statement with the named subqueries it needs."""
    if not ctes:
        return body
    parts = ",\n".join(f"{name} AS ({CTES[name][0]})" for name in _needed(ctes))
    joint = "," if body.lstrip().upper().startswith("WITH ") else ""
    rest = body.lstrip()[5:] if joint else body
    return f"WITH {parts}{joint}\n{rest}"
