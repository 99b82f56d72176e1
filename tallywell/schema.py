"""Column names, types and fixed values of the invoice-line model."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)  # one line or one price
TOTAL = T.DecimalType(28, 2)  # a sum of lines
PRICE = T.DecimalType(18, 4)  # a unit price as read

INVOICE_LINE = T.StructType(
    [
        T.StructField("invoice_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("sale_date", T.DateType()),
        T.StructField("unit_price", PRICE),
        T.StructField("customer_id", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)

# Source headers accepted for each column.
HEADER_ALIASES = {
    "Invoice": "invoice_id",
    "InvoiceNo": "invoice_id",
    "StockCode": "product_id",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "event_ts",
    "Price": "unit_price",
    "UnitPrice": "unit_price",
    "Customer ID": "customer_id",
    "CustomerID": "customer_id",
    "Country": "country",
}

REQUIRED_COLUMNS = ("invoice_id", "product_id", "quantity", "event_ts", "unit_price")
NEVER_NULL_COLUMNS = ("product_id", "quantity", "event_ts", "unit_price")
DUPLICATE_KEYS = ("invoice_id", "product_id", "event_ts", "quantity", "unit_price")

# Names of the quality rules, in the order that decides the reason.
RULE_NULL_KEYS = "columnas_obligatorias_sin_nulos"
RULE_PRODUCT = "producto_identificable"
RULE_DATE = "fecha_dentro_de_rango"
RULE_QUANTITY = "cantidad_minima"
RULE_PRICE = "precio_en_rango"
RULE_DUPLICATE = "sin_duplicados_exactos"

# Labels of bands, segments and markets.
UNKNOWN_COUNTRY = "DESCONOCIDO"
HOME_COUNTRY = "UNITED KINGDOM"
HOUR_BANDS = ("temprano", "media manana", "media tarde", "tarde")
AMOUNT_SEGMENTS = ("muy baja", "baja", "media", "alta", "muy alta")
VOLUME_SEGMENTS = ("unitaria", "minorista", "mayorista", "volumen")
MARKET_HOME = "mercado local"
MARKET_UNKNOWN = "sin identificar"
MARKET_EXPORT = "exportacion"
MARKET_TYPES = (MARKET_HOME, MARKET_EXPORT, MARKET_UNKNOWN)

# Default limits of the business rules.
MIN_QUANTITY = 1
MIN_PRICE = "0.01"
MAX_PRICE = "50000.0"
MIN_DATE = "2000-01-01"
MAX_REJECT_PCT = 15.0
AMOUNT_TOLERANCE = "0.01"
PUBLISHED_RANKING_SIZE = 50
REPORT_RANKING_SIZE = 25
MONTHLY_RANKING_SIZE = 10

# Spanish output names for readers whose dashboards and saved
# queries use them (see functions.vocabulary).
SPANISH_NAMES = {
    "invoice_id": "factura",
    "product_id": "producto_id",
    "description": "descripcion",
    "quantity": "cantidad",
    "event_ts": "fecha_hora",
    "sale_date": "fecha",
    "unit_price": "precio_unitario",
    "customer_id": "cliente_id",
    "country": "pais",
    "line_revenue": "ingreso_total",
    "reject_reason": "motivo_rechazo",
    "total_revenue": "ingreso_total",
    "units_sold": "unidades_vendidas",
    "invoice_lines": "lineas_de_factura",
    "distinct_invoices": "facturas_distintas",
    "distinct_products": "productos_distintos",
    "distinct_customers": "clientes_distintos",
    "distinct_countries": "paises_distintos",
    "mean_unit_price": "precio_unitario_promedio",
    "min_unit_price": "precio_unitario_minimo",
    "max_unit_price": "precio_unitario_maximo",
    "product_description": "descripcion_producto",
    "main_country": "pais_predominante",
    "revenue_per_invoice": "ingreso_promedio_por_factura",
    "revenue_per_unit": "ingreso_promedio_por_unidad",
    "revenue_per_product": "ingreso_promedio_por_producto",
    "mean_ticket": "ticket_promedio",
    "units_per_invoice": "unidades_promedio_por_factura",
    "admin_revenue": "ingreso_administrativo",
    "moving_avg_7d": "ingreso_media_movil_7d",
    "moving_avg": "ingreso_media_movil",
    "cumulative_revenue": "ingreso_acumulado",
    "change_vs_previous": "variacion_contra_dia_anterior",
    "position": "posicion",
    "share_pct": "participacion_porcentual",
    "cumulative_share_pct": "participacion_acumulada",
    "days_with_sales": "dias_con_venta",
    "first_sale": "primera_venta",
    "last_sale": "ultima_venta",
    "revenue_per_day": "ingreso_promedio_diario",
    "market_type": "tipo_de_mercado",
    "is_admin_concept": "es_concepto_administrativo",
    "has_no_customer": "es_venta_sin_cliente",
    "is_weekend": "es_fin_de_semana",
    "year": "anio",
    "month": "mes",
    "day": "dia",
    "year_month": "anio_mes",
    "weekday": "dia_semana",
    "day_of_week": "dia_de_semana",
    "hour_of_day": "hora_del_dia",
    "month_start": "primer_dia_del_mes",
    "week_start": "primer_dia_de_semana",
    "hour_band": "franja_horaria",
    "amount_segment": "segmento_importe",
    "volume_segment": "segmento_volumen",
}
