"""Small frames with results worked out by hand."""

from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallywell.operators.revenue import add_line_revenue
from tallywell.schema import INVOICE_LINE

UK, FR = "UNITED KINGDOM", "FRANCE"
VALID = [
    ("489434", "22086", "PAPER CHAIN KIT 50'S CHRISTMAS", 10, datetime(2009, 12, 1, 7, 45), "2.50", 13085, UK),
    ("489434", "85048", "15CM CHRISTMAS GLASS BALL", 5, datetime(2009, 12, 1, 7, 45), "6.00", 13085, UK),
    ("489435", "22086", "PAPER CHAIN KIT 50'S CHRISTMAS", 20, datetime(2009, 12, 1, 9, 10), "2.50", 13078, UK),
    ("489436", "21232", "STRAWBERRY CERAMIC TRINKET BOX", 4, datetime(2009, 12, 2, 11, 20), "1.25", 13078, FR),
    ("489437", "84879", "ASSORTED COLOUR BIRD ORNAMENT", 8, datetime(2009, 12, 2, 15, 0), "10.00", 13085, FR),
]
DEFECTS = [
    ("C489438", "22086", "X", -10, datetime(2009, 12, 3, 10, 0), "2.50", 13085, UK),
    ("489439", "21232", "X", 3, datetime(2009, 12, 3, 10, 5), "99999.00", 13085, UK),
    ("489440", "84879", "X", 5, datetime(2099, 1, 1, 10, 0), "3.00", 13085, UK),
    ("489441", None, "X", 2, datetime(2009, 12, 3, 10, 15), "4.00", 13085, UK),
    ("489434", "22086", "PAPER CHAIN KIT 50'S CHRISTMAS", 10, datetime(2009, 12, 1, 7, 45), "2.50", 13085, UK),
]


def lines(spark, rows):
    full = [
        (i, p, d, q, ts, ts.date() if ts else None, Decimal(price) if price else None, c, country)
        for i, p, d, q, ts, price, c, country in rows
    ]
    return spark.createDataFrame(full, INVOICE_LINE)


def valid(spark):
    return lines(spark, VALID)


def with_defects(spark):
    """Ordered by ``ordinal``, the defects last."""
    rows = VALID + DEFECTS
    parts = [lines(spark, [row]).withColumn("ordinal", F.lit(i)) for i, row in enumerate(rows)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def priced(spark, rows=VALID):
    return add_line_revenue(lines(spark, rows))


HEADERS = ["Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"]


def csv_text(rows, sep=",", headers=HEADERS):
    return "\n".join([sep.join(headers), *[sep.join(str(v) for v in row) for row in rows]]) + "\n"


RAW = [
    (i, p, d, q, ts.strftime("%Y-%m-%d %H:%M:%S"), price, f"{c}.0", country)
    for i, p, d, q, ts, price, c, country in VALID
]
