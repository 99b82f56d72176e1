"""Compare registered queries with their SQL, value by value."""

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("n", str(value))
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, int):
        return ("n", str(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return ("d", value.isoformat())
    return (type(value).__name__, value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(r[i]) for i in order) for r in rows], key=repr)


def differences(df, con, statement):
    """None when both results agree, else a short text."""
    cursor = con.execute(statement)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    actual = _rows(df.columns, df.collect())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(set(df.columns) ^ set(names))}"
    if expected == actual:
        return None
    only_sql = [r for r in expected if r not in set(actual)][:2] if len(expected) < 5000 else list(set(expected) - set(actual))[:2]
    only_spark = list(set(actual) - set(expected))[:2]
    return f"rows {len(actual)} / {len(expected)}\n  spark {only_spark}\n  sql   {only_sql}"
