import itertools
import random
import re
from datetime import datetime
from decimal import Decimal

import pytest
from frames import HEADERS, RAW, VALID, csv_text, valid
from pyspark.sql import functions as F

from tallywell.catalog import sources as S
from tallywell.catalog.sources import write_text
from tallywell.errors import IngestError
from tallywell.functions import text
from tallywell.session import materialize
from tallywell.sources import delimiters, files, records
from tallywell.sources.delimiters import infer_delimiter
from tallywell.sources.records import opens_field
from tallywell.sources.typing import coerce_types, column_names, normalize_name, require_columns


def put(tmp_path, name, text, encoding="utf-8"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def rows_of(df):
    return sorted(df.collect(), key=lambda r: (str(r.invoice_id), str(r.product_id)))


def test_reads_typed_lines(spark, tmp_path):
    df = files.read_sales(spark, put(tmp_path, "a.csv", csv_text(RAW)))
    first = rows_of(df)[0]
    assert df.count() == 5
    assert (first.invoice_id, first.product_id, first.quantity, first.customer_id) == ("489434", "22086", 10, 13085)
    assert first.unit_price == Decimal("2.5000") and first.event_ts == datetime(2009, 12, 1, 7, 45)
    assert first.sale_date.isoformat() == "2009-12-01"


@pytest.mark.parametrize("sep", [",", ";", "\t", "|"])
def test_infers_each_delimiter(spark, tmp_path, sep):
    path = put(tmp_path, "a.csv", csv_text(RAW, sep))
    assert [r.delimiter for r in infer_delimiter(spark, path).collect()] == [sep]
    assert files.read_sales(spark, path).count() == 5


def test_delimiter_ignores_the_other_signs_in_quotes(spark, tmp_path):
    text = 'Invoice;StockCode;Description\n1;a;"x, y, z, w"\n2;b;"x, y"\n'
    path = put(tmp_path, "a.csv", text)
    assert infer_delimiter(spark, path).first().delimiter == ";"


def test_delimiter_defaults_to_comma(spark, tmp_path):
    assert infer_delimiter(spark, put(tmp_path, "a.csv", "alone\n1\n")).first().delimiter == ","


def test_file_names_with_blanks_and_signs(spark, tmp_path):
    paths = [put(tmp_path, "año 50% a.csv", csv_text(RAW[:2], ";")), put(tmp_path, "b c.csv", csv_text(RAW[2:], "|"))]
    assert files.read_sales_csv(spark, paths).count() == 5


def test_all_lines_of_a_file_decide(spark, tmp_path):
    text = "a;b,c\n" + "x;y\n" * 3 + "p,q\n" * 20_000
    assert infer_delimiter(spark, put(tmp_path, "a.csv", text)).first().delimiter == ","


def test_headers_in_another_order_are_read_by_name(spark, tmp_path):
    put(tmp_path, "in/a.csv", "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n1,22086,A,6,2010-01-02 03:04,2.50,7,UK\n")
    put(tmp_path, "in/b.csv", "StockCode;Invoice;Description;Price;InvoiceDate;Quantity;Customer ID;Country\n22087;2;B;4.00;2010-01-02 03:04;7;8;UK\n")
    put(tmp_path, "in/c.csv", "StockCode,Invoice,Description,Price,InvoiceDate,Quantity,Customer ID,Country\n22088,3,C,4.00,2010-01-02 03:04,9,8,UK\n")
    rows = sorted(tuple(r) for r in files.read_sales_csv(spark, str(tmp_path / "in")).select("invoice_id", "product_id", "quantity").collect())
    assert rows == [("1", "22086", 6), ("2", "22087", 7), ("3", "22088", 9)]


def test_a_header_without_required_columns_is_an_error(spark, tmp_path):
    put(tmp_path, "in/a.csv", csv_text(RAW))
    put(tmp_path, "in/b.csv", "x,y\n1,2\n")
    with pytest.raises(IngestError):
        files.read_sales_csv(spark, str(tmp_path / "in"))


@pytest.mark.parametrize("extra", ["", ",too,many"])
def test_very_long_quoted_fields(spark, tmp_path, extra):
    header = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"
    long = "long, " * 20_000
    text = f'{header}\n1,22086,"{long}""x""",6,2010-01-02 03:04,2.50,7,UK{extra}\n2,22087,B,6,2010-01-02 03:04,2.50,7,UK\n'
    rows = files.read_sales_csv(spark, put(tmp_path, "a.csv", text)).select("invoice_id").collect()
    assert sorted(r.invoice_id for r in rows) == (["2"] if extra else ["1", "2"])


def test_files_with_different_delimiters_are_read_together(spark, tmp_path):
    a, b = put(tmp_path, "a.csv", csv_text(RAW[:2], ";")), put(tmp_path, "b.csv", csv_text(RAW[2:], "|"))
    assert files.read_sales_csv(spark, [a, b]).count() == 5


def test_overlong_lines_are_dropped_and_short_ones_padded(spark, tmp_path):
    text = csv_text(RAW[:1]) + "9,1,long,1,2009-12-01,1.0,1,UK,extra\n8,1,short,1,2009-12-01,1.0\n7,1,\"a, b\",1,2009-12-01,1.0,1,UK\n"
    df = files.read_sales_csv(spark, put(tmp_path, "a.csv", text), delimiter=",")
    assert sorted(r.invoice_id for r in df.select("invoice_id").collect()) == ["489434", "7", "8"]
    assert df.count() == 3
    assert df.where("invoice_id = '8'").first().country is None
    assert df.where("invoice_id = '7'").first().description == "A, B"


def test_trims_and_upper_cases(spark, tmp_path):
    raw = [("  489434 ", " 85123a ", "white hanging ", "6", "2009-12-01", "2.55", "13085", "united kingdom")]
    row = files.read_sales(spark, put(tmp_path, "a.csv", csv_text(raw))).first()
    assert (row.invoice_id, row.product_id, row.description, row.country) == ("489434", "85123A", "WHITE HANGING", "UNITED KINGDOM")


def test_bad_numbers_become_null(spark, tmp_path):
    raw = [("1", "a", "x", "diez", "2009-12-01", "2.5", "", "UK"), ("2", "b", "x", "2.5", "nunca", "sin precio", "NaN", "UK")]
    rows = rows_of(files.read_sales(spark, put(tmp_path, "a.csv", csv_text(raw))))
    assert rows[0].quantity is None and rows[0].customer_id is None
    assert (rows[1].quantity, rows[1].unit_price, rows[1].event_ts, rows[1].customer_id) == (None, None, None, None)


def test_invalid_bytes_do_not_stop_the_read(spark, tmp_path):
    body = csv_text(RAW[:1]).encode() + b"5,a,caf\xe9,1,2009-12-01,1.0,1,UK\n"
    assert files.read_sales(spark, put(tmp_path, "a.csv", body)).count() == 2


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2009-12-01 07:45:00", datetime(2009, 12, 1, 7, 45)),
        ("2009-12-01T07:45", datetime(2009, 12, 1, 7, 45)),
        ("12/1/2009 7:45", datetime(2009, 12, 1, 7, 45)),
        ("13/12/2009", datetime(2009, 12, 13)),
        ("2009/12/01", datetime(2009, 12, 1)),
        ("20091201", datetime(2009, 12, 1)),
        ("2009-13-01", None),
        ("", None),
        ("1/12/10 8:26", datetime(2010, 1, 12, 8, 26)),
        ("13/12/69 8:26", datetime(1969, 12, 13, 8, 26)),
        ("12/1/2009 1:26 PM", datetime(2009, 12, 1, 13, 26)),
        ("12/1/2009 12:05:09 a.m.", datetime(2009, 12, 1, 0, 5, 9)),
        ("Dec 1 2009", datetime(2009, 12, 1)),
        ("1-Dec-09 7:45", datetime(2009, 12, 1, 7, 45)),
        ("December 1, 2009 1:26 PM", datetime(2009, 12, 1, 13, 26)),
        ("1 september 2009 13:26", datetime(2009, 9, 1, 13, 26)),
        ("2009-12-01T13:26:00+02:00", datetime(2009, 12, 1, 11, 26)),
        ("12/1/2009 13:26 +0200", datetime(2009, 12, 1, 11, 26)),
        ("2009-12-01 13:26:00Z", datetime(2009, 12, 1, 13, 26)),
        ("Decade 1 2009", None),
        ("12/1/2009 13:26 PM", None),
        ("17850", None),
        ("2009", None),
        ("+17850-01-01", None),
        ("-5", None),
        ("17850-01-01", None),
        ("0000-01-01", None),
        ("9999-12-31", datetime(9999, 12, 31)),
        ("12:30", None),
        ("123456789", None),
    ],
)
def test_mixed_dates(spark, text, expected):
    assert coerce_types(spark.createDataFrame([(text,)], "event_ts string")).first().event_ts == expected


@pytest.mark.parametrize(
    "text, expected", [("17850.0", 17850), ("12.", 12), ("1e3", 1000), ("-5", -5), (" 7 ", 7), ("1d", None), ("0x1F", None), ("99999999999", None)]
)
def test_whole_numbers(spark, text, expected):
    assert coerce_types(spark.createDataFrame([(text,)], "quantity string")).first().quantity == expected


def test_row_cap(spark, tmp_path):
    path = put(tmp_path, "a.csv", csv_text(RAW))
    first = [r.invoice_id for r in files.read_sales(spark, path, with_ordinal=True).orderBy("ordinal").collect()][:2]
    assert [r.invoice_id for r in files.read_sales(spark, path, max_rows=2).collect()] == first


def test_null_tokens_are_opt_in(spark, tmp_path):
    raw = [("1", "NA", "x", "1", "2009-12-01", "2.5", "1", "UK")]
    path = put(tmp_path, "a.csv", csv_text(raw))
    assert files.read_sales(spark, path).first().product_id == "NA"
    assert files.read_sales(spark, path, null_tokens=("NA",)).first().product_id is None


def test_errors(spark, tmp_path):
    with pytest.raises(IngestError, match="does not exist"):
        files.read_sales(spark, str(tmp_path / "none.csv"))
    with pytest.raises(IngestError, match="unsupported format"):
        files.read_sales(spark, put(tmp_path, "a.xlsx", "x"))
    with pytest.raises(IngestError, match="no data rows"):
        files.read_sales(spark, put(tmp_path, "b.csv", ",".join(HEADERS) + "\n"))
    with pytest.raises(IngestError, match="lacks the required columns .*unit_price"):
        files.read_sales(spark, put(tmp_path, "c.csv", "Invoice,StockCode\n1,2\n"))


def test_headers():
    assert normalize_name("  Customer   ID ") == "Customer ID"
    assert column_names([" Customer  ID", "Sales Channel"]) == {" Customer  ID": "customer_id", "Sales Channel": "sales_channel"}
    with pytest.raises(IngestError):
        column_names(["Invoice", "InvoiceNo"])


def test_required_columns(spark):
    with pytest.raises(IngestError, match="quantity"):
        require_columns(valid(spark).drop("quantity"))


def test_parquet_round_trip(spark, tmp_path):
    path = str(tmp_path / "a.parquet")
    valid(spark).write.parquet(path)
    assert rows_of(files.read_sales(spark, path)) == rows_of(valid(spark))


def test_sample_keeps_whole_groups(spark):
    sample = files.sample_groups(valid(spark), "invoice_id", 2)
    picked = {r.invoice_id for r in sample.collect()}
    assert len(picked) == 2
    assert sample.count() == sum(row[0] in picked for row in VALID)
    assert sample.collect() == files.sample_groups(valid(spark), "invoice_id", 2).collect()


def test_union_fills_missing_columns(spark):
    both = files.union_inputs([valid(spark), valid(spark).drop("country")])
    assert both.count() == 10 and both.where("country is null").count() == 5


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country"


def read_back(spark, path, **options):
    df = files.read_sales_csv(spark, path, **options)
    return sorted((r.invoice_id, r.description, r.quantity, r.country) for r in df.collect())


def test_line_breaks_in_quoted_fields(spark, tmp_path):
    body = [
        '1,22086,"two\nlines",7,12/1/2010 8:26,4.00,17850,France',
        '2,22087,plain,6,12/1/2010 8:26,4.00,17850,France',
        '3,22088,"a ""quoted"" word,\n\n and, blank ""\n"" lines",5,12/1/2010 8:26,4.00,17850,"United\nKingdom"',
        '4,22089,5" pipe,4,12/1/2010 8:26,4.00,17850,Spain',
        '5,22090,"closed",3,12/1/2010 8:26,4.00,17850,"Spain"',
    ]
    path = put(tmp_path, "a.csv", "\n".join([HEADER, *body]) + "\n")
    assert read_back(spark, path) == [
        ("1", "TWO\nLINES", 7, "FRANCE"), ("2", "PLAIN", 6, "FRANCE"),
        ("3", 'A "QUOTED" WORD,\n\n AND, BLANK "\n" LINES', 5, "UNITED\nKINGDOM"), ("4", '5" PIPE', 4, "SPAIN"), ("5", "CLOSED", 3, "SPAIN"),
    ]
    assert read_back(spark, path, delimiter=",") == read_back(spark, path)
    with_place = files.read_sales_csv(spark, path, with_ordinal=True).orderBy("ordinal")
    assert [r.invoice_id for r in with_place.collect()] == ["1", "2", "3", "4", "5"]


def test_records_over_many_splits(spark, tmp_path):
    """Splits of 200 bytes cut records anywhere, some records cover several splits."""
    lines, expected = [HEADER], []
    for k in range(120):
        breaks = (0, 1, 0, 30)[k % 4]
        text = "".join(f"part {j}\n" for j in range(breaks)) + f"end {k}"
        lines.append(f'{k},2208,"{text}",{k + 1},12/1/2010 8:26,4.00,17850,France')
        expected.append((str(k), text.upper(), k + 1, "FRANCE"))
    put(tmp_path, "in/a.csv", "\n".join(lines))
    put(tmp_path, "in/b.csv", "\n".join(line.replace(",", ";") for line in [HEADER, "900,1,plain,1,12/1/2010 8:26,4.00,17850,Spain"]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        assert read_back(spark, str(tmp_path / "in")) == sorted([*expected, ("900", "PLAIN", 1, "SPAIN")])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("most", [3, 10_000])
def test_records_equal_a_walk_over_all_lines(spark, tmp_path, monkeypatch, capsys, most):
    """Random lines in splits of 40 bytes and batches of 3 lines; no step before the last shuffles the lines."""
    plans = {}

    def kept(df, name, folder=None):
        plans[name] = plan_of(df, capsys)
        return materialize(df, name, folder)

    monkeypatch.setattr(records, "materialize", kept)
    draw, expected = random.Random(most), []
    for k in range(5):
        lines = [draw.choice(['"x', 'y"', "z", "", 'a,"b', '"c",d', 'e"f', '",g', '"",h', '"']) for _ in range(draw.choice([0, 1, 25, 60]))]
        put(tmp_path, f"in/{k}.csv", "".join(line + "\n" for line in lines))
        inside, open_at = False, 0
        spans = {}
        for at, line in enumerate(lines):
            was = inside
            for field in line.split(","):
                if inside or field.startswith('"'):
                    inside = '"' not in (field if inside else field[1:]).replace('""', "")
            open_at = at if not was and inside else open_at
            if was and not inside and at - open_at < most:
                spans[open_at] = at + 1
        at, rows = 0, []
        while at < len(lines):
            rows.append("\n".join(lines[at : spans.get(at, at + 1)]))
            at = spans.get(at, at + 1)
        expected += [(f"{k}.csv", rows)] if rows else []
    settings = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.execution.arrow.maxRecordsPerBatch": "3"}
    before = {c: spark.conf.get(c) for c in settings}
    for c, v in settings.items():
        spark.conf.set(c, v)
    try:
        lines = delimiters.text_lines(spark, str(tmp_path / "in"))
        splits = records.splits_of(lines, ",")
        found = records.records(lines, splits, ",", most).join(splits.select("key", "file").distinct(), "key").orderBy("file", "split", "row").collect()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    texts = {}
    for r in found:
        texts.setdefault(r.file.rsplit("/", 1)[1], []).append(r.value)
    assert sorted(texts.items()) == sorted(expected)
    assert "Exchange hashpartitioning" not in plans["splits"] and plans["pieces"].count("Scan text") == 1
    assert "value" not in "".join(x for x in plans["pieces"].splitlines() if "Exchange hashpartitioning" in x)


def test_a_quote_that_never_ends_spoils_its_own_line_only(spark, tmp_path):
    body = ['1,22086,"open,7,12/1/2010 8:26,4.00,17850,France', "2,22087,B,6,12/1/2010 8:26,4.00,17850,France", "3,22087,C,6,12/1/2010 8:26,4.00,17850,France"]
    found = read_back(spark, put(tmp_path, "a.csv", "\n".join([HEADER, *body])))
    assert [r[0] for r in found] == ["1", "2", "3"] and found[1:] == [("2", "B", 6, "FRANCE"), ("3", "C", 6, "FRANCE")]


def test_too_many_fields_in_records_of_several_lines(spark, tmp_path):
    body = ['1,22086,"two\nlines",7,12/1/2010 8:26,4.00,17850,France,too,many', '2,22087,"two\nlines",6,12/1/2010 8:26,4.00', "3,22087,C,6,12/1/2010 8:26,4.00,17850,France,x"]
    assert read_back(spark, put(tmp_path, "a.csv", "\n".join([HEADER, *body]))) == [("2", "TWO\nLINES", 6, None)]


def plan_of(df, capsys):
    df.explain()
    return capsys.readouterr().out


def test_lines_are_counted_without_a_sort_of_their_text(spark, tmp_path, monkeypatch, capsys):
    plans = {}

    def kept(df, name, folder=None):
        plans[name] = plan_of(df, capsys)
        return materialize(df, name, folder)

    monkeypatch.setattr(delimiters, "materialize", kept, raising=False)
    path = put(tmp_path, "a.csv", csv_text(RAW))
    plans["headers"] = plan_of(delimiters.scan_headers(spark, path), capsys)
    # A line's text in an aggregate makes Spark sort all lines.
    assert all("Scan text" in p or name == "headers" for name, p in plans.items()) and "SortAggregate" not in plans["alike"]


def test_headers_of_files_packed_in_one_task_and_cut_in_many(spark, tmp_path):
    for k, sep in enumerate(",;\t|"):
        put(tmp_path, f"in/{k} +.csv", "\n  \n" * 60 + csv_text(RAW * 20, sep))
    for size in ("150", "100000"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = delimiters.scan_headers(spark, str(tmp_path / "in")).orderBy("path").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert [(r.delimiter, r.header, r.breaks) for r in found] == [(s, s.join(HEADERS), False) for s in ",;\t|"]
        assert [r.path.endswith(f"in/{k} +.csv") for k, r in enumerate(found)] == [True] * 4


@pytest.mark.parametrize("sep", [",", "|", "\t"])
def test_open_quotes_by_brute_force(spark, sep):
    def inside_after(line):
        inside = False
        for field in line.split(sep):
            if not inside and not field.startswith('"'):
                continue
            rest = field if inside else field[1:]
            inside = '"' not in rest.replace('""', "")
        return inside

    texts = ["".join(t) for n in range(8) for t in itertools.product(f'a"{sep}', repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(8)
    found = {r.value: r.open for r in df.select("value", opens_field("value", sep).alias("open")).collect()}
    assert found == {t: inside_after(t) for t in texts}


def test_quoted_text_is_left_out_of_lines_with_any_number_of_quotes(spark):
    texts = ["".join(t) for n in range(8) for t in itertools.product('a",', repeat=n)] + ['x,"' + "long, " * 500 + '",y', '"' * 9]
    df = spark.createDataFrame([(t,) for t in texts], "value string").repartition(8)
    found = {r.value: (r.text, r.n) for r in df.select("value", delimiters.unquoted("value").alias("text"), delimiters.separators("value", ",").alias("n")).collect()}
    plain = {t: re.sub('"[^"]*"', "", t) for t in texts}
    assert found == {t: (plain[t], plain[t].count(",")) for t in texts}


def test_no_task_writes_a_fixed_share_of_the_lines(spark, monkeypatch):
    """Text with line breaks is written by as many tasks as its rows have."""
    rows = [(*r, flag) for r, flag in zip(RAW, "ANRAN")]
    text = spark.createDataFrame(rows, [*HEADERS, "l_returnflag"]).repartition(5)
    monkeypatch.setattr(S, "raw_text", lambda *_: text)
    tasks = []
    monkeypatch.setattr(S, "write_text", lambda df, path, sep: tasks.append(df.rdd.getNumPartitions()) or write_text(df, path, sep))
    assert S.read_line_breaks(spark, "").count() == 5
    assert tasks == [5]


def test_long_lines_are_written_compressed_and_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "LINES_PER_FILE", 10, raising=False)
    path = str(tmp_path / "long.csv")
    S.write_lines(spark.range(25).repartition(1), F.concat(F.lit("x"), F.repeat(F.lit("long, "), 500)), path)
    files_ = list((tmp_path / "long.csv").glob("part-*.csv.gz"))
    assert len(files_) == 3 and sum(f.stat().st_size for f in files_) < 25 * 3000 / 20
    assert spark.read.text(path).count() == 25 + 3


def test_row_cap_reads_the_files_of_the_first_rows_only(spark, tmp_path):
    path = str(tmp_path / "many x")
    frame = valid(spark).unionByName(valid(spark))
    frame.withColumn("year", frame.event_ts.substr(1, 4)).repartition(5).write.partitionBy("year").parquet(path)
    every = files.read_sales(spark, path, "parquet", with_ordinal=True).orderBy("ordinal").select("invoice_id", "product_id").collect()
    for n in (1, 3, 10, 50):
        capped = files.read_sales(spark, path, "parquet", max_rows=n)
        assert capped.select("invoice_id", "product_id").collect() == every[:n]
        assert "year" in capped.columns
    read = files.first_files(spark, path, 1)
    assert len(read) == 1 and len(files.first_files(spark, path, 50)) == len(set(spark.read.parquet(path).inputFiles()))
    assert len(files.read_sales(spark, path, "parquet", max_rows=1).inputFiles()) == 1
    assert files.read_sales(spark, read[0], "parquet", max_rows=1).count() == 1


def test_strip_removes_blanks_of_any_kind_from_ends_of_any_length(spark):
    signs = [*text.BLANKS[:4], "\xa0", " ", "　", "a", "é", "中", "\U0001f600", "\u0080", "‐"]
    texts = ["".join(t) for n in range(4) for t in itertools.product(signs, repeat=n)]
    texts += [side + "long, " * 500 + other for side in ("", "　 ", "é") for other in ("", " \xa0", " ", "\U0001f600", " x")]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value string").repartition(8)
    found = {r.value: r.text for r in df.select("value", text.strip(F.col("value")).alias("text")).collect()}
    assert found == {t: t.strip(text.BLANKS) for t in texts} | {None: None}
