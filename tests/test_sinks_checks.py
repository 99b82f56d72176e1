from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from frames import priced
from pyspark.sql import functions as F

from tallywell.errors import LoadError, PersistError
from tallywell.functions.calendar import add_calendar
from tallywell.operators import checks as C
from tallywell.operators.revenue import daily_summary, revenue_by_product_date
from tallywell.sinks import files as S
from tallywell.sinks import warehouse as W


def test_partitioned_write_is_idempotent_and_pruned(spark, tmp_path):
    path = str(tmp_path / "detail")
    detail = add_calendar(priced(spark))
    for _ in range(2):
        S.write_parquet(detail, path, ["year", "month"])
    assert (tmp_path / "detail" / "year=2009" / "month=12").is_dir()
    back = S.read_result(spark, path)
    assert back.count() == 5
    pruned = back.where("year = 2009 and quantity > 5").select("line_revenue")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThan(quantity,5)" in plan
    assert "ReadSchema: struct<quantity:int,line_revenue:decimal(18,2)>" in plan


def test_overwrite_replaces(spark, tmp_path):
    path = str(tmp_path / "x")
    S.write_parquet(spark.range(3), path)
    S.write_parquet(spark.range(1), path)
    assert S.read_result(spark, path).count() == 1


def test_one_month_can_be_reloaded(spark, tmp_path):
    path = str(tmp_path / "x")
    both = spark.sql("select 1 v, 1 month union all select 2, 2")
    S.write_parquet(both, path, ["month"])
    S.replace_partitions(spark.sql("select 9 v, 2 month"), path, ["month"])
    assert sorted((r.v, r.month) for r in S.read_result(spark, path).collect()) == [(1, 1), (9, 2)]


def test_csv_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([("ARTÍCULO DE DECORACIÓN", ' a, "b" ')], "x string, y string")
    path = S.write_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).option("escape", '"').csv(path).collect() == df.collect()


def test_quarantine(spark, tmp_path):
    bad = spark.createDataFrame([("a", -1, "cantidad_minima")], "product_id string, quantity int, reject_reason string")
    assert S.write_quarantine(bad.limit(0), str(tmp_path / "q"), "r1") is None
    assert not (tmp_path / "q").exists()
    S.write_quarantine(bad, str(tmp_path / "q"), "r1")
    S.write_quarantine(bad, str(tmp_path / "q"), "r2")
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).count() == 2


def test_rejected_rows_are_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    def row(k):
        made.add(1)
        return (k,)

    bad = spark.createDataFrame(spark.sparkContext.parallelize(range(40), 4).map(row), "k int")
    S.write_quarantine(bad, str(tmp_path / "q"), "r1")
    assert made.value == 40
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).count() == 40
    S.write_quarantine(bad.limit(0), str(tmp_path / "q"), "r1")
    assert spark.read.option("header", True).csv(str(tmp_path / "q")).count() == 40


def test_missing_result(spark, tmp_path):
    with pytest.raises(PersistError):
        S.read_result(spark, str(tmp_path / "none"))


def test_small_results_are_one_ordered_file(spark, tmp_path):
    S.write_small_parquet(spark.range(100).repartition(8), str(tmp_path / "s"), "id")
    assert len(list((tmp_path / "s").glob("*.parquet"))) == 1
    assert [r.id for r in S.read_result(spark, str(tmp_path / "s")).collect()] == list(range(100))


def test_replace_table_modes(spark, tmp_path):
    W.ensure_database(spark, "modes", str(tmp_path / "db"))
    table = "modes.t"
    assert W.replace_table(spark.sql("select 1 a, 'x' b"), table).mode == W.CREATED
    spark.sql("create or replace view modes.v as select a from modes.t")
    assert W.replace_table(spark.sql("select 'y' b, 2 a union all select 'z', 3"), table) == W.LoadResult(table, 2, W.RELOADED)
    assert sorted(r.a for r in spark.table("modes.v").collect()) == [2, 3]
    assert W.replace_table(spark.table(table).limit(0), table).mode == W.SKIPPED
    assert spark.table(table).count() == 2
    assert W.replace_table(spark.table(table).where("a = 3"), table).rows == 1
    assert W.replace_table(spark.sql("select 1 a, 2 c"), table).mode == W.RECREATED
    assert spark.table(table).columns == ["a", "c"]


def test_failed_load_leaves_the_table(spark, tmp_path):
    W.ensure_database(spark, "safe", str(tmp_path / "db"))
    W.replace_table(spark.sql("select 1 a"), "safe.t")
    with pytest.raises(LoadError):
        W.replace_table(spark.sql("select cast(raise_error('no') as int) a"), "safe.t")
    assert spark.table("safe.t").count() == 1


def test_a_load_that_overflows_leaves_the_old_rows(spark, tmp_path):
    W.ensure_database(spark, "kept", str(tmp_path / "db"))
    W.replace_table(spark.sql("select cast(id as int) a from range(5)"), "kept.t")
    with pytest.raises(LoadError):
        W.replace_table(spark.sql("select id + 3000000000 a from range(9)"), "kept.t")
    assert sorted(r.a for r in spark.table("kept.t").collect()) == [0, 1, 2, 3, 4]
    assert W.replace_table(spark.sql("select id a from range(2)"), "kept.t").mode == W.RELOADED
    # The rows before stay for readers until the next load.
    assert spark.table("kept.t").dtypes == [("a", "int")] and len(list((tmp_path / "db").iterdir())) == 2
    W.replace_table(spark.sql("select id a from range(3)"), "kept.t")
    assert len(list((tmp_path / "db").iterdir())) == 2 and spark.table("kept.t").count() == 3


def test_readers_of_the_replaced_rows_go_on(spark, tmp_path):
    W.ensure_database(spark, "read", str(tmp_path / "db"))
    W.replace_table(spark.sql("select id a from range(5)"), "read.t")
    held = spark.table("read.t")
    W.replace_table(spark.sql("select id a from range(2)"), "read.t")
    assert held.count() == 5 and spark.table("read.t").count() == 2


def test_several_tables_are_switched_together(spark, tmp_path, monkeypatch):
    W.ensure_database(spark, "many", str(tmp_path / "db"))
    names = ["many.a", "many.b", "many.c"]
    assert [r.mode for r in W.replace_tables({n: spark.sql("select 1 v") for n in names}).values()] == [W.CREATED] * 3
    bad = spark.sql("select cast(raise_error('no') as int) v")
    with pytest.raises(LoadError, match="many.c"):
        W.replace_tables({n: bad if n == "many.c" else spark.sql("select 2 v union all select 3") for n in names})
    assert [spark.table(n).count() for n in names] == [1, 1, 1]
    point_at = W._Load.point_at

    def fail(load, path, previous):
        if load.table == "many.c" and path == load.path:
            raise ValueError("no")
        point_at(load, path, previous)

    monkeypatch.setattr(W._Load, "point_at", fail)
    with pytest.raises(LoadError, match="many.c"):
        W.replace_tables({n: spark.sql("select 2 v union all select 3") for n in names} | {"many.d": spark.sql("select 1 v")})
    assert [spark.table(n).count() for n in names] == [1, 1, 1] and not spark.catalog.tableExists("many.d")
    assert len(list((tmp_path / "db").iterdir())) == 3


def test_repeated_keys_are_not_published(spark, tmp_path):
    W.ensure_database(spark, "once", str(tmp_path / "db"))
    W.replace_table(spark.sql("select 1 a"), "once.t", [("a",)])
    with pytest.raises(LoadError):
        W.replace_table(spark.sql("select 2 a union all select 2"), "once.t", [("a",)])
    assert [r.a for r in spark.table("once.t").collect()] == [1]


def test_freshness_counts_parts_of_hours(spark):
    df = spark.sql("select timestamp_ntz '2011-12-09 12:00:00' sale_date")
    ages = {(26, 0): "pass", (26, 30): "warn", (72, 0): "warn", (72, 30): "error"}
    for (hours, minutes), status in ages.items():
        now = datetime(2011, 12, 9, 12) + timedelta(hours=hours, minutes=minutes)
        row = C.check_freshness(df, now).first()
        assert (row.age_hours, row.status) == (hours, status)


def test_reconciliations(spark):
    detail = priced(spark)
    aggregate = revenue_by_product_date(detail)
    assert C.totals_agree(detail, aggregate).count() == 0
    off = C.totals_agree(detail, aggregate.where("product_id != '21232'")).first()
    assert off.difference == Decimal("5.00")
    days = daily_summary(aggregate)
    assert C.daily_totals_agree(detail, days).count() == 0
    shifted = days.withColumn("sale_date", F.date_add("sale_date", 1))
    assert sorted(float(r.difference) for r in C.daily_totals_agree(detail, shifted).collect()) == [20.0, 85.0, 105.0]


def test_row_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert C.check_not_null(df, "k").count() == 2
    assert [(r.k, r.occurrences) for r in C.check_unique(df, "k").collect()] == [(1, 2)]
    assert [(r.v, r.occurrences) for r in C.check_accepted_values(df, "v", ["a", "b"]).collect()] == [("c", 2)]


@pytest.mark.parametrize("now, status", [(datetime(2010, 1, 2), "pass"), (datetime(2010, 1, 2, 4), "warn"), (datetime(2010, 1, 5), "error")])
def test_freshness(spark, now, status):
    df = spark.createDataFrame([(date(2010, 1, 1),)], "sale_date date")
    assert C.check_freshness(df, now).first().status == status
    assert C.check_freshness(df.limit(0), now).first().status == "error"


def test_ranking_coherence(spark):
    rows = [(1, "a", 60.0, 60.0), (2, "b", 101.0, 70.0), (3, "c", 10.0, 65.0), (4, "d", 1.0, 120.0)]
    ranking = spark.createDataFrame(rows, "position int, product_id string, share_pct double, cumulative_share_pct double")
    assert [(r.position, r.reason) for r in C.ranking_is_coherent(ranking).orderBy("position").collect()] == [
        (2, C.SHARE_OUT_OF_RANGE), (3, C.CUMULATIVE_FALLS), (4, C.CUMULATIVE_OUT_OF_RANGE)
    ]


def test_checks_keep_their_failures(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    checks = [
        C.Check("nulls", frame=df, predicate=F.col("k").isNull()),
        C.Check("fine", frame=df, predicate=F.col("k") > 5),
        C.Check("gaps", lambda: df.where("k = 1"), severity="warn"),
    ]
    assert C.run_checks(checks, str(tmp_path / "f")) == [
        {"check": "nulls", "violations": 1, "status": "fail"},
        {"check": "fine", "violations": 0, "status": "pass"},
        {"check": "gaps", "violations": 1, "status": "warn"},
    ]
    assert spark.read.parquet(str(tmp_path / "f" / "nulls")).count() == 1
