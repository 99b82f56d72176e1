from datetime import date

import pytest
from frames import DEFECTS, VALID, lines, priced, with_defects
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.errors import QualityError
from tallywell.operators import quality as Q
from tallywell.operators.dedup import flag_duplicates
from tallywell.operators.revenue import revenue_by_product_date

LIMITS = Q.Limits(as_of=date(2026, 1, 1))


def classify(df, limits=LIMITS):
    rules = Q.build_rules(limits, "ordinal")
    return Q.apply_rules(df, rules), rules


def test_one_defect_per_rule(spark):
    classified, rules = classify(with_defects(spark))
    counts = {r.rule: r.rejected_rows for r in Q.rule_counts(classified, rules).collect()}
    assert counts == {
        S.RULE_NULL_KEYS: 1, S.RULE_PRODUCT: 0, S.RULE_DATE: 1, S.RULE_QUANTITY: 1, S.RULE_PRICE: 1, S.RULE_DUPLICATE: 1,
    }
    assert Q.valid_rows(classified).count() == 5
    reasons = [r.reject_reason for r in classified.orderBy("ordinal").collect()]
    assert reasons == [None] * 5 + [S.RULE_QUANTITY, S.RULE_PRICE, S.RULE_DATE, S.RULE_NULL_KEYS, S.RULE_DUPLICATE]
    stats = Q.quality_stats(classified, rules).first()
    assert float(stats.reject_pct) == 50.0
    assert sum(counts.values()) == stats.rejected_rows
    assert sum(r.rejected_rows for r in Q.reason_counts(Q.rejected_rows(classified)).collect()) == 5


def test_blank_product_has_its_own_rule(spark):
    rows = [*VALID, ("1", "   ", "X", 1, VALID[0][4], "1.00", 1, "FRANCE")]
    classified, _ = classify(lines(spark, rows).withColumn("ordinal", F.monotonically_increasing_id()))
    assert classified.where(F.col("reject_reason") == S.RULE_PRODUCT).count() == 1


def test_first_failing_rule_wins(spark):
    rows = [*VALID, ("1", "22086", "X", -5, VALID[0][4], "99999.00", 1, "FRANCE")]
    classified, _ = classify(lines(spark, rows).withColumn("ordinal", F.monotonically_increasing_id()))
    assert Q.rejected_rows(classified).first().reject_reason == S.RULE_QUANTITY


def test_limits_can_change(spark):
    classified, _ = classify(with_defects(spark).where("ordinal < 5"), Q.Limits(max_price="5.0", as_of=LIMITS.as_of))
    assert Q.valid_rows(classified).count() == 3


def test_today_is_accepted_and_tomorrow_is_not(spark):
    df = spark.sql("select timestamp_ntz'2010-05-05 23:59:59' event_ts union all select timestamp_ntz'2010-05-06 00:00:00'")
    assert [r[0] for r in df.select(Q.date_out_of_range(df, date(2010, 5, 5))).collect()] == [False, True]


def test_rules_skip_missing_columns(spark):
    df = with_defects(spark).select("invoice_id", "ordinal")
    classified, _ = classify(df)
    assert Q.rejected_rows(classified).count() == 0


def test_gates(spark):
    rules = Q.build_rules(LIMITS, "ordinal")
    zero = {r.name: 0 for r in rules}
    with pytest.raises(QualityError, match="no row passed"):
        Q.quality_gate({"valid_rows": 0, "input_rows": 3, "rejected_rows": 3, **zero}, rules, 99)
    with pytest.raises(QualityError, match="37.5"):
        Q.quality_gate({"valid_rows": 5, "input_rows": 8, "rejected_rows": 3, **zero}, rules, 5.0)
    Q.quality_gate({"valid_rows": 85, "input_rows": 100, "rejected_rows": 15, **zero}, rules, 15.0)


def _copies(spark, hot):
    """A key of ``hot`` copies, 50 keys of two, 40 of one and 3 rows of null key."""
    sizes = [("hot", hot), *[(f"k{i}", 2) for i in range(50)], *[(f"s{i}", 1) for i in range(40)], (None, 3)]
    rows = [(key, 1, n) for key, times in sizes for n in range(times)]
    return spark.createDataFrame(rows, "a string, b int, n int").repartition(6)


@pytest.mark.parametrize("hot", [70, 5000])
def test_duplicates_with_a_hot_key(spark, hot):
    """A third and nearly all of the rows are copies of one key."""
    df = _copies(spark, hot)
    flagged = flag_duplicates(df, ["a", "b"], "n")
    assert flagged.columns == [*df.columns, "is_duplicate"]
    assert flagged.count() == df.count()
    assert flagged.where("is_duplicate").count() == hot - 1 + 50 + 2
    assert flagged.where("is_duplicate != (n > 0)").count() == 0


def test_keys_of_equal_hash_stay_apart(spark):
    """A null leaves the hash unchanged, so these two keys share theirs."""
    rows = [(None, "x", n) for n in range(5)] + [("x", None, n) for n in range(5, 6)]
    df = spark.createDataFrame(rows, "a string, b string, n int")
    assert df.selectExpr("xxhash64(a, b) h").distinct().count() == 1
    flagged = flag_duplicates(df, ["a", "b"], "n")
    assert sorted(r.n for r in flagged.where("is_duplicate").collect()) == [1, 2, 3, 4]


def test_copies_of_rejected_rows_are_not_counted(spark):
    rows = [VALID[0], VALID[0], DEFECTS[0], DEFECTS[0]]
    df = lines(spark, rows).withColumn("ordinal", F.monotonically_increasing_id())
    classified, rules = classify(df)
    reasons = [r.reject_reason for r in classified.orderBy("ordinal").collect()]
    assert reasons == [None, S.RULE_DUPLICATE, S.RULE_QUANTITY, S.RULE_QUANTITY]
    # Without the rules before it, the duplicate rule marks copies of all rows.
    alone = Q.apply_rules(df, rules[-1:]).orderBy("ordinal").collect()
    assert [r.reject_reason for r in alone] == [None, S.RULE_DUPLICATE] * 2
    # A rule that copies may answer differently does not hide a first copy.
    other = Q.QualityRule("other", "", lambda d: F.col("ordinal") == F.lit(df.agg(F.min("ordinal")).first()[0]))
    mixed = Q.apply_rules(df, [other, rules[-1]]).orderBy("ordinal").collect()
    assert [r.reject_reason for r in mixed] == ["other", S.RULE_DUPLICATE, None, S.RULE_DUPLICATE]
    plan = classified._jdf.queryExecution().optimizedPlan().toString().splitlines()
    grouped = next(i for i, line in enumerate(plan) if "Aggregate [" in line)
    assert any("Filter" in line and "quantity" in line for line in plan[grouped:])


def test_the_plan_is_the_same_at_every_size(spark):
    def nodes(rows):
        df = spark.createDataFrame([(n % 7, 1, n) for n in range(rows)], "a int, b int, n int")
        plan = flag_duplicates(df, ["a", "b"], "n")._jdf.queryExecution().optimizedPlan().toString()
        return [line.strip(" +-:").split(" ")[0] for line in plan.splitlines()]

    assert nodes(5) == nodes(20_000)



def test_verify_aggregate(spark):
    good = revenue_by_product_date(priced(spark))
    assert Q.verify_aggregate(good) == {"aggregate_rows": 4, "repeated_keys": 0, "negative_revenue": 0, "null_revenue": 0}
    with pytest.raises(QualityError, match="repeat in 4 rows"):
        Q.verify_aggregate(good.unionByName(good))
    negative = good.withColumn("total_revenue", -F.col("total_revenue"))
    with pytest.raises(QualityError, match="4 rows with negative revenue"):
        Q.verify_aggregate(negative)
    with pytest.raises(QualityError, match="empty"):
        Q.verify_aggregate(good.limit(0))
    with pytest.raises(QualityError, match="lacks the columns"):
        Q.verify_aggregate(good.drop("sale_date"))
    with pytest.raises(QualityError, match="negative.*without revenue|without revenue"):
        Q.verify_aggregate(good.withColumn("total_revenue", F.lit(None).cast("decimal(28,2)")))


def test_keys_of_the_aggregate_are_counted_in_shares_of_their_own(spark):
    day = date(2020, 1, 1)
    rows = [(day, "a", 1), (day, "a", -2), (None, "a", None), (None, "a", 4), (day, None, 5)]
    df = spark.createDataFrame(rows, "sale_date date, product_id string, line_revenue int")
    summed = df.groupBy("sale_date", "product_id").agg(F.sum("line_revenue").alias("total_revenue"))
    found = Q.aggregate_invariants(summed)
    assert tuple(found.first()) == (3, 0, 1, 0)
    assert tuple(Q.aggregate_invariants(df.withColumnRenamed("line_revenue", "total_revenue")).first()) == (5, 2, 1, 1)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange hashpartitioning") == 2


def test_defects_are_the_known_ones():
    assert len(DEFECTS) == 5
