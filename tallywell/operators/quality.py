"""Ordered quality rules, quarantine split, gates and output invariants."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywell import schema as S
from tallywell.errors import QualityError
from tallywell.functions.text import strip
from tallywell.operators.dedup import flag_duplicates
from tallywell.session import deal


@dataclass(frozen=True)
class QualityRule:
    """A rule names the rows it rejects.

    ``rejects`` builds the predicate; ``prepare`` may add a helper column first,
    which is dropped once the reasons are known. ``narrows`` says that the rule looks at
    the duplicate keys only, so that copies share its verdict, and rejects enough for its
    price; ``undecided`` that ``prepare`` also takes a predicate of the rows that no earlier
    rule of that kind rejects.
    """

    name: str
    description: str
    rejects: Callable[[DataFrame], Column]
    prepare: Callable[..., DataFrame] | None = None
    helper: str | None = None
    narrows: bool = False
    undecided: bool = False


@dataclass(frozen=True)
class Limits:
    """Business limits of the catalogue."""

    min_quantity: int = S.MIN_QUANTITY
    min_price: str = S.MIN_PRICE
    max_price: str = S.MAX_PRICE
    max_reject_pct: float = S.MAX_REJECT_PCT
    as_of: date | None = None


def _if_present(df: DataFrame, column: str, predicate: Callable[[Column], Column]) -> Column:
    return predicate(F.col(column)) if column in df.columns else F.lit(False)


def null_keys(df: DataFrame) -> Column:
    """DQ1: a key column is null; only the columns that exist are checked."""
    present = [F.col(c).isNull() for c in S.NEVER_NULL_COLUMNS if c in df.columns]
    return reduce(lambda a, b: a | b, present, F.lit(False))


def blank_product(df: DataFrame) -> Column:
    """DQ2: the product is null or blank."""
    return _if_present(df, "product_id", lambda c: c.isNull() | (F.length(strip(c)) == 0))


def date_out_of_range(df: DataFrame, as_of: date | None) -> Column:
    """DQ3: the time is null, before 2000, or later than the day of the run."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    end = F.date_add(today, 1).cast("timestamp_ntz")
    start = F.lit(S.MIN_DATE).cast("timestamp_ntz")
    return _if_present(df, "event_ts", lambda c: c.isNull() | (c < start) | (c >= end))


def quantity_too_low(df: DataFrame, least: int) -> Column:
    """DQ4: the quantity is below the minimum; null counts as zero."""
    return _if_present(df, "quantity", lambda c: F.coalesce(c, F.lit(0)) < least)


def price_out_of_range(df: DataFrame, lowest: str, highest: str) -> Column:
    """DQ5: the price is outside the limits; null counts as minus one."""
    low, high = F.lit(lowest).cast(S.PRICE), F.lit(highest).cast(S.PRICE)
    return _if_present(
        df, "unit_price", lambda c: ~F.coalesce(c, F.lit(-1).cast(S.PRICE)).between(low, high)
    )


def duplicate_keys(df: DataFrame) -> list[str]:
    """The key columns that exist; with fewer than three a match proves nothing."""
    keys = [k for k in S.DUPLICATE_KEYS if k in df.columns]
    return keys if len(keys) >= 3 else []


def build_rules(limits: Limits = Limits(), order_by: str | None = None) -> list[QualityRule]:
    """DQ7: the catalogue in the order that decides the reason of a row."""

    def mark_copies(df: DataFrame, undecided: Column) -> DataFrame:
        keys = duplicate_keys(df)
        if not keys:
            return df.withColumn("is_duplicate", F.lit(False))
        if order_by is None:
            raise QualityError("the duplicate rule needs a column that orders the rows")
        return flag_duplicates(df, keys, order_by, among=undecided)

    return [
        QualityRule(S.RULE_NULL_KEYS, "no key column may be empty", null_keys),
        QualityRule(S.RULE_PRODUCT, "every row needs a product code", blank_product),
        QualityRule(
            S.RULE_DATE,
            "the date must be readable and not in the future",
            lambda df: date_out_of_range(df, limits.as_of),
            narrows=True,
        ),
        QualityRule(
            S.RULE_QUANTITY,
            f"the quantity must be at least {limits.min_quantity}",
            lambda df: quantity_too_low(df, limits.min_quantity),
            narrows=True,
        ),
        QualityRule(
            S.RULE_PRICE,
            f"the price must be between {limits.min_price} and {limits.max_price}",
            lambda df: price_out_of_range(df, limits.min_price, limits.max_price),
        ),
        QualityRule(
            S.RULE_DUPLICATE,
            "the same invoice line may not repeat",
            lambda df: F.col("is_duplicate"),
            prepare=mark_copies,
            helper="is_duplicate",
            undecided=True,
        ),
    ]


def _fails(rule: QualityRule, df: DataFrame) -> Column:
    return F.coalesce(rule.rejects(df), F.lit(True))


def apply_rules(df: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """DQ7: add ``reject_reason``, the first failing rule or null.

    A predicate that is null counts as failing. All row-local rules are one
    expression of one projection. Copies are counted among the rows only whose
    reason still depends on it.
    """
    prepared = df
    for place, rule in enumerate(rules):
        if rule.prepare is None:
            continue
        if rule.undecided:
            earlier = [~_fails(r, prepared) for r in rules[:place] if r.narrows]
            prepared = rule.prepare(prepared, reduce(lambda a, b: a & b, earlier, F.lit(True)))
        else:
            prepared = rule.prepare(prepared)
    reasons = [F.when(_fails(rule, prepared), F.lit(rule.name)) for rule in rules]
    reason = F.coalesce(*reasons) if reasons else F.lit(None).cast("string")
    helpers = [rule.helper for rule in rules if rule.helper]
    return prepared.withColumn("reject_reason", reason).drop(*helpers)


def valid_rows(classified: DataFrame) -> DataFrame:
    """DQ8: rows that passed every rule, in the input's own columns."""
    return classified.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_rows(classified: DataFrame) -> DataFrame:
    """DQ8: rejected rows with their reason."""
    return classified.where(F.col("reject_reason").isNotNull())


def count_columns(rules: Sequence[QualityRule]) -> list[Column]:
    """The counters of one pass: input, valid, rejected and each rule."""
    reason = F.col("reject_reason")
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(reason.isNull()).alias("valid_rows"),
        F.count_if(reason.isNotNull()).alias("rejected_rows"),
        *[F.count_if(F.coalesce(reason == r.name, F.lit(False))).alias(r.name) for r in rules],
    ]


def quality_stats(classified: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """DQ9/DQ10: all counters and the reject percentage in one row."""
    counted = classified.agg(*count_columns(rules))
    return counted.withColumn("reject_pct", reject_pct(F.col("rejected_rows"), F.col("input_rows")))


def reject_pct(rejected: Column, total: Column) -> Column:
    """DQ10: per cent with four digits, zero for an empty input."""
    share = F.try_divide(rejected.cast("decimal(18,0)") * 100, total.cast("decimal(18,0)"))
    return F.coalesce(F.round(share, 4), F.lit(0)).cast("decimal(22,4)")


def rule_counts(classified: DataFrame, rules: Sequence[QualityRule]) -> DataFrame:
    """DQ9: one row per rule, zero where a rule found nothing."""
    counted = classified.agg(*count_columns(rules))
    pairs = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("rule_order"),
                F.lit(r.name).alias("rule"),
                F.col(r.name).alias("rejected_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counted.select(F.inline(pairs))


def quality_gate(stats: dict, rules: Sequence[QualityRule], max_reject_pct: float) -> None:
    """DQ11: stop when nothing is valid or too much was rejected."""
    per_rule = {r.name: int(stats[r.name]) for r in rules}
    if int(stats["valid_rows"]) == 0:
        raise QualityError(f"no row passed the quality rules; rejected per rule: {per_rule}")
    total, rejected = int(stats["input_rows"]), int(stats["rejected_rows"])
    pct = round(rejected / total * 100, 4)
    if pct > max_reject_pct:
        raise QualityError(
            f"{pct} per cent of the rows were rejected, more than the accepted "
            f"{max_reject_pct}; rejected per rule: {per_rule}"
        )


def aggregate_invariants(aggregate: DataFrame) -> DataFrame:
    """DQ12: counts of every broken invariant of the aggregate, one row.

    Keys are counted before the global step, so no key group is collected. They are counted
    in small shares, not in the tasks that may still hold the groups of the aggregate; in
    the aggregate's own order of keys the optimizer would leave the shares out.
    """
    keys = ("product_id", "sale_date")
    keyed = deal(aggregate.select(*keys, "total_revenue"), *keys).groupBy(*keys).agg(
        F.count("*").alias("key_rows"),
        F.count_if(F.col("total_revenue") < 0).alias("negative"),
        F.count_if(F.col("total_revenue").isNull()).alias("missing"),
    )
    return keyed.agg(
        F.coalesce(F.sum("key_rows"), F.lit(0)).alias("aggregate_rows"),
        F.coalesce(F.sum(F.col("key_rows") - 1), F.lit(0)).alias("repeated_keys"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("negative_revenue"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("null_revenue"),
    )


def verify_aggregate(aggregate: DataFrame) -> dict[str, int]:
    """DQ12: raise with all problems together, or return the counts."""
    missing = {"sale_date", "product_id", "total_revenue"} - set(aggregate.columns)
    problems = []
    if missing:
        problems.append(f"the aggregate lacks the columns {sorted(missing)}")
        counts = {"aggregate_rows": aggregate.count()}
    else:
        counts = aggregate_invariants(aggregate).first().asDict()
    if counts["aggregate_rows"] == 0:
        problems.append("the aggregate is empty")
    if counts.get("negative_revenue"):
        problems.append(f"{counts['negative_revenue']} rows with negative revenue")
    if counts.get("null_revenue"):
        problems.append(f"{counts['null_revenue']} rows without revenue")
    if counts.get("repeated_keys"):
        problems.append(f"date and product repeat in {counts['repeated_keys']} rows")
    if problems:
        raise QualityError("the aggregate has problems: " + "; ".join(problems))
    return counts


def reason_counts(rejected: DataFrame) -> DataFrame:
    """AG16: rows per reason and the share of all rejections, one decimal."""
    counts = rejected.groupBy("reject_reason").agg(F.count("*").alias("rejected_rows"))
    total = rejected.agg(F.count("*").alias("total"))
    share = F.col("rejected_rows").cast("decimal(18,0)") * 100 / total.scalar().cast("decimal(18,0)")
    return counts.withColumn("share_pct", F.round(share, 1).cast("decimal(22,1)"))
