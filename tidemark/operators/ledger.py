"""Cost gates, cost totals, log census and copy totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import money, sign, size
from tidemark.functions.columns import first_match

# Thresholds in USD and what each reason allows.
DEFAULT_BUDGET = "20.00"
TARGET_COST = "10.00"
RETRY_STOP = "15.00"
ACTIONS = {
    "INVALID_BUDGET": "STOP",
    "INVALID_CURRENT_COST": "STOP",
    "BUDGET_EXCEEDED": "TEARDOWN",
    "BUDGET_REACHED": "TEARDOWN",
    "RETRY_STOP": "NO_NEW_COMPUTE",
    "ABOVE_TARGET": "CONTINUE_WITH_CAUTION",
    "TARGET_REACHED": "CONTINUE_WITH_CAUTION",
    "WITHIN_TARGET": "CONTINUE",
}
ALLOWED = ("ABOVE_TARGET", "TARGET_REACHED", "WITHIN_TARGET")


def cost_gate(df: DataFrame, budget: str, cost: str, allow_default: bool = False) -> DataFrame:
    """Classify every (budget, cost) pair: parsed amounts, reason, action and whether work may go on.

    Amounts are rounded half-even to cents after their sign is checked, exactly and of any length; they come out as
    text with two decimals. Only a NULL budget may be replaced by the default, never a malformed one.
    """
    limit = _amount(F.col(budget), sign(F.col(budget)) > 0)
    if allow_default:
        limit = F.when(F.col(budget).isNull(), F.lit(DEFAULT_BUDGET)).otherwise(limit)
    spent = _amount(F.col(cost), sign(F.col(cost)) >= 0)
    rated = df.withColumn("budget_amount", limit).withColumn(
        "cost_amount", F.when(F.col("budget_amount").isNotNull(), spent)
    )
    b, c = F.col("budget_amount"), F.col("cost_amount")
    limit, spent, stop, target = size(b), size(c), size(F.lit(RETRY_STOP)), size(F.lit(TARGET_COST))
    reason = first_match(
        [
            (b.isNull(), "INVALID_BUDGET"),
            (c.isNull(), "INVALID_CURRENT_COST"),
            (spent > limit, "BUDGET_EXCEEDED"),
            (c == b, "BUDGET_REACHED"),
            (spent >= stop, "RETRY_STOP"),
            (spent > target, "ABOVE_TARGET"),
            (spent == target, "TARGET_REACHED"),
        ],
        F.lit("WITHIN_TARGET"),
    )
    rated = rated.withColumn("reason", reason)
    action = first_match([(F.col("reason") == r, a) for r, a in ACTIONS.items()])
    return rated.withColumn("action", action).withColumn("allowed", F.col("reason").isin(*ALLOWED))


def _amount(text: Column, acceptable: Column) -> Column:
    return F.when(acceptable, money(text))


def cost_snapshot(
    costs: DataFrame, group: str, cost: str, groups: DataFrame, group_key: str
) -> DataFrame:
    """Total cost of each listed group. A group without data is pending and has no amount, never 0."""
    totals = costs.groupBy(group).agg(F.round(F.sum(F.col(cost).cast("decimal(38,6)")), 6).alias("amount"))
    listed = groups.select(F.col(group_key).alias(group)).distinct()
    label = F.when(F.col("amount").isNull(), "PENDING BILLING SETTLEMENT").otherwise("CURRENT COST SNAPSHOT")
    return listed.join(totals, group, "left").withColumn("label", label)


def census(df: DataFrame, type_column: str) -> DataFrame:
    """Records per type, most frequent first."""
    counted = df.groupBy(type_column).agg(F.count(F.lit(1)).alias("record_count"))
    return counted.orderBy(F.desc("record_count"), type_column)


def copy_totals(
    activities: DataFrame, by: Sequence[str] = (), read: str = "rows_read", copied: str = "rows_copied", size: str = "bytes_written"
) -> DataFrame:
    """Rows read, rows copied and bytes over copy activities, and whether reads equal copies."""
    totals = activities.groupBy(*by).agg(
        F.count(F.lit(1)).alias("activities"),
        F.sum(read).alias("rows_read"),
        F.sum(copied).alias("rows_copied"),
        F.sum(size).alias("bytes_written"),
    )
    return totals.withColumn("reconciled", F.col("rows_read") == F.col("rows_copied"))


def activities_of(receipts: DataFrame, column: str = "copy_activities") -> DataFrame:
    """Copy receipts hold an array of activities; one row each."""
    return receipts.select(F.explode(column).alias("_a")).select("_a.*")
