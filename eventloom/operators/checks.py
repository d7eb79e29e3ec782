"""Data checks. Each returns the rows that break the rule, so empty means passed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def is_outside(column: str, low=None, high=None) -> Column:
    """Value outside [low, high]; a NULL value is not."""
    bounds = []
    if low is not None:
        bounds.append(F.col(column) >= low)
    if high is not None:
        bounds.append(F.col(column) <= high)
    if not bounds:
        raise ValueError("give a lower or an upper bound")
    return ~reduce(lambda a, b: a & b, bounds)


def is_out_of_order(earlier: str, later: str) -> Column:
    return F.col(later) < F.col(earlier)


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; NULLs are not counted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .where("row_count > 1")
    )


def check_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(column))


def check_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts; NULL passes."""
    return (
        df.where(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
    )


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*columns).agg(F.count("*").alias("row_count")).where("row_count > 1")


def check_between(
    df: DataFrame, column: str, low=None, high=None, row_condition: Column | str | None = None
) -> DataFrame:
    """Rows outside [low, high] among those meeting ``row_condition``; NULL passes."""
    rows = df if row_condition is None else df.where(row_condition)
    return rows.where(is_outside(column, low, high))


def check_order(df: DataFrame, earlier: str, later: str) -> DataFrame:
    """Rows where ``later`` lies before ``earlier``; NULLs pass."""
    return df.where(is_out_of_order(earlier, later))


def check_first_is_earliest(lifecycle: DataFrame, opens: DataFrame) -> DataFrame:
    """Lifecycle rows whose author opened an earlier item in the same repository."""
    chosen = lifecycle.select("repo_id", "pr_number", "pr_author_id", "opened_at")
    others = opens.select(
        F.col("repo_id").alias("_repo_id"),
        F.col("pr_author_id").alias("_author_id"),
        F.col("pr_created_at").alias("_created_at"),
        F.col("pr_number").alias("earlier_pr_number"),
    )
    earlier = (F.col("_created_at") < F.col("opened_at")) | (
        (F.col("_created_at") == F.col("opened_at")) & (F.col("earlier_pr_number") < F.col("pr_number"))
    )
    same_author = (F.col("repo_id") == F.col("_repo_id")) & (F.col("pr_author_id") == F.col("_author_id"))
    return chosen.join(others, same_author & earlier, "inner").drop("_repo_id", "_author_id", "_created_at")


def check_attributable(fact: DataFrame, responses: DataFrame) -> DataFrame:
    """Facts whose first response time no human response has."""
    # any one response at that time will do, so copies are dropped map-side first
    human = responses.select(
        F.col("repo_id").alias("_repo_id"),
        F.col("pr_number").alias("_pr_number"),
        F.col("responded_at").alias("_responded_at"),
    ).distinct()
    same = [
        F.col("repo_id") == F.col("_repo_id"),
        F.col("pr_number") == F.col("_pr_number"),
        F.col("first_review_at") == F.col("_responded_at"),
    ]
    return fact.where("first_review_at IS NOT NULL").join(human, same, "left_anti")


@dataclass(frozen=True)
class Check:
    """A named check: the failing ``rows``, or those of ``rows`` meeting ``failing``."""

    name: str
    rows: DataFrame
    failing: Column | None = None
    severity: str = "error"


def check_report(checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, severity, number of failing rows and status.

    Checks with a ``failing`` condition on the same DataFrame share one scan.
    """
    by_table: dict[int, list[Check]] = {}
    for check in checks:
        by_table.setdefault(id(check.rows), []).append(check)
    counted = [_count_failures(group) for group in by_table.values()]
    status = F.when(F.col("failures") == 0, "pass").when(F.col("severity") == "warn", "warn").otherwise("fail")
    return reduce(DataFrame.unionByName, counted).withColumn("status", status)


def _count_failures(checks: list[Check]) -> DataFrame:
    counts = [
        F.count("*") if c.failing is None else F.count_if(F.coalesce(c.failing, F.lit(False))) for c in checks
    ]
    totals = checks[0].rows.agg(*[count.alias(f"_{i}") for i, count in enumerate(counts)])
    lines = [
        F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"), F.col(f"_{i}").alias("failures"))
        for i, c in enumerate(checks)
    ]
    return totals.select(F.inline(F.array(*lines)))
