"""Doing only what is left to do: anti joins, completeness, status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(todo: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``todo`` whose key is not in ``done``; a null key is never done."""
    return todo.join(done.select(*key).distinct(), key, "left_anti")


def existing(todo: DataFrame, known: DataFrame, key: list[str]) -> DataFrame:
    return todo.join(known.select(*key).distinct(), key, "left_semi")


def new_keys(current: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Distinct keys of ``current`` that ``seen`` lacks."""
    return pending(current.select(*key).distinct(), seen, key)


def completed_groups(parts: DataFrame, done: DataFrame, group: str, key: str) -> DataFrame:
    """Relational division: ``group, parts, done_parts, complete``; complete if every part is done."""
    d = done.select(group, key).distinct().withColumn("_d", F.lit(1))
    j = parts.select(group, key).distinct().join(d, [group, key], "left")
    return j.groupBy(group).agg(F.count("*").alias("parts"), F.count("_d").alias("done_parts"), F.bool_and(F.col("_d").isNotNull()).alias("complete"))


def reset_stale(status: DataFrame, column: str = "status") -> DataFrame:
    """What was being processed when the last run ended is pending again."""
    return status.withColumn(column, F.when(F.col(column) == "processing", "pending").otherwise(F.col(column)))


def work_queue(status: DataFrame, catalog: DataFrame, key: list[str], retry_failed: bool = False) -> DataFrame:
    """Keys of the catalog that are not completed (nor failed, unless retried)."""
    s = reset_stale(status)
    s = s.where(F.col("status") != "completed")
    return existing(s if retry_failed else s.where(F.col("status") != "failed"), catalog, key)


def status_counts(status: DataFrame, column: str = "status") -> DataFrame:
    return status.groupBy(column).agg(F.count("*").alias("n"))
