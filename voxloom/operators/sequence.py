"""Numbering, ranking and choosing one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType


def first_seen_index(df: DataFrame, column: str, position: str, name: str) -> DataFrame:
    """Dense number of each value in order of first appearance, from 0.

    The numbering runs over the distinct values, one small row each, not over the table;
    where positions are whole numbers, in spans of them.
    """
    first = df.groupBy(column).agg(F.min(position).alias("_first"))
    whole = isinstance(first.schema["_first"].dataType, IntegralType)
    numbered = number_within(first, None, ["_first"], name, F.shiftright(F.col("_first").cast("long"), 16) if whole else None)
    numbered = numbered.withColumn(name, F.col(name).cast("int"))
    return df.join(numbered.select(F.col(column).alias("_k"), name), F.col(column).eqNullSafe(F.col("_k"))).drop("_k")


def number_within(df: DataFrame, group: str | None, order: list, name: str, bucket: Column | None = None) -> DataFrame:
    """Running number within a group, from 0.

    ``bucket`` splits a large group: a value that never falls along the order.  Rows are
    then sorted within their bucket only, and start where the buckets before it end.
    """
    key = [group] if group else []
    if bucket is None:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*(key or [F.lit(1)])).orderBy(*order)) - 1)
    d = df.withColumn("_b", bucket)
    # one small row per bucket
    before = Window.partitionBy(*(key or [F.lit(1)])).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    start = d.groupBy(*key, "_b").agg(F.count("*").alias("_n")).withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    j = attach(d, start, [*key, "_b"])
    return j.withColumn(name, (F.col("_start") + F.row_number().over(Window.partitionBy(*key, "_b").orderBy(*order)) - 1)).drop("_b", "_start")


def attach(df: DataFrame, per: DataFrame, keys: list[str]) -> DataFrame:
    """The columns of ``per`` (a row per key) beside each row; null keys match each other."""
    other = per.withColumnsRenamed({c: f"_key{i}" for i, c in enumerate(keys)})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_key{i}")) for i, c in enumerate(keys)])
    return df.join(other, same).drop(*[f"_key{i}" for i in range(len(keys))])


def relabel(df: DataFrame, group: str, label: str, name: str) -> DataFrame:
    """Labels of a group as 0, 1, 2, ... in their order; over the distinct labels only."""
    labels = df.select(group, label).distinct()
    labels = labels.withColumn(name, F.dense_rank().over(Window.partitionBy(group).orderBy(label)) - 1)
    return df.join(labels, [group, label])


def keep_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in the given order (as ``struct`` minimum, combined
    before the shuffle, so that a key repeated very often is no burden)."""
    return _one(df, key, order, F.min)


def keep_last(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return _one(df, key, order, F.max)


def _one(df: DataFrame, key: list[str], order: list[Column], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    o = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    best = df.groupBy(*key).agg(pick(F.struct(o.alias("_order"), *rest)).alias("_r"))
    return best.select(*key, *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*df.columns)


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``new`` take the place of rows of ``old`` with the same key."""
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def shuffled_rank(df: DataFrame, group: str | None, seed_columns: list[str], name: str, seed: int = 42) -> DataFrame:
    """A fixed random order within a group, from a hash of the seed and the columns.

    Without a group the whole table is ordered: in buckets by the hash's first digits, so
    that no task sorts all of it.
    """
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in seed_columns]))
    if group:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(group).orderBy(h, *seed_columns)))
    d = number_within(df.withColumn("_h", h), None, ["_h", *seed_columns], name, F.substring("_h", 1, 3))
    return d.withColumn(name, (F.col(name) + 1).cast("int")).drop("_h")
