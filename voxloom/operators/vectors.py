"""Vector operators as expressions over arrays, and per-group statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def is_valid(a: Column, dim: int) -> Column:
    """Whether a vector has ``dim`` finite values that are not all zero."""
    fine = F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(a) == dim) & fine & F.exists(a, lambda x: x != 0), F.lit(False))


def with_unit(df: DataFrame, vector: str, name: str = "unit") -> DataFrame:
    """``unit`` with the norm computed once per row."""
    d = df.withColumn("_n", norm(F.col(vector)))
    return d.withColumn(name, F.transform(vector, lambda x: x.cast("double") / F.when(F.col("_n") > 0, F.col("_n")).otherwise(1.0))).drop("_n")


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n > 0, dot(a, b) / n)


def rescaled(cos: Column) -> Column:
    """Similarity from 0 to 1, four digits."""
    return F.round((cos + 1) / 2, 4)


def positions(df: DataFrame, group: list[str], vector: str, **how: Callable[[Column], Column]) -> DataFrame:
    """Aggregates of each position of the vectors of a group, as arrays in the order of the
    positions.  The values are combined per task before the shuffle, so a group that holds
    many vectors sends no more than one that holds few."""
    each = df.select(*group, F.posexplode(vector).alias("_pos", "_x"))
    per = each.groupBy(*group, "_pos").agg(*[f(F.col("_x").cast("double")).alias(n) for n, f in how.items()])
    rows = per.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("_pos", *how))).alias("_a"))  # as long as a vector
    return rows.select(*group, *[F.col("_a").getField(n).alias(n) for n in how])


def elementwise(df: DataFrame, group: list[str], vector: str, dim: int, how) -> DataFrame:
    """``group, n, centroid``: ``how(column)`` of each position of a group's vectors.

    All positions are aggregated side by side in one pass, without a row per position: the
    form for groups of few vectors each (``positions`` is the one for groups of many).
    """
    aggs = [how(F.element_at(vector, i + 1).cast("double")).alias(f"_v{i}") for i in range(dim)]
    return df.groupBy(*group).agg(*aggs, F.count("*").alias("n")).select(*group, "n", F.array(*[F.col(f"_v{i}") for i in range(dim)]).alias("centroid"))


def weighted_centroids(df: DataFrame, group: list[str], vector: str, weight: str, dim: int, min_samples: int = 2) -> DataFrame:
    """Weighted mean of unit vectors, brought to length 1; groups of fewer samples are left out."""
    u = with_unit(df, vector, "_u")
    w = F.col(weight).cast("double")
    total = F.sum(w)
    c = elementwise(u, group, "_u", dim, lambda x: F.sum(x * w) / F.nullif(total, F.lit(0.0)))
    mean = df.groupBy(*group).agg(F.avg(weight).alias("avg_confidence"))
    return with_unit(c.where(F.col("n") >= min_samples), "centroid", "centroid_unit").join(mean, group).drop("centroid").withColumnRenamed("centroid_unit", "centroid")


def outliers(df: DataFrame, group: str, identifier: str, vector: str, dim: int, limit: float = 3.0, min_left: int = 10) -> DataFrame:
    """``group, identifier, max_z, outlier``: any position further than ``limit`` population
    standard deviations from its group's mean.  Positions that do not vary mark nobody; if
    ``min_left`` or fewer would be left in a group, none of it is an outlier."""
    stats = positions(df, [group], vector, _m=F.avg, _s=F.stddev_pop)
    z = F.zip_with(F.zip_with(vector, "_m", lambda x, m: F.abs(x.cast("double") - m)), "_s", lambda d, s: F.when(s > 1e-12, d / s).otherwise(0.0))
    d = df.join(stats, group).select(group, identifier, F.array_max(z).alias("max_z"))
    left = d.groupBy(group).agg(F.count_if(F.col("max_z") <= limit).alias("_left"))
    return d.join(left, group).select(group, identifier, "max_z", ((F.col("max_z") > limit) & (F.col("_left") > min_left)).alias("outlier"))


def nearest_centroid(points: DataFrame, centroids: DataFrame, group: str, point: str, vector: str, label: str, centroid: str) -> DataFrame:
    """Best centroid of the same group by dot product; confidence is half the product."""
    j = points.select(group, point, vector).join(centroids.select(group, label, centroid), group)
    s = j.withColumn("_s", dot(F.col(vector), F.col(centroid)))
    best = s.groupBy(group, point).agg(F.max(F.struct("_s", (-F.col(label)).alias("l"))).alias("_b"))
    return best.select(group, point, (-F.col("_b.l")).alias(label), (F.col("_b._s") * 0.5).alias("confidence"))


def pairs_within(df: DataFrame, group: str, identifier: str, vector: str, dim_unit: bool = True) -> DataFrame:
    """Cosines of the pairs ``a < b`` inside groups that are small by nature (the speakers
    of a book)."""
    u = with_unit(df.select(group, identifier, vector), vector, "u")
    a = u.select(group, F.col(identifier).alias("a"), F.col("u").alias("ua"))
    b = u.select(group, F.col(identifier).alias("b"), F.col("u").alias("ub"))
    return a.join(b, group).where("a < b").select(group, "a", "b", dot(F.col("ua"), F.col("ub")).alias("cos"))
