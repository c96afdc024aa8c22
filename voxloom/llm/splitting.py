"""Problem 7: splits in given shares that keep related records together.

Records that share any entity belong to one component (large-star small-star over the
entities).  Every component's hashed identifier falls into one of the splits' ranges,
whatever its size, so the split of a component depends on nothing but its identifier and
the shares: a table that grows moves no component.  The price is that a few very large
components may pull the reached shares away from the targets; ``split_report`` says how far.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.components import connected_components
from voxloom.session import materialize


def _unit(key: Column, seed: int) -> Column:
    """A number in [0, 1) from the MD5 of a key."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def record_components(df: DataFrame, identifier: str, entities: list[str], no_entity: dict[str, list] | None = None) -> DataFrame:
    """``identifier, component, n_rows`` for every distinct identifier.

    Null entity values, and those listed in ``no_entity``, link nothing; a record without
    any entity is a component of its own.  A null identifier is a record like any other.
    """
    no_entity = no_entity or {}
    rid = F.coalesce(F.col(identifier).cast("string"), F.lit("\x00null"))

    def node(c: str) -> Column:
        bad = F.col(c).isNull()
        if no_entity.get(c):
            bad = bad | F.col(c).isin(no_entity[c])
        return F.when(~bad, F.md5(F.concat(F.lit(c + "="), F.col(c).cast("string"))))

    pairs = df.select(F.col(identifier).alias("_id"), rid.alias("_r"), F.array_compact(F.array(*[node(c) for c in entities])).alias("_e"))
    per = pairs.groupBy("_id", "_r").agg(F.count("*").alias("n_rows"), F.array_distinct(F.flatten(F.collect_set("_e"))).alias("_e"))
    per = materialize(per.withColumn("_first", F.coalesce(F.array_min("_e"), F.md5(F.concat(F.lit("="), "_r")))), "records")
    edges = per.where(F.size("_e") > 1).select(F.col("_first").alias("u"), F.explode("_e").alias("v")).where("u != v")
    comp = connected_components(edges)
    out = per.join(comp, per["_first"] == comp["node"], "left")
    return out.select(F.col("_id").alias(identifier), F.coalesce("component", "_first").alias("component"), "n_rows")


def assign_splits(df: DataFrame, identifier: str, entities: list[str], shares: dict[str, float], no_entity: dict[str, list] | None = None, seed: int = 42) -> DataFrame:
    """``identifier, component, split`` for every distinct identifier of ``df``.

    ``shares`` are relative and must be positive in sum; a split of share 0 gets nothing.
    The ranges follow the splits' names in order.  An empty table gives an empty result.
    """
    total = sum(shares.values())
    if not shares or total <= 0 or min(shares.values()) < 0:
        raise ValueError("shares must be non-negative and not all zero")
    records = record_components(df, identifier, entities, no_entity)
    bounds, at = [], 0.0
    for s in sorted(s for s, w in shares.items() if w > 0):
        at += shares[s] / total
        bounds.append((s, at))
    u = _unit(F.col("component"), seed)
    split = reduce(lambda rest, b: F.when(u < b[1], b[0]).otherwise(rest), reversed(bounds[:-1]), F.lit(bounds[-1][0]))
    return records.select(identifier, "component", split.alias("split"))


def split_report(assigned: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` (``split, target_share``) with records, components, the share reached and
    the share of all records that the split's largest component holds."""
    comp = assigned.groupBy("split", "component").agg(F.count("*").alias("n"))
    got = comp.groupBy("split").agg(F.sum("n").alias("n_segments"), F.count("*").alias("n_components"), F.max("n").alias("_largest"))
    r = targets.select("split", "target_share").join(got, "split", "left").fillna(0)
    total = F.nullif(F.sum("n_segments").over(_whole()), F.lit(0))
    share = lambda c: F.coalesce(F.col(c) / total, F.lit(0.0))
    return r.withColumns({"reached_share": share("n_segments"), "largest_component_share": share("_largest")}).drop("_largest")


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # over a handful of report rows
