"""Searches for segment bounds against a transcriber, as bounded steps.

Both searches come in two forms: declarative, over an exploded table of steps and an
expression that answers for a step, and imperative, with a Python transcriber called only
for the steps the search visits (``mapInPandas``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Extension step and most steps, trim step, steps checked around the found one, shortest clip.
EXTEND_STEP, EXTEND_MOST, TRIM_STEP, AROUND, SHORTEST = 0.1, 50, 100, 5, 500


def extend_declared(df: DataFrame, key: list[str], status_at: Callable[[Column], Column]) -> DataFrame:
    """``key, extensions``: steps by which the end moves until the text is complete.

    ``status_at(step)`` gives Complete, Incomplete, Empty or null (failure).  The search
    stops at the first step that is not Incomplete; an empty result is not counted; a
    failure gives 0; 50 steps at most.
    """
    s = df.select(*key, F.explode(F.sequence(F.lit(0), F.lit(EXTEND_MOST))).alias("step"), *[c for c in df.columns if c not in key])
    s = s.withColumn("_s", status_at(F.col("step"))).where(F.col("_s").isNull() | (F.col("_s") != "Incomplete"))
    stop = s.groupBy(*key).agg(F.min(F.struct("step", F.coalesce("_s", F.lit("Failed")).alias("s"))).alias("f"))
    n = F.when(F.col("f").isNull(), EXTEND_MOST).when(F.col("f.s") == "Failed", 0).when(F.col("f.s") == "Empty", F.greatest(F.col("f.step") - 1, F.lit(0))).otherwise(F.col("f.step"))
    return df.select(*key).join(stop, key, "left").select(*key, n.cast("int").alias("extensions"))


def largest_trim(budget: int, length: int, same: Callable[[int], bool]) -> int:
    """Most milliseconds to trim so that ``same(ms)`` holds: bisection over steps of 100,
    then the five steps on either side are checked and the largest that holds counts.
    With no step long enough to check, the bisection's answer stands."""
    lo, hi, best = 0, budget // TRIM_STEP, 0
    while lo <= hi:
        mid = (lo + hi) // 2
        if length - mid * TRIM_STEP >= SHORTEST and same(mid * TRIM_STEP):
            best, lo = mid, mid + 1
        else:
            hi = mid - 1
    near = [s for s in range(max(0, best - AROUND), min(budget // TRIM_STEP, best + AROUND) + 1) if length - s * TRIM_STEP >= SHORTEST]
    if not near:
        return best * TRIM_STEP
    return max((s * TRIM_STEP for s in near if same(s * TRIM_STEP)), default=0)


def trim_declared(df: DataFrame, key: list[str], length: Column, budget: Column, same_at: Callable[[Column], Column], name: str) -> DataFrame:
    """``df`` with ``name``: the largest trim in steps of 100 that keeps the text.  Equals
    the bisection where the answer never turns from no to yes."""
    step = F.explode(F.sequence(F.lit(0), (budget / TRIM_STEP).cast("int"))).alias("_k")
    s = df.select("*", step).withColumn("_ms", F.col("_k") * TRIM_STEP)
    ok = (length - F.col("_ms") >= SHORTEST) & same_at(F.col("_ms"))
    found = s.where(ok).groupBy(*key).agg(F.max("_ms").alias(name))
    return df.join(found, key, "left").withColumn(name, F.coalesce(name, F.lit(0)).cast("int"))


def trim_searched(df: DataFrame, key: str, transcriber: Callable[[dict], Callable[[int, int], str]]) -> DataFrame:
    """``key, start_trimmed_ms, end_trimmed_ms, final_duration_ms`` by the visiting search.

    ``df`` has ``key, duration_ms, target`` and what the transcriber needs: it gets a row
    and returns a function of the milliseconds cut at start and end that gives the text.
    The end is trimmed first, then the start, both within the budget of the whole length.
    A transcript that is missing or empty matches nothing, an empty target neither.
    """

    def match(got: str | None, target: str) -> bool:
        return bool(got) and got.strip() == target

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for row in pdf.to_dict("records"):
                text, ms = transcriber(row), int(row["duration_ms"])
                target = (row["target"] or "").strip()
                budget = min(3000, ms // 2) // TRIM_STEP * TRIM_STEP
                end = largest_trim(budget, ms, lambda t: match(text(0, t), target))
                start = largest_trim(budget, ms - end, lambda t: match(text(t, end), target))
                out.append((row[key], start, end, ms - start - end))
            yield pd.DataFrame(out, columns=[key, "start_trimmed_ms", "end_trimmed_ms", "final_duration_ms"])

    kind = df.schema[key].dataType.simpleString()
    return df.mapInPandas(work, f"`{key}` {kind}, start_trimmed_ms int, end_trimmed_ms int, final_duration_ms int")
