"""Operators on frames and samples: islands of speech, timeline repair, clip metrics, trims."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.sequence import attach

# Frame length, clipping and silence levels, percentile of the noise floor.
FRAME, RATE, CLIPPED, SILENT, FLOOR_PERCENTILE, TINY = 480, 16000, 0.95, 0.01, 0.05, 1e-10


def frame_starts(n_samples: Column, frame: int = FRAME, keep_last: bool = False) -> Column:
    """First sample of each full frame.  By default a last frame that ends exactly with the
    samples is left out, as the original loop does; ``keep_last`` takes it in."""
    last = n_samples - frame - (0 if keep_last else 1)
    return F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last.cast("long"), F.lit(frame).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def speech_islands(frames: DataFrame, key: str, at: str, order: list[str], speech: str, total: Column) -> DataFrame:
    """Runs of speech frames: ``key, island_start, island_end``.

    Frames whose ``speech`` is null are skipped and end no run.  A run ends where the next
    frame without speech starts, an open one at ``total``, an aggregate over a key's frames.
    """
    w = Window.partitionBy(key).orderBy(*order)
    whole = frames.groupBy(key).agg(total.alias("_total"))
    f = frames.where(F.col(speech).isNotNull())
    new = (F.col(speech) != F.coalesce(F.lag(speech).over(w), ~F.col(speech))).cast("int")
    f = f.withColumn("_next", F.lead(at).over(w)).withColumn("_new", new)
    f = f.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = f.where(F.col(speech)).groupBy(key, "_run").agg(F.min(at).alias("island_start"), F.max(F.struct(F.col(at).alias("a"), F.col("_next").alias("n"))).alias("_l"))
    return runs.join(whole, key).select(key, "island_start", F.coalesce("_l.n", "_total").alias("island_end"))


def repair_timeline(df: DataFrame, key: str, start: str, end: str, order: list[str], fill_gaps: bool = True, bucket: Column | None = None) -> DataFrame:
    """Segments without overlap: a segment starts where the kept ones before it end.

    With ``fill_gaps`` (the original behaviour) it also starts there if there was a gap.
    Segments that end no later than that are dropped.  Null bounds are dropped.
    ``bucket`` splits a long timeline: a value that never falls along the order (a span of
    time).  Rows are then sorted within their bucket; what the buckets before it reached,
    one small row each, is carried in.
    """
    d = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_b", F.lit(0) if bucket is None else bucket)
    per = d.groupBy(key, "_b").agg(F.max(end).alias("_m"), F.min(F.struct(*order, F.col(start).alias("_s"))).alias("_f"))
    along = Window.partitionBy(key).orderBy("_b")
    carry = F.max("_m").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")
    first = F.first("_f._s").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("_first")
    d = attach(d, per.select(key, "_b", carry, first), [key, "_b"])
    before = Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    last = F.greatest(F.max(end).over(before), "_carry")
    begin = F.greatest(last, "_first") if fill_gaps else F.greatest(F.col(start), last)
    d = d.withColumn("fixed_start", begin).where(F.col("fixed_start") < F.col(end)).withColumn("fixed_end", F.col(end))
    return d.drop("_b", "_carry", "_first")


def decibel(x: Column, factor: float) -> Column:
    """``factor * log10(x)``, minus infinity at 0."""
    return F.when(x > 0, factor * F.log10(x)).when(x <= 0, F.lit(float("-inf")))


def clip_metrics(samples: DataFrame, clip: str, y: str) -> DataFrame:
    """Per clip: power, noise floor, SNR and range in dB, clipped and silent share.

    Null samples are left out.  The floor is the exact 5th percentile of the power.
    """
    p = F.col(y) * F.col(y)
    a = F.abs(F.col(y))
    d = samples.where(F.col(y).isNotNull()).groupBy(clip).agg(
        F.count("*").alias("n_samples"), F.sqrt(F.avg(p)).alias("rms"), F.max(a).alias("peak"), F.avg(p).alias("power"), F.expr(f"percentile({y} * {y}, {FLOOR_PERCENTILE})").alias("floor"),
        (100.0 * F.count_if(a > CLIPPED) / F.count("*")).alias("clipping_percentage"), (100.0 * F.count_if(a < SILENT) / F.count("*")).alias("silence_percentage"),
    )
    return d.withColumns({"snr_db": decibel(F.col("power") / (F.col("floor") + TINY), 10), "dynamic_range_db": decibel(F.col("peak") / (F.col("rms") + TINY), 20)})


def audio_scores(decoded: DataFrame, has_music: Callable[[np.ndarray, int], bool] | None = None) -> DataFrame:
    """Metrics and composite score of whole decoded clips (``path, samples, sample_rate``,
    other columns are kept), computed on the sample arrays, a row per clip.

    A clip of less than a second, an empty one included, has fixed metrics: silence 100,
    all else 0, no music, clean, score 0.  ``has_music`` is the music detector's slot; by
    default nothing is music.  Clips that could not be read have no row.
    """
    music = has_music or (lambda y, rate: False)
    rest = [c for c in decoded.columns if c not in ("samples", "error")]
    kept = ", ".join(f"`{c}` {decoded.schema[c].dataType.simpleString()}" for c in rest)
    names = ["duration", "snr_db", "dynamic_range_db", "clipping_percentage", "silence_percentage", "has_background_music"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for samples, rate in zip(pdf["samples"], pdf["sample_rate"]):
                y = np.asarray(samples, "f8")
                seconds = len(y) / rate
                if seconds < 1:
                    out.append((seconds, 0.0, 0.0, 0.0, 100.0, False))
                    continue
                p, a = y * y, np.abs(y)
                power, rms = float(p.mean()), float(np.sqrt(p.mean()))
                with np.errstate(divide="ignore"):
                    snr = 10 * np.log10(power / (np.percentile(p, 100 * FLOOR_PERCENTILE) + TINY))
                    span = 20 * np.log10(a.max() / (rms + TINY))
                out.append((seconds, float(snr), float(span), 100.0 * float((a > CLIPPED).mean()), 100.0 * float((a < SILENT).mean()), bool(music(y, int(rate)))))
            yield pd.concat([pdf[rest].reset_index(drop=True), pd.DataFrame(out, columns=names)], axis=1)

    d = decoded.where("samples is not null and sample_rate > 0").select(*rest, "samples")
    d = d.mapInPandas(work, f"{kept}, duration double, snr_db double, dynamic_range_db double, clipping_percentage double, silence_percentage double, has_background_music boolean")
    d = d.withColumn("is_clean", ~F.col("has_background_music"))
    return d.withColumn("quality_score", clip_score(*[F.col(c) for c in ("snr_db", "sample_rate", "clipping_percentage", "silence_percentage", "dynamic_range_db", "duration", "is_clean")]))


def clip_score(snr: Column, rate: Column, clipping: Column, silence: Column, span: Column, duration: Column, clean: Column) -> Column:
    """Composite 0 to 100.  A clip of less than a second scores 0."""
    above = lambda x, *steps: _steps(x, steps, lambda a, b: a > b)
    score = (
        50
        + above(snr, (20, 30), (10, 20), (5, 10))
        + _steps(rate, ((44100, 15), (22050, 10), (16000, 5)), lambda a, b: a >= b)
        - above(clipping, (5, 20), (1, 10), (0.1, 5))
        - above(silence, (50, 15), (30, 10), (20, 5))
        + above(span, (20, 10), (15, 7), (10, 5))
        + F.when(duration.between(30, 300), 10).when(duration.between(10, 600), 5).otherwise(0)
        + F.when(clean, 10).otherwise(0)
    )
    return F.when(duration < 1, 0.0).otherwise(F.least(F.lit(100.0), F.greatest(F.lit(0.0), score.cast("double"))))


def _steps(x: Column, steps, test) -> Column:
    c = F.when(test(x, steps[0][0]), steps[0][1])
    for limit, points in steps[1:]:
        c = c.when(test(x, limit), points)
    return c.otherwise(0)


def release_guard(df: DataFrame, min_score: float = 75, min_rate: int = 22050, max_clipping: float = 1.0, clean_only: bool = True) -> DataFrame:
    ok = (F.col("quality_score") >= min_score) & (F.col("sample_rate") >= min_rate) & (F.col("clipping_percentage") <= max_clipping)
    return df.where(ok & F.col("is_clean") if clean_only else ok)


def int16(y: Column) -> Column:
    """A sample as 16-bit integer, cut toward zero.

    Samples lie between -1 and 1.  One beyond keeps its low 16 bits, as in the original's
    ``astype(np.int16)``, and ends no job; one beyond 32 bits or not finite gives 0 there.
    """
    x = y * 32767
    low = F.pmod(x.cast("long") + 32768, F.lit(65536)) - 32768
    return F.when(F.abs(x) < 2**31, low).when(x.isNotNull(), 0).cast("smallint")


def sample_at(seconds: Column, rate: int = RATE) -> Column:
    return (seconds * rate).cast("int")


def trim_budget(ms: Column) -> Column:
    """Most milliseconds to cut from one side: at most 3 s or half the clip, in steps of 100."""
    return (F.floor(F.least(F.lit(3000), F.floor(ms / 2)) / 100) * 100).cast("int")
