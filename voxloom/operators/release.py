"""The release: labelled segments with audio and text scores, filtered, with totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least audio and text scores of a released segment.
MIN_AUDIO, MIN_TEXT = 75, 0.5


def number(x: Column) -> Column:
    """A score without NaN, which would pass every lower limit."""
    return F.nanvl(x, F.lit(None).cast("double"))


def combine(segments: DataFrame, audio: DataFrame, text: DataFrame, key: str = "segment_path") -> DataFrame:
    """Segments with the scores that exist; unmatched scores are null."""
    return segments.join(audio, key, "left").join(text, key, "left")


def releasable(df: DataFrame, strict: bool = False) -> DataFrame:
    """Rows good enough to release.

    A missing or NaN score fails; missing music counts as none; a missing completion
    status passes, as do Empty, Invalid and Error unless ``strict``.
    """
    ok = (number(F.col("audio_quality_score")) >= MIN_AUDIO) & (number(F.col("text_quality_score")) >= MIN_TEXT)
    ok = ok & ~F.coalesce("has_background_music", F.lit(False)) & (F.col("global_speaker_id") != -1)
    status = F.col("completion_status").eqNullSafe("Complete") if strict else ~F.col("completion_status").eqNullSafe("Incomplete")
    return df.where(ok & status)


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """Those of the columns that exist, in this order."""
    return df.select([c for c in columns if c in df.columns])


def totals(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("segments"), F.round(F.sum("final_duration_ms") / 3_600_000, 6).alias("hours"), F.count_distinct("global_speaker_id").alias("speakers"))
