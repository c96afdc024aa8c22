"""Evaluation of audio pairs: error rates against a transcriber, similarity of speakers."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions.models import Batch, apply_model
from voxloom.operators.metrics import error_summary, group_means, similarity_tiers, with_error_rates
from voxloom.operators.vectors import cosine, rescaled
from voxloom.sources import audio as A
from voxloom.sources.tables import first_present, write_outputs

Factory = Callable[[], Batch]


def transcribing(transcriber: Callable[[np.ndarray, int], str | None], rate: int = A.RATE) -> Factory:
    """A batch slot from a transcriber of one clip; a clip it fails at has the text ""."""

    def factory() -> Batch:
        def one(y) -> str:
            try:
                return transcriber(np.asarray(y, "f4"), rate) or "" if y is not None else ""
            except Exception:
                return ""

        return lambda clips: [one(y) for y in clips]

    return factory


def with_clip(spark: SparkSession, samples: DataFrame, column: str, root: str, name: str, decoder: A.Decoder = A.decode_wav, silence: bool = False) -> DataFrame:
    """``samples`` with the decoded clip that ``column`` names (a path below ``root``), null or
    a second of silence where there is none that can be read."""
    files = A.audio_files(spark, root, A.CLIPS)
    d = A.decoded(files, A.RATE, None, silence_on_error=silence, decoder=decoder)
    d = d.select(F.regexp_extract("path", f"^(?:[a-z0-9]+:/*(?=/))?{re.escape(root.rstrip('/'))}/(.+)$", 1).alias("_f"), F.col("samples").alias(name))
    out = samples.join(d, samples[column] == d["_f"], "left").drop("_f")
    return out.withColumn(name, F.coalesce(name, F.array_repeat(F.lit(0.0).cast("float"), A.RATE))) if silence else out


def word_error_rates(spark: SparkSession, samples: DataFrame, root: str, recognizer: Factory, audio: str = "generated_audio", text: str = "transcript", decoder: A.Decoder = A.decode_wav, silence: bool = False, out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Samples with ``hypothesis, wer, cer``, and the summary.  ``recognizer`` is a batch slot
    (a batch engine, or ``transcribing`` around one clip at a time)."""
    d = apply_model(with_clip(spark, samples.dropna(subset=[text, audio]), audio, root, "_y", decoder, silence), "_y", "recognizer", recognizer, "string", "hypothesis").drop("_y")
    rates = with_error_rates(d.withColumn("hypothesis", F.coalesce("hypothesis", F.lit(""))), text, "hypothesis")
    if out:
        write_outputs(rates, out)
    return rates, error_summary(rates)


def speaker_similarity(spark: SparkSession, samples: DataFrame, root: str, encoder: Factory, reference: str = "reference_audio", generated: str = "generated_audio", decoder: A.Decoder = A.decode_wav, out: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Samples with ``similarity`` (0 to 1, null where a clip is missing), the summary, and the
    means by gender as far as the samples name one."""
    d = samples
    for column, name in ((reference, "_a"), (generated, "_b")):
        d = apply_model(with_clip(spark, d, column, root, "_y", decoder), "_y", "encoder", encoder, "array<double>", name).drop("_y")
    d = d.withColumn("similarity", rescaled(cosine(F.col("_a"), F.col("_b")))).drop("_a", "_b")
    d = d.withColumn("gender", first_present(d, "speaker_gender", "Gender"))
    if out:
        write_outputs(d, out)
    return d, similarity_tiers(d, "similarity"), group_means(d.where("gender != ''"), "gender", "similarity")
