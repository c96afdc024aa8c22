"""Audio files: discovery, decoding slots, export."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Suffixes of recordings that are cut into segments, and of clips that are scored.
RECORDINGS = ("mp3", "wav", "m4a", "flac", "ogg", "mp4")
CLIPS = ("mp3", "wav", "flac", "m4a", "aac", "ogg", "wma")
# Peak level, sample rate, size above which a clip is brought to a lower rate.
PEAK, RATE, LARGE_MB, LARGE_RATE = 0.95, 16000, 50, 22050
MB = 1024 * 1024

Decoder = Callable[[bytes], tuple[np.ndarray, int]]


def is_audio(path: Column, suffixes: tuple[str, ...] = RECORDINGS) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*suffixes)


def audio_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = RECORDINGS) -> DataFrame:
    """Audio files at a path or below it: ``path, folder, length, modificationTime, content``."""
    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return d.where(is_audio(F.col("path"), suffixes)).withColumn("folder", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))


def folders_with_audio(files: DataFrame) -> DataFrame:
    return files.select("folder").distinct()


def listing(files: DataFrame) -> DataFrame:
    """Files with their place in the sorted listing of their folder, from 0; contents are
    not shuffled."""
    from voxloom.operators.sequence import number_within

    return number_within(files.select("folder", "path", "length"), "folder", ["path"], "place")


def decode_wav(content: bytes) -> tuple[np.ndarray, int]:
    """16-bit PCM as samples from -1 to 1, one row per channel."""
    with wave.open(io.BytesIO(content)) as w:
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype("f4") / 32768
        return x.reshape(-1, w.getnchannels()).T, w.getframerate()


def resample(x: np.ndarray, rate: int, to: int, zeros: int = 16) -> np.ndarray:
    """Samples at another rate, by windowed sinc filters that let no frequency alias.

    Output samples repeat ``to / gcd`` phases, so each phase is one filter and a strided
    product; ``zeros`` is the filter's length in zero crossings on each side.
    """
    if rate == to or not len(x):
        return x.astype("f4")
    g = math.gcd(rate, to)
    up, down = to // g, rate // g
    cut = min(1.0, to / rate)
    half = int(np.ceil(zeros / cut))
    n = max(1, int(round(len(x) * to / rate)))
    padded = np.pad(np.asarray(x, "f8"), (half, half + down + 1))
    out, step = np.empty(n), padded.strides[0]
    for p in range(min(up, n)):
        count = (n - p + up - 1) // up
        base, part = divmod(p * down, up)
        at = np.arange(1 - half, half + 1) - part / up
        h = cut * np.sinc(cut * at) * np.cos(np.pi * np.clip(at / half, -1, 1) / 2) ** 2
        rows = np.lib.stride_tricks.as_strided(padded[base + 1 :], (count, 2 * half), (down * step, step))
        out[p::up] = rows @ (h / h.sum())
    return out.astype("f4")


def prepared(decoder: Decoder, content: bytes, rate: int = RATE, peak: float = PEAK) -> np.ndarray:
    """One channel of a recording at the working rate, brought to a peak unless silent."""
    x, r = decoder(content)
    y = resample(np.atleast_2d(x).mean(axis=0), r, rate)
    top = float(np.abs(y).max()) if len(y) else 0.0
    return y * np.float32(peak / top) if top > 0 else y


def decoded(
    files: DataFrame, rate: int | None = RATE, peak: float | None = PEAK, only_above_mb: float = 0.0, silence_on_error: bool = False, decoder: Decoder = decode_wav, mono: bool = True
) -> DataFrame:
    """``path, samples, sample_rate, error``: resampled and brought to a peak.

    ``rate`` None keeps the rate; files of up to ``only_above_mb`` keep it too.  ``mono``
    averages the channels; otherwise ``samples`` is an array of channels.  A file that
    cannot be read gives null samples, rate 0 and the reason, or a second of silence.
    """
    kind = "array<float>" if mono else "array<array<float>>"

    def one(content: bytes) -> tuple:
        x, r = decoder(content)
        x = np.atleast_2d(x)
        x = x.mean(axis=0, keepdims=True) if mono else x
        if rate and len(content) > only_above_mb * MB:
            x, r = np.array([resample(c, r, rate) for c in x]), rate
        top = float(np.abs(x).max()) if x.size else 0.0
        x = (x * (peak / top) if peak and top > 0 else x).astype("f4")
        return (x[0] if mono else list(x)), r, None

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        silence = np.zeros(rate or RATE, "f4")
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    out.append((path, *one(bytes(content))))
                except Exception as e:
                    why = f"{type(e).__name__}: {e}"
                    out.append((path, silence if mono else [silence], rate or RATE, why) if silence_on_error else (path, None, 0, why))
            yield pd.DataFrame(out, columns=["path", "samples", "sample_rate", "error"])

    return files.select("path", "content").mapInPandas(work, f"path string, samples {kind}, sample_rate int, error string")


def readable(d: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Decoded files, and the table ``path, error`` of those that could not be read."""
    return d.where("samples is not null").drop("error"), d.where("error is not null").select("path", "error")


def wav_bytes(samples: np.ndarray, rate: int = RATE) -> bytes:
    """One channel of 16-bit PCM, cut toward zero."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def export(df: DataFrame, path: str, data: str, to_bytes: Callable[[np.ndarray], bytes] = wav_bytes) -> DataFrame:
    """``path, content``: files ready to be written by ``save_files``."""

    @F.pandas_udf("binary")
    def pack(s: pd.Series) -> pd.Series:
        return s.map(lambda x: to_bytes(np.asarray(x, "f4")), na_action="ignore")

    return df.where(F.col(data).isNotNull() & F.col(path).isNotNull()).select(F.col(path).alias("path"), pack(data).alias("content"))


def save_files(files: DataFrame, root: str) -> None:
    """Write each row's bytes under a root that all executors see: a folder or a URI of a
    file system that the columnar library knows (``hdfs://``, ``s3://``)."""

    def write(rows) -> None:
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(root) if "://" in root else (fs.LocalFileSystem(), root)
        for r in rows:
            to = f"{base.rstrip('/')}/{r['path']}"
            where.create_dir(to.rsplit("/", 1)[0], recursive=True)
            with where.open_output_stream(to + ".part") as out:
                out.write(bytes(r["content"]))
            where.move(to + ".part", to)

    files.foreachPartition(write)


def npy_bytes(x: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, np.asarray(x, "f4"))
    return out.getvalue()


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """``path, vector`` of NPY files; one that cannot be read gives null."""

    @F.pandas_udf("array<float>")
    def load(s: pd.Series) -> pd.Series:
        def one(b):
            try:
                return np.load(io.BytesIO(bytes(b)), allow_pickle=False).astype("f4").ravel()
            except Exception:
                return None

        return s.map(one)

    d = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.npy").load(path)
    return d.select("path", load("content").alias("vector"))


def trimmed(samples: Column, start_ms: Column, end_ms: Column, rate: int = RATE) -> Column:
    """Samples without so many milliseconds at either end."""
    a, b = (start_ms * rate / 1000).cast("int"), (end_ms * rate / 1000).cast("int")
    return F.slice(samples, a + 1, F.greatest(F.lit(0), F.size(samples) - a - b))
