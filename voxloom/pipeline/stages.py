"""The stages: each reads what the one before wrote under a root, does only what is left to
do, and appends its own table.

    segment -> trim -> score_audio, score_text, embed -> speakers -> release

Rows that are done are found by anti joins against the stage's own table, so a stage that
was stopped goes on where its last commit ended.  Audio is decoded where it is read; models
are slots with stand-ins that need no download, except the transcriber, which must be given.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.config import Config
from voxloom.functions.models import Batch, apply_model, spectral_embedding, with_punctuation
from voxloom.operators import cluster as C
from voxloom.operators import release as L
from voxloom.operators import vectors as V
from voxloom.operators.incremental import pending
from voxloom.operators.search import trim_searched
from voxloom.operators.sequence import keep_first, keep_last, number_within
from voxloom.operators.signal import RATE, audio_scores
from voxloom.operators.text import file_name, has_text, with_text_scores
from voxloom.pipeline.recordings import Completeness, Detector, Transcriber, energy_detector, extended, islands, repaired, transcribed
from voxloom.session import materialize
from voxloom.sources import audio as A
from voxloom.sources.checkpoint import Checkpoint
from voxloom.sources.tables import catalog, write_labels, write_manifest


def ends_with_mark(texts: list[str]) -> list[str]:
    """Stand-in for the completeness model: a text that ends in a mark or a verb form."""
    done = re.compile(r"(?:[.!?؟]|است|بود|شد|گفت|رفت|ماند|کرد)\s*$")
    return ["Invalid" if not t.strip() else "Complete" if done.search(t) else "Incomplete" for t in texts]


@dataclass(frozen=True)
class Models:
    """The slots.  Each is a plain function or a factory; all must be picklable."""

    transcriber: Transcriber
    decoder: A.Decoder = A.decode_wav
    detector: Detector = field(default_factory=energy_detector)
    completeness: Completeness = ends_with_mark
    music: Callable[[np.ndarray, int], bool] | None = None
    encoder: Callable[[], Batch] = field(default_factory=spectral_embedding)
    dimensions: int = 96


class Corpus:
    """A root folder that all executors see, its tables and files."""

    def __init__(self, spark: SparkSession, root: str, models: Models, config: Config | None = None):
        self.spark, self.root, self.models, self.config = spark, root.rstrip("/"), models, config

    def at(self, name: str) -> str:
        """The folder of a table or of files: the configured one, else one below the root."""
        first, _, rest = name.partition("/")
        folder = (self.config and getattr(self.config, first, "")) or f"{self.root}/{first}"
        return f"{folder}/{rest}" if rest else folder

    def name_in(self, folder: str) -> Column:
        """The name of a file's ``path`` relative to a folder."""
        return F.regexp_extract("path", f"^(?:[a-z0-9]+:/*(?=/))?{re.escape(self.at(folder))}/(.+)$", 1)

    def table(self, name: str) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.at(name))
        there = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.parquet(self.at(name)) if there else None

    def left(self, todo: DataFrame, name: str, key: str, done_key: str | None = None) -> DataFrame:
        """Rows of ``todo`` that the stage's table does not have yet."""
        done = self.table(name)
        return todo if done is None else pending(todo, done.select(F.col(done_key or key).alias(key)), [key])

    def files(self, folder: str, suffixes=A.CLIPS) -> DataFrame:
        """Audio files below a folder of the root, ``name`` relative to that folder."""
        return A.audio_files(self.spark, self.at(folder), suffixes).withColumn("name", self.name_in(folder))

    # 1
    def segment(self, books: DataFrame, retry_failed: bool = False, reset: bool = False, most_books: int | None = None) -> DataFrame:
        """Recordings of the books still to do, cut into segments with transcripts.

        ``books``: ``title, narrator, audio_path`` (a file or a folder of files).  A book
        without a readable recording is marked as failed; ``retry_failed`` takes it up
        again, ``reset`` starts anew, ``most_books`` takes the first so many of the list.
        """
        state = Checkpoint(self.spark, self.at("status"))
        if reset:
            state.completed, state.failed = {}, {}
        b = catalog(books).withColumn("key", F.concat_ws(":", F.col("title_index"), "full_path"))
        b = state.left(b, retry_failed=retry_failed)
        if most_books is not None:
            b = b.orderBy("title_index", "full_path").limit(most_books)
        b = materialize(b, "books")
        names = [r["full_path"] for r in b.select("full_path").distinct().collect()]  # the books a person listed
        if names:
            f = self.spark.read.format("binaryFile").load(names).where(A.is_audio(F.col("path")))
            plain = F.regexp_replace("path", "^[a-z0-9]+:/{0,2}(?=/)", "")
            # a file belongs to the book that lists it, and to the one that lists its folder
            f = f.withColumn("_p", plain).select("path", "content", F.explode(F.array("_p", F.regexp_extract("_p", "^(.+)/[^/]+$", 1))).alias("_b"))
            root = F.regexp_replace(F.regexp_replace("full_path", "^[a-z0-9]+:/{0,2}(?=/)", ""), "/+$", "")
            own = b.select("key", "title", "title_index", "narrator", "narrator_index", root.alias("_b"))
            got = materialize(self._cut(f.join(own, "_b")), "segments")
            bad = got.where("error is not null")
            # numbers run through a book's files in the order of their paths
            rows = number_within(got.where("error is null and place is not null"), "key", ["path", "place"], "segment_index", F.col("path"))
            book = F.concat(file_name(F.col("title")), F.lit("_"), F.col("title_index"))
            path = F.concat(book, F.lit("/segment_"), F.lpad(F.col("segment_index").cast("string"), 6, "0"), F.lit(".wav"))
            rows = materialize(rows.withColumns({"audiobook_name": book, "segment_path": F.when(has_text(F.col("final_transcript")), path)}), "numbered")
            A.save_files(A.export(rows, "segment_path", "samples"), self.at("segments_audio"))
            columns = ["segment_path", "audiobook_name", F.col("title").alias("original_audio_book_name"), "title_index", "narrator", "narrator_index", "final_duration", "number_of_extensions", "completion_status", "final_transcript", "audio_book_time"]
            rows.select(*columns).write.mode("append").partitionBy("audiobook_name").parquet(self.at("segments"))
            fine = {r["key"] for r in got.where("error is null").select("key").distinct().collect()}
            why = {r["key"]: r["e"] for r in bad.groupBy("key").agg(F.max("error").alias("e")).collect()}
            for r in b.select("key").distinct().collect():
                if r["key"] in fine:
                    state.mark_completed(r["key"])
                else:
                    state.mark_failed(r["key"], why.get(r["key"], "no audio files"))
        return self.table("segments")

    def _cut(self, files: DataFrame) -> DataFrame:
        """Segments of each file with their samples; a row of its own for a file without any."""
        m = self.models
        info = ["key", "title", "title_index", "narrator", "narrator_index"]
        kinds = ", ".join(f"{c} {files.schema[c].dataType.simpleString()}" for c in info)

        def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for row in pdf.to_dict("records"):
                    base = {**{c: row[c] for c in info}, "path": row["path"], "error": None, "place": None, "samples": None, "final_duration": None, "number_of_extensions": None, "completion_status": None, "final_transcript": None, "audio_book_time": None}
                    try:
                        y = A.prepared(m.decoder, bytes(row["content"]))
                        found = repaired([extended(y, s, m.transcriber, m.completeness) for s in islands(y, m.detector)])
                        said = transcribed(y, found, m.transcriber, m.completeness)
                        out = [base | {"place": i, "samples": y[int(s * RATE) : int(e * RATE)], "final_duration": max(0.0, e - s), "number_of_extensions": n, "completion_status": status, "final_transcript": text, "audio_book_time": s} for i, ((s, e, n), (text, status)) in enumerate(zip(found, said))]
                    except Exception as e:
                        out = [base | {"error": f"{type(e).__name__}: {e}"}]
                    yield pd.DataFrame(out or [base]).astype({"place": "Int32", "number_of_extensions": "Int32"})

        schema = f"{kinds}, path string, error string, place int, samples array<float>, final_duration double, number_of_extensions int, completion_status string, final_transcript string, audio_book_time double"
        return files.select(*info, "path", "content").mapInPandas(work, schema)

    # 2
    def trim(self) -> DataFrame:
        """Segments cut at both ends as far as their transcript allows."""
        m = self.models
        todo = self.left(self.table("segments").where("segment_path is not null"), "trimmed", "segment_path")
        a = A.decoded(self.files("segments_audio"), None, None, decoder=m.decoder)
        a = a.withColumn("segment_path", self.name_in("segments_audio")).select("segment_path", "samples", "sample_rate")
        d = todo.join(a.where("samples is not null"), "segment_path")
        d = materialize(d.withColumns({"duration_ms": F.floor(F.size("samples") * 1000 / F.col("sample_rate")), "target": F.col("final_transcript")}), "to-trim")

        def transcriber(row: dict):
            y, r = np.asarray(row["samples"], "f4"), int(row["sample_rate"])
            return lambda start, end: m.transcriber(y[start * r // 1000 : len(y) - end * r // 1000], r)

        got = trim_searched(d, "segment_path", transcriber)
        rows = d.join(got, "segment_path").withColumns({"fixed_segment_path": F.col("segment_path"), "original_duration_ms": F.col("duration_ms").cast("int"), "processing_timestamp": F.unix_micros(F.current_timestamp()) / 1e6})
        rows = materialize(rows.withColumn("samples", _cut_ends("samples", "sample_rate", "start_trimmed_ms", "end_trimmed_ms")), "trimmed")
        A.save_files(A.export(rows, "fixed_segment_path", "samples"), self.at("trimmed_audio"))
        rows.drop("samples", "sample_rate", "target", "duration_ms").write.mode("append").partitionBy("audiobook_name").parquet(self.at("trimmed"))
        return self.table("trimmed")

    # 3
    def score_audio(self) -> DataFrame:
        """Metrics and scores of the trimmed clips that have none yet."""
        f = self.left(self.files("trimmed_audio"), "audio_scores", "name", "file_path")
        d = A.decoded(f, A.LARGE_RATE, None, only_above_mb=A.LARGE_MB, decoder=self.models.decoder)
        good, bad = A.readable(d)
        s = audio_scores(good, self.models.music).withColumn("file_path", self.name_in("trimmed_audio"))
        s = s.withColumns({"audiobook_folder": F.regexp_extract("file_path", "([^/]+)/[^/]+$", 1), "filename": F.regexp_extract("file_path", "[^/]+$", 0)}).drop("path")
        s = s.join(f.select(F.col("name").alias("file_path"), (F.col("length") / A.MB).alias("file_size_mb")), "file_path")
        s.write.mode("append").parquet(self.at("audio_scores"))
        return self.table("audio_scores")

    # 4
    def score_text(self) -> DataFrame:
        t = self.left(self.table("trimmed").select(F.col("fixed_segment_path").alias("segment_path"), F.col("final_transcript").alias("text")), "text_scores", "segment_path")
        with_text_scores(t, "text").drop("normalized").write.mode("append").parquet(self.at("text_scores"))
        return self.table("text_scores")

    # 5
    def embed(self) -> DataFrame:
        """A speaker vector for each trimmed clip that has none yet; clips that cannot be read
        or encoded are tried again by the next run."""
        m = self.models
        f = self.left(self.files("trimmed_audio"), "embeddings", "name", "segment_path")
        d = A.readable(A.decoded(f, None, None, decoder=m.decoder))[0].withColumn("segment_path", self.name_in("trimmed_audio"))
        e = apply_model(d.select("segment_path", "samples"), "samples", "encoder", m.encoder, "array<double>", "embedding").where("embedding is not null").select("segment_path", "embedding")
        meta = keep_last(self.table("trimmed").select(F.col("fixed_segment_path").alias("segment_path"), "audiobook_name", "title_index", "narrator", "final_transcript", "completion_status", "final_duration_ms", "processing_timestamp"), ["segment_path"], [F.col("processing_timestamp")])
        e.join(meta.drop("processing_timestamp"), "segment_path").write.mode("append").partitionBy("audiobook_name").parquet(self.at("embeddings"))
        return self.table("embeddings")

    # 6
    def speakers(self) -> DataFrame:
        local = materialize(local_labels(self.table("embeddings"), "audiobook_name", "segment_path", self.models.dimensions), "local")
        labels, summary = global_labels(local, "audiobook_name", "segment_path", self.models.dimensions)
        write_labels(local.drop("embedding"), labels.drop("embedding"), summary, self.at("speakers"), "audiobook_name")
        return self.spark.read.parquet(self.at("speakers/global"))

    # 7
    def release(self, strict: bool = False) -> DataFrame:
        labels = self.spark.read.parquet(self.at("speakers/global"))
        audio = keep_first(self.table("audio_scores").select(F.col("file_path").alias("segment_path"), F.col("quality_score").alias("audio_quality_score"), "has_background_music"), ["segment_path"], [F.col("audio_quality_score")])
        text = keep_first(self.table("text_scores").select("segment_path", F.col("total_score").alias("text_quality_score")), ["segment_path"], [F.col("text_quality_score")])
        r = with_punctuation(L.releasable(L.combine(labels, audio, text), strict), "final_transcript", "final_transcript_punctuated")
        r = materialize(L.present(r, ["segment_path", "final_transcript_punctuated", "final_duration_ms", "global_speaker_id", "speaker_confidence", "audio_quality_score", "text_quality_score"]), "release")
        write_manifest(r, self.at("release"))
        return r

    def everything(self, books: DataFrame, **how) -> DataFrame:
        self.segment(books, **how)
        self.trim()
        self.score_audio()
        self.score_text()
        self.embed()
        self.speakers()
        return self.release()


def _cut_ends(samples: str, rate: str, start: str, end: str):
    a, b = ((F.col(x) * F.col(rate) / 1000).cast("int") for x in (start, end))
    return F.slice(samples, a + 1, F.greatest(F.lit(0), F.size(samples) - a - b))


def local_labels(df: DataFrame, book: str, identifier: str, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows of ``df`` that belong to a speaker of their book: clustered, weak rows and small
    speakers pruned, speakers numbered anew (``speaker_id, speaker_confidence``)."""
    # the clusters are named by a number of the book, whatever kind its key is
    ids = df.select(book, identifier, vector, F.xxhash64(F.col(book)).alias("_b"), F.xxhash64(F.col(book), F.col(identifier)).alias("_i"))
    got = C.local_speakers(ids, "_b", "_i", vector, dim).where("status = 'completed'").select("_b", "_i", "speaker_id", "speaker_confidence")
    kept = C.prune_speakers(got, "_b", "speaker_id", "speaker_confidence").select("_i", F.col("new_speaker_id").alias("speaker_id"), "speaker_confidence")
    return df.withColumn("_i", F.xxhash64(F.col(book), F.col(identifier))).drop("speaker_id", "speaker_confidence").join(kept, "_i").drop("_i")


def global_labels(local: DataFrame, book: str, identifier: str, dim: int, vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """Rows with ``global_speaker_id`` (-1 where their speaker has no centroid), and the table
    of global speakers: samples, books, validation score."""
    c = V.weighted_centroids(local, [book, "speaker_id"], vector, "speaker_confidence", dim)
    c = materialize(c.withColumn("id", F.xxhash64(F.col(book), F.col("speaker_id"))), "centroids")
    merged = C.global_merge(c.select("id", F.col("centroid").alias("v")), dim)
    m = materialize(C.evidence_rule(merged.join(c, "id"), "cluster", "id", book, "n"), "merged")
    least = V.pairs_within(m, "final_cluster", "id", "centroid").groupBy("final_cluster").agg(F.min("cos").alias("least"))
    t = m.groupBy("final_cluster").agg(F.sum("n").alias("total_samples"), F.count_distinct(book).alias("num_books"), F.array_join(F.array_sort(F.collect_set(F.col(book).cast("string"))), ", ").alias("books"))
    t = t.join(least, "final_cluster", "left").withColumn("confidence_score", F.when(F.col("least").isNull(), 1.0).otherwise(C.validation_score(F.col("least")))).drop("least")
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("total_samples"), "final_cluster")) - 1  # over speakers, not rows
    t = materialize(t.withColumn("global_speaker_id", place), "speakers")
    names = m.join(t.select("final_cluster", "global_speaker_id"), "final_cluster").select(book, "speaker_id", "global_speaker_id")
    rows = local.join(names, [book, "speaker_id"], "left").withColumn("global_speaker_id", F.coalesce("global_speaker_id", F.lit(-1)))
    return rows, t.select("global_speaker_id", "total_samples", "num_books", "books", "confidence_score")
