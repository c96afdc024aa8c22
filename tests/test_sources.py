import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom import schemas
from voxloom.config import Config
from voxloom.functions.models import apply_model, final_status, spectral_embedding
from voxloom.operators import release as L
from voxloom.sources import audio as A
from voxloom.sources import state as S
from voxloom.sources import tables as T


def test_catalog(spark, tmp_path):
    (tmp_path / "c.csv").write_text('title,narrator,audio_path\nB,"x, y",b.mp3\nA,,a.mp3\nB,"x, y",c/\n', encoding="utf-8")
    c = T.read_catalog(spark, str(tmp_path / "c.csv"), "/r").orderBy("audio_path").collect()
    assert [(r.title_index, r.narrator_index, r.narrator, r.full_path) for r in c] == [(1, 1, "unknown", "/r/a.mp3"), (0, 0, "x, y", "/r/b.mp3"), (0, 0, "x, y", "/r/c/")]
    with pytest.raises(ValueError, match="narrator"):
        T.catalog(spark.createDataFrame([("a", "b")], "title string, audio_path string"))


def test_stage_tables(spark, tmp_path):
    d = spark.createDataFrame([("p1", "متن", "k1"), ("p2", "  ", "k2")], "segment_path string, final_transcript string, book string")
    assert T.segment_rows(d).where("segment_path is null").count() == 1
    T.write_partitioned(d, str(tmp_path / "t"), "book")
    T.write_partitioned(d.where("book = 'k1'"), str(tmp_path / "t"), "book", "overwrite")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    for b in ("x", "y"):
        (tmp_path / "s" / b).mkdir(parents=True)
        (tmp_path / "s" / b / "metadata.csv").write_text("segment_path,final_transcript\np,t\n,u\n")
    r = T.read_stage(spark, str(tmp_path / "s"), "segment_path string, final_transcript string", "audiobook_name")
    assert {(x.audiobook_name, x.segment_path) for x in r.collect()} == {("x", "p"), ("x", None), ("y", "p"), ("y", None)}
    assert schemas.empty(spark, schemas.RATINGS).count() == 0


def test_upsert_table(spark, tmp_path):
    p, kind, key, order = str(tmp_path / "r"), "k int, t int, v string", ["k"], [F.col("t")]
    assert S.read_state(spark, p, kind, key, order).count() == 0
    S.merge_into(spark, p, spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], kind), key, order)
    out = S.merge_into(spark, p, spark.createDataFrame([(2, 5, "d"), (1, 1, "old")], kind), key, order)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "b"), (2, 5, "d")]
    # a writer that died before it moved the pointer leaves the state as it was
    spark.createDataFrame([(1, 99, "lost")], kind).write.parquet(f"{p}/part-dead")
    assert sorted(tuple(r) for r in S.read_state(spark, p, kind, key, order).collect()) == [(1, 2, "b"), (2, 5, "d")]
    before = S.read_state(spark, p, kind, key, order)
    for i in range(6):  # folded on the way; a reader of before a fold can still read
        out = S.merge_into(spark, p, spark.createDataFrame([(3, i, str(i))], kind), key, order, most_parts=3)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 2, "b"), (2, 5, "d"), (3, 5, "5")]
    assert before.schema == out.schema


def test_checkpoint(spark, tmp_path):
    from voxloom.sources.checkpoint import Checkpoint, file_key

    c = Checkpoint(spark, str(tmp_path / "c"))
    a = file_key("book", "a.csv", 1)
    assert a != file_key("book", "a.csv", 2) and not c.is_completed(a)
    c.mark_failed(a, "broken")
    assert c.is_failed(a)
    c.mark_completed(a, {"rows": 3})
    again = Checkpoint(spark, str(tmp_path / "c"))
    assert again.is_completed(a) and not again.is_failed(a) and again.result(a) == {"rows": 3}
    todo = spark.createDataFrame([(a,), ("other",)], "key string")
    assert [r.key for r in again.left(todo).collect()] == ["other"]


def test_other_sources(spark, tmp_path):
    for f in ("a/x_embedding.csv", "a/b_embeddings.csv", "a/embedding_backup.csv", "b/speakers.csv"):
        (tmp_path / "t" / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / f).write_text("segment_path,v\np,1\n")
    found = T.embedding_tables(spark, str(tmp_path / "t")).collect()
    assert [(r.folder, r.path.rsplit("/", 1)[1]) for r in found] == [("a", "b_embeddings.csv")]
    d = T.union_tables(spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2, 0.5)], "i int, q double"))
    assert sorted((r.i, r.s, r.q) for r in d.collect()) == [(1, "x", None), (2, None, 0.5)]
    for f in ("m/one/metadata.csv", "m/two/metadata.csv", "m/two/deep/metadata.csv"):
        (tmp_path / f).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / f).write_text("segment_path,final_transcript\np,t\n,u\n")
    schema = "segment_path string, final_transcript string"
    assert T.read_stage(spark, str(tmp_path / "m"), schema, "book").count() == 6
    assert T.read_stage(spark, str(tmp_path / "m/*/metadata.csv"), schema, "book", recursive=False).count() == 4
    left = T.read_stage(spark, str(tmp_path / "m"), schema, "book", completed=spark.createDataFrame([("one",)], "book string"), required="segment_path")
    assert {(r.book, r.segment_path) for r in left.collect()} == {("two", "p"), ("deep", "p")}
    rows = [("/b/2.wav", "b", "2", 1.0), ("/a/1.wav", "a", "1", 2.0), ("/b/2.wav", "b", "2", 9.0)]
    m = T.master_table(spark.createDataFrame(rows, "file_path string, audiobook_folder string, filename string, q double"), order=["q"]).collect()
    assert [(r.file_path, r.q) for r in m] == [("/a/1.wav", 2.0), ("/b/2.wav", 1.0)]
    T.write_outputs(d, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2
    who = spark.createDataFrame([("one", 1), ("two", 2)], "book string, speaker int")
    T.write_labels(who, who, who.select("speaker"), str(tmp_path / "labels"), "book")
    assert spark.read.parquet(str(tmp_path / "labels/global")).count() == 2


def test_suffixes_and_listing(spark, tmp_path):
    for name in ("b.mp4", "a.wav", "c.wma", "d.opus"):
        (tmp_path / name).write_bytes(b"x")
    assert {r.path.rsplit("/", 1)[1]: r.place for r in A.listing(A.audio_files(spark, str(tmp_path))).collect()} == {"a.wav": 0, "b.mp4": 1}
    assert {r.path.rsplit("/", 1)[1] for r in A.audio_files(spark, str(tmp_path), A.CLIPS).collect()} == {"a.wav", "c.wma"}


def test_resampling_keeps_low_tones_and_drops_high_ones():
    t = np.arange(44100) / 44100
    low, high = np.sin(2 * np.pi * 440 * t), np.sin(2 * np.pi * 12000 * t)
    for to in (16000, 22050, 48000):
        got = A.resample(low, 44100, to)
        want = np.sin(2 * np.pi * 440 * np.arange(len(got)) / to)
        assert len(got) == to and np.abs(got - want)[200:-200].max() < 2e-3
    assert np.abs(A.resample(high, 44100, 16000))[200:-200].max() < 0.02  # above half the new rate
    assert len(A.resample(np.zeros(0), 8000, 16000)) == 0


def test_large_files_and_channels(spark, tmp_path):
    import io
    import wave

    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(8000)
        w.writeframes(np.tile(np.array([1000, -1000], "<i2"), 4000).tobytes())
    (tmp_path / "two.wav").write_bytes(out.getvalue())
    f = A.audio_files(spark, str(tmp_path))
    mean, both = A.decoded(f, None, None).first(), A.decoded(f, None, None, mono=False).first()
    assert not any(mean.samples) and [len(c) for c in both.samples] == [4000, 4000] and both.samples[0][0] == -both.samples[1][0]
    mb = len(out.getvalue()) / 2**20
    assert A.decoded(f, 16000, None, only_above_mb=mb * 1.0001).first().sample_rate == 8000
    assert A.decoded(f, 16000, None, only_above_mb=mb * 0.9999).first().sample_rate == 16000


def test_audio(spark, tmp_path):
    wave = np.sin(np.arange(8000) / 20).astype("f4") * 0.5
    for name in ("a/x.wav", "a/y.WAV", "b/z.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(A.wav_bytes(wave, 8000))
    (tmp_path / "a" / "bad.wav").write_bytes(b"nothing")
    files = A.audio_files(spark, str(tmp_path))
    assert files.count() == 3 and A.folders_with_audio(files).count() == 1
    got = {r.path.rsplit("/", 1)[1]: r for r in A.decoded(files).collect()}
    assert got["x.wav"].sample_rate == 16000 and len(got["x.wav"].samples) == 16000
    assert abs(max(map(abs, got["x.wav"].samples)) - 0.95) < 1e-6
    assert got["bad.wav"].samples is None and got["bad.wav"].sample_rate == 0
    good, bad = A.readable(A.decoded(files))
    assert good.count() == 2 and bad.first().path.endswith("bad.wav") and bad.first().error
    quiet = {r.path.rsplit("/", 1)[1]: r for r in A.decoded(files, silence_on_error=True).collect()}
    assert len(quiet["bad.wav"].samples) == 16000
    d = A.decoded(files, rate=None, peak=None).where("samples is not null").withColumn("cut", A.trimmed(F.col("samples"), F.lit(100), F.lit(200), 8000))
    assert {len(r.cut) for r in d.collect()} == {8000 - 800 - 1600}
    A.save_files(A.export(d.withColumn("to", F.concat(F.lit("n/"), F.regexp_extract("path", "[^/]+$", 0), F.lit(".npy"))), "to", "cut", A.npy_bytes), str(tmp_path))
    v = A.read_vectors(spark, str(tmp_path / "n")).collect()
    assert len(v) == 2 and len(v[0].vector) == 5600


def test_model_slot(spark):
    d = spark.createDataFrame([(1, [0.1] * 200), (2, None)], "i int, w array<float>")
    out = {r.i: r.e for r in apply_model(d, "w", "encoder", spectral_embedding(96), "array<double>", "e").collect()}
    assert len(out[1]) == 96 and out[2] is None
    s = spark.createDataFrame([("t", "Complete", False), (" ", None, False), ("t", None, True), ("t", None, False)], "t string, c string, f boolean")
    assert [r[0] for r in s.select(final_status(F.col("t"), F.col("c"), F.col("f"))).collect()] == ["Complete", "Empty", "Error", "Invalid"]


def test_release_rules(spark):
    kind = "segment_path string, audio_quality_score double, text_quality_score double, has_background_music boolean, global_speaker_id int, completion_status string"
    rows = [("ok", 75.0, 0.5, None, 1, None), ("nan", float("nan"), 0.9, False, 1, "Complete"), ("music", 80.0, 0.9, True, 1, "Complete"), ("nobody", 80.0, 0.9, False, -1, "Complete"), ("half", 80.0, 0.9, False, 1, "Incomplete"), ("none", None, 0.9, False, 1, "Complete"), ("empty", 80.0, 0.9, False, 1, "Empty")]
    d = spark.createDataFrame(rows, kind)
    assert {r.segment_path for r in L.releasable(d).collect()} == {"ok", "empty"}
    assert L.releasable(d, strict=True).count() == 0
    s = spark.createDataFrame([("p", 1)], "segment_path string, x int")
    twice = spark.createDataFrame([("p", 1.0), ("p", 2.0)], "segment_path string, a double")
    assert L.combine(s, twice, spark.createDataFrame([], "segment_path string, t double")).count() == 2


def test_config(monkeypatch):
    monkeypatch.setenv("VOXLOOM_ROOT", "/tmp/x")
    assert Config().folder("release") == "/tmp/x/release"
    monkeypatch.setenv("VOXLOOM_TRIMMED", "/else/where")
    from voxloom.pipeline.stages import Corpus

    c = Corpus(None, "/r", None, Config())
    assert (c.at("trimmed"), c.at("speakers/global"), c.at("status")) == ("/else/where", "/r/speakers/global", "/r/status")


def test_intermediate_tables(spark):
    from pathlib import Path

    from voxloom import session

    d = spark.range(20).selectExpr("id", "id % 3 as k")
    plain, parted = session.materialize(d, "a"), session.materialize(d, "b", by="k")
    assert plain.count() == parted.count() == 20 and parted.where("k = 1").count() == 7
    folder = Path(session.shared_folder(spark).removeprefix("file://"))
    before = set(folder.iterdir())
    session.release(parted.where("k = 1"))
    session.release(plain)
    gone = before - set(folder.iterdir())
    assert {p.name[0] for p in gone} == {"a", "b"} and len(gone) == 2
    few, many = spark.range(0, 10, 1, 1), spark.range(0, 1000, 1, 64)
    assert session.spread(few, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and session.spread(many, "id") is many


def test_no_private_folder_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from voxloom import session

    def fake(master):
        return SimpleNamespace(sparkContext=SimpleNamespace(applicationId=f"app-{master}", master=master), conf=SimpleNamespace(get=lambda k, d: ""))

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(fake(master))
    assert session.shared_folder(fake("local[2]")).startswith("file://")
