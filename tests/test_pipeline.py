import numpy as np
import pytest

from voxloom.pipeline import recordings as R
from voxloom.pipeline.stages import Corpus, Models, ends_with_mark
from voxloom.sources import audio as A

RATE = 16000


def tone(seconds, pitch):
    t = np.arange(int(seconds * RATE)) / RATE
    return (0.6 * np.sin(2 * np.pi * pitch * t) * (0.6 + 0.4 * np.sin(2 * np.pi * 3 * t))).astype("f4")


def speech(n, pitch, seed):
    """Bursts of a tone with pauses between them."""
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(n):
        parts += [np.zeros(int(RATE * 0.4), "f4"), tone(1.2 + 0.3 * rng.random(), pitch) + 0.002 * rng.normal(size=1).astype("f4")]
    return np.concatenate([*parts, np.zeros(RATE // 3, "f4")])


def listen(samples, rate):
    """A transcriber that hears how long the tone is: part of the text for each quarter of a second."""
    loud = int((np.abs(samples) > 0.05).sum() / rate / 0.2)
    words = ["او", "به", "خانه", "رفت", "و", "کتاب", "را", "از", "روی", "میز"]
    return " ".join(words[i % 10] for i in range(loud)) + " گفت." if loud else None


def test_islands_like_the_declared_form():
    y = np.concatenate([tone(0.3, 200), np.zeros(RATE // 2, "f4"), tone(0.3, 300)])
    got = R.islands(y, R.energy_detector())
    assert len(got) == 2 and got[0][0] == 0 and abs(got[0][1] - 0.3) < 0.04 and abs(got[1][1] - 1.1) < 1e-9
    flags = iter([1, -1, 1, 0, -1, 1])
    assert R.islands(np.zeros(480 * 6 + 1), lambda f, r: np.array([next(flags) for _ in f])) == [(0.0, 0.09), (0.15, (480 * 6 + 1) / RATE)]
    assert R.islands(np.zeros(0), R.energy_detector()) == [] and len(R.frames(np.zeros(960))) == 1 and len(R.frames(np.zeros(960), True)) == 2


def test_extension_visits_only_what_it_needs():
    asked = []

    def transcribe(x, rate):
        asked.append(len(x))
        return "تمام شد." if len(x) >= 0.5 * RATE else "نیمه"

    assert R.extended(np.zeros(RATE), (0.0, 0.2), transcribe, ends_with_mark) == (0.0, pytest.approx(0.5), 3) and len(asked) == 4
    assert R.extended(np.zeros(RATE), (0.0, 0.2), lambda x, r: 1 / 0, ends_with_mark) == (0.0, 0.2, 0)
    assert R.extended(np.zeros(RATE * 9), (0.0, 0.2), lambda x, r: "نیمه", ends_with_mark)[2] == 50
    texts = iter(["نیمه", "نیمه", ""])
    assert R.extended(np.zeros(RATE), (0.0, 0.2), lambda x, r: next(texts), ends_with_mark)[2] == 1


def test_repair_and_transcripts():
    assert R.repaired([(3.0, 5.0, 1), (0.0, 2.0, 0), (4.0, 4.5, 0)]) == [(0.0, 2.0, 0), (2.0, 5.0, 1)]
    assert R.repaired([]) == []

    def transcribe(x, rate):
        if len(x) == 3:
            raise RuntimeError
        return {1: "یک گفت.", 2: None}[len(x)]

    cut = [(0, 1 / RATE, 0), (0, 2 / RATE, 0), (0, 3 / RATE, 0)]
    assert R.transcribed(np.zeros(9), cut, transcribe, ends_with_mark) == [("یک گفت.", "Complete"), ("", "Empty"), ("", "Error")]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("corpus")
    for book, pitches in (("one", (220, 220)), ("two", (220, 450)), ("three", (450,))):
        (root / "in" / book).mkdir(parents=True)
        for i, p in enumerate(pitches):
            (root / "in" / book / f"{i}.wav").write_bytes(A.wav_bytes(speech(6, p, i)))
    (root / "in" / "broken.wav").write_bytes(b"no sound")
    rows = [(b, "someone", f"{root}/in/{b}") for b in ("one", "two", "three")] + [("broken", None, f"{root}/in/broken.wav"), ("absent", None, f"{root}/in/one/notes")]
    (root / "in" / "one" / "notes").mkdir()
    (root / "in" / "one" / "notes" / "readme.txt").write_text("x")
    books = spark.createDataFrame(rows, "title string, narrator string, audio_path string")
    c = Corpus(spark, str(root / "out"), Models(listen))
    return c, books, c.everything(books)


def test_from_recordings_to_release(spark, corpus):
    c, books, released = corpus
    s = c.table("segments").toPandas()
    assert set(s["original_audio_book_name"]) == {"one", "two", "three"} and len(s) == 30
    one = s[s["original_audio_book_name"] == "one"].sort_values("segment_path")
    assert [p.rsplit("_", 1)[1] for p in one["segment_path"]] == [f"{i:06d}.wav" for i in range(12)]  # numbers run through both files
    assert (s["completion_status"] == "Complete").all()
    t = c.table("trimmed").toPandas()
    assert len(t) == 30 and (t["start_trimmed_ms"] >= 300).any() and (t["final_duration_ms"] + t["start_trimmed_ms"] + t["end_trimmed_ms"] == t["original_duration_ms"]).all()
    a = c.table("audio_scores").toPandas()
    assert len(a) == 30 and (a["quality_score"] > 0).all() and (a["file_size_mb"] > 0).all() and set(a["audiobook_folder"]) == set(t["audiobook_name"])
    assert c.table("text_scores").count() == 30 and c.table("embeddings").count() == 30
    labels = spark.read.parquet(c.at("speakers/global")).toPandas()
    assert (labels["global_speaker_id"] >= 0).any() and len(labels)
    r = released.toPandas()
    assert list(r.columns) == ["segment_path", "final_transcript_punctuated", "final_duration_ms", "global_speaker_id", "speaker_confidence", "audio_quality_score", "text_quality_score"]
    assert set(r["segment_path"]) <= set(labels["segment_path"]) and spark.read.option("header", True).csv(c.at("release")).count() == len(r)


def test_stages_go_on_where_they_stopped(spark, corpus):
    c, books, _ = corpus
    from voxloom.sources.checkpoint import Checkpoint

    state = Checkpoint(spark, c.at("status"))
    assert len(state.completed) == 3 and len(state.failed) == 2
    before = {n: c.table(n).count() for n in ("segments", "trimmed", "audio_scores", "text_scores", "embeddings")}
    c.segment(books)
    c.trim(), c.score_audio(), c.score_text(), c.embed()
    assert before == {n: c.table(n).count() for n in before}
    from pathlib import Path

    Path(books.where("title = 'broken'").first().audio_path).write_bytes(A.wav_bytes(speech(5, 300, 9)))
    assert c.segment(books).count() == 30  # failed books wait until they are asked for
    assert c.segment(books, retry_failed=True).count() == 35
    assert c.trim().count() == 35


def test_command_line(spark, tmp_path, monkeypatch):
    from voxloom.__main__ import main, parser

    assert parser().parse_args(["release", "--strict"]).strict
    with pytest.raises(SystemExit):
        main(["segment", "--root", str(tmp_path)])
    (tmp_path / "b.wav").write_bytes(A.wav_bytes(speech(4, 200, 1)))
    (tmp_path / "catalog.csv").write_text(f"title,narrator,audio_path\nb,,{tmp_path}/b.wav\n")
    assert main(["segment", "--root", str(tmp_path), "--transcriber", "tests.test_pipeline:listen"]) == 0
    assert spark.read.parquet(str(tmp_path / "segments")).count() == 4
    assert main(["trim", "--root", str(tmp_path), "--transcriber", "tests.test_pipeline:listen"]) == 0
    assert main(["score-text", "--root", str(tmp_path)]) == 0


def test_evaluation(spark, tmp_path):
    from voxloom.__main__ import main
    from voxloom.functions.models import spectral_embedding
    from voxloom.pipeline import evaluation as E

    for name, y in (("a", tone(1, 220)), ("b", tone(1, 220) * 0.5), ("c", tone(1, 900))):
        (tmp_path / f"{name}.wav").write_bytes(A.wav_bytes(y))
    text = listen(tone(1, 220), RATE)
    rows = [(text, "a.wav", "b.wav", "f"), ("چیز دیگری", "a.wav", "c.wav", "m"), (text, "a.wav", "missing.wav", None), (None, "a.wav", "b.wav", "f")]
    samples = spark.createDataFrame(rows, "transcript string, reference_audio string, generated_audio string, Gender string")
    rates, summary = E.word_error_rates(spark, samples, str(tmp_path), E.transcribing(listen))
    got = {(r.transcript, r.generated_audio): r for r in rates.collect()}
    assert len(got) == 3 and got[(text, "missing.wav")].hypothesis == "" and got[(text, "missing.wav")].wer == 1 and summary.first().n == 3
    assert got[(text, "b.wav")].wer < 0.5 and got[("چیز دیگری", "c.wav")].wer > 1
    rows_, tiers, means = E.speaker_similarity(spark, samples, str(tmp_path), spectral_embedding(), out=str(tmp_path / "out"))
    s = {r.generated_audio: r.similarity for r in rows_.collect()}
    assert s["b.wav"] > s["c.wav"] and s["missing.wav"] is None and tiers.first().n == 3 and {r.gender for r in means.collect()} == {"f", "m"}
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 4
    (tmp_path / "s.csv").write_text(f"transcript,reference_audio,generated_audio,Gender\n{text},a.wav,b.wav,f\n")
    assert main(["wer", "--root", str(tmp_path), "--samples", str(tmp_path / "s.csv"), "--transcriber", "tests.test_pipeline:listen"]) == 0
    assert main(["similarity", "--root", str(tmp_path), "--samples", str(tmp_path / "s.csv")]) == 0


def test_tagged_punctuation(spark):
    from voxloom.functions.models import with_tagged_punctuation

    def factory():
        def tag(text):
            if "خطا" in text:
                raise RuntimeError
            out = [(None, "O")]
            for i, w in enumerate(text.split(" ")[:3]):  # the model's limit: three words
                out += [(i, "B-؟"), (i, "B-." if i == 2 else "O")] if len(w) > 2 else [(i, "B-،")]
            return out + [(None, "B-.")]

        return tag

    d = spark.createDataFrame([(1, "او رفت خانه  دیر"), (2, "خطا, اینجا"), (3, "  "), (4, None)], "i int, t string")
    assert {r.i: r.p for r in with_tagged_punctuation(d, "t", "p", factory).collect()} == {1: "او، رفت خانه. دیر", 2: "خطا, اینجا", 3: "", 4: ""}
