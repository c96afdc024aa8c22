"""Command line of the stages: ``python -m voxloom STAGE --transcriber module:function``."""

from __future__ import annotations

import argparse
import importlib
import time

STAGES = ("segment", "trim", "score-audio", "score-text", "embed", "speakers", "release", "all", "wer", "similarity")


def slot(name: str):
    """The object behind ``module:name``."""
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="voxloom", description="From recordings to a speech-text corpus.")
    p.add_argument("stage", choices=STAGES)
    p.add_argument("--root", help="folder of all tables and files (default: the configured one)")
    p.add_argument("--catalog", help="CSV with title, narrator, audio_path (default: catalog.csv in the root)")
    p.add_argument("--transcriber", help="module:function of samples and rate that gives a text")
    p.add_argument("--decoder", help="module:function of bytes that gives samples and rate")
    p.add_argument("--samples", help="CSV of evaluation pairs, for wer and similarity; audio paths are relative to the root")
    p.add_argument("--recognizer", help="module:factory of a batch recognizer, in place of --transcriber (wer)")
    p.add_argument("--encoder", help="module:factory of a batch speaker encoder (similarity)")
    p.add_argument("--output", help="folder for the rows of an evaluation")
    p.add_argument("--retry-failed", action="store_true", help="take up books that failed")
    p.add_argument("--reset", action="store_true", help="forget which books are done")
    p.add_argument("--most-books", type=int, help="only the first so many books, to try things out")
    p.add_argument("--strict", action="store_true", help="release complete segments only")
    p.add_argument("--master", help="Spark master, where the session is not configured otherwise")
    return p


def evaluate(spark, a, root: str, made: dict) -> int:
    from voxloom.functions.models import spectral_embedding
    from voxloom.pipeline import evaluation as E
    from voxloom.sources.tables import read_samples

    if not a.samples or a.stage == "wer" and not (a.transcriber or a.recognizer):
        raise SystemExit("--samples is needed, and for wer --transcriber or --recognizer")
    samples, how = read_samples(spark, a.samples), {k: v for k, v in made.items() if k == "decoder"} | {"out": a.output}
    if a.stage == "wer":
        recognizer = slot(a.recognizer) if a.recognizer else E.transcribing(made["transcriber"])
        tables = E.word_error_rates(spark, samples, root, recognizer, silence=bool(a.recognizer), **how)[1:]
    else:
        tables = E.speaker_similarity(spark, samples, root, slot(a.encoder) if a.encoder else spectral_embedding(), **how)[1:]
    for t in tables:
        t.show(truncate=False)
    return 0


def main(arguments: list[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    from pyspark.sql import SparkSession

    from voxloom.config import Config
    from voxloom.pipeline.stages import Corpus, Models
    from voxloom.session import release_all
    from voxloom.sources.tables import read_catalog_file

    def silent(samples, rate):
        raise RuntimeError("this stage needs --transcriber")

    builder = SparkSession.builder.appName("voxloom")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    root = a.root or Config().root
    made = {"transcriber": slot(a.transcriber) if a.transcriber else silent} | ({"decoder": slot(a.decoder)} if a.decoder else {})
    if a.stage in ("segment", "trim", "all") and not a.transcriber:
        raise SystemExit("--transcriber is needed to segment and to trim")
    if a.stage in ("wer", "similarity"):
        return evaluate(spark, a, root, made)
    corpus = Corpus(spark, root, Models(**made), Config())
    books = lambda: read_catalog_file(spark, a.catalog or f"{root}/catalog.csv")
    how = {"retry_failed": a.retry_failed, "reset": a.reset, "most_books": a.most_books}
    steps = {
        "segment": lambda: corpus.segment(books(), **how),
        "trim": corpus.trim,
        "score-audio": corpus.score_audio,
        "score-text": corpus.score_text,
        "embed": corpus.embed,
        "speakers": corpus.speakers,
        "release": lambda: corpus.release(a.strict),
        "all": lambda: corpus.everything(books(), **how),
    }
    start = time.perf_counter()
    print(f"{a.stage}: {steps[a.stage]().count()} rows after {time.perf_counter() - start:.1f} s")
    release_all(spark)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
