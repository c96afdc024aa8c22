"""Slots for pretrained models, each with a deterministic stand-in that needs no download.

A slot is a factory, called once per Python worker, that returns a function over a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.text import has_text, strip_marks, unify_marks, words

Batch = Callable[[list], list]
_loaded: dict[str, Batch] = {}


def once(name: str, factory: Callable[[], Batch]) -> Batch:
    """A model loaded once per worker."""
    if name not in _loaded:
        _loaded[name] = factory()
    return _loaded[name]


def apply_model(df: DataFrame, column: str, name: str, factory: Callable[[], Batch], kind: str, output: str) -> DataFrame:
    """Add the model's answer for a column, batch by batch; a failing batch is answered
    one by one, and a failing row with null."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{output}` {kind}"

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = once(name, factory)

        def single(x):
            try:
                return model([x])[0]
            except Exception:
                return None

        for pdf in batches:
            values = pdf[column].tolist()
            try:
                out = model(values)
            except Exception:
                out = [single(x) for x in values]
            yield pdf.assign(**{output: pd.Series(out, index=pdf.index, dtype=object)})

    return df.mapInPandas(work, schema)


def completion_status(text: Column) -> Column:
    """Stand-in for the completeness model: a text that ends in a mark or a verb form."""
    return F.when(~has_text(text), "Invalid").when(text.rlike(r"(?:[.!?؟]|است|بود|شد|گفت|رفت|ماند|کرد)\s*$"), "Complete").otherwise("Incomplete")


def final_status(text: Column, completion: Column, failed: Column) -> Column:
    """Status of a finished segment."""
    return F.when(failed, "Error").when(~has_text(text), "Empty").otherwise(F.coalesce(completion, F.lit("Invalid")))


def mark_labels(w: Column) -> Column:
    """Stand-in for the punctuation model: a full stop after the last word, a comma before
    a conjunction, else nothing."""
    pauses = F.array(F.lit("اما"), F.lit("ولی"), F.lit("زیرا"), F.lit("که"))
    n = F.size(w)
    nxt = lambda i: F.get(w, i + 1)
    return F.transform(w, lambda x, i: F.when(i == n - 1, "B-.").when(F.array_contains(pauses, nxt(i)), "B-،").otherwise("O"))


def with_punctuation(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add text with restored marks; blank and null become empty.  The word list is a column
    of its own, so that no lambda evaluates it anew."""
    from voxloom.operators.text import join_marks, squeeze

    d = df.withColumn("_w", words(squeeze(strip_marks(unify_marks(F.col(text))))))
    d = d.withColumn("_l", mark_labels(F.col("_w")))
    return d.withColumn(name, join_marks(F.col("_w"), F.col("_l"))).drop("_w", "_l")


#: A text to its sub-tokens' (place of their word, or None; label), cut off at the model's limit.
Tagger = Callable[[str], list[tuple[int | None, str]]]


def marked(text: str, words_: list[str], tags: list[tuple[int | None, str]]) -> str:
    """Words with the marks of their labels: of a word's sub-tokens the last one speaks for it;
    words beyond the model's limit have none."""
    marks = [""] * len(words_)
    for i, (place, label) in enumerate(tags):
        last = i + 1 == len(tags) or tags[i + 1][0] != place
        if place is not None and place < len(words_) and last:
            marks[place] = "" if label == "O" else label.replace("B-", "")
    return " ".join(w + m for w, m in zip(words_, marks))


def with_tagged_punctuation(df: DataFrame, text: str, name: str, tagger: Callable[[], Tagger]) -> DataFrame:
    """Add text with the marks that a model of sub-tokens restores.  ``tagger`` is called once
    per worker.  A text it fails at stays as it is; blank and null become empty."""
    from voxloom.operators.text import squeeze

    clean = squeeze(strip_marks(unify_marks(F.col(text))))

    @F.pandas_udf("string")
    def restore(cleaned: pd.Series, raw: pd.Series) -> pd.Series:
        model = once("tagger", tagger)

        def one(c, r) -> str:
            if not c:
                return ""
            try:
                return marked(c, c.split(" "), model(c))
            except Exception:
                return r

        return pd.Series([one(c, r) for c, r in zip(cleaned, raw)], dtype=object)

    return df.withColumn(name, restore(clean, F.coalesce(F.col(text), F.lit(""))))


def has_music(labels: Column) -> Column:
    """Whether a segmenter's labels name music; null means none."""
    return F.coalesce(F.array_contains(labels, "music"), F.lit(False))


def spectral_embedding(dim: int = 96) -> Callable[[], Batch]:
    """Stand-in for the speaker encoder: averaged log spectrum, of unit length."""

    def factory() -> Batch:
        def encode(waves: list) -> list:
            out = []
            for w in waves:
                if w is None or len(w) < 2:
                    out.append(None)
                    continue
                s = np.log1p(np.abs(np.fft.rfft(np.asarray(w, "f8"), 2 * dim)))[:dim]
                n = np.linalg.norm(s)
                out.append((s / n).tolist() if n > 0 else None)
            return out

        return encode

    return factory
