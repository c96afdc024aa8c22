"""Error rates, similarity tiers, opinion scores and progress of raters."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.operators.text import char_form, eval_form, word_form, words


# Words are spelled as characters from this one on: all planes but the first.
FIRST_CODE, CODES = 0x10000, 0x100000


def word_codes(w: Column, vocabulary: Column) -> Column:
    """A word list as a text with one character per word, numbered by the vocabulary."""
    code = lambda x: F.decode(F.unhex(F.lpad(F.hex(F.array_position(vocabulary, x) + (FIRST_CODE - 1)), 8, "0")), "UTF-32")
    return F.array_join(F.transform(w, code), "")


def edit_distance(a: list[str], b: list[str]) -> int:
    """Edit distance of two word lists of any vocabulary, a row of the table at a time."""
    number = {w: i for i, w in enumerate(dict.fromkeys([*a, *b]))}
    x, y = np.array([number[w] for w in a], "int64"), np.array([number[w] for w in b], "int64")
    steps = np.arange(len(y) + 1)
    row = steps.copy()
    for i, c in enumerate(x):
        new = np.empty_like(row)
        new[0] = i + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (y != c))
        row = np.minimum.accumulate(new - steps) + steps
    return int(row[-1])


def with_word_distance(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Edit distance of two columns of words.

    Each distinct word of a pair becomes one character, then the built-in distance of
    strings applies.  The vocabulary is a column of its own, so that no word makes it anew.
    A pair of more distinct words than there are characters is counted in Python, with the
    same result.
    """
    d = df.withColumn("_v", F.array_distinct(F.concat(a, b)))

    @F.pandas_udf("long")
    def slow(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else edit_distance(list(p), list(q)) for p, q in zip(x, y)], dtype="Int64")

    many = F.size("_v") > CODES
    d = d.withColumn("_slow", slow(F.when(many, F.col(a)), F.when(many, F.col(b))))
    fast = F.levenshtein(word_codes(F.col(a), F.col("_v")), word_codes(F.col(b), F.col("_v")))
    return d.withColumn(name, F.when(many, F.col("_slow")).otherwise(fast)).drop("_v", "_slow")


def _rate(distance: Column, ref_len: Column, hyp_len: Column) -> Column:
    return F.when(ref_len > 0, distance / F.nullif(ref_len, F.lit(0))).when(hyp_len == 0, 0.0).otherwise(1.0)


def with_error_rates(df: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """Add ``wer`` and ``cer``.  An empty reference gives 0 if the hypothesis is empty too,
    else 1; null texts are empty."""
    d = df.withColumn("_r", eval_form(F.col(reference))).withColumn("_h", eval_form(F.col(hypothesis)))
    d = d.withColumns({"_rw": words(word_form(F.col("_r"))), "_hw": words(word_form(F.col("_h"))), "_rc": char_form(F.col("_r")), "_hc": char_form(F.col("_h"))})
    d = with_word_distance(d, "_rw", "_hw", "_wd")
    wer = _rate(F.col("_wd"), F.size("_rw"), F.size("_hw"))
    cer = _rate(F.levenshtein("_rc", "_hc"), F.length("_rc"), F.length("_hc"))
    return d.withColumns({"wer": wer, "cer": cer}).drop("_r", "_h", "_rw", "_hw", "_rc", "_hc", "_wd")


def error_summary(df: DataFrame) -> DataFrame:
    """Mean rates of the clips in percent (every clip counts alike, whatever its length)."""
    return df.where("wer is not null").agg(F.count("*").alias("n"), F.round(F.avg("wer") * 100, 6).alias("mean_wer"), F.round(F.avg("cer") * 100, 6).alias("mean_cer"))


def similarity_tiers(df: DataFrame, score: str) -> DataFrame:
    """Mean, median, spread and the four half-open tiers of a similarity; nulls left out."""
    s = F.col(score)
    n = F.count(s)
    part = lambda c: F.round(100.0 * F.count_if(c) / F.nullif(n, F.lit(0)), 6)
    return df.agg(
        n.alias("n"), F.round(F.avg(s), 6).alias("mean"), F.round(F.median(s), 6).alias("median"), F.round(F.stddev_samp(s), 6).alias("spread"),
        part(s >= 0.8).alias("excellent"), part((s >= 0.7) & (s < 0.8)).alias("good"), part((s >= 0.6) & (s < 0.7)).alias("fair"), part(s < 0.6).alias("poor"),
    )


def group_means(df: DataFrame, group: str, score: str) -> DataFrame:
    return df.where(F.col(group).isNotNull() & F.col(score).isNotNull()).groupBy(group).agg(F.round(F.avg(score), 6).alias("mean"), F.count("*").alias("n"))


def opinion_summary(ratings: DataFrame, by: list[str]) -> DataFrame:
    """Mean opinion score, spread, number and the half-width of its 95 % interval."""
    sd = F.stddev_samp("score")
    return ratings.groupBy(*by).agg(
        F.count("*").alias("n"), F.round(F.avg("score"), 6).alias("mos"), F.round(sd, 6).alias("sd"), F.round(1.96 * sd / F.sqrt(F.count("*")), 6).alias("half_width")
    )


def rater_progress(ratings: DataFrame, n_items: int, n_questions: int = 3) -> DataFrame:
    """Per rater: scores given, items with every question answered, share of the work."""
    item = ratings.groupBy("user_id", "audio_index").agg(F.count_distinct("question").alias("q"))
    return item.groupBy("user_id").agg(
        F.sum("q").alias("answered"), F.count_if(F.col("q") == n_questions).alias("complete_items"), F.round(F.sum("q") / F.lit(n_items * n_questions), 6).alias("progress")
    )


def throughput(events: DataFrame, group: list[str], seconds: str) -> DataFrame:
    """Items, time spent and items per second; none where no time was measured."""
    return events.groupBy(*group).agg(F.count("*").alias("items"), F.sum(seconds).alias("seconds"), (F.count("*") / F.nullif(F.sum(seconds), F.lit(0.0))).alias("per_second"))
