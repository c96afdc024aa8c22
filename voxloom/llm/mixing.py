"""Problem 9: sources mixed to target shares of the tokens.

Tokens per source give each source a rate, the expected number of copies of each of its
texts: ``share * total / tokens``, at most its cap.  A text is emitted floor(rate) times
and once more with the fraction as probability, decided by a seeded hash of its identity.
Equal texts are one text, so no wording occurs more often than its source may repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.splitting import _unit
from voxloom.llm.tokens import DEFAULT_RANKS, token_count
from voxloom.session import materialize


def distinct_texts(docs: DataFrame, identifier: str = "doc_id", text: str = "text", source: str = "source", ranks: str = DEFAULT_RANKS) -> DataFrame:
    """``source, doc_id, n_tokens`` of every distinct text that has a source, under its smallest id.

    Null and blank texts have nothing to give and are left out.
    """
    some = docs.where(F.col(source).isNotNull() & F.col(text).rlike(r"\S"))
    # only hashes and ids are shuffled, texts are not
    first = some.select(F.sha2(text, 256).alias("_h"), F.struct(F.col(identifier).alias("i"), F.col(source).alias("s"), token_count(F.col(text), ranks).alias("n")).alias("_r"))
    return first.groupBy("_h").agg(F.min("_r").alias("_r")).select(F.col("_r.s").alias("source"), F.col("_r.i").alias("doc_id"), F.col("_r.n").alias("n_tokens"))


def mixing_rates(texts: DataFrame, targets: DataFrame, total_tokens: int | None = None) -> DataFrame:
    """Per target source: its tokens, share, cap and rate.

    ``total_tokens`` is the size aimed at, by default all tokens that the listed sources
    have.  A source gets ``share * total / tokens`` copies of each text, or its cap where
    that is less: then it gives what the cap allows, no other source makes up for it, and
    the report says what share it reached.  Targets are few, as the user writes them;
    repeated targets of a source are taken once (the largest).
    """
    goal = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    have = texts.groupBy("source").agg(F.sum("n_tokens").alias("source_tokens"), F.count("*").alias("n_texts"))
    t = goal.join(have, "source", "left").fillna(0, ["source_tokens", "n_texts"])
    usable = (F.col("source_tokens") > 0) & (F.col("target_share") > 0)
    share = F.when(usable, F.col("target_share")) / F.sum(F.when(usable, F.col("target_share"))).over(_all())
    t = t.withColumn("_share", share)
    total = F.lit(total_tokens).cast("double") if total_tokens is not None else F.sum(F.when(usable, F.col("source_tokens"))).over(_all())
    rate = F.least(F.col("max_repeats").cast("double"), F.col("_share") * total / F.col("source_tokens"))
    return t.withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("_share")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # over the few target rows only


def mix_sources(texts: DataFrame, rates: DataFrame, seed: int = 42) -> DataFrame:
    """``source, doc_id, copy, n_tokens``: one row per emitted copy, numbered from 1."""
    whole = F.floor(F.col("rate") + 1e-9)
    extra = (_unit(F.col("doc_id").cast("string"), seed) < F.col("rate") - whole).cast("int")
    rows = texts.join(F.broadcast(rates.select("source", "rate")), "source").withColumn("_n", (whole + extra).cast("int"))
    return rows.where("_n > 0").select("source", "doc_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("copy"), "n_tokens")


def mix_report(mixed: DataFrame, rates: DataFrame) -> DataFrame:
    """Target and reached share of every target source."""
    got = mixed.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("n_copies"), F.max("copy").alias("most_copies"))
    r = rates.join(got, "source", "left").fillna(0, ["mixed_tokens", "n_copies", "most_copies"])
    reached = F.coalesce(F.col("mixed_tokens") / F.nullif(F.sum("mixed_tokens").over(_all()), F.lit(0)), F.lit(0.0))
    return r.withColumn("reached_share", reached)


def mixture(docs: DataFrame, targets: DataFrame, seed: int = 42, total_tokens: int | None = None, ranks: str = DEFAULT_RANKS) -> tuple[DataFrame, DataFrame]:
    """The mixed copies and the report, from one pass over the texts."""
    texts = materialize(distinct_texts(docs, ranks=ranks), "texts")
    rates = materialize(mixing_rates(texts, targets, total_tokens).coalesce(1), "rates")
    mixed = mix_sources(texts, rates, seed)
    return mixed, mix_report(mixed, rates)
