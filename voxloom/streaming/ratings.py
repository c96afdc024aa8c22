"""Ratings as a stream: a keyed table that keeps the last score, and sessions of raters."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from voxloom.sources.state import merge_into, read_state

KEY = ["user_id", "audio_index", "question"]
EVENT = "user_id long, audio_index int, question string, score double, kind string, at timestamp"
RATED = "user_id long, audio_index int, question string, score double, at timestamp"
SESSION = "user_id long, answered int, cursor int, scores map<string,double>, last_at timestamp"


def _order() -> list:
    return [F.col("at"), F.col("score")]


def rating_events(spark: SparkSession, path: str, schema: str = EVENT, per_trigger: int = 8) -> DataFrame:
    """Events from the files of a folder, some files at a time."""
    reader: DataStreamReader = spark.readStream
    return reader.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def allowed(question, score):
    """Scores a rater can give: half steps for ``text_match``, whole ones otherwise."""
    fine = F.when(question == "text_match", score * 2).otherwise(score)
    return score.between(1, 5) & (fine == F.floor(fine))


def run_upsert(events: DataFrame, path: str, checkpoint: str):
    """Merge each batch into the ratings at ``path`` (see ``read_ratings``); a repeated batch
    changes nothing, since the last score of a key stays.  A batch costs what it holds."""

    def merge(batch: DataFrame, _: int) -> None:
        new = batch.where((F.col("kind") == "rate") & allowed(F.col("question"), F.col("score"))).select(*KEY, "score", "at")
        merge_into(batch.sparkSession, path, new, KEY, _order())

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """The last score of every rater, item and question merged so far."""
    return read_state(spark, path, RATED, KEY, _order())


def fold_session(state: tuple | None, events: pd.DataFrame) -> tuple:
    """A rater's session after further events: scores, cursor, time.

    ``rate`` sets a score and, once an item has three, moves on; ``jump`` and ``edit`` set
    the cursor; ``reset`` clears the session but not what is already in the ratings table.
    """
    scores, cursor, last = state or ({}, 0, None)
    scores = dict(scores)
    for e in events.sort_values(["at", "audio_index", "question"], na_position="last").itertuples():
        if e.kind == "rate":
            scores[f"{int(e.audio_index)}_{e.question}"] = float(e.score)
            if int(e.audio_index) == cursor and sum(k.startswith(f"{cursor}_") for k in scores) >= 3:
                cursor += 1
        elif e.kind in ("jump", "edit"):
            cursor = int(e.audio_index)
        elif e.kind == "next":
            cursor += 1
        elif e.kind == "reset":
            scores, cursor = {}, 0
        last = e.at
    return scores, cursor, last


def sessions(events: DataFrame) -> DataFrame:
    """Stateful sessions, one per rater; a row per rater and batch that has news."""

    def step(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        old = None
        if state.exists:
            names, values, cursor, last = state.get
            old = (dict(zip(names, values)), cursor, last)
        scores, cursor, last = fold_session(old, pd.concat(list(batches)))
        last = pd.Timestamp(last).to_pydatetime()
        state.update((list(scores), list(scores.values()), cursor, last))
        yield pd.DataFrame({"user_id": [key[0]], "answered": [len(scores)], "cursor": [cursor], "scores": [scores], "last_at": [last]})

    return events.groupBy("user_id").applyInPandasWithState(step, SESSION, "names array<string>, vals array<double>, cursor int, last timestamp", "update", GroupStateTimeout.NoTimeout)


def latencies(ratings: DataFrame) -> DataFrame:
    """Seconds from an item being seen to played, and from played to rated."""
    t = lambda c: F.unix_micros(c) / 1e6
    return ratings.withColumns({"seen_to_played": t("audio_played") - t("message_seen"), "played_to_rated": t("rating_timestamp") - t("audio_played")})


def event_counts(events: DataFrame, window: str = "1 hour", delay: str = "30 minutes") -> DataFrame:
    """Extension: events per window and type, late ones dropped by a watermark."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
