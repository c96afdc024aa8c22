from datetime import datetime, timedelta

import pandas as pd

from voxloom.streaming import ratings as R

START = datetime(2025, 1, 1)


def events():
    rows = [(1, 0, "naturalness", 3.0, "rate"), (1, 0, "naturalness", 4.0, "rate"), (1, 0, "similarity", 2.0, "rate"), (1, 0, "text_match", 2.5, "rate"), (2, 0, "similarity", 2.5, "rate"), (2, 5, None, None, "jump"), (2, 5, "similarity", 5.0, "rate")]
    return [(*r, START + timedelta(seconds=i)) for i, r in enumerate(rows)]


def test_upsert_stream(spark, tmp_path):
    e = events()
    for i, part in enumerate((e[:3], e[3:])):
        spark.createDataFrame(part, R.EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = R.run_upsert(R.rating_events(spark, str(tmp_path / "in"), per_trigger=1), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {(r.user_id, r.audio_index, r.question): r.score for r in R.read_ratings(spark, str(tmp_path / "out")).collect()}
    # a half step counts for text_match only
    assert got == {(1, 0, "naturalness"): 4.0, (1, 0, "similarity"): 2.0, (1, 0, "text_match"): 2.5, (2, 5, "similarity"): 5.0}


def test_session_fold():
    pdf = pd.DataFrame(events(), columns=["user_id", "audio_index", "question", "score", "kind", "at"])
    scores, cursor, _ = R.fold_session(None, pdf[pdf.user_id == 1])
    assert cursor == 1 and scores["0_naturalness"] == 4.0
    scores, cursor, _ = R.fold_session((scores, cursor, START), pd.DataFrame([(1, None, None, None, "reset", START)], columns=pdf.columns))
    assert scores == {} and cursor == 0


def test_session_stream(spark, tmp_path):
    spark.createDataFrame(events(), R.EVENT).coalesce(1).write.parquet(str(tmp_path / "in"))
    q = R.sessions(R.rating_events(spark, str(tmp_path / "in"))).writeStream.outputMode("update").format("memory").queryName("sessions").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r.user_id: (r.answered, r.cursor) for r in spark.sql("select * from sessions").collect()}
    assert got == {1: (3, 1), 2: (2, 5)}
