"""Catalog and release: the flagship joins, filters and totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions.models import with_punctuation
from voxloom.operators import release as L
from voxloom.operators.sequence import keep_last
from voxloom.plans.base import query, table
from voxloom.plans.text_quality import CLEAN, JOINED, SCORED, SPLIT, scored
from voxloom.sources.tables import catalog


@query("""WITH a AS (SELECT title_index AS book, added_at, title, coalesce(narrator, 'unknown') AS narrator, '/data/' || audio_path AS full_path FROM audiobooks),
    t AS (SELECT title, row_number() OVER (ORDER BY min(book)) - 1 AS title_index FROM a GROUP BY 1), n AS (SELECT narrator, row_number() OVER (ORDER BY min(book)) - 1 AS narrator_index FROM a GROUP BY 1)
    SELECT a.book, added_at, full_path, title_index::INT AS title_index, narrator_index::INT AS narrator_index FROM a JOIN t USING (title) JOIN n USING (narrator)""")
def catalog_index(spark, d):
    a = table(spark, d, "audiobooks").select(F.col("title_index").alias("book"), "added_at", "title", "narrator", "audio_path")
    return catalog(a, "/data", "book").select("book", "added_at", F.regexp_replace("full_path", "^/data//", "/data//").alias("full_path"), "title_index", "narrator_index")


def labels(spark, d):
    """Segments with the speaker of their latest release row."""
    r = table(spark, d, "release_manifest", "segment_path", "global_speaker_id", "speaker_confidence", "released_at")
    who = keep_last(r.withColumn("global_speaker_id", F.coalesce("global_speaker_id", F.lit(-1))), ["segment_path"], [F.col("released_at"), F.col("global_speaker_id"), F.col("speaker_confidence")])
    s = table(spark, d, "segments", "segment_id", "fixed_segment_path", "final_transcript", "final_duration_ms", "completion_status", "processing_timestamp")
    s = keep_last(s, ["segment_id"], [F.col("processing_timestamp"), F.col("completion_status")]).withColumnRenamed("fixed_segment_path", "segment_path")
    return s.join(who.drop("released_at"), "segment_path")


def audio(spark, d):
    """Latest audio score of each path; a music flag for one path in 23."""
    r = table(spark, d, "release_manifest", "segment_id", "segment_path", "audio_quality_score", "released_at")
    score = r.withColumn("audio_quality_score", L.number(F.col("audio_quality_score")))
    last = keep_last(score, ["segment_path"], [F.col("released_at"), F.col("audio_quality_score")])
    music = F.when(F.col("segment_id") % 3 == 0, F.col("segment_id") % 23 == 0)
    return last.select("segment_path", "audio_quality_score", music.alias("has_background_music"))


def text(spark, d):
    t = scored(spark, d).select(F.col("fixed_segment_path").alias("segment_path"), F.col("total_score").alias("text_quality_score"), "processing_timestamp")
    return keep_last(t, ["segment_path"], [F.col("processing_timestamp"), F.col("text_quality_score")]).drop("processing_timestamp")


COLUMNS = ["segment_path", "final_transcript_punctuated", "final_duration_ms", "global_speaker_id", "speaker_confidence", "audio_quality_score", "text_quality_score"]


def released(spark, d, strict=False):
    return L.releasable(L.combine(labels(spark, d), audio(spark, d), text(spark, d)), strict)


LATEST = """seg AS (SELECT segment_id, fixed_segment_path AS segment_path, final_transcript, final_duration_ms, completion_status FROM (SELECT *, row_number() OVER (PARTITION BY segment_id
      ORDER BY processing_timestamp DESC, completion_status DESC NULLS LAST) AS k FROM segments) WHERE k = 1),
    who AS (SELECT segment_path, g AS global_speaker_id, speaker_confidence FROM (SELECT *, coalesce(global_speaker_id, -1) AS g, row_number() OVER (PARTITION BY segment_path
      ORDER BY released_at DESC, coalesce(global_speaker_id, -1) DESC, speaker_confidence DESC) AS k FROM release_manifest) WHERE k = 1),
    aud AS (SELECT segment_path, q AS audio_quality_score, CASE WHEN segment_id % 3 = 0 THEN segment_id % 23 = 0 END AS has_background_music FROM (SELECT *, row_number() OVER (PARTITION BY segment_path
      ORDER BY released_at DESC, q DESC NULLS LAST) AS k FROM (SELECT *, CASE WHEN isnan(audio_quality_score) THEN NULL ELSE audio_quality_score END AS q FROM release_manifest)) WHERE k = 1),"""
TXT = f"""txt AS (SELECT segment_path, total_score AS text_quality_score FROM (SELECT fixed_segment_path AS segment_path, total_score, row_number() OVER (PARTITION BY fixed_segment_path
      ORDER BY processing_timestamp DESC, total_score DESC) AS k FROM ({SCORED})) WHERE k = 1)"""
MERGED = f"WITH {LATEST} {TXT}, merged AS (SELECT * FROM seg JOIN who USING (segment_path) LEFT JOIN aud USING (segment_path) LEFT JOIN txt USING (segment_path))"
PASSES = "audio_quality_score >= 75 AND text_quality_score >= 0.5 AND NOT coalesce(has_background_music, false) AND global_speaker_id <> -1"


@query(f"""{MERGED} SELECT segment_path, {JOINED} AS final_transcript_punctuated, final_duration_ms, global_speaker_id, round(speaker_confidence, 6) AS speaker_confidence,
    round(audio_quality_score, 6) AS audio_quality_score, round(text_quality_score, 6) AS text_quality_score
    FROM (SELECT *, {SPLIT} AS w FROM (SELECT *, {CLEAN} AS c FROM merged WHERE {PASSES} AND completion_status IS DISTINCT FROM 'Incomplete'))""")
def release_manifest(spark, d):
    r = with_punctuation(released(spark, d), "final_transcript", "final_transcript_punctuated")
    return L.present(r, COLUMNS).withColumns({c: F.round(c, 6) for c in ("speaker_confidence", "audio_quality_score", "text_quality_score")})


@query(f"{MERGED} SELECT count(*) AS segments, round(sum(final_duration_ms) / 3600000, 6) AS hours, count(DISTINCT global_speaker_id) AS speakers FROM merged WHERE {PASSES} AND completion_status IS DISTINCT FROM 'Incomplete'")
def release_summary(spark, d):
    return L.totals(released(spark, d))


@query(f"{MERGED} SELECT count(*) AS segments, round(sum(final_duration_ms) / 3600000, 6) AS hours, count(DISTINCT global_speaker_id) AS speakers FROM merged WHERE {PASSES} AND completion_status IS NOT DISTINCT FROM 'Complete'")
def release_summary_strict(spark, d):
    return L.totals(released(spark, d, strict=True))


@query(f"""{MERGED} SELECT count(*) AS labelled, count(*) FILTER (length(coalesce(final_transcript, '')) > 0) AS with_text, count(*) FILTER (audio_quality_score >= 75) AS good_audio,
    count(*) FILTER (text_quality_score >= 0.5) AS good_text, count(*) FILTER ({PASSES} AND completion_status IS DISTINCT FROM 'Incomplete') AS released FROM merged""")
def stage_funnel(spark, d):
    m = L.combine(labels(spark, d), audio(spark, d), text(spark, d))
    ok = (F.col("audio_quality_score") >= 75) & (F.col("text_quality_score") >= 0.5) & ~F.coalesce("has_background_music", F.lit(False)) & (F.col("global_speaker_id") != -1)
    ok = ok & ~F.col("completion_status").eqNullSafe("Incomplete")
    return m.agg(
        F.count("*").alias("labelled"), F.count_if(F.length(F.coalesce("final_transcript", F.lit(""))) > 0).alias("with_text"), F.count_if(F.col("audio_quality_score") >= 75).alias("good_audio"),
        F.count_if(F.col("text_quality_score") >= 0.5).alias("good_text"), F.count_if(ok).alias("released"),
    )


@query("SELECT title_index, count(*) AS segments, round(sum(final_duration_ms) / 3600000, 6) AS hours FROM segments GROUP BY 1")
def book_totals(spark, d):
    return table(spark, d, "segments").groupBy("title_index").agg(F.count("*").alias("segments"), F.round(F.sum("final_duration_ms") / 3_600_000, 6).alias("hours"))
