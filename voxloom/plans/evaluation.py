"""Evaluation: error rates, similarity of pairs, ratings."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import metrics as M
from voxloom.operators.sequence import keep_last
from voxloom.plans.base import query, table
from voxloom.sources.tables import first_present

FROM_DIGITS, TO_DIGITS = "۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩٫", "01234567890123456789."


def ratings(spark, d):
    """Every saved score that is a number from 1 to 5, the last per rater, item and question."""
    s = table(spark, d, "user_sessions", "user_id", "scores", "saved_at")
    m = s.select("user_id", "saved_at", F.explode(F.from_json("scores", "map<string,string>")).alias("k", "v"))
    score = F.translate("v", FROM_DIGITS, TO_DIGITS).try_cast("double")
    m = m.select("user_id", F.regexp_extract("k", r"^(\d+)_", 1).cast("int").alias("audio_index"), F.regexp_extract("k", r"^\d+_(.+)$", 1).alias("question"), score.alias("score"), F.col("saved_at").alias("rated_at"))
    return keep_last(m.where("score between 1 and 5"), ["user_id", "audio_index", "question"], [F.col("rated_at"), F.col("score")])


RATINGS = f"""SELECT user_id, regexp_extract(key, '^([0-9]+)_', 1)::INT AS audio_index, regexp_extract(key, '^[0-9]+_(.+)$', 1) AS question, score, rated_at FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, key ORDER BY rated_at DESC, score DESC) AS k FROM (
      SELECT user_id, saved_at AS rated_at, j.key AS key, try_cast(translate(j.value->>'$', '{FROM_DIGITS}', '{TO_DIGITS}') AS DOUBLE) AS score
      FROM (SELECT user_id, saved_at, CASE WHEN json_valid(scores) THEN scores ELSE '{{}}' END AS s FROM user_sessions), json_each(s) AS j) WHERE score BETWEEN 1 AND 5) WHERE k = 1"""


@query(f"SELECT user_id, audio_index, question, score, rated_at FROM ({RATINGS})")
def rating_upsert(spark, d):
    return ratings(spark, d)


@query(f"""SELECT user_id, sum(q)::BIGINT AS answered, count(*) FILTER (q = 3) AS complete_items, round(sum(q) / ((SELECT count(DISTINCT audio_index) FROM samples) * 3.0::DOUBLE), 6) AS progress
    FROM (SELECT user_id, audio_index, count(DISTINCT question) AS q FROM ({RATINGS}) GROUP BY 1, 2) GROUP BY 1""")
def rater_progress(spark, d):
    n = table(spark, d, "samples").agg(F.count_distinct("audio_index")).first()[0]
    return M.rater_progress(ratings(spark, d), n)


@query(f"SELECT user_id, audio_index FROM ({RATINGS}) GROUP BY 1, 2 HAVING count(DISTINCT question) = 3")
def item_complete(spark, d):
    return ratings(spark, d).groupBy("user_id", "audio_index").agg(F.count_distinct("question").alias("q")).where("q = 3").drop("q")


@query(f"SELECT user_id, audio_index, max(score) FILTER (question = 'naturalness') AS naturalness, max(score) FILTER (question = 'similarity') AS similarity, max(score) FILTER (question = 'text_match') AS text_match FROM ({RATINGS}) GROUP BY 1, 2")
def item_scores_wide(spark, d):
    return ratings(spark, d).groupBy("user_id", "audio_index").pivot("question", ["naturalness", "similarity", "text_match"]).agg(F.max("score"))


MOS = "count(*) AS n, round(avg(score), 6) AS mos, round(stddev_samp(score), 6) AS sd, round(1.96 * stddev_samp(score) / sqrt(count(*)), 6) AS half_width"


@query(f"SELECT question, {MOS} FROM ({RATINGS}) GROUP BY 1")
def mos_summary(spark, d):
    return M.opinion_summary(ratings(spark, d), ["question"])


@query(f"SELECT audio_index, question, {MOS} FROM ({RATINGS}) GROUP BY 1, 2")
def mos_by_item(spark, d):
    return M.opinion_summary(ratings(spark, d), ["audio_index", "question"])


@query("SELECT user_id, saved_at, try_cast(age AS INTEGER) BETWEEN 10 AND 100 AS age_ok, current_audio_index < (SELECT count(DISTINCT audio_index) FROM samples) AS index_ok FROM user_sessions")
def session_domain_checks(spark, d):
    n = table(spark, d, "samples").agg(F.count_distinct("audio_index")).first()[0]
    s = table(spark, d, "user_sessions")
    return s.select("user_id", "saved_at", F.col("age").try_cast("int").between(10, 100).alias("age_ok"), (F.col("current_audio_index") < n).alias("index_ok"))


def pairs(spark, d):
    """Each sample beside the next one's transcript as what was recognized."""
    s = table(spark, d, "samples", "sample_id", "transcript").groupBy("sample_id").agg(F.max("transcript").alias("transcript"))
    n = s.select((F.col("sample_id") - 1).alias("sample_id"), F.col("transcript").alias("hypothesis"))
    return s.join(n, "sample_id", "left")


@query()
def wer_cer(spark, d):
    w = M.with_error_rates(pairs(spark, d), "transcript", "hypothesis")
    return w.select("sample_id", F.round("wer", 6).alias("wer"), F.round("cer", 6).alias("cer"))


@query()
def wer_summary(spark, d):
    return M.error_summary(M.with_error_rates(pairs(spark, d), "transcript", "hypothesis"))


@query("SELECT sample_id, transcript, reference_audio, generated_audio, speaker_gender FROM samples WHERE transcript IS NOT NULL AND generated_audio IS NOT NULL")
def eval_samples(spark, d):
    s = table(spark, d, "samples").dropna(subset=["transcript", "generated_audio"])
    return s.select("sample_id", "transcript", "reference_audio", "generated_audio", first_present(s, "speaker_gender", "Gender").alias("speaker_gender"))


SIM = "SELECT *, CASE WHEN audio_quality_score IS NULL OR isnan(audio_quality_score) THEN NULL ELSE round(audio_quality_score / 100, 4) END AS s FROM release_manifest"


def similarities(spark, d):
    q = F.nanvl("audio_quality_score", F.lit(None).cast("double"))
    return table(spark, d, "release_manifest", "segment_id", "audio_quality_score", "global_speaker_id").withColumn("s", F.round(q / 100, 4))


@query(f"""SELECT count(s) AS n, round(avg(s), 6) AS mean, round(median(s), 6) AS median, round(stddev_samp(s), 6) AS spread, round(100.0::DOUBLE * count(*) FILTER (s >= 0.8) / count(s), 6) AS excellent,
    round(100.0::DOUBLE * count(*) FILTER (s >= 0.7 AND s < 0.8) / count(s), 6) AS good, round(100.0::DOUBLE * count(*) FILTER (s >= 0.6 AND s < 0.7) / count(s), 6) AS fair, round(100.0::DOUBLE * count(*) FILTER (s < 0.6) / count(s), 6) AS poor FROM ({SIM})""")
def similarity_tiers(spark, d):
    return M.similarity_tiers(similarities(spark, d), "s")


@query(f"SELECT global_speaker_id, round(avg(s), 6) AS mean, count(*) AS n FROM ({SIM}) WHERE s IS NOT NULL AND global_speaker_id IS NOT NULL GROUP BY 1")
def similarity_by_speaker(spark, d):
    return M.group_means(similarities(spark, d), "global_speaker_id", "s")
