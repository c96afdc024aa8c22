"""Text operators over the segments' transcripts and the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions.models import completion_status, mark_labels, with_punctuation
from voxloom.operators import text as T
from voxloom.plans.base import query, table
from voxloom.profiles import LATIN, PERSIAN, Profile
from voxloom.session import spread


PUNCTUATION = r"\p{P}"


def sql_squeeze(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{T.WS}+', ' ', 'g'), '^ | $', '', 'g')"


def sql_normalize(x: str, p: Profile = PERSIAN) -> str:
    x = f"translate({x}, '{p.replace_from}', '{p.replace_to}')" if p.replace_from else x
    return f"coalesce({sql_squeeze(x)}, '')"


def sql_count(chars: str) -> str:
    return f"(length(t) - length(translate(t, '{chars}', '')))" if chars else "0"


def sql_matches(pattern: str) -> str:
    return f"(length(t) - length(regexp_replace(t, '{pattern}', '', 'g')))"


def sql_features(source: str, key: str, text: str, p: Profile = PERSIAN) -> str:
    """Subquery with the key, the normal form t, the words w and the six features."""
    quoted = lambda xs: ", ".join(f"'{x}'" for x in xs)
    verbs = " OR ".join(f"contains(t, '{v}')" for v in p.verbs)
    letters = "[" + quoted(p.letters) + "]"
    return f"""
    SELECT {key}, t, w,
      CASE WHEN t = '' THEN 0.0 ELSE least(1.0, greatest(0.0, {sql_count(p.letters)}::DOUBLE / length(t) * 0.6 + least({sql_matches(T.DIGIT)}::DOUBLE / length(t) * 10, 0.2)
        + least({sql_matches(PUNCTUATION)}::DOUBLE / length(t) * 5, 0.15) - {sql_count(p.variants)}::DOUBLE / length(t) * 0.5)) END::DOUBLE AS character_quality,
      CASE WHEN t = '' THEN 0.0 WHEN n BETWEEN 5 AND 20 AND length(t) BETWEEN 30 AND 150 THEN 1.0 WHEN n BETWEEN 3 AND 30 AND length(t) BETWEEN 20 AND 200 THEN 0.8
        WHEN n BETWEEN 1 AND 50 AND length(t) BETWEEN 10 AND 300 THEN 0.6 ELSE 0.2 END::DOUBLE AS length_quality,
      CASE WHEN t = '' THEN 0.0::DOUBLE ELSE (CASE WHEN regexp_matches(t, '[.!?؟]$') THEN 0.3::DOUBLE ELSE 0 END) + (CASE WHEN regexp_matches(t, '^[{p.first}]') THEN 0.2::DOUBLE ELSE 0 END)
        + (CASE WHEN {verbs} THEN 0.5::DOUBLE ELSE 0 END) END AS sentence_quality,
      CASE WHEN t = '' THEN 0.0::DOUBLE WHEN n < 3 THEN 1.0::DOUBLE ELSE greatest(len(list_distinct(w))::DOUBLE / n - least(list_max(map_values(list_histogram(w)))::DOUBLE / n * 3, 0.5), 0.0) END::DOUBLE AS repetition_score,
      CASE WHEN t = '' THEN 0.0 ELSE least(1.0, greatest(0.0, len(list_filter(w, lambda x: x IN ({quoted(p.common)})))::DOUBLE / n * 0.4
        + (1.0 - least((length(t) - (n - 1))::DOUBLE / n / 15, 0.5)) * 0.4 + (1.0 - least({sql_count(p.pauses)}::DOUBLE / n * 2, 0.3)) * 0.2)) END::DOUBLE AS linguistic_complexity,
      CASE WHEN t = '' THEN 0.0::DOUBLE ELSE least(len(list_filter({letters}, lambda c: contains(lower(t), c)))::DOUBLE / {len(p.letters)}
        + CASE WHEN regexp_matches(lower(t), '[{p.vowels}]') AND regexp_matches(lower(t), '[{p.consonants}]') THEN 0.2::DOUBLE ELSE 0 END, 1.0::DOUBLE) END AS phonetic_coverage
    FROM (SELECT *, len(w) AS n FROM (SELECT *, CASE WHEN t = '' THEN [] ELSE string_split(t, ' ') END AS w FROM (
      SELECT {key}, {sql_normalize(text, p)} AS t FROM {source})))"""


FEATURES = list(T.WEIGHTS)
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in FEATURES)
TOTAL = "round(" + " + ".join(f"{c} * {w}::DOUBLE" for c, w in T.WEIGHTS.items()) + ", 9)"
TIER = f"CASE WHEN total_score <= 0 THEN NULL WHEN total_score <= {T.LOW_TO} THEN 'low' WHEN total_score <= {T.MID_TO} THEN 'mid' WHEN total_score <= 1.0 THEN 'high' END"
SCORED = f"SELECT *, {TIER} AS quality_tier FROM (SELECT *, {TOTAL} AS total_score FROM ({sql_features('segments', 'segment_id, fixed_segment_path, processing_timestamp', 'final_transcript')}))"


def segments(spark, d):
    return spread(table(spark, d, "segments", "segment_id", "fixed_segment_path", "final_transcript", "processing_timestamp"), "segment_id", "processing_timestamp")


def scored(spark, d):
    return T.with_text_scores(segments(spark, d), "final_transcript")


@query(f"""SELECT segment_id, processing_timestamp, {sql_normalize('final_transcript')} AS normalized,
    translate(coalesce(translate(final_transcript, '{T.MARK_FROM}', '{T.MARK_TO}'), ''), '{T.MARKS}', '') AS unmarked FROM segments""")
def text_normalize(spark, d):
    t = F.col("final_transcript")
    return segments(spark, d).select("segment_id", "processing_timestamp", T.normalize(t).alias("normalized"), T.strip_marks(T.unify_marks(t)).alias("unmarked"))


@query(f"SELECT segment_id, processing_timestamp, {ROUNDED} FROM ({sql_features('segments', 'segment_id, processing_timestamp', 'final_transcript')})")
def text_features(spark, d):
    f = T.with_text_features(segments(spark, d), "final_transcript")
    return f.select("segment_id", "processing_timestamp", *[F.round(c, 6).alias(c) for c in FEATURES])


@query(f"SELECT doc_id, {ROUNDED} FROM ({sql_features('documents', 'doc_id', 'text', LATIN)})")
def text_features_latin(spark, d):
    f = T.with_text_features(spread(table(spark, d, "documents", "doc_id", "text"), "doc_id"), "text", LATIN)
    return f.select("doc_id", *[F.round(c, 6).alias(c) for c in FEATURES])


@query(f"SELECT segment_id, fixed_segment_path AS segment_path, round(total_score, 6) AS total_score, quality_tier FROM ({SCORED})")
def text_scores(spark, d):
    return scored(spark, d).select("segment_id", F.col("fixed_segment_path").alias("segment_path"), F.round("total_score", 6).alias("total_score"), "quality_tier")


@query(f"SELECT quality_tier, count(*) AS n FROM ({SCORED}) WHERE quality_tier IS NOT NULL GROUP BY 1")
def text_tier_counts(spark, d):
    # counting the key itself: a filter on it would be pushed below, and evaluate the scores again and again
    return scored(spark, d).groupBy("quality_tier").agg(F.count("quality_tier").alias("n")).where("n > 0")


@query(f"SELECT count(*) AS n, round(avg(total_score), 6) AS mean, round(median(total_score), 6) AS median, count(*) FILTER (total_score >= {T.PASS_MARK}) AS passed FROM ({SCORED})")
def text_summary(spark, d):
    s = F.col("total_score")
    return scored(spark, d).agg(F.count("*").alias("n"), F.round(F.avg(s), 6).alias("mean"), F.round(F.median(s), 6).alias("median"), F.count_if(s >= T.PASS_MARK).alias("passed"))


CUSTOM = {"length_quality": 0.5, "repetition_score": 0.5}


@query(f"SELECT segment_id, processing_timestamp, round(length_quality * 0.5 + repetition_score * 0.5, 6) AS total_score FROM ({sql_features('segments', 'segment_id, processing_timestamp', 'final_transcript')})")
def text_scores_custom_weights(spark, d):
    return T.with_text_scores(segments(spark, d), "final_transcript", weights=CUSTOM).select("segment_id", "processing_timestamp", F.round("total_score", 6).alias("total_score"))


@query(r"""SELECT title_index, added_at, substring(translate(regexp_replace(title, '[<>:"/\\|?*]', '', 'g'), ' ', '_'), 1, 100) AS file_name FROM audiobooks""")
def filename_sanitize(spark, d):
    return table(spark, d, "audiobooks").select("title_index", "added_at", T.file_name(F.col("title")).alias("file_name"))


@query("SELECT doc_id, CASE WHEN length(text) > 50 THEN substring(text, 1, 50) || '...' ELSE text END AS preview FROM documents")
def text_preview(spark, d):
    return table(spark, d, "documents").select("doc_id", T.preview(F.col("text")).alias("preview"))


VALID = f"coalesce(length({sql_squeeze('final_transcript')}) > 0, false)"
STATUS = rf"CASE WHEN NOT {VALID} THEN 'Invalid' WHEN regexp_matches(final_transcript, '(?:[.!?؟]|است|بود|شد|گفت|رفت|ماند|کرد)\s*$') THEN 'Complete' ELSE 'Incomplete' END"


@query(f"SELECT segment_id, processing_timestamp, {VALID} AS valid, {STATUS} AS status, CASE WHEN {VALID} THEN segment_path END AS written_path FROM segments")
def transcript_validity(spark, d):
    t = F.col("final_transcript")
    s = table(spark, d, "segments", "segment_id", "processing_timestamp", "segment_path", "final_transcript")
    return s.select("segment_id", "processing_timestamp", T.has_text(t).alias("valid"), completion_status(t).alias("status"), F.when(T.has_text(t), F.col("segment_path")).alias("written_path"))


CLEAN = sql_squeeze(f"translate(coalesce(translate(final_transcript, '{T.MARK_FROM}', '{T.MARK_TO}'), ''), '{T.MARKS}', '')")


#: Marks after the words w of a cleaned text, and the words of c.
JOINED = "array_to_string(list_transform(range(len(w)), lambda i: w[i + 1] || CASE WHEN i = len(w) - 1 THEN '.' WHEN w[i + 2] IN ('اما', 'ولی', 'زیرا', 'که') THEN '،' ELSE '' END), ' ')"
SPLIT = "CASE WHEN c = '' THEN [] ELSE string_split(c, ' ') END"


@query(f"SELECT segment_id, processing_timestamp, {JOINED} AS punctuated FROM (SELECT *, {SPLIT} AS w FROM (SELECT segment_id, processing_timestamp, {CLEAN} AS c FROM segments))")
def punctuation_restored(spark, d):
    return with_punctuation(segments(spark, d), "final_transcript", "punctuated").select("segment_id", "processing_timestamp", "punctuated")


@query(f"""SELECT segment_id, processing_timestamp, len(w) AS n_words, array_to_string(list_transform(range(len(w)), lambda i: CASE WHEN i = len(w) - 1 THEN 'B-.' WHEN w[i + 2] IN ('اما', 'ولی', 'زیرا', 'که') THEN 'B-،' ELSE 'O' END), ' ') AS labels
    FROM (SELECT *, {SPLIT} AS w FROM (SELECT segment_id, processing_timestamp, {sql_normalize('final_transcript')} AS c FROM segments))""")
def punctuation_labels(spark, d):
    s = segments(spark, d).select("segment_id", "processing_timestamp", T.words(T.normalize(F.col("final_transcript"))).alias("words"))
    return s.select("segment_id", "processing_timestamp", F.size("words").alias("n_words"), F.array_join(mark_labels(F.col("words")), " ").alias("labels"))


@query()
def eval_normal_forms(spark, d):
    t = T.eval_form(F.col("final_transcript"))
    s = segments(spark, d).select("segment_id", t.alias("form"))
    return s.select("segment_id", "form", T.word_form(F.col("form")).alias("word_form"), T.char_form(F.col("form")).alias("char_form"))
