"""Schemas of the stage tables, as DDL, and empty tables of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG = "title string, narrator string, audio_path string"
RAW_SEGMENTS = "segment_path string, original_audio_book_name string, title_index int, narrator string, narrator_index int, final_duration double, number_of_extensions int, completion_status string, final_transcript string, audio_book_time double"
TRIMMED_SEGMENTS = RAW_SEGMENTS + ", audiobook_name string, fixed_segment_path string, start_trimmed_ms int, end_trimmed_ms int, original_duration_ms int, final_duration_ms int, processing_timestamp double"
AUDIO_SCORES = "file_path string, audiobook_folder string, filename string, sample_rate int, duration double, file_size_mb double, snr_db double, dynamic_range_db double, clipping_percentage double, silence_percentage double, has_background_music boolean, is_clean boolean, quality_score double, processing_time double"
TEXT_SCORES = "segment_path string, text string, character_quality double, length_quality double, sentence_quality double, repetition_score double, linguistic_complexity double, phonetic_coverage double, total_score double, quality_tier string"
EVAL_SAMPLES = "transcript string, reference_audio string, generated_audio string, speaker_id string, Gender string, age string, accent string, speaker_type string"
RATINGS = "user_id long, username string, user_name string, user_age string, user_gender string, audio_index int, speaker_id string, speaker_gender string, speaker_age string, accent string, generated_audio string, reference_audio string, transcript string, speaker_type string, question_type string, rating_score double, audio_played timestamp, message_seen timestamp, rating_timestamp timestamp"
USERS = "user_id long, username string, name string, age string, gender string, registration_date timestamp"
BOOK_STATUS = "book_index int, status string"


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)
