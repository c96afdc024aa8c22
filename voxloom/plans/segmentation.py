"""Sequence, signal and search operators over events and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import search as R
from voxloom.operators import signal as S
from voxloom.operators.sequence import number_within
from voxloom.plans.base import query, table


def frames(spark, d):
    """Events as frames of a recording per user: speech where the value is above 20,
    undecodable where it is a whole hundred seventh."""
    e = table(spark, d, "events")
    return e.select(F.col("user_id").alias("file_id"), "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("moment"), F.when(F.col("event_id") % 37 != 0, F.col("value") > 20).alias("is_speech"))


FRAMES = "SELECT user_id AS file_id, event_id, epoch_us(ts) / 1e6 AS moment, CASE WHEN event_id % 37 <> 0 THEN value > 20 END AS is_speech FROM events"


@query(f"""WITH f AS ({FRAMES}), total AS (SELECT file_id, max(moment) + 0.03 AS total FROM f GROUP BY 1),
    k AS (SELECT *, lead(moment) OVER o AS nxt, CASE WHEN is_speech = lag(is_speech) OVER o THEN 0 ELSE 1 END AS new FROM f WHERE is_speech IS NOT NULL WINDOW o AS (PARTITION BY file_id ORDER BY moment, event_id)),
    r AS (SELECT *, sum(new) OVER (PARTITION BY file_id ORDER BY moment, event_id ROWS UNBOUNDED PRECEDING) AS run FROM k)
    SELECT file_id, round(min(moment), 6) AS island_start, round(coalesce(arg_max(nxt, (moment, event_id)), max(total)), 6) AS island_end
    FROM (SELECT r.file_id, run, moment, event_id, coalesce(nxt, total) AS nxt, total FROM r JOIN total USING (file_id) WHERE is_speech) GROUP BY file_id, run""")
def vad_islands(spark, d):
    i = S.speech_islands(frames(spark, d), "file_id", "moment", ["moment", "event_id"], "is_speech", F.max("moment") + 0.03)
    return i.select("file_id", F.round("island_start", 6).alias("island_start"), F.round("island_end", 6).alias("island_end"))


@query("""SELECT segment_id, processing_timestamp, unnest(range(0, original_duration_ms * 16 - 480, 480)) AS frame_start FROM segments WHERE original_duration_ms * 16 > 480""")
def frame_split(spark, d):
    s = table(spark, d, "segments", "segment_id", "processing_timestamp", "original_duration_ms")
    return s.select("segment_id", "processing_timestamp", F.explode(S.frame_starts(F.col("original_duration_ms") * 16)).alias("frame_start"))


def intervals(spark, d):
    s = table(spark, d, "segments", "segment_id", "title_index", "audio_book_time", "final_duration", "processing_timestamp")
    return s.withColumn("s", F.col("audio_book_time")).withColumn("e", F.col("audio_book_time") + F.col("final_duration") * 1000)


def span():
    """Spans of a book's time, so that a book with very many segments is sorted in parts."""
    return F.floor(F.col("s") / 600_000)


INTERVALS = "SELECT segment_id, title_index, processing_timestamp, audio_book_time AS s, audio_book_time + final_duration * 1000 AS e FROM segments"


@query(f"""WITH i AS ({INTERVALS}), w AS (SELECT *, greatest(max(e) OVER (PARTITION BY title_index ORDER BY s, segment_id, processing_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      first_value(s) OVER (PARTITION BY title_index ORDER BY s, segment_id, processing_timestamp)) AS fixed FROM i)
    SELECT segment_id, processing_timestamp, round(fixed, 6) AS fixed_start, round(e, 6) AS fixed_end FROM w WHERE fixed < e""")
def timeline_repair(spark, d):
    r = S.repair_timeline(intervals(spark, d), "title_index", "s", "e", ["s", "segment_id", "processing_timestamp"], bucket=span())
    return r.select("segment_id", "processing_timestamp", F.round("fixed_start", 6).alias("fixed_start"), F.round("fixed_end", 6).alias("fixed_end"))


@query(f"""WITH i AS ({INTERVALS}), w AS (SELECT *, greatest(s, max(e) OVER (PARTITION BY title_index ORDER BY s, segment_id, processing_timestamp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS fixed FROM i)
    SELECT segment_id, processing_timestamp, round(fixed, 6) AS fixed_start, round(e, 6) AS fixed_end FROM w WHERE fixed < e""")
def timeline_repair_overlaps_only(spark, d):
    r = S.repair_timeline(intervals(spark, d), "title_index", "s", "e", ["s", "segment_id", "processing_timestamp"], fill_gaps=False, bucket=span())
    return r.select("segment_id", "processing_timestamp", F.round("fixed_start", 6).alias("fixed_start"), F.round("fixed_end", 6).alias("fixed_end"))


def pcm(spark, d):
    """Events as samples of a clip per user, signed by the parity of the event."""
    return table(spark, d, "events").select(F.col("user_id").alias("clip_id"), "event_id", (F.col("value") / 500 * F.when(F.col("event_id") % 2 == 0, 1).otherwise(-1)).alias("y"))


PCM = "SELECT user_id AS clip_id, event_id, value / 500 * (CASE WHEN event_id % 2 = 0 THEN 1 ELSE -1 END) AS y FROM events"
DB = "CASE WHEN {0} > 0 THEN {1} * log10({0}) ELSE '-infinity'::DOUBLE END"
METRICS = f"""SELECT *, {DB.format("(power / (floor + 1e-10))", 10)} AS snr_db, {DB.format("(peak / (rms + 1e-10))", 20)} AS dynamic_range_db FROM (
    SELECT clip_id, count(*) AS n_samples, sqrt(avg(y * y)) AS rms, max(abs(y)) AS peak, avg(y * y) AS power, quantile_cont(y * y, 0.05) AS floor,
    100.0::DOUBLE * count(*) FILTER (abs(y) > 0.95) / count(*) AS clipping_percentage, 100.0::DOUBLE * count(*) FILTER (abs(y) < 0.01) / count(*) AS silence_percentage FROM ({PCM}) GROUP BY 1)"""
METRIC_NAMES = ["rms", "peak", "power", "floor", "clipping_percentage", "silence_percentage", "snr_db", "dynamic_range_db"]


@query(f"SELECT clip_id, n_samples, {', '.join(f'round({c}, 6) AS {c}' for c in METRIC_NAMES)} FROM ({METRICS})")
def clip_metrics(spark, d):
    return S.clip_metrics(pcm(spark, d), "clip_id", "y").select("clip_id", "n_samples", *[F.round(c, 6).alias(c) for c in METRIC_NAMES])


def scored_clips(spark, d):
    m = S.clip_metrics(pcm(spark, d), "clip_id", "y")
    m = m.withColumns({"duration": F.col("n_samples") / 10.0, "sample_rate": F.element_at(F.array(*[F.lit(x) for x in (8000, 16000, 22050, 44100)]), (F.col("clip_id") % 4 + 1).cast("int")), "is_clean": F.col("clip_id") % 5 != 0})
    score = S.clip_score(F.col("snr_db"), F.col("sample_rate"), F.col("clipping_percentage"), F.col("silence_percentage"), F.col("dynamic_range_db"), F.col("duration"), F.col("is_clean"))
    return m.withColumn("quality_score", score)


CLIPS = f"""SELECT *, CASE WHEN duration < 1 THEN 0.0 ELSE least(100.0, greatest(0.0, 50 + CASE WHEN snr_db > 20 THEN 30 WHEN snr_db > 10 THEN 20 WHEN snr_db > 5 THEN 10 ELSE 0 END
      + CASE WHEN sample_rate >= 44100 THEN 15 WHEN sample_rate >= 22050 THEN 10 WHEN sample_rate >= 16000 THEN 5 ELSE 0 END
      - CASE WHEN clipping_percentage > 5 THEN 20 WHEN clipping_percentage > 1 THEN 10 WHEN clipping_percentage > 0.1 THEN 5 ELSE 0 END
      - CASE WHEN silence_percentage > 50 THEN 15 WHEN silence_percentage > 30 THEN 10 WHEN silence_percentage > 20 THEN 5 ELSE 0 END
      + CASE WHEN dynamic_range_db > 20 THEN 10 WHEN dynamic_range_db > 15 THEN 7 WHEN dynamic_range_db > 10 THEN 5 ELSE 0 END
      + CASE WHEN duration BETWEEN 30 AND 300 THEN 10 WHEN duration BETWEEN 10 AND 600 THEN 5 ELSE 0 END + CASE WHEN is_clean THEN 10 ELSE 0 END)) END::DOUBLE AS quality_score
    FROM (SELECT *, n_samples / 10.0::DOUBLE AS duration, [8000, 16000, 22050, 44100][(clip_id % 4 + 1)::INT] AS sample_rate, clip_id % 5 <> 0 AS is_clean FROM ({METRICS}))"""


@query(f"SELECT clip_id, quality_score, CASE WHEN quality_score >= 90 THEN 'high' WHEN quality_score >= 75 THEN 'mid' ELSE 'low' END AS audio_tier FROM ({CLIPS})")
def clip_scores(spark, d):
    q = F.col("quality_score")
    return scored_clips(spark, d).select("clip_id", "quality_score", F.when(q >= 90, "high").when(q >= 75, "mid").otherwise("low").alias("audio_tier"))


@query(f"SELECT clip_id, quality_score FROM ({CLIPS}) WHERE quality_score >= 75 AND sample_rate >= 22050 AND clipping_percentage <= 1 AND is_clean")
def clip_release_guard(spark, d):
    return S.release_guard(scored_clips(spark, d)).select("clip_id", "quality_score")


@query(f"SELECT count(*) AS n, round(avg(quality_score), 6) AS mean_score, count(*) FILTER (is_clean) AS clean FROM ({CLIPS})")
def clip_summary(spark, d):
    return scored_clips(spark, d).agg(F.count("*").alias("n"), F.round(F.avg("quality_score"), 6).alias("mean_score"), F.count_if("is_clean").alias("clean"))


@query(f"SELECT event_id, trunc(y * 32767)::SMALLINT AS pcm16, trunc(abs(y) * 16000)::INT AS sample FROM ({PCM})")
def pcm_quantized(spark, d):
    return pcm(spark, d).select("event_id", S.int16(F.col("y")).alias("pcm16"), S.sample_at(F.abs("y")).alias("sample"))


TRIMS = "SELECT segment_id, processing_timestamp, original_duration_ms AS duration_ms, (segment_id % 30) * 100 AS safe_end, (segment_id % 17) * 100 AS safe_start, (least(3000, original_duration_ms // 2) // 100 * 100)::INT AS budget FROM segments"


def trim_input(spark, d):
    s = table(spark, d, "segments", "segment_id", "processing_timestamp", "original_duration_ms")
    return s.select("segment_id", "processing_timestamp", F.col("original_duration_ms").alias("duration_ms"), ((F.col("segment_id") % 30) * 100).alias("safe_end"), ((F.col("segment_id") % 17) * 100).alias("safe_start"), S.trim_budget(F.col("original_duration_ms")).alias("budget"))


@query(f"SELECT segment_id, processing_timestamp, budget FROM ({TRIMS})")
def trim_budget(spark, d):
    return trim_input(spark, d).select("segment_id", "processing_timestamp", "budget")


@query(f"""WITH t AS ({TRIMS}), a AS (SELECT *, coalesce((SELECT max(x) FROM unnest(range(0, budget + 1, 100)) u(x) WHERE duration_ms - x >= 500 AND x <= safe_end), 0)::INT AS end_trimmed_ms FROM t),
    b AS (SELECT *, coalesce((SELECT max(x) FROM unnest(range(0, budget + 1, 100)) u(x) WHERE duration_ms - end_trimmed_ms - x >= 500 AND x <= safe_start), 0)::INT AS start_trimmed_ms FROM a)
    SELECT segment_id, processing_timestamp, start_trimmed_ms, end_trimmed_ms FROM b""")
def trim_search(spark, d):
    key = ["segment_id", "processing_timestamp"]
    t = R.trim_declared(trim_input(spark, d), key, F.col("duration_ms"), F.col("budget"), lambda ms: ms <= F.col("safe_end"), "end_trimmed_ms")
    t = R.trim_declared(t, key, F.col("duration_ms") - F.col("end_trimmed_ms"), F.col("budget"), lambda ms: ms <= F.col("safe_start"), "start_trimmed_ms")
    return t.select(*key, "start_trimmed_ms", "end_trimmed_ms")


@query(f"""WITH t AS ({TRIMS}), a AS (SELECT *, coalesce((SELECT max(x) FROM unnest(range(0, budget + 1, 100)) u(x) WHERE duration_ms - x >= 500 AND x <= safe_end), 0)::INT AS e FROM t),
    b AS (SELECT *, coalesce((SELECT max(x) FROM unnest(range(0, budget + 1, 100)) u(x) WHERE duration_ms - e - x >= 500 AND x <= safe_start), 0)::INT AS s FROM a)
    SELECT segment_id, s AS start_trimmed_ms, e AS end_trimmed_ms, (duration_ms - s - e)::INT AS final_duration_ms FROM b""")
def trim_search_visiting(spark, d):
    """The bisection with a transcriber in Python, called only where the search looks."""

    def transcriber(row):
        return lambda start, end: "text" if start <= row["safe_start"] and end <= row["safe_end"] else "other"

    return R.trim_searched(trim_input(spark, d).withColumn("target", F.lit("text")), "segment_id", transcriber)


EXTEND = "CASE WHEN segment_id % 53 = 0 THEN 0 WHEN segment_id % 7 = 3 THEN greatest(least(segment_id % 11, 50) - 1, 0) ELSE least(segment_id % 61, 50) END"


@query(f"SELECT segment_id, processing_timestamp, ({EXTEND})::INT AS extensions FROM segments")
def boundary_extension(spark, d):
    """A transcriber that fails, falls silent or completes at a step given by the id."""
    i = F.col("segment_id")

    def status(step):
        silent = F.when(step < i % 11, "Incomplete").otherwise("Empty")
        return F.when(i % 53 == 0, F.lit(None)).when(i % 7 == 3, silent).when(step < i % 61, "Incomplete").otherwise("Complete")

    s = table(spark, d, "segments", "segment_id", "processing_timestamp")
    return R.extend_declared(s, ["segment_id", "processing_timestamp"], status)


@query("""SELECT title_index, segment_id, processing_timestamp, (row_number() OVER (PARTITION BY title_index ORDER BY audio_book_time, segment_id, processing_timestamp) - 1)::INT AS segment_number FROM segments""")
def segment_numbering(spark, d):
    s = table(spark, d, "segments", "title_index", "segment_id", "processing_timestamp", "audio_book_time")
    n = number_within(s, "title_index", ["audio_book_time", "segment_id", "processing_timestamp"], "segment_number", F.floor(F.col("audio_book_time") / 600_000))
    return n.withColumn("segment_number", F.col("segment_number").cast("int")).drop("audio_book_time")
