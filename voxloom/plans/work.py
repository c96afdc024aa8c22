"""Incremental work, choice of rows, sets, order."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voxloom.operators import incremental as I
from voxloom.operators.orders import shuffled_orders
from voxloom.operators.sequence import keep_first, keep_last, shuffled_rank, upsert
from voxloom.plans.base import query, table


def trimmed(spark, d):
    return table(spark, d, "segments", "segment_id", "segment_path", "title_index", "processing_timestamp", "completion_status")


@query("SELECT DISTINCT s.segment_path, s.title_index FROM segments s WHERE NOT EXISTS (SELECT 1 FROM segment_embeddings e WHERE e.segment_id = s.segment_id)")
def pending_segments(spark, d):
    done = table(spark, d, "segment_embeddings", "segment_id")
    return I.pending(trimmed(spark, d), done, ["segment_id"]).select("segment_path", "title_index").distinct()


@query("SELECT DISTINCT title_index FROM audiobooks WHERE title_index NOT IN (SELECT title_index FROM segments)")
def new_books(spark, d):
    return I.new_keys(table(spark, d, "audiobooks"), table(spark, d, "segments"), ["title_index"])


@query("SELECT DISTINCT title_index FROM audiobooks WHERE title_index IN (SELECT title_index FROM segments)")
def known_books(spark, d):
    return I.existing(table(spark, d, "audiobooks", "title_index").distinct(), table(spark, d, "segments"), ["title_index"])


@query("""SELECT title_index, count(*) AS parts, count(e.segment_id) AS done_parts, bool_and(e.segment_id IS NOT NULL) AS complete
    FROM (SELECT DISTINCT title_index, segment_id FROM segments) s LEFT JOIN (SELECT DISTINCT title_index, segment_id FROM segment_embeddings) e USING (title_index, segment_id) GROUP BY 1""")
def completed_books(spark, d):
    return I.completed_groups(trimmed(spark, d), table(spark, d, "segment_embeddings"), "title_index", "segment_id")


STATUS = "SELECT o_orderkey AS book_index, CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'failed' END AS status FROM orders"


def status(spark, d):
    s = F.col("o_orderstatus")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("book_index"), F.when(s == "F", "completed").when(s == "O", "processing").otherwise("failed").alias("status"))


@query(f"SELECT status, count(*) AS n FROM ({STATUS}) GROUP BY 1")
def book_status_counts(spark, d):
    return I.status_counts(status(spark, d))


@query(f"SELECT book_index, 'pending' AS status FROM ({STATUS}) WHERE status = 'processing' AND book_index IN (SELECT l_orderkey FROM lineitem)")
def work_queue(spark, d):
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("book_index"))
    return I.work_queue(status(spark, d), known, ["book_index"])


@query(f"SELECT book_index, CASE status WHEN 'processing' THEN 'pending' ELSE status END AS status FROM ({STATUS}) WHERE status <> 'completed' AND book_index IN (SELECT l_orderkey FROM lineitem)")
def retry_queue(spark, d):
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("book_index"))
    return I.work_queue(status(spark, d), known, ["book_index"], retry_failed=True)


DEDUP = "SELECT segment_id, segment_path, title_index, processing_timestamp, completion_status FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY processing_timestamp {0}, completion_status {0} NULLS {1}) AS k FROM segments) WHERE k = 1"


@query(DEDUP.format("ASC", "FIRST"))
def dedup_first(spark, d):
    return keep_first(trimmed(spark, d), ["segment_id"], [F.col("processing_timestamp"), F.col("completion_status")])


@query(DEDUP.format("DESC", "LAST"))
def dedup_last(spark, d):
    return keep_last(trimmed(spark, d), ["segment_id"], [F.col("processing_timestamp"), F.col("completion_status")])


USERS = "SELECT user_id, name, age, gender, saved_at FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY saved_at DESC, age DESC, gender DESC, name DESC) AS k FROM user_sessions) WHERE k = 1"


@query(USERS)
def user_upsert(spark, d):
    u = table(spark, d, "user_sessions", "user_id", "name", "age", "gender", "saved_at")
    return keep_last(u, ["user_id"], [F.col("saved_at"), F.col("age"), F.col("gender"), F.col("name")])


@query("""WITH new AS (SELECT l_orderkey, l_linenumber, 'new' AS state FROM lineitem WHERE l_returnflag = 'R'), old AS (SELECT l_orderkey, l_linenumber, 'old' AS state FROM lineitem)
    SELECT * FROM old WHERE (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM new) UNION ALL SELECT * FROM new""")
def keyed_upsert(spark, d):
    li = table(spark, d, "lineitem")
    new = li.where("l_returnflag = 'R'").select("l_orderkey", "l_linenumber", F.lit("new").alias("state"))
    return upsert(li.select("l_orderkey", "l_linenumber", F.lit("old").alias("state")), new, ["l_orderkey", "l_linenumber"])


@query("SELECT kind, count(*) AS n FROM (SELECT 'segment' AS kind, final_transcript AS text FROM segments UNION ALL SELECT 'sample', transcript FROM samples UNION ALL SELECT 'document', text FROM documents) GROUP BY 1")
def text_union(spark, d):
    parts = [("segment", "segments", "final_transcript"), ("sample", "samples", "transcript"), ("document", "documents", "text")]
    all_ = [table(spark, d, t).select(F.lit(k).alias("kind"), F.col(c).alias("text")) for k, t, c in parts]
    return all_[0].unionByName(all_[1]).unionByName(all_[2]).groupBy("kind").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT original_audio_book_name, title_index FROM segments")
def distinct_books(spark, d):
    return table(spark, d, "segments").select("original_audio_book_name", "title_index").distinct()


@query("SELECT title_index, segment_path FROM (SELECT DISTINCT title_index, segment_path, row_number() OVER (PARTITION BY title_index ORDER BY segment_path) AS k FROM (SELECT DISTINCT title_index, segment_path FROM segments)) WHERE k <= 10")
def first_ten_per_book(spark, d):
    s = table(spark, d, "segments").select("title_index", "segment_path").distinct()
    w = Window.partitionBy("title_index").orderBy("segment_path")
    return s.withColumn("k", F.row_number().over(w)).where("k <= 10").drop("k")


@query("SELECT user_id, audio_index, (row_number() OVER (PARTITION BY user_id ORDER BY md5('42:' || user_id || ':' || audio_index), user_id, audio_index))::INT AS place FROM (SELECT DISTINCT user_id FROM user_sessions), (SELECT DISTINCT audio_index FROM samples WHERE audio_index IS NOT NULL)")
def rater_shuffle(spark, d):
    """Each rater's own order of all items, as the session draws it: raters times items rows
    are the result itself.  Only the raters are shuffled, each task orders the items of some."""
    return shuffled_orders(table(spark, d, "user_sessions", "user_id"), table(spark, d, "samples", "audio_index"), "place")


@query("SELECT sample_id, (row_number() OVER (ORDER BY md5('42:' || sample_id), sample_id))::INT AS place FROM (SELECT DISTINCT sample_id FROM samples)")
def samples_shuffled(spark, d):
    return shuffled_rank(table(spark, d, "samples").select("sample_id").distinct(), None, ["sample_id"], "place")


@query("SELECT segment_path, title_index FROM (SELECT DISTINCT segment_path, title_index FROM segments)")
def listing_sorted(spark, d):
    return table(spark, d, "segments").select("segment_path", "title_index").distinct().orderBy("title_index", "segment_path")
