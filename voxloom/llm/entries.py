"""Queries of the operators in this package, by problem number."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Problem 1
def p1_entities(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.names import link_names, narrator_names

    return link_names(narrator_names(table(spark, d, "audiobooks"))).select(F.col("id").alias("narrator_index"), F.col("entity").cast("int").alias("entity"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.session import materialize

    e = materialize(p1_entities(spark, d), "entities")
    a = e.select(F.col("narrator_index").alias("narrator_index_a"), "entity")
    b = e.select(F.col("narrator_index").alias("narrator_index_b"), "entity")
    return a.join(b, "entity").where("narrator_index_a < narrator_index_b").drop("entity")


# Problem 2
def _transcripts(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.lookalikes import transcript_records

    seg = table(spark, d, "segments").select("segment_id", "final_transcript", "processing_timestamp")
    return transcript_records(seg, table(spark, d, "samples").select("sample_id", "transcript"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.lookalikes import equal_looks

    return equal_looks(_transcripts(spark, d))


def p2_normalized(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.lookalikes import with_skeletons

    return with_skeletons(_transcripts(spark, d)).select("record", "skeleton")


# Problem 3: at most floor(0.02 N) segments of a speaker
SPEAKER_SHARE = 0.02


def _capped(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.capping import cap_contributors, latest_rows

    m = table(spark, d, "release_manifest").select("segment_id", "global_speaker_id", "audio_quality_score", "released_at")
    m = latest_rows(m.where("segment_id is not null"), "segment_id", "released_at").where("global_speaker_id != -1")
    return cap_contributors(m, "global_speaker_id", "segment_id", "audio_quality_score", max_share=SPEAKER_SHARE)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d).where("not kept").select("segment_id")


def p3_capped_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _capped(spark, d).where("kept").drop("kept")


# Problem 4: a rater with 20 scores or more whose fitted parameters tie response to truth less than this
MIN_SCORES, MIN_RELIABILITY = 20, 0.2


def _consensus(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    from voxloom.llm.consensus import consensus, session_labels

    return consensus(session_labels(table(spark, d, "user_sessions").select("user_id", "scores", "saved_at")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d)[1].where((F.col("n_scores") >= MIN_SCORES) & (F.col("reliability") < MIN_RELIABILITY)).select("user_id")


def p4_consensus(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d)[0]


def p4_reliability(spark: SparkSession, d: str) -> DataFrame:
    return _consensus(spark, d)[1]


def p4_agreement(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.consensus import agreement, session_labels

    return agreement(session_labels(table(spark, d, "user_sessions").select("user_id", "scores", "saved_at")))


# Problem 5
DIMENSIONS = 96


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.voices import find_voices

    return find_voices(_segments(spark, d), DIMENSIONS)[0].withColumnRenamed("id", "segment_id")


def p5_voices(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.voices import find_voices

    return find_voices(_segments(spark, d), DIMENSIONS)[1]


def p5_centroid_voices(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.voices import find_voices

    return find_voices(_centroids(spark, d), DIMENSIONS)[1]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.voices import find_clusters

    m = find_clusters(_segments(spark, d), DIMENSIONS)[0]
    return m.where("id != cluster").select(F.col("cluster").alias("segment_id_a"), F.col("id").alias("segment_id_b"))


def p5_check(spark: SparkSession, d: str) -> DataFrame:
    """What the exact check adds to the graph's links: clusters it joined, and their number after."""
    from voxloom.llm.voices import find_clusters

    m, missing = find_clusters(_segments(spark, d), DIMENSIONS)
    rows = [m.agg(F.lit("vectors").alias("figure"), F.count("*").alias("n")), m.agg(F.lit("clusters"), F.count_distinct("cluster")), missing.agg(F.lit("links the check added"), F.count("*"))]
    return rows[0].union(rows[1]).union(rows[2])


# Problem 6


def _centroids(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.vectors import valid_vectors

    return valid_vectors(table(spark, d, "speaker_centroids"), "centroid_id", "centroid_embedding", DIMENSIONS, ["computed_at"])


def _segments(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.vectors import valid_vectors

    return valid_vectors(table(spark, d, "segment_embeddings"), "segment_id", "embedding", DIMENSIONS, ["extracted_at"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.similar import similar_pairs

    p = similar_pairs(_centroids(spark, d), DIMENSIONS, 5, 0.80)
    return p.select(F.col("id_a").alias("centroid_id_a"), F.col("id_b").alias("centroid_id_b"))


def p6_centroid_neighbours(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.similar import most_similar

    return most_similar(_centroids(spark, d), DIMENSIONS, 5, slack=0.8).withColumnsRenamed({"id": "centroid_id", "neighbour": "neighbour_id"})


def p6_segment_neighbours(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.similar import most_similar

    return most_similar(_segments(spark, d), DIMENSIONS, 5, slack=0.8, queries="id % 50 = 0").withColumnsRenamed({"id": "segment_id", "neighbour": "neighbour_id"})


# Problem 7
def p7_splits(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.splitting import assign_splits

    shares = {r["split"]: r["target_share"] for r in table(spark, d, "split_targets").collect()}  # the user's few splits
    m = table(spark, d, "release_manifest").select("segment_id", "global_speaker_id")
    return assign_splits(m, "segment_id", ["global_speaker_id"], shares, {"global_speaker_id": [-1]})


def p7_split_shares(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.splitting import split_report

    return split_report(p7_splits(spark, d), table(spark, d, "split_targets"))


# Problem 8
def p8_packed(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.packing import pack_documents

    return pack_documents(table(spark, d, "documents"), table(spark, d, "pack_targets"))


def p8_pack_report(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.packing import pack_report

    return pack_report(p8_packed(spark, d), table(spark, d, "pack_targets"))


# Problem 9
def p9_mixed(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.mixing import mixture

    return mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_mix_report(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.mixing import mixture

    return mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


# Problem 10
def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    from voxloom.llm.encoding import repaired_texts

    return repaired_texts(table(spark, d, "documents")).select("doc_id", F.array_join("steps", " ").alias("steps"), "repaired")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_repaired(spark, d).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k[0] == "p" and k[1].isdigit() and callable(f)}
    return dict(sorted(found.items(), key=lambda x: (int(x[0][1:].split("_")[0]), x[0])))


#: DuckDB text for the queries that SQL can express on whole tables.
SQL: dict[str, str] = {
    "p3_found": """
        WITH latest AS (SELECT segment_id, global_speaker_id, audio_quality_score FROM (
            SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY released_at DESC, global_speaker_id DESC NULLS LAST,
                audio_quality_score DESC NULLS LAST) AS n FROM release_manifest WHERE segment_id IS NOT NULL) WHERE n = 1),
        m AS (SELECT * FROM latest WHERE global_speaker_id <> -1),
        r AS (SELECT segment_id, row_number() OVER (PARTITION BY global_speaker_id ORDER BY
            coalesce(CASE WHEN isnan(audio_quality_score) THEN NULL ELSE -audio_quality_score END, 'infinity'::DOUBLE), segment_id) AS k FROM m)
        SELECT segment_id FROM r WHERE k > (SELECT floor(0.02 * count(*)) FROM m)""",
}
SQL["p3_capped_manifest"] = SQL["p3_found"].replace("SELECT segment_id, row_number() OVER (PARTITION BY global", "SELECT *, row_number() OVER (PARTITION BY global").replace(
    "SELECT segment_id FROM r WHERE k > (", "SELECT segment_id, global_speaker_id, audio_quality_score FROM r WHERE k <= ("
)

#: Vectors of 96 finite values that are not all zero, an id once by its latest row, as doubles.
VECTORS = """(SELECT {0} AS id, {1}::DOUBLE[] AS v FROM (SELECT *, row_number() OVER (PARTITION BY {0} ORDER BY {2} DESC, {1} DESC) AS k FROM {3}
    WHERE {0} IS NOT NULL AND {1} IS NOT NULL AND len({1}) = 96 AND len(list_filter({1}, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter({1}, lambda x: x <> 0)) > 0) WHERE k = 1)"""
SQL["p5_found"] = f"""
    WITH RECURSIVE x AS MATERIALIZED {VECTORS.format('segment_id', 'embedding', 'extracted_at', 'segment_embeddings')},
    e AS MATERIALIZED (SELECT a.id AS u, b.id AS w FROM x a, x b WHERE a.id <> b.id AND list_cosine_similarity(a.v, b.v) >= 0.75),
    r(id, other) AS (SELECT u, w FROM e WHERE w < u UNION SELECT r.id, e.w FROM r JOIN e ON e.u = r.other WHERE e.w <> r.id),
    c AS (SELECT u AS id, least(u, coalesce(min(other), u)) AS cluster FROM (SELECT DISTINCT u FROM e) LEFT JOIN r ON r.id = u GROUP BY u)
    SELECT cluster AS segment_id_a, id AS segment_id_b FROM c WHERE cluster <> id"""
SQL["p6_found"] = f"""
    WITH x AS MATERIALIZED {VECTORS.format('centroid_id', 'centroid_embedding', 'computed_at', 'speaker_centroids')},
    p AS (SELECT a.id AS a, b.id AS b, round(list_cosine_similarity(a.v, b.v), 12) AS c FROM x a, x b WHERE a.id <> b.id),
    n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS k FROM p) WHERE k <= 5 AND c >= 0.8)
    SELECT DISTINCT least(a, b) AS centroid_id_a, greatest(a, b) AS centroid_id_b FROM n"""

#: Scores of each rater's latest readable snapshot.
LABELS = r"""(SELECT user_id, regexp_extract(k, '^(\d+)_(.+)$', 1)::INT AS audio_index, regexp_extract(k, '^(\d+)_(.+)$', 2) AS question, score FROM (
    SELECT user_id, j.key AS k, try_cast(translate(trim(j.value->>'$', ' '), '۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩０１２３４５６７８９٫，,．', '012345678901234567890123456789....') AS DOUBLE) AS score FROM (
      SELECT user_id, s, row_number() OVER (PARTITION BY user_id ORDER BY saved_at DESC, len(json_keys(s)) DESC, s DESC) AS n FROM (
        SELECT user_id, saved_at, CASE WHEN json_valid(scores) AND json_type(scores) = 'OBJECT' THEN scores::JSON ELSE '{}'::JSON END AS s FROM user_sessions WHERE user_id IS NOT NULL)
      WHERE len(json_keys(s)) > 0) q, json_each(q.s) j WHERE n = 1) WHERE regexp_matches(k, '^\d+_.+$') AND score BETWEEN 1 AND 5)"""
SQL["p4_agreement"] = f"""
    WITH i AS (SELECT question, audio_index, count(*) AS n, sum(score) AS s, sum(score * score) AS ss FROM {LABELS} GROUP BY 1, 2 HAVING count(*) > 1),
    q AS (SELECT question, count(*) AS n_items, sum(n)::BIGINT AS n, sum(2 * (n * ss - s * s) / (n - 1)) AS inside, sum(s) AS s, sum(ss) AS ss FROM i GROUP BY 1)
    SELECT question, n_items, n AS n_scores, round(CASE WHEN n * ss > s * s THEN 1 - (inside / n) / (2 * (n * ss - s * s) / (n * (n - 1.0::DOUBLE))) END, 6) AS alpha FROM q"""

#: A segment's component follows from its one speaker; the hash of the component falls into a range.
SPLITS = """
    r AS (SELECT segment_id, max(CASE WHEN global_speaker_id <> -1 THEN global_speaker_id END) AS s FROM release_manifest GROUP BY 1),
    c AS (SELECT segment_id, md5(CASE WHEN s IS NULL THEN '=' || segment_id ELSE 'global_speaker_id=' || s END) AS component FROM r),
    t AS (SELECT split, sum(target_share) OVER (ORDER BY split) / sum(target_share) OVER () AS upto, row_number() OVER (ORDER BY split DESC) AS last FROM split_targets WHERE target_share > 0),
    a AS (SELECT segment_id, component, (SELECT arg_min(split, upto) FROM t WHERE ('0x' || substr(md5('42:' || component), 1, 12))::BIGINT / 281474976710656.0::DOUBLE < upto OR last = 1) AS split FROM c)"""
SQL["p7_splits"] = f"WITH {SPLITS} SELECT segment_id, component, split FROM a"
SQL["p7_split_shares"] = f"""
    WITH {SPLITS}, n AS (SELECT split, component, count(*) AS n FROM a GROUP BY 1, 2), g AS (SELECT split, sum(n)::BIGINT AS n_segments, count(*) AS n_components, max(n) AS most FROM n GROUP BY 1)
    SELECT split, target_share, coalesce(n_segments, 0) AS n_segments, coalesce(n_components, 0) AS n_components,
      coalesce(n_segments, 0) / (SELECT sum(n_segments) FROM g)::DOUBLE AS reached_share, coalesce(most, 0) / (SELECT sum(n_segments) FROM g)::DOUBLE AS largest_component_share FROM split_targets LEFT JOIN g USING (split)"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
