"""Vector and clustering operators over the embeddings and centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import cluster as C
from voxloom.operators import vectors as V
from voxloom.operators.sequence import keep_last, relabel
from voxloom.plans.base import query, table
from voxloom.session import materialize, spread

DIM = 96


def embeddings(spark, d):
    """Valid vectors, a segment once, with a confidence derived from its number."""
    e = spread(table(spark, d, "segment_embeddings", "segment_id", "embedding", "title_index", "speaker_id", "final_duration_ms", "extracted_at"), "segment_id")
    e = keep_last(e.where(V.is_valid(F.col("embedding"), DIM)), ["segment_id"], [F.col("extracted_at"), F.col("title_index"), F.col("speaker_id")])
    return e.withColumn("confidence", F.round((F.col("segment_id") % 11 + F.col("speaker_id") % 3) / 12, 6))


OK = "embedding IS NOT NULL AND len(embedding) = 96 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"
VALID = f"""SELECT *, round((segment_id % 11 + speaker_id % 3) / 12.0::DOUBLE, 6)::DOUBLE AS confidence FROM (SELECT *, row_number() OVER (PARTITION BY segment_id ORDER BY extracted_at DESC, title_index DESC, speaker_id DESC) AS k
    FROM (SELECT segment_id, embedding::DOUBLE[] AS embedding, title_index, speaker_id, extracted_at FROM segment_embeddings WHERE {OK})) WHERE k = 1"""
LONG = f"SELECT segment_id, title_index, speaker_id, confidence, unnest(embedding) AS x, unnest(range(96)) AS pos FROM ({VALID})"


@query(f"SELECT segment_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x * x))), 5) AS norm, round(embedding[1] / sqrt(list_sum(list_transform(embedding, lambda x: x * x))), 5) AS first FROM ({VALID})")
def vector_norms(spark, d):
    e = V.with_unit(embeddings(spark, d), "embedding")
    return e.select("segment_id", F.round(V.norm(F.col("embedding")), 5).alias("norm"), F.round(F.element_at("unit", 1), 5).alias("first"))


@query(f"""WITH l AS ({LONG}), st AS (SELECT title_index, pos, avg(x) AS m, stddev_pop(x) AS s FROM l GROUP BY 1, 2), z AS (SELECT l.title_index, segment_id, max(CASE WHEN s > 1e-12 THEN abs(x - m) / s ELSE 0 END) AS max_z FROM l JOIN st USING (title_index, pos) GROUP BY 1, 2)
    SELECT title_index, segment_id, round(max_z, 5) AS max_z, max_z > 3 AND sum((max_z <= 3)::INT) OVER (PARTITION BY title_index) > 10 AS outlier FROM z""")
def zscore_outliers(spark, d):
    return V.outliers(embeddings(spark, d), "title_index", "segment_id", "embedding", DIM).withColumn("max_z", F.round("max_z", 5))


@query(f"SELECT title_index, speaker_id, count(DISTINCT segment_id) AS n, round(avg(x) FILTER (pos = 0), 5) AS first, round(avg(x) FILTER (pos = 95), 5) AS last FROM ({LONG}) GROUP BY 1, 2")
def plain_centroids(spark, d):
    c = V.elementwise(embeddings(spark, d), ["title_index", "speaker_id"], "embedding", DIM, F.avg)
    return c.select("title_index", "speaker_id", "n", F.round(F.element_at("centroid", 1), 5).alias("first"), F.round(F.element_at("centroid", 96), 5).alias("last"))


WEIGHTED = f"""WITH l AS ({LONG}), u AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY segment_id)) AS ux FROM l),
    c AS (SELECT title_index, speaker_id, pos, sum(ux * confidence) / sum(confidence) AS v, count(*) AS n, avg(confidence) AS avg_confidence FROM u GROUP BY 1, 2, 3 HAVING count(*) >= 2),
    w AS (SELECT *, v / sqrt(sum(v * v) OVER (PARTITION BY title_index, speaker_id)) AS cv FROM c)"""


@query(f"{WEIGHTED} SELECT title_index, speaker_id, max(n) AS n, round(max(avg_confidence), 5) AS avg_confidence, round(max(cv) FILTER (pos = 0), 5) AS first, round(max(cv) FILTER (pos = 95), 5) AS last FROM w GROUP BY 1, 2")
def weighted_centroids(spark, d):
    c = V.weighted_centroids(embeddings(spark, d), ["title_index", "speaker_id"], "embedding", "confidence", DIM)
    return c.select("title_index", "speaker_id", "n", F.round("avg_confidence", 5).alias("avg_confidence"), F.round(F.element_at("centroid", 1), 5).alias("first"), F.round(F.element_at("centroid", 96), 5).alias("last"))


CENT = f"""SELECT * FROM (SELECT centroid_id, title_index, local_speaker_id, num_samples, avg_confidence, centroid_embedding::DOUBLE[] AS embedding, row_number() OVER (PARTITION BY centroid_id ORDER BY computed_at DESC) AS k
    FROM speaker_centroids WHERE {OK.replace('embedding', 'centroid_embedding')}) WHERE k = 1"""


def centroids(spark, d):
    c = table(spark, d, "speaker_centroids").where(V.is_valid(F.col("centroid_embedding"), DIM))
    return keep_last(c.select("centroid_id", "title_index", "local_speaker_id", "num_samples", "avg_confidence", "centroid_embedding", "computed_at"), ["centroid_id"], [F.col("computed_at")])


@query(f"SELECT a.title_index, a.centroid_id AS a, b.centroid_id AS b, round(list_cosine_similarity(a.embedding, b.embedding), 5) AS cos FROM ({CENT}) a JOIN ({CENT}) b ON a.title_index = b.title_index AND a.centroid_id < b.centroid_id")
def cosine_within_books(spark, d):
    return V.pairs_within(centroids(spark, d), "title_index", "centroid_id", "centroid_embedding").withColumn("cos", F.round("cos", 5))


@query(f"SELECT a.title_index, a.centroid_id AS a, b.centroid_id AS b, round((list_cosine_similarity(a.embedding, b.embedding) + 1) / 2, 4) AS similarity FROM ({CENT}) a JOIN ({CENT}) b ON a.title_index = b.title_index AND a.centroid_id < b.centroid_id")
def rescaled_similarity(spark, d):
    return V.pairs_within(centroids(spark, d), "title_index", "centroid_id", "centroid_embedding").select("title_index", "a", "b", V.rescaled(F.col("cos")).alias("similarity"))


@query(f"""WITH e AS ({VALID}), c AS ({CENT}), s AS (SELECT e.title_index, segment_id, local_speaker_id, list_inner_product(e.embedding, c.embedding) AS s FROM e JOIN c ON e.title_index = c.title_index)
    SELECT title_index, segment_id, arg_max(local_speaker_id, (s, -local_speaker_id)) AS local_speaker_id, round(max(s) * 0.5, 4) AS confidence FROM s GROUP BY 1, 2""")
def nearest_centroid(spark, d):
    n = V.nearest_centroid(embeddings(spark, d), centroids(spark, d), "title_index", "segment_id", "embedding", "local_speaker_id", "centroid_embedding")
    return n.withColumn("confidence", F.round("confidence", 4))


@query(f"""WITH e AS ({VALID}), n AS (SELECT title_index, speaker_id, count(*) FILTER (confidence >= 0.4) AS n FROM e GROUP BY 1, 2),
    k AS (SELECT title_index, speaker_id FROM (SELECT *, sum(n) OVER (PARTITION BY title_index) AS a, count(*) OVER (PARTITION BY title_index) AS c FROM n) WHERE n >= greatest(2, floor(a * (1.0::DOUBLE / c))))
    SELECT segment_id, title_index, speaker_id, (dense_rank() OVER (PARTITION BY title_index ORDER BY speaker_id) - 1)::INT AS new_speaker_id FROM e JOIN k USING (title_index, speaker_id) WHERE confidence >= 0.4""")
def speaker_prune(spark, d):
    return C.prune_speakers(embeddings(spark, d), "title_index", "speaker_id", "confidence").select("segment_id", "title_index", "speaker_id", "new_speaker_id")


@query(f"SELECT title_index, speaker_id, (dense_rank() OVER (PARTITION BY title_index ORDER BY speaker_id) - 1)::INT AS new_id FROM (SELECT DISTINCT title_index, speaker_id FROM ({VALID}))")
def speaker_relabel(spark, d):
    return relabel(embeddings(spark, d).select("title_index", "speaker_id").distinct(), "title_index", "speaker_id", "new_id")


@query(f"SELECT title_index, count(*) >= 4 AS eligible, count(*) AS valid_vectors FROM ({VALID}) GROUP BY 1")
def book_eligibility(spark, d):
    g = embeddings(spark, d).groupBy("title_index").agg(F.count("*").alias("valid_vectors"))
    return g.withColumn("eligible", F.col("valid_vectors") >= 4)


@query()
def local_clusters(spark, d):
    return C.local_speakers(table(spark, d, "segment_embeddings", "segment_id", "embedding", "title_index"), "title_index", "segment_id", "embedding", DIM)


def merged(spark, d):
    c = centroids(spark, d)
    u = materialize(V.with_unit(c, "centroid_embedding").select(F.col("centroid_id").alias("id"), F.col("unit").alias("v")), "units")
    return C.global_merge(u, DIM).withColumnRenamed("id", "centroid_id").join(c, "centroid_id")


@query()
def global_merge(spark, d):
    return C.evidence_rule(merged(spark, d), "cluster", "centroid_id", "title_index", "num_samples").select("centroid_id", "cluster", "final_cluster")


#: A labelling both engines share: the centroids' number modulo 97.
FIXED = f"SELECT centroid_id, title_index, local_speaker_id, num_samples, avg_confidence, embedding, centroid_id % 97 AS cluster FROM ({CENT})"


def fixed(spark, d):
    return centroids(spark, d).withColumn("cluster", F.col("centroid_id") % 97)


RULE = f"""WITH f AS ({FIXED}), g AS (SELECT cluster, count(DISTINCT title_index) AS b, sum(num_samples) AS s FROM f GROUP BY 1),
    m AS (SELECT f.*, CASE WHEN b > 1 AND s < 100 THEN centroid_id + 1000000 ELSE f.cluster END AS final_cluster FROM f JOIN g USING (cluster)),
    t AS (SELECT final_cluster, sum(num_samples)::BIGINT AS total_samples, count(DISTINCT title_index) AS num_books, array_to_string(list_sort(list(DISTINCT title_index)), ', ') AS books FROM m GROUP BY 1),
    r AS (SELECT *, (row_number() OVER (ORDER BY total_samples DESC, final_cluster) - 1)::INT AS global_speaker_id FROM t)"""


def ranked(members, own):
    """Members and clusters under the evidence rule, clusters ranked by their samples;
    ``own`` names the cluster of a member that is left alone."""
    from pyspark.sql import Window

    m = C.evidence_rule(members.withColumn("own", own), "cluster", "own", "title_index", "num_samples")
    t = m.groupBy("final_cluster").agg(F.sum("num_samples").alias("total_samples"), F.count_distinct("title_index").alias("num_books"), F.array_join(F.array_sort(F.collect_set("title_index")), ", ").alias("books"))
    place = F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.desc("total_samples"), "final_cluster")) - 1  # over clusters, not members
    return m, t.withColumn("global_speaker_id", place)


@query(f"{RULE} SELECT global_speaker_id, total_samples, num_books, books FROM r")
def fixed_summary(spark, d):
    return ranked(fixed(spark, d), F.col("centroid_id") + 1_000_000)[1].select("global_speaker_id", "total_samples", "num_books", "books")


@query(f"""{RULE} SELECT e.segment_id, coalesce(max(global_speaker_id), -1) AS global_speaker_id FROM ({VALID}) e
    LEFT JOIN (SELECT title_index, local_speaker_id, min(global_speaker_id) AS global_speaker_id FROM m JOIN r USING (final_cluster) GROUP BY 1, 2) x ON e.title_index = x.title_index AND e.speaker_id = x.local_speaker_id GROUP BY 1""")
def fixed_ids(spark, d):
    return segment_ids(spark, d, *ranked(fixed(spark, d), F.col("centroid_id") + 1_000_000))


def segment_ids(spark, d, m, t):
    """The global speaker of each segment, -1 where its speaker has none."""
    names = m.join(t.select("final_cluster", "global_speaker_id"), "final_cluster").groupBy("title_index", F.col("local_speaker_id").alias("speaker_id")).agg(F.min("global_speaker_id").alias("global_speaker_id"))
    e = embeddings(spark, d).select("segment_id", "title_index", "speaker_id").join(names, ["title_index", "speaker_id"], "left")
    return e.select("segment_id", F.coalesce("global_speaker_id", F.lit(-1)).alias("global_speaker_id"))


LEAST = f"SELECT a.title_index, min(list_cosine_similarity(a.embedding, b.embedding)) AS least FROM ({CENT}) a JOIN ({CENT}) b ON a.title_index = b.title_index AND a.centroid_id < b.centroid_id GROUP BY 1"


@query(f"SELECT title_index, round(least, 5) AS least, round(CASE WHEN least >= 0.9 THEN 1.0 WHEN least >= 0.85 THEN 0.5 + (least - 0.85) / 0.05 * 0.5 ELSE 0.0 END, 4)::DOUBLE AS validation FROM ({LEAST})")
def book_validation(spark, d):
    p = V.pairs_within(centroids(spark, d), "title_index", "centroid_id", "centroid_embedding").groupBy("title_index").agg(F.min("cos").alias("least"))
    return p.select("title_index", F.round("least", 5).alias("least"), F.round(C.validation_score(F.col("least")), 4).alias("validation"))


def merged_ranked(spark, d):
    """Clusters of the merge itself; each is named by its least centroid, so a member left alone keeps its own number."""
    m, t = ranked(merged(spark, d), F.col("centroid_id"))
    return materialize(m, "ranked"), t


@query()
def global_summary(spark, d):
    return merged_ranked(spark, d)[1].select("global_speaker_id", "total_samples", "num_books", "books")


@query()
def global_ids(spark, d):
    return segment_ids(spark, d, *merged_ranked(spark, d))


@query()
def cluster_validation(spark, d):
    """Least cosine inside each global speaker's cluster; 1 for a speaker of one centroid."""
    m, t = merged_ranked(spark, d)
    p = V.pairs_within(m, "final_cluster", "centroid_id", "centroid_embedding").groupBy("final_cluster").agg(F.min("cos").alias("least"))
    v = t.join(p, "final_cluster", "left")
    return v.select("global_speaker_id", F.round("least", 5).alias("least"), F.round(F.when(F.col("least").isNull(), 1.0).otherwise(C.validation_score(F.col("least"))), 4).alias("validation"))


def chain(spark, d):
    """Clustering inside books, pruning, centroids, the merge across books and its names, one
    after the other, over the stored vectors."""
    from voxloom.pipeline.stages import global_labels, local_labels

    e = embeddings(spark, d).select("segment_id", "title_index", "embedding")
    return global_labels(materialize(local_labels(e, "title_index", "segment_id", DIM), "local"), "title_index", "segment_id", DIM)


@query()
def speaker_chain(spark, d):
    return chain(spark, d)[0].select("segment_id", "title_index", "speaker_id", "speaker_confidence", "global_speaker_id")


@query()
def speaker_chain_summary(spark, d):
    return chain(spark, d)[1]
