import numpy as np
from pyspark.sql import functions as F

from voxloom.operators import cluster as C
from voxloom.operators import vectors as V


def groups(n, k, d=16, seed=0, spread=0.1):
    rng = np.random.default_rng(seed)
    c = C.normalize(rng.normal(size=(k, d)))
    return C.normalize(np.repeat(c, n, axis=0) + spread * rng.normal(size=(n * k, d)) / np.sqrt(d)), np.repeat(np.arange(k), n)


def slow_average_link(x, below):
    groups_ = [[i] for i in range(len(x))]
    d = 1 - x @ x.T
    while len(groups_) > 1:
        best = min((np.mean([d[i, j] for i in a for j in b]), p, q) for p, a in enumerate(groups_) for q, b in enumerate(groups_) if p < q)
        if best[0] >= below:
            break
        groups_[best[1]] += groups_.pop(best[2])
    return {frozenset(g) for g in groups_}


def as_sets(labels):
    return {frozenset(np.flatnonzero(labels == v).tolist()) for v in set(labels.tolist())}


def test_average_link_against_plain_form():
    rng = np.random.default_rng(3)
    for n in (2, 5, 17):
        x = C.normalize(rng.normal(size=(n, 3)))
        for below in (0.05, 0.15, 0.6):
            assert as_sets(C.average_link(x, below=below)) == slow_average_link(x, below)


def slow_dbscan(x, eps, points=3):
    near = (1 - x @ x.T) <= eps
    core, labels, cur = near.sum(axis=1) >= points, [-1] * len(x), 0
    for i in range(len(x)):
        if core[i] and labels[i] < 0:
            todo = [i]
            labels[i] = cur
            while todo:
                for b in np.flatnonzero(near[todo.pop(0)]):
                    if labels[b] < 0:
                        labels[b] = cur
                        if core[b]:
                            todo.append(b)
            cur += 1
    return labels


def test_dbscan_against_plain_form():
    x, _ = groups(20, 4, d=8, spread=0.6)
    for eps in (0.02, 0.1, 0.3, 0.6):
        assert C.dbscan(x, eps).tolist() == slow_dbscan(x, eps)


def test_speaker_number_and_labels():
    x, truth = groups(15, 3)
    assert as_sets(C.average_link(x, 3)) == as_sets(truth)
    assert as_sets(C.ensemble(x, 3)) == as_sets(truth)
    assert C.estimate_speakers(x) == 3
    conf = C.confidences(x, truth)
    assert ((conf >= 0) & (conf <= 1)).all() and conf.mean() > 0.7
    assert (C.confidences(x, np.zeros(len(x), int)) == 1).all()


def test_outlier_filter_is_off_for_few():
    x = np.ones((8, 4))
    x[0] = 99
    assert C.drop_outliers(x).all()


def test_silhouette_of_single_member():
    x, _ = groups(3, 2)
    assert C.silhouette(x, np.array([0, 0, 0, 1, 1, 2]))[5] == 0


def test_elbow_counts_from_one_cluster():
    x, _ = groups(15, 3, spread=0.05)
    tree = C.merge_tree(x)
    w = [C.dispersion(x, C.cut_tree(len(x), tree, k)) for k in range(1, 16)]
    second = np.diff(np.diff(w))
    place = int(np.argmax(second)) + 2
    assert (place, place + 1) == (2, 3)  # the third entry is that of three clusters
    # all three estimates agree, so the median is the elbow's too
    assert C.estimate_speakers(x) == place + 1


def test_failing_methods_are_left_out(monkeypatch):
    x, truth = groups(15, 3)

    def fails(*_):
        raise np.linalg.LinAlgError

    monkeypatch.setattr(C, "spectral", fails)
    assert as_sets(C.ensemble(x, 3)) == as_sets(truth)
    monkeypatch.setattr(C, "gaussian_mixture", fails)
    assert as_sets(C.ensemble(x, 3)) == as_sets(truth)
    assert C.ensemble(x, 1).max() == 0  # no method gives several clusters: average link stands


def test_many_dimensions_become_few():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(30, 5)) @ rng.normal(size=(5, 700))
    y = C.principal(x)
    d = lambda z: ((z[:, None] - z[None]) ** 2).sum(axis=2)
    assert y.shape == (30, 29) and np.allclose(d(x), d(y)) and C.principal(x[:, :512]) is not None and C.principal(x[:, :512]).shape == (30, 512)


def test_prune(spark):
    rows = [("b", s, 0.9) for s in [0] * 6 + [1] * 3 + [2] * 3] + [("b", 0, 0.1)]
    out = C.prune_speakers(spark.createDataFrame(rows, "b string, s int, c double"), "b", "s", "c").collect()
    assert len(out) == 6 and {r.new_speaker_id for r in out} == {0}
    # speakers without a confident row make the share smaller: 12 confident rows of 4 speakers
    more = rows + [("b", 3, 0.2)]
    out = C.prune_speakers(spark.createDataFrame(more, "b string, s int, c double"), "b", "s", "c").collect()
    assert len(out) == 12 and {r.new_speaker_id for r in out} == {0, 1, 2}


def test_merge_and_evidence(spark):
    x, _ = groups(4, 5, d=8, spread=0.05)
    v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>")
    got = np.array([r.cluster for r in C.global_merge(v, 8).orderBy("id").collect()])
    assert as_sets(got) == slow_average_link(x, 0.15)
    m = spark.createDataFrame([(1, 10, "a", 50), (1, 11, "b", 49), (2, 20, "a", 50), (2, 21, "b", 50)], "c long, i long, b string, n int")
    assert [r.final_cluster for r in C.evidence_rule(m, "c", "i", "b", "n").orderBy("i").collect()] == [10, 11, 2, 2]


def test_validation(spark):
    d = spark.createDataFrame([(0.90,), (0.875,), (0.84,)], "x double")
    assert [round(r[0], 9) for r in d.select(C.validation_score(F.col("x"))).collect()] == [1.0, 0.75, 0.0]


def test_vectors(spark):
    nan = float("nan")
    d = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([nan, 1.0],), ([1.0],), (None,), ([None, 1.0],)], "v array<double>")
    assert [r[0] for r in d.select(V.is_valid(F.col("v"), 2)).collect()] == [True, False, False, False, False, False]
    u = V.with_unit(d.limit(2), "v").collect()
    assert u[0].unit == [0.6, 0.8] and u[1].unit == [0.0, 0.0]


def test_single_sample_has_no_centroid(spark):
    d = spark.createDataFrame([("a", [1.0, 0.0], 0.5), ("a", [0.0, 1.0], 0.5), ("b", [1.0, 0.0], 0.9)], "g string, v array<double>, w double")
    out = V.weighted_centroids(d, ["g"], "v", "w", 2).collect()
    assert [r.g for r in out] == ["a"] and abs(out[0].centroid[0] - 0.5**0.5) < 1e-12


def test_constant_position_marks_nobody(spark):
    rows = [("g", i, [1.0, float(i % 3)]) for i in range(20)] + [("g", 99, [1.0, 50.0])]
    out = V.outliers(spark.createDataFrame(rows, "g string, i int, v array<double>"), "g", "i", "v", 2).where("outlier").collect()
    assert [r.i for r in out] == [99]


def test_every_vector_of_a_large_book_is_clustered(spark):
    x, _ = groups(400, 4, d=8, spread=0.3)
    x = np.vstack([x, groups(3, 1, d=8, seed=5, spread=0.01)[0]])  # a speaker of three segments
    d = spark.createDataFrame([(1, i, row.tolist()) for i, row in enumerate(x)], "b long, i long, v array<double>")
    got = C.local_speakers(d, "b", "i", "v", 8).orderBy("i").toPandas()
    keep = C.drop_outliers(x)
    labels = C.ensemble(C.normalize(x)[keep])
    assert len(got) == len(x) and (got["speaker_id"].to_numpy()[keep] == labels).all()
    assert np.allclose(got["speaker_confidence"].to_numpy()[keep], C.confidences(C.normalize(x)[keep], labels), atol=1e-6)


def test_leading_vectors_against_dense_form():
    x, truth = groups(60, 4, d=8, spread=0.5)
    a = np.maximum(x @ x.T, 0)
    s = 1 / np.sqrt(a.sum(axis=1))
    v = np.linalg.eigh(a * s[:, None] * s[None, :])[1][:, -4:]
    u = C._leading_vectors(x, 4, 1)
    assert np.allclose(u @ u.T, v @ v.T, atol=1e-6)


def test_global_speakers_follow_the_merge(spark, data):
    from voxloom.plans import speakers as P

    want = {r.centroid_id: r.final_cluster for r in P.global_merge(spark, data).collect()}
    found = P.global_summary(spark, data).collect()
    assert len(found) == len(set(want.values())) and sorted(r.global_speaker_id for r in found) == list(range(len(found)))
    samples = {r.centroid_id: r.num_samples for r in P.centroids(spark, data).collect()}
    sums = {}
    for c, f in want.items():
        sums[f] = sums.get(f, 0) + samples[c]
    assert [r.total_samples for r in sorted(found, key=lambda r: r.global_speaker_id)] == sorted(sums.values(), reverse=True)
    checked = P.cluster_validation(spark, data).collect()
    assert len(checked) == len(found) and all(r.validation == 1 for r in checked if r.least is None)


def test_speakers_from_vectors_to_names(spark):
    from voxloom.pipeline.stages import global_labels, local_labels

    rng = np.random.default_rng(2)
    voice = C.normalize(rng.normal(size=(3, 24)))
    rows = []
    for book, voices_, n in (("a", (0, 1), 60), ("b", (0, 2), 55), ("c", (1,), 3)):
        for v in voices_:
            rows += [(book, f"{book}{v}{i}", (3 * (voice[v] + 0.02 * rng.normal(size=24))).tolist()) for i in range(n)]
    d = spark.createDataFrame(rows, "book string, path string, embedding array<double>").withColumn("speaker_id", F.lit(-7))
    local = local_labels(d, "book", "path", 24)
    labels, summary = global_labels(local, "book", "path", 24)
    got = labels.toPandas()
    of = lambda p: set(got[got["path"].str.startswith(p)]["global_speaker_id"])
    assert of("a0") == of("b0") and len(of("a0")) == 1 and len({*of("a0"), *of("a1"), *of("b2")}) == 3 and "c" not in set(got["book"])
    s = {r.global_speaker_id: r for r in summary.collect()}
    assert s[0].books == "a, b" and s[0].num_books == 2 and s[0].global_speaker_id in of("a0") and all(0 <= r.confidence_score <= 1 for r in s.values())
