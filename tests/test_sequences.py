import random

import numpy as np
from pyspark.sql import functions as F

from voxloom.operators import metrics as M
from voxloom.operators import search as R
from voxloom.operators import signal as S
from voxloom.operators.components import connected_components
from voxloom.operators.incremental import completed_groups, pending, work_queue
from voxloom.operators.sequence import first_seen_index, keep_first, keep_last, number_within, shuffled_rank, upsert


def islands(spark, frames):
    rows = [("f", i, i * 0.03, s) for i, s in enumerate(frames)]
    d = spark.createDataFrame(rows, "k string, i int, t double, s boolean")
    out = S.speech_islands(d, "k", "t", ["i"], "s", F.count("*") * 0.03).collect()
    return sorted((round(r.island_start, 2), round(r.island_end, 2)) for r in out)


def test_islands(spark):
    T, N, X = True, False, None
    assert islands(spark, [T, T, N, T]) == [(0.0, 0.06), (0.09, 0.12)]
    assert islands(spark, [N, T, X, T, N]) == [(0.03, 0.12)]
    assert islands(spark, [N, N]) == []
    assert islands(spark, [T]) == [(0.0, 0.03)]
    assert islands(spark, [X, X]) == []


def fold(segments):
    out, reached = [], None
    for s, e in segments:
        start = s if reached is None else reached
        if start < e:
            out.append((start, e))
            reached = e
        elif reached is None:
            reached = s
    return out


def test_repair(spark):
    d = spark.createDataFrame([("a", 0, 0.0, 2.0), ("a", 1, 3.0, 5.0), ("a", 2, 4.0, 4.5), ("a", 3, 6.0, 7.0)], "k string, i int, s double, e double")
    r = S.repair_timeline(d, "k", "s", "e", ["s", "i"]).orderBy("i").collect()
    assert [(x.fixed_start, x.fixed_end) for x in r] == [(0, 2), (2, 5), (5, 7)]


def test_repair_against_fold(spark):
    rnd, rows, want = random.Random(1), [], {}
    for k in range(60):
        segs = sorted((rnd.randint(0, 40), i) for i in range(rnd.randint(1, 8)))
        segs = [(s, s + rnd.randint(1, 12)) for s, _ in segs]
        rows += [(k, i, float(s), float(e)) for i, (s, e) in enumerate(segs)]
        want[k] = fold(segs)
    d = spark.createDataFrame(rows, "k int, i int, s double, e double")
    got = {}
    for r in S.repair_timeline(d, "k", "s", "e", ["s", "i"]).orderBy("k", "s", "i").collect():
        got.setdefault(r.k, []).append((r.fixed_start, r.fixed_end))
    assert got == want


def test_frames(spark):
    d = spark.createDataFrame([(0,), (480,), (481,), (960,), (961,)], "n int")
    assert [len(r[0]) for r in d.select(S.frame_starts(F.col("n"))).collect()] == [0, 0, 1, 1, 2]
    assert [len(r[0]) for r in d.select(S.frame_starts(F.col("n"), keep_last=True)).collect()] == [0, 1, 1, 2, 2]


def test_clip_metrics(spark):
    rows = [("zero", 0.0)] * 4 + [("loud", 0.95)] * 2 + [("loud", 0.96)] * 2 + [("null", None)]
    m = {r.c: r for r in S.clip_metrics(spark.createDataFrame(rows, "c string, y double"), "c", "y").collect()}
    assert m["zero"].snr_db == float("-inf") and m["zero"].silence_percentage == 100
    assert m["loud"].clipping_percentage == 50 and "null" not in m


def test_clip_score(spark):
    d = spark.createDataFrame([(float("-inf"), 8000, 90.0, 90.0, float("-inf"), 5.0, False), (30.0, 48000, 0.0, 0.0, 30.0, 60.0, True), (30.0, 48000, 0.0, 0.0, 30.0, 0.99, True)], "a double, b int, c double, d double, e double, f double, g boolean")
    assert [r[0] for r in d.select(S.clip_score(*[F.col(c) for c in "abcdefg"])).collect()] == [15.0, 100.0, 0.0]


def test_int16_cuts_toward_zero(spark):
    d = spark.createDataFrame([(0.99999,), (-0.99999,), (1.0,), (0.0,)], "y double")
    assert [r[0] for r in d.select(S.int16(F.col("y"))).collect()] == [int(0.99999 * 32767), int(-0.99999 * 32767), 32767, 0]


def test_int16_beyond_full_scale(spark, tmp_path):
    from voxloom.plans.segmentation import pcm_quantized

    ys = [1.12042, -1.04032, 1.00001, 1.00004, -1.00004, -1.00007, 3.0, 1e6, -1e6, float("nan"), float("inf"), None]
    got = [r[0] for r in spark.createDataFrame([(y,) for y in ys], "y double").select(S.int16(F.col("y"))).collect()]
    assert got == [-28824, 31448, 32767, -32768, -32768, 32767, 32765, 0, 0, 0, 0, None]
    rows = [(0, 560.21), (1, 520.16), (2, 499.99), (3, None)]
    spark.createDataFrame([(i, 7, v) for i, v in rows], "event_id long, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    assert sorted(map(tuple, pcm_quantized(spark, str(tmp_path)).collect())) == [(0, -28824, 17926), (1, 31448, 16645), (2, 32766, 15999), (3, None, None)]


def test_extension(spark):
    d = spark.createDataFrame([("now", 0), ("never", 99), ("silent", 3), ("fails", 1)], "k string, at int")

    def status(step):
        done = F.when(F.col("k") == "silent", "Empty").when(F.col("k") == "fails", F.lit(None).cast("string")).otherwise("Complete")
        return F.when(step < F.col("at"), "Incomplete").otherwise(done)

    got = {r.k: r.extensions for r in R.extend_declared(d, ["k"], status).collect()}
    assert got == {"now": 0, "never": 50, "silent": 2, "fails": 0}


def test_trim_forms_agree(spark):
    rows = [(i, ms, safe) for i, (ms, safe) in enumerate([(800, 0), (900, 300), (5000, 700), (9000, 9999), (400, 100), (1200, 900)])]
    d = spark.createDataFrame(rows, "k int, ms int, safe int")
    t = R.trim_declared(d, ["k"], F.col("ms"), S.trim_budget(F.col("ms")), lambda x: x <= F.col("safe"), "cut")
    for r in t.collect():
        budget = min(3000, r.ms // 2) // 100 * 100
        assert r.cut == R.largest_trim(budget, r.ms, lambda x, s=r.safe: x <= s)


def test_trim_checks_around(spark):
    holds = {0, 100, 200, 300, 400, 700}  # not monotone: the check around the answer finds 700
    assert R.largest_trim(3000, 9000, lambda x: x in holds) in (400, 700)
    assert R.largest_trim(3000, 9000, lambda x: False) == 0


def test_an_empty_transcript_matches_nothing(spark):
    rows = [(1, 5000, "", ""), (2, 5000, None, ""), (3, 5000, "x", None), (4, 5000, "x", " x ")]
    d = spark.createDataFrame(rows, "k int, duration_ms int, target string, says string")
    got = {r.k: (r.start_trimmed_ms, r.end_trimmed_ms) for r in R.trim_searched(d, "k", lambda row: lambda a, b: row["says"]).collect()}
    assert got == {1: (0, 0), 2: (0, 0), 3: (0, 0), 4: (2000, 2500)}


def test_buckets_change_nothing(spark):
    rnd = random.Random(5)
    rows = [(i % 3, i, float(rnd.randint(0, 400)), float(rnd.randint(1, 30))) for i in range(500)]
    d = spark.createDataFrame(rows, "k int, i int, s double, len double").withColumn("e", F.col("s") + F.col("len"))
    for gaps in (True, False):
        forms = [S.repair_timeline(d, "k", "s", "e", ["s", "i"], gaps, b).select("i", "fixed_start").collect() for b in (None, F.floor(F.col("s") / 20))]
        assert sorted(forms[0]) == sorted(forms[1])
    for group in ("k", None):
        forms = [number_within(d, group, ["s", "i"], "n", b).select("i", "n").collect() for b in (None, F.floor(F.col("s") / 20))]
        assert sorted(forms[0]) == sorted(forms[1])
    order = shuffled_rank(d.select("i"), None, ["i"], "place").collect()
    assert sorted(r.place for r in order) == list(range(1, 501))


def test_edit_distance_of_any_vocabulary(spark, monkeypatch):
    rnd = random.Random(2)
    pairs = [([rnd.choice("abcdefg") for _ in range(rnd.randint(0, 12))], [rnd.choice("abcdefg") for _ in range(rnd.randint(0, 12))]) for _ in range(80)]
    d = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>")
    fast = {r.i: r.n for r in M.with_word_distance(d, "a", "b", "n").collect()}
    monkeypatch.setattr(M, "CODES", 3)  # most pairs have more words than that
    assert fast == {r.i: r.n for r in M.with_word_distance(d, "a", "b", "n").collect()} == {i: M.edit_distance(a, b) for i, (a, b) in enumerate(pairs)}


def test_audio_scores(spark):
    rng = np.random.default_rng(0)
    loud = (0.5 * rng.normal(size=16000)).clip(-1, 1)
    rows = [("short", [0.5] * 100, 16000), ("empty", [], 16000), ("loud", loud.tolist(), 16000), ("zero", [0.0] * 16000, 16000), ("bad", None, 0)]
    d = spark.createDataFrame(rows, "path string, samples array<double>, sample_rate int").withColumn("extra", F.lit(1))
    got = {r.path: r for r in S.audio_scores(d).collect()}
    assert set(got) == {"short", "empty", "loud", "zero"} and got["loud"].extra == 1
    for s in ("short", "empty"):
        assert (got[s].snr_db, got[s].silence_percentage, got[s].is_clean, got[s].quality_score) == (0, 100, True, 0)
    assert got["zero"].snr_db == float("-inf")
    # the same as the declared form over one row per sample
    y = spark.createDataFrame([("loud", float(v)) for v in loud], "c string, y double")
    m = S.clip_metrics(y, "c", "y").first()
    for a, b in ((m.snr_db, got["loud"].snr_db), (m.dynamic_range_db, got["loud"].dynamic_range_db), (m.clipping_percentage, got["loud"].clipping_percentage)):
        assert abs(a - b) < 1e-6
    assert S.audio_scores(d, lambda y, rate: True).where("path = 'loud'").first().is_clean is False


def test_throughput(spark):
    d = spark.createDataFrame([("a", 2.0), ("a", 2.0), ("b", 0.0)], "g string, s double")
    assert {(r.g, r["items"], r.per_second) for r in M.throughput(d, ["g"], "s").collect()} == {("a", 2, 0.5), ("b", 1, None)}


def test_choice_of_rows(spark):
    d = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, None), (2, 1, None)], "k int, o int, v string")
    assert sorted(tuple(r) for r in keep_first(d, ["k"], [F.col("o")]).collect()) == [(1, 1, "a"), (2, 1, None)]
    assert sorted(tuple(r) for r in keep_last(d, ["k"], [F.col("o")]).collect()) == [(1, 2, "b"), (2, 1, None)]
    assert keep_last(d.where("k > 9"), ["k"], [F.col("o")]).count() == 0
    new = spark.createDataFrame([(1, 9, "n")], d.schema)
    assert sorted(r.o for r in upsert(d, new, ["k"]).collect()) == [1, 1, 9]


def test_first_seen(spark):
    d = spark.createDataFrame([("b", 0), ("a", 1), ("b", 2), (None, 3)], "t string, p int")
    assert {r.t: r.n for r in first_seen_index(d, "t", "p", "n").collect()} == {"b": 0, "a": 1, None: 2}


def test_division(spark):
    parts = spark.createDataFrame([("x", 1), ("x", 2), ("y", 1), ("z", 1)], "g string, k int")
    done = spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("z", 2)], "g string, k int")
    assert {r.g: r.complete for r in completed_groups(parts, done, "g", "k").collect()} == {"x": True, "y": False, "z": False}
    assert pending(parts, done, ["g", "k"]).count() == 2


def test_queue(spark):
    s = spark.createDataFrame([(1, "completed"), (2, "processing"), (3, "failed"), (4, "pending")], "k int, status string")
    c = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert {(r.k, r.status) for r in work_queue(s, c, ["k"]).collect()} == {(2, "pending")}
    assert {r.k for r in work_queue(s, c, ["k"], retry_failed=True).collect()} == {2, 3}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 101), (102, 101), (5, 5), (200, 200), (None, 3)] + [(50, i) for i in range(51, 70)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(1, 31)} == {1} and got[102] == 100 and got[200] == 200 and got[69] == 50
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_raters_order_all_items(spark, tmp_path):
    from voxloom.plans.work import rater_shuffle

    spark.range(120).selectExpr("id as audio_index").write.parquet(f"{tmp_path}/samples.parquet")
    spark.range(3).selectExpr("id as user_id").write.parquet(f"{tmp_path}/user_sessions.parquet")
    orders = {}
    for r in rater_shuffle(spark, str(tmp_path)).orderBy("user_id", "place").collect():
        orders.setdefault(r.user_id, []).append(r.audio_index)
    assert all(sorted(o) == list(range(120)) for o in orders.values()) and len({tuple(o) for o in orders.values()}) == 3


def test_rater_orders_as_sql(spark, tmp_path):
    from tests.oracle import same
    from voxloom.plans.base import SQL
    from voxloom.plans.work import rater_shuffle

    spark.createDataFrame([(i,) for i in [None, -7, -123456, 2**31 - 1, -(2**31), *range(1200), *range(0, 1200, 3)]], "audio_index int").write.parquet(f"{tmp_path}/samples.parquet")
    spark.createDataFrame([(i,) for i in [None, 0, 9, 10, 10, -5, 123456789, 2**63 - 1, -(2**63)]], "user_id long").write.parquet(f"{tmp_path}/user_sessions.parquet")
    d = rater_shuffle(spark, str(tmp_path))
    same(d, SQL["rater_shuffle"], str(tmp_path))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "md5" not in plan  # the pairs are neither shuffled nor sorted
    spark.createDataFrame([], "audio_index int").write.parquet(f"{tmp_path}/none/samples.parquet")
    spark.range(3).selectExpr("id as user_id").write.parquet(f"{tmp_path}/none/user_sessions.parquet")
    assert rater_shuffle(spark, f"{tmp_path}/none").collect() == []


def test_orders_of_equal_first_digits(monkeypatch):
    import hashlib

    from voxloom.operators import orders as O

    items = np.array([*range(-20, 3000), 10**18, -(2**63)])
    heads = [b"42:%d:" % u for u in (10, 77, 99)]
    want = [sorted(range(len(items)), key=lambda k: (hashlib.md5(h + b"%d" % items[k]).hexdigest(), items[k])) for h in heads]
    for cells, bits in ((O.CELLS, 0), (500, 0), (500, 60)):  # 4 bits of the hash at last, so all heads are sorted again
        monkeypatch.setattr(O, "CELLS", cells)
        got = O.hashed_orders(np.array([list(h) for h in heads], "u1"), items, O.by_length(items), bits)
        assert got.tolist() == want
