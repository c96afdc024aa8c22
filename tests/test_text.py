from pyspark.sql import functions as F

from voxloom.functions.models import with_punctuation
from voxloom.operators import metrics as M
from voxloom.operators import text as T
from voxloom.profiles import LATIN, PERSIAN


def one(spark, value, *columns, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first()


def test_normalize(spark):
    x = F.col("x")
    assert one(spark, " كتاب  يك  أ\x1c ", T.normalize(x))[0] == "کتاب یک ا"
    assert one(spark, None, T.normalize(x))[0] == ""
    assert one(spark, "  \n", T.has_text(x))[0] is False
    assert one(spark, "می‌شود", T.normalize(x))[0] == "می‌شود"


def test_tiers(spark):
    d = spark.createDataFrame([(0.0,), (0.62,), (0.78,), (1.0,)], "x double")
    assert [r[0] for r in d.select(T.tier(F.col("x"))).collect()] == [None, "low", "mid", "high"]


def features(spark, text, p=PERSIAN):
    d = spark.createDataFrame([(text,)], "x string")
    return T.with_text_features(d, "x", p).first().asDict()


def test_length_edges(spark):
    score = lambda t: features(spark, t, LATIN)["length_quality"]
    assert score("abcde abcde abcde abcde abcdef") == 1.0
    assert score(" ".join(["abcdefg"] * 18 + ["abc", "ab"])) == 1.0
    assert score("abcdef abcdef abcdef") == 0.8
    assert score("abcdefghij") == 0.6
    assert score(" ".join(["a"] * 51)) == 0.2


def test_repetition(spark):
    score = lambda t: features(spark, t)["repetition_score"]
    assert score("a a") == 1.0
    assert score("a a a") == 0.0
    assert abs(score("a b c d e f g h i j") - 0.7) < 1e-9


def test_blank_scores_nothing(spark):
    d = spark.createDataFrame([("  ",), (None,), ("",)], "x string")
    for r in T.with_text_scores(d, "x").collect():
        assert r.total_score == 0 and r.quality_tier is None


def test_digits_and_marks(spark):
    a, b = features(spark, "متن ²"), features(spark, "متن $")
    assert a["character_quality"] > b["character_quality"]  # a superscript counts as a digit, $ is no punctuation


def test_long_text(spark):
    f = features(spark, "کلمه " * 40_000)
    assert f["repetition_score"] == 0.0 and f["length_quality"] == 0.2


def test_punctuation(spark):
    d = spark.createDataFrame([("سلام, او گفت که رفت!",), (None,), (" ",)], "x string")
    assert [r.y for r in with_punctuation(d, "x", "y").collect()] == ["سلام او گفت، که رفت.", "", ""]


def test_file_name(spark):
    assert one(spark, 'a<b>:"/\\|?* c' + "x" * 200, T.file_name(F.col("x")))[0] == "ab_c" + "x" * 96


def python_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y))
    return row[-1]


def test_error_rates(spark):
    rows = [("الف ب پ", "الف س پ ت"), ("", ""), (None, None), ("", "متن"), ("متن", None), ("متن", "یک دو سه چهار"), ("كتاب ۱۲", "کتاب 12"), ("ﺩﺭ خانه", "در خانه")]
    out = M.with_error_rates(spark.createDataFrame(rows, "r string, h string"), "r", "h").collect()
    wer = [round(r.wer, 6) for r in out]
    assert wer == [round(2 / 3, 6), 0.0, 0.0, 1.0, 1.0, 4.0, 0.0, 0.0]
    assert out[1].cer == 0 and out[3].cer == 1 and out[6].cer == 0


def test_error_rates_against_dynamic_programming(spark):
    import random

    rnd = random.Random(5)
    rows = [(" ".join(rnd.choices("ابپتث", k=rnd.randint(1, 12))), " ".join(rnd.choices("ابپتث", k=rnd.randint(1, 12)))) for _ in range(60)]
    for r in M.with_error_rates(spark.createDataFrame(rows, "r string, h string"), "r", "h").collect():
        a, b = r.r.split(), r.h.split()
        assert abs(r.wer - python_distance(a, b) / len(a)) < 1e-12
        assert abs(r.cer - python_distance("".join(a), "".join(b)) / len("".join(a))) < 1e-12


def test_similarity_tiers(spark):
    d = spark.createDataFrame([(0.6,), (0.7,), (0.8,), (None,)], "s double")
    r = M.similarity_tiers(d, "s").first()
    assert (r.n, r.excellent, r.good, r.fair, r.poor) == (3, 33.333333, 33.333333, 33.333333, 0.0)
    assert M.similarity_tiers(d.where("s > 9"), "s").first().n == 0
