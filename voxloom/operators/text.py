"""Text operators as column expressions: normal forms, quality features, tiers, marks."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.profiles import PERSIAN, Profile

#: White space as a scripting language sees it; the pattern reads alike in Java and RE2.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Decimal digits, and the superscript and circled ones that also count as digits.
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}]"
# Default weights of the six features, tier limits and the pass mark.
WEIGHTS = {"character_quality": 0.20, "length_quality": 0.15, "sentence_quality": 0.20, "repetition_score": 0.15, "linguistic_complexity": 0.15, "phonetic_coverage": 0.15}
LOW_TO, MID_TO, PASS_MARK = 0.62, 0.78, 0.5
# Marks that the punctuation model knows, and their variants.
MARK_FROM, MARK_TO, MARKS = ",!。?", "،..؟", ".،؟:"


def squeeze(t: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.regexp_replace(F.regexp_replace(t, WS + "+", " "), "^ | $", "")


def normalize(t: Column, p: Profile = PERSIAN) -> Column:
    """Unified letters and blanks; null becomes empty."""
    t = F.translate(t, p.replace_from, p.replace_to) if p.replace_from else t
    return F.coalesce(squeeze(t), F.lit(""))


def words(t: Column) -> Column:
    """Words of a normalized text; none of an empty one."""
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def count_of(t: Column, chars: str) -> Column:
    """How many characters of a text are among these."""
    return F.length(t) - F.length(F.translate(t, chars, "")) if chars else F.lit(0)


def clamp(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def character_quality(t: Column, p: Profile = PERSIAN) -> Column:
    n = F.nullif(F.length(t), F.lit(0))
    score = (
        count_of(t, p.letters) / n * 0.6
        + F.least(F.regexp_count(t, F.lit(DIGIT)) / n * 10, F.lit(0.2))
        + F.least(F.regexp_count(t, F.lit(r"\p{P}")) / n * 5, F.lit(0.15))
        - count_of(t, p.variants) / n * 0.5
    )
    return F.coalesce(clamp(score), F.lit(0.0))


def length_quality(t: Column, w: Column) -> Column:
    n, c = F.size(w), F.length(t)
    best = n.between(5, 20) & c.between(30, 150)
    good = n.between(3, 30) & c.between(20, 200)
    fair = n.between(1, 50) & c.between(10, 300)
    return F.when(best, 1.0).when(good, 0.8).when(fair, 0.6).otherwise(0.2)


def sentence_quality(t: Column, p: Profile = PERSIAN) -> Column:
    verb = F.lit(False)
    for v in p.verbs:
        verb = verb | F.contains(t, F.lit(v))
    return F.when(t.rlike("[.!?؟]$"), 0.3).otherwise(0.0) + F.when(t.rlike(f"^[{p.first}]"), 0.2).otherwise(0.0) + F.when(verb, 0.5).otherwise(0.0)


def most_frequent(w: Column) -> Column:
    """Number of times the commonest word occurs, in one pass over the sorted words."""
    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s, x):
        run = F.when(s["word"] == x, s["run"] + 1).otherwise(1)
        return F.struct(x.alias("word"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    return F.aggregate(F.array_sort(w), start, step, lambda s: s["best"])


def repetition_score(w: Column) -> Column:
    n, kinds = F.nullif(F.size(w), F.lit(0)), F.size(F.array_distinct(w))
    # most texts repeat no word: the pass over the sorted words is left to those that do
    score = F.greatest(kinds / n - F.least(F.when(kinds == n, F.lit(1)).otherwise(most_frequent(w)) / n * 3, F.lit(0.5)), F.lit(0.0))
    return F.when(F.size(w) < 3, 1.0).otherwise(score)


def linguistic_complexity(t: Column, w: Column, p: Profile = PERSIAN) -> Column:
    n = F.nullif(F.size(w), F.lit(0))
    common = F.size(F.filter(w, lambda x: x.isin(*p.common))) / n
    mean = (F.length(t) - (n - 1)) / n  # letters without the blanks between words
    short = 1.0 - F.least(mean / 15, F.lit(0.5))
    pauses = F.least(count_of(t, p.pauses) / n * 2, F.lit(0.3))
    return F.coalesce(clamp(common * 0.4 + short * 0.4 + (1.0 - pauses) * 0.2), F.lit(0.0))


def phonetic_coverage(t: Column, p: Profile = PERSIAN) -> Column:
    low = F.lower(t)
    letters = dict.fromkeys(p.letters)
    kinds = sum((F.contains(low, F.lit(c)).cast("int") for c in letters), F.lit(0)) / len(p.letters)
    both = low.rlike(f"[{p.vowels}]") & low.rlike(f"[{p.consonants}]")
    return F.least(kinds + F.when(both, 0.2).otherwise(0.0), F.lit(1.0))


def with_text_features(df: DataFrame, text: str, p: Profile = PERSIAN) -> DataFrame:
    """Add ``normalized`` and the six features; all 0 where the text is null or blank."""
    d = df.withColumn("normalized", normalize(F.col(text), p)).withColumn("_w", words(F.col("normalized")))
    t, w = F.col("normalized"), F.col("_w")
    made = {
        "character_quality": character_quality(t, p),
        "length_quality": length_quality(t, w),
        "sentence_quality": sentence_quality(t, p),
        "repetition_score": repetition_score(w),
        "linguistic_complexity": linguistic_complexity(t, w, p),
        "phonetic_coverage": phonetic_coverage(t, p),
    }
    return d.withColumns({k: F.when(t == "", F.lit(0.0)).otherwise(x) for k, x in made.items()}).drop("_w")


def tier(total: Column) -> Column:
    """Right-closed tiers; a total of 0 or less has none."""
    return F.when(total <= 0, F.lit(None)).when(total <= LOW_TO, "low").when(total <= MID_TO, "mid").when(total <= 1.0, "high")


def with_text_scores(df: DataFrame, text: str, p: Profile = PERSIAN, weights: dict[str, float] | None = None) -> DataFrame:
    """Features, their weighted ``total_score`` and ``quality_tier``."""
    w = weights or WEIGHTS
    d = with_text_features(df, text, p)
    total = sum((F.col(k) * x for k, x in list(w.items())[1:]), F.col(next(iter(w))) * next(iter(w.values())))
    return d.withColumn("total_score", F.round(total, 9)).withColumn("quality_tier", tier(F.col("total_score")))


def unify_marks(t: Column) -> Column:
    """Variants of the model's punctuation marks; null becomes empty."""
    return F.coalesce(F.translate(t, MARK_FROM, MARK_TO), F.lit(""))


def strip_marks(t: Column) -> Column:
    return F.translate(t, MARKS, "")


def join_marks(w: Column, labels: Column) -> Column:
    """Each word with its label's mark; ``O`` and missing labels add none."""
    mark = lambda x: F.when(x.isNull() | (x == "O"), "").otherwise(F.regexp_replace(x, "B-", ""))
    return F.array_join(F.zip_with(w, labels, lambda a, b: F.concat(a, mark(b))), " ")


def file_name(t: Column) -> Column:
    """Text made fit for a file name: at most 100 characters."""
    return F.substring(F.translate(F.regexp_replace(t, r'[<>:"/\\|?*]', ""), " ", "_"), 1, 100)


def preview(t: Column, n: int = 50) -> Column:
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def has_text(t: Column) -> Column:
    """Whether a text holds anything but white space; null does not."""
    return F.coalesce(F.length(squeeze(t)) > 0, F.lit(False))


# Marks removed and characters mapped before recognition is compared.
EVAL_MARKS = "".join(chr(c) for c in (*range(0x64B, 0x660), 0x670))
EVAL_FROM = "يكةأإآؤئ" + "١٢٣٤٥٦٧٨٩٠" + "1234567890" + "«»؟؛،٬٫﴾﴿"
EVAL_TO = "یکهاااوی" + "۱۲۳۴۵۶۷۸۹۰" + "۱۲۳۴۵۶۷۸۹۰" + "\"\"?;,,.()"
EVAL_DROP = "ء‌‍ـ"
EVAL_SCRIPT = r"\x{600}-\x{6ff}\x{750}-\x{77f}\x{8a0}-\x{8ff}\x{fb50}-\x{fdff}\x{fe70}-\x{feff}"


def compatible(t: Column) -> Column:
    """Compatibility composition (NFKC), the one step without a built-in function."""

    @F.pandas_udf("string")
    def nfkc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: x if x.isascii() else unicodedata.normalize("NFKC", x), na_action="ignore")

    return nfkc(t)


def eval_form(t: Column) -> Column:
    """Common form of references and recognized texts; null becomes empty."""
    t = F.translate(F.translate(compatible(t), EVAL_MARKS + EVAL_DROP, ""), EVAL_FROM, EVAL_TO)
    t = F.regexp_replace(t, f"[^{EVAL_SCRIPT} .,?!:;()\\-/\"']", " ")
    return F.coalesce(F.lower(squeeze(t)), F.lit(""))


def word_form(t: Column) -> Column:
    return squeeze(F.regexp_replace(t, f"[^{EVAL_SCRIPT} ]", ""))


def char_form(t: Column) -> Column:
    return F.regexp_replace(t, f"[^{EVAL_SCRIPT}]", "")
