"""Problem 2: one form for text that looks the same.

The skeleton of a text is what a reader sees: it is decomposed, every character is
replaced by the prototype of its look-alikes, and it is decomposed again.  What is not
seen is dropped, kinds of blank become one blank.  Joiners and presentation forms count
only where they change how Arabic-script letters are joined.  Texts with equal skeletons
form a group.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize

# Letters drawn alike, by prototype.
YEH, KAF, HEH = "ی", "ک", "ه"
SAME_LETTERS = {"ي": YEH, "ى": YEH, "ك": KAF, "ڪ": KAF, "ہ": HEH, "ھ": HEH}
# Digits drawn alike; 4, 5 and 6 differ between the two sets.
SAME_DIGITS = dict(zip("٠١٢٣٧٨٩", "۰۱۲۳۷۸۹"))
# Greek and Cyrillic letters with the Latin letters they look like.
GREEK = dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϳονϲιρυκγχ", "ABEZHIKMNOPTYXCjovcipukyx"))
CYRILLIC = dict(zip("АВЕКМНОРСТХІЈЅУԚԜаеорсухіјѕԁһԛԝӏҮ", "ABEKMHOPCTXIJSYQWaeopcyxijsdhqwlY"))
# letters that join on both sides, and those that join only to the letter before
DUAL = "بپتثجچحخسشصضطظعغفقکگلمنهیئٹٺٻټٿڀڃڄڇڠڡڤڨڭںڻـ"
RIGHT = "اآأإٱدذرزژوؤةےڈڑۆۇۈۉۋ"
MARKS = "̀-ͯؐ-ًؚ-ٰٟۖ-ۜ۟-۪ۤۧۨ-ۭ"
ZWNJ, ZWJ, CUT, STUB = "‌", "‍", "", ""


def _table() -> dict[int, str | None]:
    """Unseen characters go, blanks become one kind, look-alikes become their prototype."""
    table: dict[int, str | None] = {}
    for cp in range(0x20000):
        cat = unicodedata.category(chr(cp))
        if cat == "Zs" or cp in (9, 10, 11, 12, 13, 0x85, 0x2028, 0x2029):
            table[cp] = " "
        elif (cat in ("Cf", "Cc") and chr(cp) not in (ZWNJ, ZWJ)) or 0xFE00 <= cp <= 0xFE0F or cp in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0, 0x17B4, 0x17B5):
            table[cp] = None
    for m in (SAME_LETTERS, SAME_DIGITS, GREEK, CYRILLIC):
        table |= {ord(a): b for a, b in m.items()}
    for cp in range(0xE0100, 0xE01F0):
        table[cp] = None
    return table


def _ranges(codes: list[int]) -> str:
    """Character class of code points."""
    out, start = [], None
    for i, c in enumerate(codes):
        start = c if start is None else start
        if i + 1 == len(codes) or codes[i + 1] != c + 1:
            out.append(f"\\U{start:08x}-\\U{c:08x}")
            start = None
    return f"[{''.join(out)}]"


TABLE = _table()
_CHANGED = re.compile(_ranges(sorted(c for c, x in TABLE.items() if x != chr(c))))
_FORMS = re.compile("[ﭐ-ﯿﺀ-ﻼ]")
_AE = re.compile(f"ە([{MARKS}]*)")
_RUN = re.compile(f"[{ZWNJ}{ZWJ}]*{ZWNJ}[{ZWNJ}{ZWJ}]*")
_CUTS = re.compile(f"([{DUAL}][{MARKS}]*){ZWNJ}(?=[{DUAL}{RIGHT}])")
_JOINS = re.compile(f"([{DUAL}][{MARKS}]*){ZWJ}+(?=[{DUAL}{RIGHT}])")
_STUBS = re.compile(f"(?<=[{DUAL}]){ZWJ}+|{ZWJ}+(?=[{DUAL}{RIGHT}])")
_BLANKS = re.compile("  +")


def _spelled(text: str) -> str:
    """Presentation forms as ordinary letters, with a joiner or non-joiner wherever the
    drawn form is not the one the ordinary letters would take."""
    out: list[str] = []
    before: tuple[str, bool] | None = None  # last letter and whether it reaches out to the next
    for c in text:
        parts = unicodedata.decomposition(c).split() if _FORMS.match(c) else []
        tag = parts[0] if parts and parts[0][0] == "<" else ""
        if not tag:
            if unicodedata.combining(c) == 0:
                if before and before[1] and tag == "" and c not in (ZWNJ, ZWJ):
                    # a drawn initial or medial form in front of an ordinary letter or none
                    if c.translate(TABLE) is None or not re.match(f"[{DUAL}{RIGHT}]", c.translate(TABLE) or " "):
                        out.append(ZWJ)
                before = None
            out.append(c)
            continue
        base = "".join(chr(int(x, 16)) for x in parts[1:])
        reaches_back = tag in ("<final>", "<medial>")
        if before is not None:
            if before[1] != reaches_back or not before[1]:
                if before[1]:
                    out.append(ZWJ)
                out.append(ZWNJ)
        elif reaches_back and (not out or not re.match(f"[{DUAL}{MARKS}]", (out[-1].translate(TABLE) or " ")[-1])):
            out.append(ZWJ)
        elif not reaches_back:
            out.append(ZWNJ)
        out.append(base)
        before = (base, tag in ("<initial>", "<medial>"))
    if before and before[1]:
        out.append(ZWJ)
    elif before:
        out.append(ZWNJ)
    return "".join(out)


def skeleton(text: str) -> str:
    """The common form of all texts that look like this one."""
    if text.isascii():
        return _BLANKS.sub(" ", text.translate(TABLE)).strip(" ")
    if _FORMS.search(text):
        text = _spelled(text)
    t = unicodedata.normalize("NFKD", text)
    if "\u06d5" in t:
        t = _AE.sub(rf"{HEH}\1{ZWNJ}", t)
    if _CHANGED.search(t):  # most texts have nothing to replace
        t = unicodedata.normalize("NFKD", t.translate(TABLE))
    if ZWNJ in t or ZWJ in t:
        t = _CUTS.sub(rf"\1{CUT}", _RUN.sub(ZWNJ, t)).replace(ZWNJ, "")
        if ZWJ in t:
            t = _STUBS.sub(STUB, _JOINS.sub(r"\1", t)).replace(ZWJ, "")
    return _BLANKS.sub(" ", t).strip(" ").replace(CUT, ZWNJ).replace(STUB, ZWJ)


def look(text: Column) -> Column:
    """Skeleton of a text column; null stays null, a blank text gives an empty string."""

    @F.pandas_udf("string")
    def skeletons(texts: pd.Series) -> pd.Series:
        return texts.map(skeleton, na_action="ignore")

    return skeletons(text)


def with_skeletons(records: DataFrame, text: str = "text") -> DataFrame:
    """``records`` (with a unique ``record``) plus ``skeleton``."""
    return records.withColumn("skeleton", look(F.col(text)))


def _hashed(records: DataFrame) -> DataFrame:
    """Record, 128-bit hash of skeleton and of text; blank and null texts are no records."""
    s = records.select("record", "text", look(F.col("text")).alias("s")).where("s != ''")
    return s.select("record", F.unhex(F.md5("s")).alias("k"), F.unhex(F.md5("text")).alias("t"))


def equal_looks(records: DataFrame, part: int = 500) -> DataFrame:
    """Pairs ``record_a < record_b`` with equal skeletons and different texts.

    ``records`` has one row per ``record`` with its ``text``.  Only skeletons with several
    texts are joined; a group of more than ``part`` records is joined in salted parts.
    """
    h = materialize(_hashed(records), "looks")
    groups = h.groupBy("k").agg(F.count("*").alias("n"), F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo != hi")
    groups = groups.select("k", F.ceil(F.col("n") / part).cast("int").alias("parts"))
    m = materialize(h.join(groups, "k"), "several")
    a = m.select(F.col("record").alias("record_a"), "k", F.col("t").alias("ta"), F.pmod(F.hash("record"), F.col("parts")).alias("p"))
    b = m.select(F.col("record").alias("record_b"), "k", F.col("t").alias("tb"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("p"))
    return a.join(b, ["k", "p"]).where("ta != tb and record_a < record_b").select("record_a", "record_b")


def transcript_records(segments: DataFrame, samples: DataFrame) -> DataFrame:
    """``record, text``: every segment and sample once, with the text of its latest row."""
    seg = segments.where("segment_id is not null").groupBy("segment_id").agg(F.max(F.struct("processing_timestamp", F.col("final_transcript").alias("x"))).alias("r"))
    smp = samples.where("sample_id is not null").groupBy("sample_id").agg(F.max("transcript").alias("x"))
    return seg.select(F.concat(F.lit("segments/"), F.col("segment_id").cast("string")).alias("record"), F.col("r.x").alias("text")).unionByName(
        smp.select(F.concat(F.lit("samples/"), F.col("sample_id").cast("string")).alias("record"), F.col("x").alias("text"))
    )
