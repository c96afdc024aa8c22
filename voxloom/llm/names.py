"""Problem 1: variant spellings of names typed by people.

Each distinct string is cleaned (roles, titles, quotes, order of the parts) into tokens.
A token has a letter form, in which letters of equal sound are one, and a sound form of
consonants only that Persian and Latin spellings share.  Candidate pairs come from a
prefix-filtered set-similarity join over the q-grams of the distinct tokens' sound forms;
a token only stands for its names if the other tokens alone could not reach the
threshold.  Candidates are verified by a soft, weighted token similarity in which rare
tokens count more, so a shared family name alone is not enough.  Verified links between
written-out names form components.  Initials and short forms fit several people; a
component of such strings joins the one best-attested component that it fits.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.components import connected_components
from voxloom.session import materialize

# Strings that name nobody.
PLACEHOLDERS = {"unknown", "none", "null", "n/a", "na", "nan", "anonymous", "narrator", "ناشناس", "نامشخص", "ندارد", "نامعلوم", "بی نام", "بدون نام", "بدون راوی", "مجهول", "راوی", "گوینده"}
# Roles and titles in front of or behind a name.
ROLES = {"راوی", "گوینده", "خوانش", "روایت", "با صدای", "به روایت", "narrator", "reader", "read by", "narrated by"}
TITLES = {"سید", "سیده", "دکتر", "استاد", "آقای", "خانم", "مهندس", "حاج", "dr", "mr", "mrs", "ms", "prof"}
# Words that say what kind of body a name is, and words such names are filled up with.
BODIES = {"استودیو": "@studio", "استدیو": "@studio", "studio": "@studio", "studios": "@studio", "گروه": "@group", "group": "@group", "انتشارات": "@publisher", "نشر": "@publisher", "publishing": "@publisher", "publisher": "@publisher", "publications": "@publisher", "press": "@publisher"}
FILLERS = {"صدای", "صدا", "هنری", "صوتی", "art", "audio", "sound", "voice", "the", "of"}
# Endings of family names that are sometimes written apart.
ENDINGS = {"نیا", "دوست", "یان", "فر", "پور", "خواه", "وند", "نژاد", "زاده"}
# Persian letters of equal sound, and the consonants they are written with in Latin.
SAME_SOUND = str.maketrans({"ذ": "ز", "ض": "ز", "ظ": "ز", "ص": "س", "ث": "س", "ط": "ت", "ح": "ه", "غ": "ق", "ع": "ا", "آ": "ا", "أ": "ا", "إ": "ا", "ؤ": "و", "ئ": "ی", "ي": "ی", "ى": "ی", "ك": "ک", "ة": "ه", "ۀ": "ه", "ە": "ه", "ء": ""})
SAME_FORM = str.maketrans("أإيىك", "اایی" + "ک")
CONSONANTS = {"ب": "b", "پ": "p", "ت": "t", "ج": "j", "چ": "C", "خ": "K", "د": "d", "ر": "r", "ز": "z", "ژ": "Z", "س": "s", "ش": "S", "ف": "f", "ق": "G", "ک": "k", "گ": "g", "ل": "l", "م": "m", "ن": "n", "ه": "h"}
DIGRAPHS = {"kh": "K", "sh": "S", "ch": "C", "zh": "Z", "gh": "G"}

WEIGHT_THRESHOLD, GRAM_THRESHOLD = 0.8, 0.33


def sound(token: str) -> str:
    """Consonants of a token, alike for both scripts; vowels and semivowels are left out."""
    if re.search("[a-z]", token):
        token = re.sub("kh|sh|ch|zh|gh", lambda m: DIGRAPHS[m[0]], token.replace("q", "gh").replace("ph", "f").replace("c", "k") if "ch" not in token else token)
        return re.sub("[^a-zA-Z]|[aeiouywv]", "", token).replace("x", "ks")
    return "".join(CONSONANTS.get(c, "") for c in token.translate(SAME_SOUND))


def _unified(token: str) -> str:
    """Letters of equal sound as one, but for the first, which initials are told apart by."""
    return token[:1].translate(SAME_FORM) + token[1:].translate(SAME_SOUND)


def initial(token: str) -> str:
    """Latin class of the first letter; all vowels are one class."""
    c = token[:1].translate(SAME_SOUND)
    if c in "اaeiou" or not c:
        return "a"
    return {"و": "v", "ی": "y"}.get(c) or CONSONANTS.get(c, c)[:1].lower()


def parse_name(text: str) -> tuple[list[str], bool, bool]:
    """Tokens in the order given name, family name; whether it is a body; whether usable."""
    t = unicodedata.normalize("NFKC", text).replace("ٔ", "")
    t = "".join(" " if c in "_\t\n" or unicodedata.category(c) == "Zs" else c for c in t if unicodedata.category(c) not in ("Cf", "Mn") or c == "‌")
    t = t.replace("‌", "").replace("ي", "ی").replace("ك", "ک").replace("ى", "ی").lower()
    t = re.sub(r"[«»\"'“”„]", " ", t)
    t = re.sub(r"\s+", " ", t).strip(" ،,؛;:-–")
    if t in PLACEHOLDERS or not re.search(r"[^\W\d_]", t):
        return [], False, False
    while True:
        before = t
        for r in ROLES:
            if t.startswith(r + " :") or t.startswith(r + ":") or (" " in r and t.startswith(r + " ")):
                t = t[len(r) :].lstrip(" :")
        t = re.sub(r"\((?:%s)\)\s*$" % "|".join(ROLES), "", t).strip(" ،,؛;:-–")
        if t == before:
            break
    parts = [p.strip() for p in re.split(r"[،,]| [-–] ", t) if p.strip()]
    if len(parts) == 2:
        parts.reverse()
    words = [w for w in re.split(r"[\s.()/]+", " ".join(parts)) if w.strip("-–:؛;")]
    words = [w for i, w in enumerate(words) if w not in TITLES or len(words) < 2]
    kinds = [BODIES[w] for w in words if w in BODIES]
    if kinds:
        core = [w for w in words if w not in BODIES and w not in FILLERS]
        return ([kinds[0], *map(_unified, core)], True, bool(core))
    merged: list[str] = []
    for w in words:
        if w in ENDINGS and merged and len(merged[-1]) > 1:
            merged[-1] += w
        else:
            merged.append(w)
    tokens = [w if re.search("[a-z]", w) else _unified(w) for w in merged]
    return [w for w in tokens if w], False, any(len(w) > 1 for w in tokens)


def edits(a: str, b: str, most: int = 2) -> int:
    """Edit distance with swaps of neighbours, up to ``most`` + 1."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two, one = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return one[-1]


def _within(a: str, b: str) -> bool:
    """Whether the letters of a occur in b in this order."""
    rest = iter(b)
    return len(a) >= 2 and all(c in rest for c in a)


def token_similarity(a: str, b: str) -> tuple[float, bool]:
    """Similarity of two tokens, and whether one is only a short form of the other."""
    if a == b:
        return 1.0, False
    if a[0] == "@" or b[0] == "@":
        return 0.0, False
    latin_a, latin_b = bool(re.search("[a-z]", a)), bool(re.search("[a-z]", b))
    if len(a) == 1 or len(b) == 1:
        if latin_a == latin_b:
            same = a[0] == b[0]
        else:
            same = initial(a) == initial(b)
        return (0.95 if same else 0.0), len(a) != len(b)
    if latin_a or latin_b:
        x, y = sound(a).replace("Z", "j"), sound(b).replace("Z", "j")  # both are written j
        if x == y and len(x) >= 2 or x == y and initial(a) == initial(b) and len(x) == 1:
            return 0.97, False
        if edits(x, y, 1) <= 1 and min(len(x), len(y)) >= 5:
            return 0.9, False
        # a short form in the other script
        return (0.9, True) if min(len(x), len(y)) >= 2 and max(len(x), len(y)) - min(len(x), len(y)) <= 2 and (x.startswith(y) or y.startswith(x)) else (0.0, False)
    short, long = sorted((a, b), key=len)
    if edits(a, b, 1) <= 1 and len(short) >= 3:
        # a letter more or less at the end may as well be a short form; both readings agree
        return 0.95, False
    if len(short) >= 2 and len(long) - len(short) >= 1:
        if short.endswith("ی") and len(short) >= 3 and long.startswith(short[:-1]) or len(short) >= 3 and long.startswith(short):
            return 0.92, True
        if short.endswith("ی") and len(short) <= 4 and len(short) >= 3 and short[0] == long[0] and _within(sound(short), sound(long)):
            return 0.9, True
        if len(short) >= 3 and short[:2] == long[:2] and sound(short) and sound(long).startswith(sound(short)) and len(long) <= len(short) + 2:
            return 0.9, True
    return 0.0, False


def name_similarity(a: list[str], b: list[str], wa: list[float], wb: list[float]) -> tuple[float, int]:
    """Soft weighted similarity of two token lists; -1, 1 or 0: which one is a short form."""
    joined = "".join(a), "".join(b)
    if not any("@" in x for x in joined) and min(map(len, joined)) >= 7 and (len(a) == 1) != (len(b) == 1) or len(a) != len(b):
        if min(len(x) for x in a) > 1 and min(len(x) for x in b) > 1 and min(map(len, joined)) >= 7 and edits(*joined, 1) <= 1:
            return 0.95, 0
    na, nb = sum(w * w for w in wa) ** 0.5, sum(w * w for w in wb) ** 0.5
    pairs = sorted(((token_similarity(x, y), i, j) for i, x in enumerate(a) for j, y in enumerate(b)), key=lambda p: (-p[0][0], p[1], p[2]))
    used_a, used_b, total, lean = set(), set(), 0.0, 0
    for (s, short), i, j in pairs:
        if s and i not in used_a and j not in used_b:
            used_a.add(i)
            used_b.add(j)
            # a short form says as little as it is long, but it stands for the whole word
            x, y = (max(wa[i], wb[j]),) * 2 if short else (wa[i], wb[j])
            if short:
                na, nb = (na * na - wa[i] ** 2 + x * x) ** 0.5, (nb * nb - wb[j] ** 2 + y * y) ** 0.5
                lean = -1 if len(a[i]) < len(b[j]) else 1
            total += s * x * y
    return min(1.0, total / (na * nb)) if na and nb else 0.0, lean


def _grams(s: str) -> list[str]:
    p = f"#{s}$"
    return sorted({p[i : i + 2] for i in range(len(p) - 1)})


def parsed_names(names: DataFrame) -> DataFrame:
    """``id, n, tokens, body`` of every usable distinct string."""

    @F.pandas_udf("struct<tokens: array<string>, body: boolean, usable: boolean>")
    def parse(s: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_name(x) for x in s], columns=["tokens", "body", "usable"])

    p = names.where(F.col("name").isNotNull()).withColumn("_p", parse("name"))
    return p.where("_p.usable").select("id", "n", "_p.tokens", "_p.body")


def similar_tokens(tokens: DataFrame, threshold: float = GRAM_THRESHOLD) -> DataFrame:
    """``token_a, token_b`` with a Jaccard similarity of q-grams of at least the threshold,
    both directions and each token with itself.  Prefix filter: of a token's grams, rarest
    first, only so many are joined that every similar pair still meets."""

    @F.pandas_udf("array<string>")
    def grams(s: pd.Series) -> pd.Series:
        return s.map(lambda x: _grams(sound(x) if x[0] != "@" else x))

    sets = materialize(tokens.select("token", grams("token").alias("g")), "grams")
    each = sets.select("token", F.size("g").alias("n"), F.explode("g").alias("gram"))
    freq = each.groupBy("gram").agg(F.count("*").alias("f"))
    order = Window.partitionBy("token").orderBy("f", "gram")
    keep = F.col("n") - F.ceil(F.col("n") * threshold) + 1
    prefix = each.join(freq, "gram").withColumn("k", F.row_number().over(order)).where(F.col("k") <= keep).select("token", "n", "gram")
    a, b = prefix.select(F.col("token").alias("token_a"), F.col("n").alias("na"), "gram"), prefix.select(F.col("token").alias("token_b"), F.col("n").alias("nb"), "gram")
    near = a.join(b, "gram").where((F.col("na") >= F.col("nb") * threshold) & (F.col("nb") >= F.col("na") * threshold) & (F.col("token_a") < F.col("token_b"))).select("token_a", "token_b").distinct()
    near = near.join(sets.select(F.col("token").alias("token_a"), F.col("g").alias("ga")), "token_a").join(sets.select(F.col("token").alias("token_b"), F.col("g").alias("gb")), "token_b")
    same = F.size(F.array_intersect("ga", "gb"))
    near = near.where(same >= F.lit(threshold) * (F.size("ga") + F.size("gb") - same)).select("token_a", "token_b")
    both = near.unionByName(near.select(F.col("token_b").alias("token_a"), F.col("token_a").alias("token_b")))
    return both.unionByName(sets.select(F.col("token").alias("token_a"), F.col("token").alias("token_b")))


def link_names(names: DataFrame, threshold: float = WEIGHT_THRESHOLD) -> DataFrame:
    """``id, entity`` for every usable row of ``names`` (``id`` unique, ``name``, ``n`` uses).

    The entity is the least id of its names.  Placeholders, blank and null strings are no
    names and are left out; equal strings should come once.
    """
    parsed = materialize(parsed_names(names), "names")
    total = max(1, parsed.count())
    tok = parsed.select("id", F.posexplode("tokens").alias("pos", "token"))
    df = tok.select("id", "token").distinct().groupBy("token").agg(F.count("*").alias("df"))
    weighted = tok.join(df, "token").withColumn("w", F.log(1 + F.lit(total) / F.col("df")))
    lists = weighted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "token", "w"))).alias("l"))
    rows = materialize(lists.select("id", F.col("l.token").alias("tokens"), F.col("l.w").alias("weights")), "lists")
    # weighted prefix: the tokens without which the rest cannot reach the threshold; the whole
    # string without blanks stands for names whose blank is missing or misplaced
    heavy = F.expr("filter(transform(arrays_zip(tokens, weights), t -> struct(t.weights as w, t.tokens as t)), x -> length(x.t) > 1)")
    squares = "aggregate(l, 0D, (s, x) -> s + x.w * x.w)"
    pre = rows.withColumn("l", F.sort_array(heavy, asc=False)).withColumn("l", F.expr(f"""filter(transform(l, (x, i) ->
        struct(x.t as t, aggregate(slice(l, i + 1, size(l)), 0D, (s, y) -> s + y.w * y.w) as rest)), x -> x.rest >= {threshold * threshold / 2} * {squares}).t"""))
    index = pre.select("id", F.explode(F.array_union("l", F.array(F.array_join("tokens", "")))).alias("token")).where(F.length("token") > 1)
    index = materialize(index.where(~F.col("token").contains("@") | (F.col("token").substr(1, 1) != "@")).distinct(), "index")
    near = similar_tokens(index.select("token").distinct())
    a = index.select(F.col("id").alias("a"), F.col("token").alias("token_a"))
    b = index.select(F.col("id").alias("b"), F.col("token").alias("token_b"))
    pairs = a.join(near, "token_a").join(b, "token_b").where("a < b").select("a", "b").distinct()
    side = lambda x: rows.select(F.col("id").alias(x), F.col("tokens").alias(f"t{x}"), F.col("weights").alias(f"w{x}"))
    # a number and a key of its own: adaptive execution would put all pairs, which are small, into one task
    tasks = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").repartition(tasks, F.xxhash64("a", "b"))

    @F.pandas_udf("struct<s: double, lean: int>")
    def verify(ta: pd.Series, tb: pd.Series, wa: pd.Series, wb: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([name_similarity(list(p), list(q), list(x), list(y)) for p, q, x, y in zip(ta, tb, wa, wb)], columns=["s", "lean"])

    verify = verify.asNondeterministic()  # else the filter on its result is put before the repartition, and it with it
    links = materialize(pairs.select("a", "b", verify("ta", "tb", "wa", "wb").alias("v")).where(F.col("v.s") >= threshold).select("a", "b", "v.s", "v.lean"), "links")
    firm = connected_components(links.where("lean = 0").select(F.col("a").alias("u"), F.col("b").alias("v")))
    comp = parsed.select("id", "n").join(firm.withColumnRenamed("node", "id"), "id", "left").select("id", "n", F.coalesce("component", "id").alias("c"))
    comp = materialize(comp, "firm")
    size = comp.groupBy("c").agg(F.sum("n").alias("size"))
    short = F.when(F.col("lean") < 0, F.col("a")).otherwise(F.col("b"))
    long = F.when(F.col("lean") < 0, F.col("b")).otherwise(F.col("a"))
    loose = links.where("lean != 0").select(short.alias("short"), long.alias("long"), "s")
    loose = loose.join(comp.select(F.col("id").alias("short"), F.col("c").alias("cs")), "short").join(comp.select(F.col("id").alias("long"), F.col("c").alias("cl")), "long").where("cs != cl")
    votes = loose.groupBy("cs", "cl").agg(F.count("*").alias("votes"), F.max("s").alias("s")).join(size.withColumnRenamed("c", "cl"), "cl")
    best = votes.groupBy("cs").agg(F.max_by("cl", F.struct("size", "votes", "s", -F.col("cl"))).alias("cl"))
    merged = connected_components(best.select(F.col("cs").alias("u"), F.col("cl").alias("v")))
    out = comp.join(merged.withColumnRenamed("node", "c"), "c", "left").select("id", F.coalesce("component", "c").alias("e"))
    return out.join(out.groupBy("e").agg(F.min("id").alias("entity")), "e").select("id", "entity")


def narrator_names(books: DataFrame) -> DataFrame:
    """The distinct narrator strings with their index and number of different books."""
    b = books.where("narrator is not null and narrator_index is not null")
    return b.groupBy(F.col("narrator_index").alias("id")).agg(F.min("narrator").alias("name"), F.count_distinct("title_index").alias("n"))
