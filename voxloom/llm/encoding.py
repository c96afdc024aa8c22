"""Problem 10: text decoded with the wrong character encoding.

Best-first search over the texts that one step leads to.  A step writes stretches of the
text as bytes of one encoding and reads them as another (UTF-8 read as a one-byte code
page, one code page read as another), or resolves escapes; stretches are found in place,
so text that is damaged here and there is repaired there.  The cost of a text is the
number of bits its characters take under the document frequencies of all texts, plus
penalties for neighbours that do not go together.  The cheapest text reached is the
repair; a text that no step makes clearly cheaper is left as it is.
"""

from __future__ import annotations

import heapq
import html
import math
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize

# Code pages that UTF-8 is mistaken for, and pairs (shown as, really) of code pages.
AS_UTF8 = ("cp1252", "cp1256", "cp1251", "mac_roman", "cp437", "cp850", "koi8-r", "cp1250", "cp1253", "iso8859-6", "cp866")
SWAPS = (("cp1252", "cp1256"), ("cp1252", "cp1251"), ("cp1252", "koi8-r"), ("cp1252", "iso8859-6"), ("cp1251", "koi8-r"), ("koi8-r", "cp1251"), ("cp1251", "cp1256"), ("cp1251", "cp866"))
REAL_SCRIPT = {"cp1256": "arab", "iso8859-6": "arab", "cp1251": "cyr", "koi8-r": "cyr", "cp866": "cyr"}
#: Gain in bits that a repaired stretch, and a repaired text, must bring.
STRETCH_GAIN, TEXT_GAIN = 4.0, 12.0
#: Wrong decodings on top of each other that are undone, and by how many bits a text on the
#: way may be dearer than the cheapest one so far.
MAX_DEPTH, WORSE = 4, 200.0
#: What a text must hold to be looked into: a character beyond ASCII or an escape.
SUSPECT = r"[^\x00-\x7f]|&[#A-Za-z]|\\u[0-9a-fA-F]{4}|%[0-9a-fA-F]{2}"
LOST = "�"


@lru_cache(maxsize=None)
def byte_of(codec: str) -> dict[str, int]:
    """High characters of a code page; bytes it leaves undefined stand for themselves."""
    table = {}
    for b in range(0x80, 0x100):
        try:
            c = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            c = chr(b)
        table.setdefault(c, b)
    for b in range(0x80, 0xA0):  # C1 controls pass through careless converters
        table.setdefault(chr(b), b)
    return table


@lru_cache(maxsize=None)
def char_of(codec: str) -> dict[int, str]:
    out = {}
    for b in range(0x80, 0x100):
        try:
            out[b] = bytes([b]).decode(codec)
        except UnicodeDecodeError:
            out[b] = chr(b)
    return out


def _class(chars) -> str:
    return "[" + "".join(f"\\U{ord(c):08x}" for c in sorted(chars)) + "]"


@lru_cache(maxsize=None)
def utf8_pattern(codec: str) -> re.Pattern:
    """Runs of UTF-8 sequences as they look in a code page; a lost byte may be the last of one."""
    t = byte_of(codec)
    pick = lambda lo, hi: _class(c for c, b in t.items() if lo <= b <= hi)
    tail, lost = pick(0x80, 0xBF), f"(?:{pick(0x80, 0xBF)}|{LOST})"
    two, three, four = f"{pick(0xC2, 0xDF)}{lost}", f"{pick(0xE0, 0xEF)}{tail}{lost}", f"{pick(0xF0, 0xF4)}{tail}{tail}{lost}"
    return re.compile(f"(?:{two}|{three}|{four})+")


@lru_cache(maxsize=None)
def needed(codec: str) -> tuple[frozenset[str], frozenset[str], frozenset[str]]:
    """Characters of which a text must hold some: leads, tails, letters."""
    t = byte_of(codec)
    return frozenset(c for c, b in t.items() if 0xC2 <= b <= 0xF4), frozenset({LOST, *(c for c, b in t.items() if b <= 0xBF)}), frozenset(c for c in t if c.isalpha())


@lru_cache(maxsize=None)
def swap_pattern(codec: str) -> re.Pattern:
    """Stretches of words made of high characters only, with what stands between them."""
    hi = _class(byte_of(codec))
    word = f"(?<![A-Za-z]){hi}+(?:[.,:;!?()\\-\"'0-9]*{hi}+)*(?![A-Za-z])"
    return re.compile(f"{word}(?:[ \\n0-9.,:;!?()\\-\"'‌]+{word})*")


def _kind(c: str) -> str:
    """Rough class of a character, for what may stand next to what."""
    o = ord(c)
    if c == " " or c == "\n":
        return "_"
    if o < 0x80:
        return "u" if c.isupper() else "l" if c.isalpha() else "d" if c.isdigit() else "."
    if 0x80 <= o < 0xA0:
        return "x"
    if c == LOST:
        return "?"
    cat = unicodedata.category(c)
    if cat[0] == "M" or cat == "Cf" or cat == "Lm":
        return "m"
    if cat[0] == "L":
        if o < 0x250:
            return "U" if cat == "Lu" else "L"
        if 0x370 <= o < 0x400:
            return "g"
        if 0x400 <= o < 0x530:
            return "K" if cat == "Lu" else "k"
        if 0x600 <= o < 0x700 or 0x750 <= o < 0x780:
            return "a"
        return "o"
    return "d" if cat == "Nd" else "." if cat[0] in "PZ" else "s"


SCRIPT = {"u": "latin", "l": "latin", "U": "latin", "L": "latin", "g": "greek", "k": "cyr", "K": "cyr", "a": "arab", "o": "other"}


@lru_cache(maxsize=65536)
def _pair(a: str, b: str) -> float:
    """Penalty in bits for neighbours of these kinds."""
    p = 0.0
    sa, sb = SCRIPT.get(a), SCRIPT.get(b)
    if sa and sb:
        if sa != sb:
            p += 6
        elif a in "UL" and b in "UL":
            p += 3
        if a in "lLk" and b in "uUK":
            p += 4
    elif (sa and b == "s") or (a == "s" and sb):
        p += 2
    return p


#: The classes of ``_kind``, their scripts and penalties as tables.
KINDS = "_uld.xmULgKkaos?"
MARK = KINDS.index("m")
SCRIPT_NAMES = [None, *dict.fromkeys(SCRIPT.values())]
SCRIPTS = np.array([SCRIPT_NAMES.index(SCRIPT.get(k)) for k in KINDS])
PAIRS = np.array([[_pair(a, b) for b in KINDS] for a in KINDS])


class Lookup(dict):
    """A table for ``str.translate`` that is filled as characters come."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, point: int):
        self[point] = out = self.make(point)
        return out


class Plausibility:
    """Bits per character, plus penalties for neighbours.

    A letter is measured among the letters of its script, so that a script that few texts
    are written in is no less plausible than the others; starting another script costs
    ``SWITCH`` bits instead.  Other characters are measured among all.
    """

    SWITCH = 5.0

    def __init__(self, frequency: dict[str, int]):
        total = max(1, sum(frequency.values()))
        of: dict[str, int] = {}
        for c, n in frequency.items():
            if k := SCRIPT.get(_kind(c)):
                of[k] = of.get(k, 0) + n
        self.bits = {c: -math.log2((n + 0.5) / max(100, of.get(SCRIPT.get(_kind(c), ""), total))) for c, n in frequency.items()}
        self.unseen = 22.0
        self.kinds: dict[str, str] = {}
        #: What stretches become, by code page, stretch and surroundings: the same few pairs of
        #: letters come again and again in sound text.
        self.codes, self.costs = np.full(0x110000, 255, "u1"), np.zeros(0x110000)  # filled as characters come
        self.kind_of = Lookup(lambda p: self.kind(chr(p)))
        self.known: dict[tuple, tuple[str, float, bool] | None] = {}

    def char(self, c: str) -> float:
        b = self.bits.get(c)
        if b is None:  # nobody writes unassigned or private characters
            b = self.bits[c] = 60.0 if unicodedata.category(c) in ("Cn", "Co", "Cs") else self.unseen
        return b + 12 if "\x80" <= c < "\xa0" or c == LOST else b

    def kind(self, c: str) -> str:
        k = self.kinds.get(c)
        if k is None:
            k = self.kinds[c] = _kind(c)
        return k

    def long_cost(self, text: str, around: tuple) -> float:
        """The same with arrays."""
        last, script, after, right = around
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        kinds = self.codes[points]
        if (new := kinds == 255).any():
            for p in np.unique(points[new]).tolist():
                self.codes[p], self.costs[p] = KINDS.index(self.kind(chr(p))), self.char(chr(p))
            kinds = self.codes[points]
        total = float(self.costs[points].sum())
        seen = np.r_[KINDS.index(last), kinds[kinds != MARK]]  # marks are looked through
        total += float(PAIRS[seen[:-1], seen[1:]].sum())
        scripts = SCRIPTS[seen[1:]]
        scripts = scripts[scripts > 0]
        if script:
            scripts = np.r_[SCRIPT_NAMES.index(script), scripts]
        total += self.SWITCH * float((scripts[1:] != scripts[:-1]).sum())
        if after:
            total += PAIRS[seen[-1], KINDS.index(after)]
            total += self.SWITCH if len(scripts) and right and SCRIPT_NAMES[scripts[-1]] != right else 0.0
        return total

    def around(self, text: str, start: int, end: int) -> tuple[str, str | None, str, str | None]:
        """What a stretch stands between: kind and script before it, kind and script after it."""
        kind = self.kind
        before = kind(text[start - 1]) if start else "_"
        after = kind(text[end]) if end < len(text) else ""
        left = right = None
        for i in range(start - 1, max(-1, start - 13), -1):
            if left := SCRIPT.get(kind(text[i])):
                break
        for i in range(end, min(len(text), end + 12)):
            if right := SCRIPT.get(kind(text[i])):
                break
        return before, left, after, right

    def cost(self, text: str, around: tuple[str, str | None, str, str | None] = ("_", None, "", None)) -> float:
        """Cost of a stretch between what stands before and after it."""
        return self.long_cost(text, around) if len(text) > 48 else self.short_cost(text, around)

    def short_cost(self, text: str, around: tuple) -> float:
        last, script, after, right = around
        total = 0.0
        for c in text:
            k = self.kind(c)
            total += self.char(c) + _pair(last, k)
            if s := SCRIPT.get(k):
                if script and s != script:
                    total += self.SWITCH
                script = s
            if k != "m":  # marks are looked through
                last = k
        if after:
            total += _pair(last, after)
            total += self.SWITCH if script and right and right != script else 0.0
        return total


def _lost_tail(lead: list[int], model: Plausibility, following: str) -> str:
    """The likeliest character whose last byte was lost: one of those cp1252 has no character for."""
    best = (math.inf, LOST)
    for b in (0x81, 0x8D, 0x8F, 0x90, 0x9D):
        try:
            c = bytes([*lead, b]).decode("utf-8")
        except UnicodeDecodeError:
            continue
        # a mark is likelier where another mark follows
        bonus = 8.0 if following and unicodedata.combining(c) and unicodedata.combining(following) else 0.0
        best = min(best, (model.char(c) - bonus, c))
    return best[1]


def _read_utf8(stretch: str, codec: str, model: Plausibility) -> tuple[str, int] | None:
    table = byte_of(codec)
    out: list[str] = []
    pending: list[tuple[int, list[int]]] = []
    i = 0
    while i < len(stretch):
        b = table[stretch[i]]
        n = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
        seq = stretch[i : i + n]
        if seq[-1] == LOST:
            pending.append((len(out), [table[c] for c in seq[:-1]]))
            out.append(LOST)
        else:
            try:
                out.append(bytes(table[c] for c in seq).decode("utf-8"))
            except UnicodeDecodeError:
                return None
        i += n
    for at, lead in reversed(pending):
        out[at] = _lost_tail(lead, model, out[at + 1] if at + 1 < len(out) else "")
    return "".join(out), len(out)


def _belongs(shown: str, new: str, around: tuple, model: Plausibility) -> bool:
    """Whether the letter that one sequence becomes is of the script of the word it stands
    in, while what was shown is no part of such a word: letters of other scripts, or a
    sign (punctuation may follow a letter in sound text)."""
    script = SCRIPT.get(model.kind(new[0]))
    beside = {SCRIPT.get(around[0]), SCRIPT.get(around[2])} - {None}
    foreign = all(SCRIPT.get(model.kind(c)) != script for c in shown) or unicodedata.category(shown[-1])[0] in "SNC"
    return script is not None and beside == {script} and foreign


def _stretch(s: str, codec: str, around: tuple, model: Plausibility) -> tuple[str, float, bool] | None:
    """What a stretch of UTF-8 becomes, the bits gained, and whether it alone is proof enough."""
    key = (codec, s, around)
    if key in model.known:
        return model.known[key]
    got = _read_utf8(s, codec, model)
    out = None
    if got is not None:
        new, n = got
        gain = model.cost(s, around) - model.cost(new, around)
        # one sequence alone may be chance where its parts are usual characters
        alone = codec in ("cp1252", "cp1251") or codec in ("cp437", "cp850") and model.kind(new[0]) != "a" or _belongs(s, new, around, model)
        out = new, gain, n >= 2 and gain >= 12 or n == 1 and alone and gain >= 8 or len(s) >= 3 and gain >= 12
    if len(model.known) > 500_000:
        model.known.clear()
    model.known[key] = out
    return out


def from_utf8(text: str, codec: str, model: Plausibility):
    """Read UTF-8 that was shown in a code page: the new text and the bits gained, with the
    stretches that gain, and with all stretches if that differs."""
    better, every, sure = [], [], False
    for m in utf8_pattern(codec).finditer(text):
        start, end = m.span()
        got = _stretch(m[0], codec, model.around(text, start, end), model)
        if got is None:
            continue
        new, gain, proof = got
        every.append((start, end, new, gain))
        if gain > STRETCH_GAIN:
            better.append(every[-1])
            sure |= proof
    if sure or len(better) >= 3:
        yield _replaced(text, better)
        if len(every) > len(better):
            yield _replaced(text, every)


@lru_cache(maxsize=None)
def swap_tables(shown: str, real: str) -> tuple[dict, Lookup]:
    """High characters as the other code page has them; and what leaves only high characters."""
    table, chars = byte_of(shown), char_of(real)
    return {ord(c): chars[b] for c, b in table.items()}, Lookup(lambda p: chr(p) if chr(p) in table else None)


def from_swap(text: str, shown: str, real: str, model: Plausibility) -> tuple[str, float]:
    """Read stretches of high characters as another code page."""
    to_real, high_only = swap_tables(shown, real)
    letters = "".join(k for k in KINDS if SCRIPT.get(k) == REAL_SCRIPT[real])
    found = []
    for m in swap_pattern(shown).finditer(text):
        s = m[0]
        high = s.translate(high_only)
        if len(high) < 2:
            continue
        around = model.around(text, m.start(), m.end())
        if len(high) < 4 and {around[1], around[3]} - {None} != {REAL_SCRIPT[real]}:
            continue  # two or three letters are enough only amid text of the script they become
        new = s.translate(to_real)
        # letters became letters of the script that the real code page is for
        was, now = high.translate(model.kind_of), new.translate(model.kind_of)
        if sum(was.count(k) for k in SCRIPT) < 0.5 * len(high) or sum(now.count(k) for k in letters) < 0.6 * len(high):
            continue
        gain = model.cost(s, around) - model.cost(new, around)
        if gain > TEXT_GAIN and gain > 1.5 * len(high):
            found.append((m.start(), m.end(), new, gain))
    return _replaced(text, found)


def _replaced(text: str, found: list[tuple[int, int, str, float]]) -> tuple[str, float]:
    if not found:
        return text, 0.0
    out, at = [], 0
    for start, end, new, _ in found:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), sum(f[3] for f in found)


_ESCAPES = re.compile(r"(?:\\u[0-9a-fA-F]{4})+|(?:%[0-9a-fA-F]{2}){2,}|&amp;(?=#?[0-9A-Za-z]{2,8};)|(?:&(?:#\d{2,7}|#[xX][0-9a-fA-F]{2,6}|[A-Za-z]{2,8});)+")

_NAME = re.compile("[#0-9A-Za-z]+;?")


def from_escapes(text: str, model: Plausibility) -> tuple[str, float]:
    """Resolve escapes that write letters as codes, or the mark of such an escape as one."""
    found = []
    for m in _ESCAPES.finditer(text):
        s = m[0]
        if s[0] == "%":
            try:
                new = bytes.fromhex(s.replace("%", "")).decode("utf-8")
            except UnicodeDecodeError:
                continue
        elif s[0] == "\\":
            new = s.encode().decode("unicode_escape").encode("utf-16", "surrogatepass").decode("utf-16", "replace")
        else:
            new = html.unescape(s)
        # the mark of an escape is resolved where what follows is one of a letter
        letter = html.unescape("&" + _NAME.match(text, m.end())[0]) if s == "&amp;" else new
        if new != s and all(ord(c) >= 0x80 for c in letter):
            found.append((m.start(), m.end(), new, model.cost(s) - model.cost(new)))
    return _replaced(text, [f for f in found if f[3] > STRETCH_GAIN])


def _moves(text: str, model: Plausibility):
    """Every text one step away, with the bits it gains."""
    if "&" in text or "\\u" in text or "%" in text:
        yield "unescape", *from_escapes(text, model)
    has = frozenset(text)
    for codec in AS_UTF8:
        leads, tails, _ = needed(codec)
        if not has.isdisjoint(leads) and not has.isdisjoint(tails):
            for new, gain in from_utf8(text, codec, model):
                yield f"{codec}>utf-8", new, gain
    for shown, real in SWAPS:
        if len(has & needed(shown)[2]) >= 2:
            yield f"{shown}>{real}", *from_swap(text, shown, real, model)


def repair(text: str, model: Plausibility, depth: int = MAX_DEPTH, worse: float = WORSE) -> tuple[str, list[str], float]:
    """The cheapest text that at most ``depth`` steps reach, the steps to it and the bits
    gained; no step if none gains enough.

    Texts are looked into cheapest first, and one reached twice only once, unless by fewer
    steps.  The search ends when all that is left costs over ``worse`` bits more than the
    cheapest text so far: a way out may lead through dearer texts, but not through dearer
    ones than that.  With ``worse`` infinite the queue is run until it is empty.
    """
    if text.isascii() and not _ESCAPES.search(text):
        return text, [], 0.0
    moves = list(_moves(text, model))
    if all(new == text for _, new, _ in moves):
        return text, [], 0.0
    start = model.cost(text)
    best = (start, text, [])
    queue: list[tuple[float, int, str, list[str]]] = []
    seen, pushed = {hash(text): 0}, 0

    def push(moves, path) -> int:
        at = pushed
        for name, new, _ in moves:
            if seen.get(hash(new), depth + 1) > len(path) + 1:
                seen[hash(new)] = len(path) + 1
                at += 1
                heapq.heappush(queue, (model.cost(new), at, new, [*path, name]))
        return at

    pushed = push(moves, [])
    while queue and queue[0][0] <= best[0] + worse:
        cost, _, here, path = heapq.heappop(queue)
        if (cost, len(path)) < (best[0], len(best[2])):
            best = (cost, here, path)
        if len(path) < depth:
            pushed = push(_moves(here, model), path)
    cost, new, path = best
    if not path or start - cost < (8.0 if path[0].endswith("utf-8") else TEXT_GAIN):
        return text, [], 0.0
    return new, path, start - cost


def character_frequencies(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Number of texts each character occurs in, over all texts.  The result is bounded by
    Unicode's size, so it may go to the driver and to every task."""

    def count(batches):
        from collections import Counter

        total: Counter = Counter()
        for pdf in batches:
            for t in pdf[text]:
                total.update(set(t))
        yield pd.DataFrame({"c": list(total), "n": list(total.values())}, columns=["c", "n"]).astype({"n": "int64"})

    rows = docs.select(text).where(f"{text} is not null").mapInPandas(count, "c string, n long").groupBy("c").agg(F.sum("n").alias("n"))
    return {r["c"]: r["n"] for r in rows.toLocalIterator()}


def repaired_texts(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """``identifier, repaired, steps, gain`` of the texts that were decoded wrongly.

    Whole texts are searched, however long.  Null and empty texts are never among them;
    equal texts get equal repairs.  A text without any non-ASCII character or escape
    cannot be wrong and never reaches the search.
    """
    frequencies = docs.sparkSession.sparkContext.broadcast(character_frequencies(docs, text))
    some = docs.select(identifier, text).where(F.col(text).rlike(SUSPECT))
    kind = docs.schema[identifier].dataType.simpleString()

    def fix(batches):
        m = Plausibility(frequencies.value)  # once per task
        for pdf in batches:
            out = [(i, *got) for i, t in zip(pdf.iloc[:, 0], pdf.iloc[:, 1]) if (got := repair(t, m))[1]]
            yield pd.DataFrame(out, columns=["i", "repaired", "steps", "gain"])

    out = some.mapInPandas(fix, f"i {kind}, repaired string, steps array<string>, gain double")
    return materialize(out.select(F.col("i").alias(identifier), "repaired", "steps", "gain"), "repaired")
