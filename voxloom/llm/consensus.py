"""Problem 4: consensus of several raters by regularised minimax conditional entropy.

A rater i puts an item j of true class c into class k with probability proportional to
``exp(sigma_i[c, k] + tau_j[c, k])``: tilting parameters of rater and item, the multipliers
of the minimax problem, held back by a quadratic penalty.  The penalised dual

    sum over labels of E_q log P(label | c)  +  entropy of q  -  penalties

is ascended one block at a time, the others fixed: the label posteriors q by their closed
form, the items' parameters, the raters' parameters.  A parameter step divides the gradient
by a bound of the curvature (a softmax curves by at most a half) and goes ``RELAX`` times as
far, which below twice as far cannot lower the dual; rounds end when it rises by less than a
tolerance.

An item whose labels fill one chunk is a row with its labels and its parameters, which are
updated in place; the labels of an item that more rated lie in several chunks, so it is
never in one row, and its sums are aggregated.  Of the others only sums per rater are
shuffled, formed per task first.  The raters' parameters go to all tasks while they are few,
else they are joined in.
Agreement is measured apart from the model.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize, release

K = 5  # classes 1 to 5; half steps go to the class above
KK = K * K
#: Over-relaxation of the parameter steps, below 2.
RELAX = 1.8


def score_value(text: Column) -> Column:
    """A number from 1 to 5, however its digits are written; anything else is null."""
    plain = F.translate(F.trim(text), "۰۱۲۳۴۵۶۷۸۹٠١٢٣٤٥٦٧٨٩０１２３４５６７８９٫，,．", "012345678901234567890123456789....")
    value = plain.try_cast("double")
    return F.when((value >= 1) & (value <= 5), value)


def session_labels(sessions: DataFrame) -> DataFrame:
    """``user_id, audio_index, question, score`` of each rater's latest readable snapshot.

    A snapshot is readable if its JSON is a map with any entry.  Among snapshots of the
    same time the one with more entries counts.  Null, wrong and out-of-range scores, and
    keys that are not ``<number>_<question>``, are left out.
    """
    read = sessions.where("user_id is not null").select("user_id", "saved_at", F.from_json("scores", "map<string,string>").alias("m")).where("size(m) > 0")
    key = F.struct("saved_at", F.size("m").alias("n"), F.array_sort(F.map_entries("m")).alias("e"))
    last = read.groupBy("user_id").agg(F.max(key).alias("r")).select("user_id", F.explode("r.e").alias("e"))
    out = last.select("user_id", F.regexp_extract("e.key", r"^(\d+)_(.+)$", 1).alias("a"), F.regexp_extract("e.key", r"^(\d+)_(.+)$", 2).alias("question"), score_value(F.col("e.value")).alias("score"))
    return out.where("a != '' and score is not null").select("user_id", F.col("a").cast("int").alias("audio_index"), "question", "score")


def _stack(col: pd.Series, width: int) -> np.ndarray:
    return np.vstack(col.to_numpy()) if len(col) else np.zeros((0, width))


def _log_probabilities(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    z = (s + t).reshape(-1, K, K)
    z = z - z.max(axis=2, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=2, keepdims=True))


def _unrolled(pdf: pd.DataFrame, table: tuple[np.ndarray, np.ndarray] | None):
    """Of chunks: the row of each label, its rater, its class, its rater's parameters, and
    log-probabilities (label, class, response)."""
    n = np.array([len(r) for r in pdf["raters"]])
    row = np.repeat(np.arange(len(pdf)), n)
    rater, x = np.concatenate(pdf["raters"].to_numpy()), np.concatenate(pdf["ks"].to_numpy()).astype(int)
    if table is None:
        s = np.concatenate(pdf["sigma"].to_numpy()).reshape(-1, KK)
    else:
        s = table[1][np.searchsorted(table[0], rater)]
    return row, n, rater, x, _log_probabilities(s, _stack(pdf["t"], KK)[row])


class Fit:
    """Block ascent over ``labels`` (``rater, item, k``), each rater and item once."""

    def __init__(self, labels: DataFrame, rater_penalty: float = 1.0, item_penalty: float = 4.0, chunk: int = 512, few_raters: int = 200_000):
        self.rater_penalty, self.item_penalty, self.few = rater_penalty, item_penalty, few_raters
        self.dual: list[float] = []
        zero = F.array(*[F.lit(0.0)] * KK)
        # start: the labels' frequencies, smoothed; raters are believed a little
        count = [F.count_if(F.col("k") == c).cast("double").alias(f"n{c}") for c in range(K)]
        near = [sum((F.lit(w) * F.col(f"n{o}") for o in range(K) if (w := (1.0, 0.35, 0.1, 0.02, 0.01)[abs(o - c)])), F.lit(0.0)) for c in range(K)]
        total = sum(near[1:], near[0])
        items = materialize(labels.groupBy("item").agg(*count, F.count("*").alias("n")).select("item", "n", F.array(*[n / total for n in near]).alias("q"), zero.alias("t")), "items")
        parts = items.select("item", F.ceil(F.col("n") / chunk).alias("_p"))
        cut = labels.join(parts, "item").withColumn("chunk", F.pmod(F.xxhash64("rater"), F.col("_p")))
        cut = cut.groupBy("item", "chunk").agg(F.collect_list(F.struct("rater", "k")).alias("_l"))  # about `chunk` labels a row
        cut = materialize(cut.select("item", "chunk", F.col("_l.rater").alias("raters"), F.col("_l.k").alias("ks")), "chunks")
        #: Items of one chunk, with their labels; chunks of the others, and their parameters.
        self.solo = materialize(cut.join(items.where(F.col("n") <= chunk), "item"), "solo")
        self.shared = items.where(F.col("n") > chunk)
        self.chunks = cut if not self.shared.isEmpty() else None
        trust = F.array(*[F.lit(float(-0.5 * abs(c - k))) for c in range(K) for k in range(K)])
        self.raters = materialize(labels.groupBy("rater").agg(F.count("*").alias("n_labels")).select("rater", "n_labels", trust.alias("s")), "raters")
        self.n_labels, self.n_raters = items.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], self.raters.count()
        self._spread()

    def _spread(self) -> None:
        """The raters' parameters for all tasks, if they are at most ``few`` rows of 200 bytes."""
        self.table = None
        if self.n_raters <= self.few:
            r = self.raters.select("rater", "s").toPandas().sort_values("rater")
            self.table = self.raters.sparkSession.sparkContext.broadcast((r["rater"].to_numpy("int64"), _stack(r["s"], KK)))

    @property
    def items(self) -> DataFrame:
        """``item, n, q, t`` of all items."""
        solo = self.solo.select("item", "n", "q", "t")
        return solo if self.chunks is None else solo.unionByName(self.shared.select("item", "n", "q", "t"))

    def rows(self, solo: bool = True, shared: bool = True) -> DataFrame:
        """Chunks with the parameters of their item."""
        mine = self._with_raters(self.solo) if solo else None
        if not shared or self.chunks is None:
            return mine
        rest = self._with_raters(self.chunks.join(self.shared, "item"))
        return rest if mine is None else mine.unionByName(rest)

    def _with_raters(self, d: DataFrame) -> DataFrame:
        """Chunks with the parameters of their raters too, where these are many."""
        if self.table is not None:
            return d
        each = d.select("item", "chunk", F.explode(F.arrays_zip("raters", "ks")).alias("_e")).select("item", "chunk", F.col("_e.raters").alias("rater"), F.col("_e.ks").alias("k"))
        each = each.join(self.raters.select("rater", "s"), "rater").groupBy("item", "chunk").agg(F.collect_list(F.struct("rater", "k", "s")).alias("_l"))
        return each.join(d.drop("raters", "ks"), ["item", "chunk"]).select("item", "chunk", "n", "q", "t", F.col("_l.rater").alias("raters"), F.col("_l.k").alias("ks"), F.flatten("_l.s").alias("sigma"))

    def item_step(self) -> None:
        """Posteriors of the items by their closed form, then their parameters."""
        table, p = self.table, self.item_penalty

        def sums_of(pdf):
            row, n, _, x, lp = _unrolled(pdf, table.value if table is not None else None)
            at = np.arange(len(x))
            g = -np.exp(lp)
            g[at, :, x] += 1
            return np.add.reduceat(np.hstack([g.reshape(-1, KK), lp[at, :, x]]), np.r_[0, np.cumsum(n)[:-1]], axis=0)

        def update(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                total, t, n = sums_of(pdf), _stack(pdf["t"], KK), pdf["n"].to_numpy("f8")
                q = np.exp(total[:, KK:] - total[:, KK:].max(axis=1, keepdims=True))
                q /= q.sum(axis=1, keepdims=True)
                w = np.repeat(q, K, axis=1)
                t = t + RELAX * (w * total[:, :KK] - p * t) / (0.5 * n[:, None] * w + p)
                yield pdf[["item", "chunk", "raters", "ks", "n"]].assign(q=list(q), t=list(t))

        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.solo.select("item", "chunk", "raters", "ks", "n").schema)
        new = materialize(self.rows(shared=False).mapInPandas(update, f"{kinds}, q array<double>, t array<double>"), "solo")
        release(self.solo)
        self.solo = new
        if self.chunks is None:
            return

        def sums(batches):
            for pdf in batches:
                if len(pdf):
                    out = pd.DataFrame(sums_of(pdf), columns=[f"v{i}" for i in range(KK + K)])
                    out.insert(0, "item", pdf["item"].to_numpy())
                    yield out

        cols = [f"v{i}" for i in range(KK + K)]
        got = self.rows(solo=False).mapInPandas(sums, "item long, " + ", ".join(f"{c} double" for c in cols)).groupBy("item").agg(*[F.sum(c).alias(c) for c in cols])
        d = got.join(self.shared, "item")
        lls = [F.col(f"v{KK + c}") for c in range(K)]
        d = d.withColumn("_m", F.greatest(*lls)).withColumn("_e", F.array(*[F.exp(x - F.col("_m")) for x in lls]))
        d = d.withColumn("_z", F.aggregate("_e", F.lit(0.0), lambda a, x: a + x)).withColumn("q", F.transform("_e", lambda x: x / F.col("_z")))
        at = lambda a, i: F.element_at(a, i + 1)
        step = [at("t", i) + RELAX * (at("q", i // K) * F.col(f"v{i}") - p * at("t", i)) / (0.5 * F.col("n") * at("q", i // K) + p) for i in range(KK)]
        self.shared = materialize(d.select("item", "n", "q", F.array(*step).alias("t")), "items")

    def rater_step(self) -> float:
        """Parameters of the raters; the value of the dual before the step."""
        table = self.table

        def sums(batches):
            for pdf in batches:
                if not len(pdf):
                    continue
                row, _, rater, x, lp = _unrolled(pdf, table.value if table is not None else None)
                q, at = _stack(pdf["q"], K)[row], np.arange(len(x))
                g = -np.exp(lp)
                g[at, :, x] += 1
                g *= q[:, :, None]
                value = (q * lp[at, :, x]).sum(axis=1, keepdims=True)
                ids, place = np.unique(rater, return_inverse=True)
                total = np.zeros((len(ids), KK + K + 1))
                np.add.at(total, place, np.hstack([g.reshape(-1, KK), q, value]))
                out = pd.DataFrame(total, columns=[f"v{i}" for i in range(KK + K + 1)])
                out.insert(0, "rater", ids)
                yield out

        cols = [f"v{i}" for i in range(KK + K + 1)]
        got = self.rows().mapInPandas(sums, "rater long, " + ", ".join(f"{c} double" for c in cols)).groupBy("rater").agg(*[F.sum(c).alias(c) for c in cols])
        p, at = self.rater_penalty, lambda a, i: F.element_at(a, i + 1)
        step = [at("s", i) + RELAX * (F.col(f"v{i}") - p * at("s", i)) / (0.5 * F.col(f"v{KK + i // K}") + p) for i in range(KK)]
        square = lambda a: F.aggregate(a, F.lit(0.0), lambda z, x: z + x * x)
        new = got.join(self.raters, "rater").select("rater", "n_labels", F.array(*step).alias("s"), F.col(f"v{KK + K}").alias("_value"), square("s").alias("_old"))
        new = materialize(new, "raters")
        r = new.agg(F.sum("_value"), F.sum("_old")).first()
        entropy = -F.aggregate("q", F.lit(0.0), lambda z, x: z + F.when(x > 0, x * F.log(x)).otherwise(0.0))
        i = self.items.agg(F.sum(entropy), F.sum(square("t"))).first()
        self.dual.append(sum(x or 0.0 for x in (r[0], i[0])) - 0.5 * (p * (r[1] or 0.0) + self.item_penalty * (i[1] or 0.0)))
        release(self.raters)
        self.raters = new.select("rater", "n_labels", "s")
        self._spread()
        return self.dual[-1]

    def ascend(self, tolerance: float = 1e-3, most: int = 100) -> "Fit":
        """Rounds until the dual rises by less than ``tolerance`` per label, then posteriors
        once more; an error if it has not settled after ``most`` rounds."""
        if not self.n_labels:
            return self
        last = -np.inf
        for _ in range(most):
            self.item_step()
            now = self.rater_step()
            if now - last < tolerance * self.n_labels:
                self.item_step()
                return self
            last = now
        raise RuntimeError(f"the dual did not settle in {most} rounds")


def rater_reliability(raters: DataFrame, classes: Column) -> DataFrame:
    """``rater, reliability``: the correlation of true class and response that a rater's own
    tilting parameters stand for, on an ordinary item and with the classes as frequent as in
    ``classes`` (an array).  1: always right; about 0: says nothing; below 0: says the reverse."""

    @F.pandas_udf("double")
    def reliability(s: pd.Series, prior: pd.Series) -> pd.Series:
        if not len(s):
            return pd.Series([], dtype="float64")
        p = np.exp(_log_probabilities(_stack(s, KK), np.zeros(KK))) * _stack(prior, K)[:, :, None]
        v = np.arange(1, K + 1)
        c, k = p.sum(axis=2) @ v, p.sum(axis=1) @ v
        cov = np.einsum("nck,c,k->n", p, v, v) - c * k
        vc, vk = p.sum(axis=2) @ v**2 - c**2, p.sum(axis=1) @ v**2 - k**2
        return pd.Series(np.where((vc > 1e-12) & (vk > 1e-12), cov / np.sqrt(np.maximum(vc * vk, 1e-300)), 0.0))

    return raters.select("rater", reliability("s", classes).alias("reliability"))


def consensus(labels: DataFrame, tolerance: float = 1e-3) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Consensus per item, reliability per rater, agreement per question.

    ``labels``: ``user_id, audio_index, question, score``, a rater and item once.  An item
    with one label gets the class that label speaks for, but does not count towards the
    figures beside the reliability: correlation with, bias from and distance to the score
    expected from all other labels of the item (leaving the rater's own out).
    """
    base = labels.select("user_id", "audio_index", "question", "score", F.xxhash64("audio_index", "question").alias("item"))
    base = materialize(base, "labels")
    coded = base.select(F.col("user_id").alias("rater"), "item", (F.least(F.lit(K), F.floor(F.col("score") + 0.5)) - 1).cast("int").alias("k"))
    fit = Fit(coded).ascend(tolerance)
    per = base.groupBy("item", "audio_index", "question").agg(F.count("*").alias("n_labels"), F.avg("score").alias("mean_score"))
    best = F.array_position("q", F.array_max("q")).cast("int")
    expected = sum((F.element_at("q", c + 1) * (c + 1) for c in range(1, K)), F.element_at("q", 1))
    cons = fit.items.join(per, "item").select("audio_index", "question", "n_labels", best.alias("consensus"), F.round(expected, 4).alias("consensus_score"), F.round(F.array_max("q"), 4).alias("certainty"), "mean_score")
    table = fit.table

    def against(batches):
        """Sums over each rater's labels beside the score that the item's other labels expect."""
        v = np.arange(1, K + 1)
        for pdf in batches:
            if not len(pdf):
                continue
            row, _, rater, x, lp = _unrolled(pdf, table.value if table is not None else None)
            lq = np.log(np.maximum(_stack(pdf["q"], K), 1e-300))[row] - lp[np.arange(len(x)), :, x]
            q = np.exp(lq - lq.max(axis=1, keepdims=True))
            e, y = (q / q.sum(axis=1, keepdims=True)) @ v, x + 1.0
            use = (pdf["n"].to_numpy()[row] > 1).astype("f8")
            yield pd.DataFrame({"rater": rater, "w": use, "x": use * y, "e": use * e, "xx": use * y * y, "ee": use * e * e, "xe": use * y * e}).groupby("rater", as_index=False).sum()

    sums = fit.rows().mapInPandas(against, "rater long, w double, x double, e double, xx double, ee double, xe double").groupBy("rater").agg(*[F.sum(c).alias(c) for c in ("w", "x", "e", "xx", "ee", "xe")])
    mean = lambda c: F.col(c) / F.nullif("w", F.lit(0.0))
    cov, vx, ve = mean("xe") - mean("x") * mean("e"), mean("xx") - mean("x") * mean("x"), mean("ee") - mean("e") * mean("e")
    corr = F.coalesce(F.when((vx > 1e-9) & (ve > 1e-9), cov / F.sqrt(vx * ve)), F.lit(0.0))
    spread = F.sqrt(F.greatest(F.lit(0.0), mean("xx") - 2 * mean("xe") + mean("ee")))
    sums = sums.select("rater", corr.alias("correlation"), (mean("x") - mean("e")).alias("bias"), spread.alias("error"))
    prior = F.array(*[F.lit(float(x)) for x in _prior(fit.items)])
    own = rater_reliability(fit.raters, prior)
    rel = fit.raters.select("rater", F.col("n_labels").alias("n_scores")).join(own, "rater").join(sums, "rater", "left").withColumnRenamed("rater", "user_id")
    return cons, rel, agreement(base)


def _prior(items: DataFrame) -> list[float]:
    """Share of each class over the items, a little smoothed."""
    got = items.agg(*[F.coalesce(F.sum(F.element_at("q", c + 1)), F.lit(0.0)) for c in range(K)]).first()
    n = sum(got)
    return [(g + 0.5) / (n + 0.5 * K) for g in got]


def agreement(labels: DataFrame) -> DataFrame:
    """Krippendorff's alpha (interval) per question, over items with several scores."""
    item = labels.groupBy("question", "audio_index").agg(F.count("*").alias("n"), F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("ss")).where("n > 1")
    # sum of squared differences of all ordered pairs, from sums alone
    within = F.sum(2 * (F.col("n") * F.col("ss") - F.col("s") * F.col("s")) / (F.col("n") - 1))
    q = item.groupBy("question").agg(F.count("*").alias("n_items"), F.sum("n").alias("n"), within.alias("within"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    between = 2 * (F.col("n") * F.col("ss") - F.col("s") * F.col("s")) / (F.col("n") * (F.col("n") - 1))
    alpha = F.when(between > 0, 1 - (F.col("within") / F.col("n")) / between)
    return q.select("question", "n_items", F.col("n").alias("n_scores"), F.round(alpha, 6).alias("alpha"))
