"""Problem 6: the k most similar vectors of every vector, by vantage-point trees per shard.

Every shard is a vantage-point tree.  A vector is searched in its own shard first; its
k-th distance then says which cells can hold anything closer, and it visits their shards.
A subtree or cell is left out when the triangle inequality puts it farther away than
``slack`` times the k-th distance: slack 1 is exact, less is faster and may lose some.
Outliers are compared with directly, a bounded block at a time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.vectors import Layout, distance, lay_out, outlier_blocks, rows_at_once, unpack
from voxloom.session import materialize

LEAF = 192
#: Vectors compared with at once, and pairs kept before those that others have overtaken go.
PIECE, PAIRS = 2048, 500_000
ROWS = "id long, neighbour long, cos double"


class Best:
    """The k best cosines of each query so far, and every pair that may be among them."""

    def __init__(self, ids: np.ndarray, k: int, least: float):
        self.ids, self.k = ids, k
        self.top = np.full((len(ids), k), least - 1e-12)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.pairs = 0

    def add_all(self, at: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, rare: bool = False) -> None:
        """``add`` a bounded block at a time.  Where hits are ``rare``, 32-bit products tell
        first, with a margin above their error, which queries can have one."""
        step, margin = rows_at_once(4 * PIECE), 1.2e-7 * (x.shape[1] + 8)
        for i in range(0, len(ids), PIECE):
            n, y = ids[i : i + PIECE], x[i : i + PIECE]
            y4 = y.astype("f4").T if rare else None
            for j in range(0, len(at), step):
                a, p = at[j : j + step], q[j : j + step]
                if rare:
                    some = (p.astype("f4") @ y4).max(axis=1) >= self.top[a, -1] - margin
                    a, p = a[some], p[some]
                if len(a):
                    self.add(a, p, n, y)

    def add(self, at: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        cos = q @ x.T
        cos[self.ids[at][:, None] == ids[None, :]] = -3.0
        hit = cos >= self.top[at, -1][:, None] - 1e-12
        some = hit.any(axis=1)
        if not some.any():
            return
        i, j = np.nonzero(hit)
        self.found.append((at[i], ids[j], cos[i, j]))
        rows = at[some]
        both = np.hstack([self.top[rows], cos[some]])
        self.top[rows] = -np.sort(np.partition(-both, self.k - 1, axis=1)[:, : self.k], axis=1)
        self.pairs += len(i)
        if self.pairs > PAIRS + self.k * len(self.ids):
            self.found = [self._best()]
            self.pairs = len(self.found[0][0])

    def reach(self, at: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, 2 - 2 * self.top[at, -1])) + 1e-7

    def _best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of what was found for each query: its place, the neighbour, the cosine."""
        q, n, c = (np.concatenate(x) for x in zip(*self.found))
        keep = c >= self.top[q, -1] - 1e-12
        q, n, c = q[keep], n[keep], np.round(c[keep], 12)  # equal vectors give equal cosines however they were multiplied
        order = np.lexsort((n, -c, q))
        q, n, c = q[order], n[order], c[order]
        new = np.r_[True, q[1:] != q[:-1]]
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(new, np.arange(len(q)), 0))
        keep = rank < self.k
        return q[keep], n[keep], c[keep]

    def rows(self) -> pd.DataFrame:
        if not self.found:
            return pd.DataFrame({"id": np.zeros(0, "int64"), "neighbour": np.zeros(0, "int64"), "cos": np.zeros(0)})
        q, n, c = self._best()
        return pd.DataFrame({"id": self.ids[q], "neighbour": n, "cos": c})


class Tree:
    """Vantage-point tree over the vectors of a shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[order], x[order]
        self.root = self._build(np.arange(len(ids)))

    def _build(self, at: np.ndarray):
        if len(at) <= LEAF:
            return at
        vp = at[len(at) // 2]
        d = np.sqrt(np.maximum(0, 2 - 2 * self.x[at] @ self.x[vp]))
        # the widest gap near the middle separates groups better than the median does
        s = np.sort(d)
        lo, hi = len(s) // 4, max(len(s) // 4 + 2, 3 * len(s) // 4)
        cut = lo + int(np.argmax(np.diff(s[lo:hi])))
        inside = d <= (s[cut] + s[cut + 1]) / 2
        if inside.all() or not inside.any():
            return at  # all alike: one leaf, however large
        return vp, float(d[inside].max()), float(d[~inside].min()), self._build(at[inside]), self._build(at[~inside])

    def search(self, best: Best, q: np.ndarray, slack: float) -> None:
        self._visit(self.root, np.arange(len(q)), best, q, slack)

    def _visit(self, node, at: np.ndarray, best: Best, q: np.ndarray, slack: float) -> None:
        if not len(at):
            return
        if isinstance(node, np.ndarray):
            best.add_all(at, q[at], self.ids[node], self.x[node])
            return
        vp, inner, outer, a, b = node
        d = np.sqrt(np.maximum(0, 2 - 2 * q[at] @ self.x[vp]))
        near = d <= (inner + outer) / 2
        self._visit(a, at[near], best, q, slack)
        self._visit(b, at[~near], best, q, slack)
        reach = best.reach(at) * slack
        self._visit(a, at[~near & (d - inner <= reach)], best, q, slack)
        self._visit(b, at[near & (outer - d <= reach)], best, q, slack)


def most_similar(v: DataFrame, dim: int, k: int = 5, least: float = -1.0, slack: float = 1.0, queries: str = "true", reach: float = 0.75, layout: Layout | None = None) -> DataFrame:
    """``id, neighbour, cos``: for each query the k most similar other vectors.

    ``v`` has unique ``id`` and packed ``v`` (see ``valid_vectors``); ``queries`` is a
    condition on id; only neighbours with a cosine of ``least`` or more count.  Equal
    cosines (to 12 digits) go to the smaller id.  Exact for slack 1.
    """
    lay = layout or lay_out(v, dim, reach)
    cells, sc = lay.cells, v.sparkSession.sparkContext
    placed = materialize(lay.placed.withColumn("q", F.expr(queries)), "placed")

    def own(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = unpack(pdf["v"], dim), pdf["id"].to_numpy("int64")
        asked = np.flatnonzero(pdf["q"].to_numpy(bool))
        best = Best(ids[asked], k, least)
        Tree(ids, x).search(best, x[asked], slack)
        rows = best.rows()
        ask = pd.DataFrame({"id": ids[asked], "cos": best.top[:, -1], "v": pdf["v"].to_numpy()[asked], "shard": pdf["shard"].to_numpy()[asked]})
        rows["v"], rows["shard"] = None, -1
        ask["neighbour"] = -1
        return pd.concat([rows, ask], ignore_index=True)[["id", "neighbour", "cos", "v", "shard"]]

    both = materialize(placed.groupBy("shard").applyInPandas(own, f"{ROWS}, v binary, shard int"), "own")
    found = [both.where("neighbour >= 0").select("id", "neighbour", "cos")]
    asks = both.where("neighbour < 0").select("id", "v", "shard", "cos")
    lonely = lay.outliers.where(queries).select("id", "v", F.lit(-1).alias("shard"), F.lit(float(least)).alias("cos"))
    asks = asks.unionByName(lonely)
    # the vectors that lie alone, for all queries
    for alone, x in outlier_blocks(lay.outliers.select("id", "v"), lay.n_outliers, dim):
        block = sc.broadcast((alone["id"].to_numpy("int64"), x))

        def direct(batches, block=block):
            for pdf in batches:
                best = Best(pdf["id"].to_numpy("int64"), k, least)
                best.top[:] = np.maximum(least, pdf["cos"].to_numpy())[:, None] - 1e-12
                q, at = unpack(pdf["v"], dim), np.arange(len(pdf))
                if len(pdf):
                    best.add_all(at, q, *block.value, rare=True)
                yield best.rows()

        found.append(materialize(asks.mapInPandas(direct, ROWS), "alone"))
        block.destroy()
    if cells.shards:
        shared = sc.broadcast((cells.pivots.astype("f4"), cells.radius, cells.first_shard, cells.parts))

        def route(batches):
            pivots, radius, first, parts = shared.value
            step = rows_at_once(len(pivots))
            for pdf in batches:
                for i in range(0, len(pdf), step):
                    part = pdf.iloc[i : i + step]
                    d = np.sqrt(np.maximum(0, 2 - 2 * (unpack(part["v"], dim).astype("f4") @ pivots.T)))
                    limit = np.sqrt(np.maximum(0, 2 - 2 * part["cos"].to_numpy()))
                    a, c = np.nonzero(d - radius[None, :] <= limit[:, None] * slack + 1e-3)
                    times = parts[c]
                    a, s = np.repeat(a, times), np.repeat(first[c], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    pair = np.unique(np.stack([a, s], axis=1), axis=0)
                    pair = pair[pair[:, 1] != part["shard"].to_numpy()[pair[:, 0]]]
                    sel = part.iloc[pair[:, 0]]
                    yield pd.DataFrame({"id": sel["id"].to_numpy(), "v": sel["v"].to_numpy(), "cos": sel["cos"].to_numpy(), "shard": pair[:, 1].astype("int32")})

        visits = asks.mapInPandas(route, "id long, v binary, cos double, shard int")

        def call(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if not len(left) or not len(right):
                return pd.DataFrame({"id": [], "neighbour": [], "cos": []}).astype({"id": "int64", "neighbour": "int64"})
            best = Best(right["id"].to_numpy("int64"), k, least)
            best.top[:] = np.maximum(least, right["cos"].to_numpy())[:, None] - 1e-12
            Tree(left["id"].to_numpy("int64"), unpack(left["v"], dim)).search(best, unpack(right["v"], dim), slack)
            return best.rows()

        # visitors come in lots: about 4096 of them meet a shard in one task
        crowd = materialize(visits, "visits")
        many = materialize(crowd.groupBy("shard").agg(F.ceil(F.count("*") / 4096).cast("int").alias("lots")), "lots")
        crowd = crowd.join(many, "shard").withColumn("lot", F.pmod(F.xxhash64("id", F.lit(3)), F.col("lots")).cast("int")).drop("lots")
        hosts = placed.select("id", "v", "shard").join(many, "shard").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
        found.append(hosts.groupBy("shard", "lot").cogroup(crowd.groupBy("shard", "lot")).applyInPandas(call, ROWS))
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cos"), "neighbour"))
    return rows.where(F.col("cos") >= least).distinct().withColumn("_r", rank).where(F.col("_r") <= k).drop("_r")


def similar_pairs(v: DataFrame, dim: int, k: int, least: float) -> DataFrame:
    """``id_a < id_b`` where one is among the k most similar of the other; exact."""
    n = most_similar(v, dim, k, least, 1.0)
    return n.select(F.least("id", "neighbour").alias("id_a"), F.greatest("id", "neighbour").alias("id_b")).distinct()
