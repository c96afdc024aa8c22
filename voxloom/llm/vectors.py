"""Vectors laid out for neighbour search: valid rows, pivots, cells, shards.

Pivots are a bounded sample of the vectors.  A cell holds the vectors that have one pivot
nearest and within ``reach``; vectors far from every pivot get further sets of pivots from
among themselves, level by level, until they are few or pivots reach little but themselves;
what is far from all of them are outliers.  Neighbouring cells are
packed into shards of bounded size, an overfull cell is cut into several shards by a hash.
Distances are Euclidean between unit vectors: d = sqrt(2 - 2 cos), so the triangle
inequality holds.  Raw 32-bit values are kept and normalised in 64 bits where they are used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import materialize, release, release_part

#: Bounds of the samples that pivots are taken from, per level: the first two, those after them.
MAX_PIVOTS, MORE_PIVOTS = 2048, 8192
#: In a table of very many vectors the later samples hold one in so many, so that levels stay few.
PER_SAMPLE = 256
#: Outliers are sent to all tasks in blocks of at most so many vectors.
OUTLIER_BLOCK = 20_000
#: Numbers in one product of vectors, so that a task's memory does not grow with the cells.
PRODUCT = 4_000_000
#: Tables of narrow rows are broadcast up to so many.
BROADCAST = 500_000


def rows_at_once(others: int, most: int = 2000) -> int:
    """Rows that one product with so many other vectors may take."""
    return max(1, min(most, PRODUCT // max(1, others)))


def small(d: DataFrame, most: int = BROADCAST) -> DataFrame:
    """A table of narrow rows, to be broadcast if it has at most so many."""
    return F.broadcast(d) if d.limit(most + 1).count() <= most else d


def distance(cos: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * cos)))


def unpack(col, dim: int) -> np.ndarray:
    """Unit vectors in 64 bits from packed 32-bit values."""
    if not len(col):
        return np.zeros((0, dim))
    x = np.frombuffer(b"".join(col), dtype="<f4").reshape(len(col), -1).astype("f8")
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def valid_vectors(df: DataFrame, identifier: str, vector: str, dim: int, order: list[str]) -> DataFrame:
    """``id, v`` with packed values: each identifier once, by its last row in ``order``.

    Valid is a vector of ``dim`` finite values that are not all zero; rows with any other,
    and null identifiers, are left out before repeats are resolved.
    """

    def pack(batches):
        for pdf in batches:
            rows = [i for i, x in enumerate(pdf["_v"]) if x is not None and len(x) == dim]
            pdf = pdf.iloc[rows]
            if len(pdf):
                m = np.vstack(pdf["_v"].to_numpy()).astype("f4")
                with np.errstate(over="ignore"):
                    norm = np.linalg.norm(m.astype("f8"), axis=1)
                ok = np.isfinite(m).all(axis=1) & (norm > 0)
                pdf = pdf[ok]
                pdf = pdf.assign(v=[x.tobytes() for x in m[ok].astype("<f4")])
            else:
                pdf = pdf.assign(v=[])
            yield pdf[["id", *[c for c in pdf.columns if c.startswith("_o")], "v"]]

    keys = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    src = df.where(F.col(identifier).isNotNull() & F.col(vector).isNotNull()).select(F.col(identifier).cast("long").alias("id"), *keys, F.col(vector).cast("array<float>").alias("_v"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema if f.name != "_v") + ", v binary"
    # vectors of identifiers that stand in one row need no shuffle
    often = df.where(F.col(identifier).isNotNull()).groupBy(F.col(identifier).cast("long").alias("id")).agg(F.count("*").alias("n"))
    often = small(materialize(often.where("n > 1").select("id"), "repeated"))
    once = src.join(often, "id", "left_anti").mapInPandas(pack, schema).select("id", "v")
    packed = src.join(often, "id", "left_semi").mapInPandas(pack, schema)
    last = packed.groupBy("id").agg(F.max(F.struct(*[f"_o{i}" for i in range(len(order))], "v")).alias("r"))
    return once.unionByName(last.select("id", F.col("r.v").alias("v")))


@dataclass
class Cells:
    """Pivots with the radius of their cells and the shards these lie in."""

    pivots: np.ndarray
    radius: np.ndarray
    first_shard: np.ndarray
    parts: np.ndarray

    @property
    def shards(self) -> int:
        return int((self.first_shard + self.parts).max()) if len(self.parts) else 0


@dataclass
class Layout:
    """``placed``: id, v, cell, shard.  ``outliers``: id, v, near (the pivot of the last level
    that is nearest, however far), and group, which packs neighbouring pivots' outliers."""

    placed: DataFrame
    outliers: DataFrame
    cells: Cells
    dim: int
    n: int
    n_outliers: int
    written: tuple[DataFrame, ...]

    def release(self) -> None:
        """Delete the written tables; nothing of this layout may be read afterwards."""
        for t in self.written:
            release(t)


def _pivots(v: DataFrame, count: int, total: int, dim: int, above: int = -(2**63)) -> tuple[np.ndarray, int]:
    """The ``count`` vectors of least hash among ``total``, and the largest of their hashes.

    Hashes up to ``above`` are as good as used up, so a guess of the largest leaves little to sort.
    """
    h = F.xxhash64("id", F.lit(42))
    guess = above + (2**63 - 1 - above) * (2 * count + 1000) // max(1, total)
    rows = v.where(h <= guess).select("v", h.alias("h"), "id").orderBy("h", "id").limit(count).collect() if guess < 2**63 - 1 else []  # bounded by the samples' bounds
    if len(rows) < min(count, total):
        rows = v.select("v", h.alias("h"), "id").orderBy("h", "id").limit(count).collect()
    return (np.unique(unpack([bytes(r["v"]) for r in rows], dim), axis=0), rows[-1]["h"]) if rows else (np.zeros((0, dim)), above)


def _nearest(v: DataFrame, pivots: np.ndarray, first: int, dim: int, reach: float) -> DataFrame:
    shared = v.sparkSession.sparkContext.broadcast(pivots.astype("f4"))

    def assign(batches):
        p = shared.value
        step = rows_at_once(len(p))
        for whole in batches:
            for i in range(0, len(whole), step):
                pdf = whole.iloc[i : i + step]
                cos = unpack(pdf["v"], dim).astype("f4") @ p.T
                at = cos.argmax(axis=1)
                d = np.sqrt(np.maximum(0, 2 - 2 * cos[np.arange(len(pdf)), at].astype("f8")))
                # 32-bit products: the margin keeps radii upper bounds
                yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "cell": np.where(d <= reach, at + first, -1).astype("int32"), "d": d + 1e-3, "near": np.asarray(at, "int32")})

    return v.mapInPandas(assign, "id long, v binary, cell int, d double, near int")


def _pack_cells(pivots: np.ndarray, count: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each cell and the number of shards it is cut into."""
    n = len(pivots)
    shard, parts = np.zeros(n, "int64"), np.maximum(1, -(-count // size))
    free, nxt = np.ones(n, bool), 0
    at = np.flatnonzero(parts == 1)  # cells that may join another; those taken are left out now and then
    left, taken = pivots[at].astype("f4"), 0
    for c in np.argsort(-count, kind="stable"):
        if not free[c]:
            continue
        free[c] = False
        shard[c] = nxt
        if parts[c] > 1:
            nxt += int(parts[c])
            continue
        if taken > len(at) // 4:
            keep = free[at]
            at, left, taken = at[keep], left[keep], 0
        total, cos, few = count[c], left @ pivots[c].astype("f4"), min(len(at), 2048)
        while few:
            near = np.argpartition(-cos, few - 1)[:few] if few < len(at) else np.arange(len(at))
            full = False
            for o in at[near[np.lexsort((near, -cos[near]))]]:
                if free[o]:
                    if total + count[o] > size:
                        full = True
                        break
                    free[o] = False
                    shard[o] = nxt
                    total += count[o]
                    taken += 1
            if full or few == len(at):
                break
            few = min(len(at), 8 * few)
        taken += 1
        nxt += 1
    return shard, parts


def lay_out(v: DataFrame, dim: int, reach: float, per_pivot: int = 32, shard_size: int = 4096) -> Layout:
    """Place vectors (``id, v``) in cells and shards."""
    spark = v.sparkSession
    v = materialize(v, "vectors")
    n = n_far = v.count()
    far, levels, samples, first, more, last = v, [], [], 0, np.zeros((0, dim)), -(2**63)
    while not levels or n_far:
        per = max(2, per_pivot // 4) if levels else per_pivot
        more, last = _pivots(far, min(max(MORE_PIVOTS, n // PER_SAMPLE) if len(levels) > 1 else MAX_PIVOTS, max(16, n_far // per)), n_far, dim, last)
        level = _nearest(far, more, first, dim, reach) if n else far.select("id", "v", *[F.lit(0).cast(t).alias(c) for c, t in (("cell", "int"), ("d", "double"), ("near", "int"))])
        level = materialize(level.withColumn("far", F.col("cell") < 0), f"level-{len(levels) + 1}", by="far")
        if levels:
            release_part(levels[-1], "far=true")
        else:
            release(v)
        levels.append(level)
        samples.append(more)
        first += len(more)
        far = level.where("far").select("id", "v")
        before, n_far = n_far, far.count() if n else 0
        if len(levels) > 1 and (n_far <= OUTLIER_BLOCK or before - n_far < 2 * len(more)):
            break
    placed = levels[0].where("not far")
    for level in levels[1:]:
        placed = placed.unionByName(level.where("not far"))
    pivots = np.vstack(samples)
    del samples
    stats = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("d").alias("r")).collect()  # one row per pivot
    count, radius = np.zeros(len(pivots), "int64"), np.zeros(len(pivots))
    for r in stats:
        count[r["cell"]], radius[r["cell"]] = r["n"], r["r"]
    kept = np.flatnonzero(count)
    order = {int(c): i for i, c in enumerate(kept)}
    shard, parts = _pack_cells(pivots[kept], count[kept], shard_size) if len(kept) else (np.zeros(0, "int64"), np.zeros(0, "int64"))
    cells = Cells(pivots[kept], radius[kept], shard, parts)
    rows = [(c, i, int(shard[i]), int(parts[i])) for c, i in order.items()]
    table = F.broadcast(spark.createDataFrame(rows, "cell int, c int, s long, p long"))
    out = placed.join(table, "cell").select("id", "v", F.col("c").alias("cell"), (F.col("s") + F.pmod(F.xxhash64("id"), F.col("p"))).cast("int").alias("shard"))
    n_out = n_far
    outliers = levels[-1].where("far").select("id", "v", "near")
    counts = {r["near"]: r["n"] for r in outliers.groupBy("near").agg(F.count("*").alias("n")).collect()} if n_out else {}  # one row per pivot
    lone = np.array(sorted(counts), "int64")
    group, pieces = _pack_cells(more[lone], np.array([counts[c] for c in lone.tolist()]), shard_size) if len(lone) else (lone, lone)
    table = spark.createDataFrame([(int(c), int(g), int(p)) for c, g, p in zip(lone, group, pieces)], "near int, g long, p long")
    outliers = outliers.join(F.broadcast(table), "near").select("id", "v", "near", (F.col("g") + F.pmod(F.xxhash64("id"), F.col("p"))).cast("int").alias("group"))
    return Layout(out, outliers, cells, dim, n, n_out, tuple(levels))


def outlier_blocks(outliers: DataFrame, n: int, dim: int):
    """Outliers (``id, v`` and more) as a table without v and unit vectors, a bounded block
    at a time."""
    parts = -(-n // OUTLIER_BLOCK)
    for b in range(parts):
        block = outliers.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(parts)) == b).toPandas()
        yield block.drop(columns="v"), unpack(block["v"], dim)
