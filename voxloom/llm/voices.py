"""Problem 5: clusters of similar vectors, their sizes and most typical members.

One graph over all vectors links each to its ``K`` nearest neighbours that are similar
enough.  It is built by neighbour descent in blocks: what a block of rows is compared with
next are the blocks in which its neighbours' neighbours lie.  Inside a shard of neighbouring
rows this runs in one task.  Then the vectors themselves travel: each visits the shards whose
cells are nearest, and from then on, round by round, those that hold its neighbours'
neighbours, a few shards a round, until hardly a list gets better.  Lists keep the best of
all visits, so the graph knows no shards.

*Communities* are looked for by modularity-based moves, inside shards first, then between
the communities of all shards with the weights of all links of the graph, as joins and
aggregations.  A member is the more typical the higher its weighted degree inside.

*Clusters* in the sense of "cosine at least t, directly or through others" join what the
graph's links join.  As the graph is approximate, a check follows that is exact: whatever
pair it still finds between two clusters joins them.  Cells that cannot hold such a partner
are ruled out by the triangle inequality of angles, cells of the same cluster need not be
looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.vectors import BROADCAST, lay_out, outlier_blocks, rows_at_once, small, unpack
from voxloom.operators.components import connected_components
from voxloom.session import materialize, release

K = 10
TYPICAL = 5
#: Rows of a block, blocks first looked into, shards visited a round, visitors per task.
BLOCK, FIRST_BLOCKS, VISITS, LOT = 128, 4, 4, 16384
#: Width of a ring of a cell's rows around their mean, in radians.
RING = 0.08
LIST = "array<struct<c:float,nb:bigint,s:int>>"


def _best(nb: np.ndarray, cos: np.ndarray, cand: np.ndarray, cs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of old lists and candidates that are none of them."""
    k = nb.shape[1]
    ids, val = np.hstack([nb, cand]), np.hstack([cos, cs])
    top = np.argpartition(-val, k - 1, axis=1)[:, :k]
    return np.take_along_axis(ids, top, 1), np.take_along_axis(val, top, 1)


def neighbour_descent(x: np.ndarray, k: int = K, least: float = -1.0) -> tuple[np.ndarray, np.ndarray]:
    """Approximate ``k`` nearest neighbours (indices, cosines) of unit vectors; places that no
    neighbour takes have cosine -3.  Similar rows should stand together.

    Rows are handled in blocks.  A block first looks into itself and the few blocks whose
    means are nearest, then into the blocks where its neighbours' neighbours are, as far as
    the links have a cosine of ``least``, until there are no new ones.
    """
    n = len(x)
    k = min(k, n - 1)
    nb, cos = np.zeros((n, max(k, 0)), "int64"), np.full((n, max(k, 0)), -3.0, x.dtype)
    if k < 1:
        return nb, cos
    block = np.arange(n) // BLOCK
    count = int(block[-1]) + 1
    rows = [np.flatnonzero(block == b) for b in range(count)]
    mean = np.array([x[r].mean(axis=0) for r in rows])
    near = np.argsort(-(mean @ mean.T), axis=1, kind="stable")[:, : FIRST_BLOCKS + 1]
    todo = [sorted({b, *near[b].tolist()}) for b in range(count)]
    seen = np.zeros((count, count), bool)
    while any(len(into) for into in todo):
        for b, into in enumerate(todo):
            if not len(into):
                continue
            seen[b, into] = True
            at, cand = rows[b], np.concatenate([rows[i] for i in into])
            cs = x[at] @ x[cand].T
            cs[at[:, None] == cand[None, :]] = -3
            if cs.shape[1] > k:
                top = np.argpartition(-cs, k - 1, axis=1)[:, :k]
                nb[at], cos[at] = _best(nb[at], cos[at], cand[top], np.take_along_axis(cs, top, 1))
            else:
                nb[at], cos[at] = _best(nb[at], cos[at], np.tile(cand, (len(at), 1)), cs)
        links = np.zeros((count, count), bool)
        i, j = np.nonzero(cos >= max(least, -1.0))
        links[block[i], block[nb[i, j]]] = True
        links |= links.T  # those that name a row are its neighbours as well
        further = (links.astype("f4") @ links.astype("f4") > 0) & ~seen
        todo = [np.flatnonzero(further[b]) for b in range(count)]
    return nb, cos


def _least_labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Connected components of edges a-b; a component's label is its least node."""
    label = np.arange(n)
    while True:
        old = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == old).all():
            return label


def louvain(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray, total: float, levels: int = 4, seed: int = 1) -> np.ndarray:
    """Communities by modularity moves; ``total`` is the weight of the whole graph's edges.

    Edges are undirected and named once.  In a round about half of the nodes may move, each
    to the neighbouring community of greatest gain; then communities become nodes.
    """
    member, rng = np.arange(n), np.random.default_rng(seed)
    i, j, w = np.r_[a, b], np.r_[b, a], np.r_[w, w].astype("f8")
    degree = np.bincount(i, w, n)
    for _ in range(levels):
        com, still = np.arange(n), 0
        for _ in range(40):
            tot = np.bincount(com, degree, n)
            key, place = np.unique(i * n + com[j], return_inverse=True)
            node, c = key // n, key % n
            gain = np.bincount(place, w, len(key)) - degree[node] * (tot[c] - np.where(c == com[node], degree[node], 0)) / (2 * total)
            own = -degree * (tot[com] - degree) / (2 * total)
            mine = c == com[node]
            own[node[mine]] = gain[mine]
            order = np.lexsort((c, -np.round(gain, 12), node))
            first = order[np.r_[True, node[order][1:] != node[order][:-1]]] if len(order) else order
            better = gain[first] > own[node[first]] + 1e-9
            move = first[better & (rng.random(len(first)) < 0.5)]
            com[node[move]] = c[move]
            still = 0 if better.any() else still + 1
            if still or better.sum() <= n // 500 and not len(move):
                break
        names, com = np.unique(com, return_inverse=True)
        if len(names) == n:
            break
        member, degree = com[member], np.bincount(com, degree)
        i, j, n = com[i], com[j], len(names)
        apart = i != j
        i, j, w = i[apart], j[apart], w[apart]
    return member


#: Vectors travel as unit vectors of 16-bit floats.  A component is off by at most 2**-11 of
#: itself, so a cosine by less than this; whatever lies nearer to the threshold is looked at again.
MARGIN = 1.2e-3
NODE = f"kind string, id long, v binary, h binary, shard int, cell int, part long, community long, kth double, l {LIST}, radius double"


def _shard_graph(dim: int, n_all: int, threshold: float):
    """The graph of one shard: lists, parts that its links join, communities; and its cells."""

    def work(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["cell", "id"], kind="stable")
        ids, x, shard = pdf["id"].to_numpy("int64"), unpack(pdf["v"], dim), int(pdf["shard"].iloc[0])
        n = len(ids)
        nb, cos = neighbour_descent(x.astype("f4"), K, threshold)
        i, j = np.nonzero(cos >= threshold - 1e-5)
        a, b = i, nb[i, j]
        w = np.einsum("nd,nd->n", x[a], x[b])  # in 64 bits, so that the threshold is sharp
        sure = w >= threshold
        a, b, w = a[sure], b[sure], w[sure]
        part = _least_labels(n, a, b)
        once = np.unique(np.minimum(a, b) * n + np.maximum(a, b), return_index=True)[1]
        com = louvain(n, a[once], b[once], w[once], max(1e-9, w[once].sum()) * n_all / n)
        least_com, least_part = (np.full(n, np.iinfo("int64").max) for _ in range(2))
        np.minimum.at(least_com, com, ids)
        np.minimum.at(least_part, part, ids)
        order = np.lexsort((ids[b], -w, a))
        a, b, w = a[order], b[order], w[order]
        start = np.searchsorted(a, np.arange(n + 1))
        lists = [[{"c": c, "nb": o, "s": shard} for c, o in zip(w[s:e].tolist(), ids[b[s:e]].tolist())] for s, e in zip(start[:-1], start[1:])]
        kth = np.array([x[-1]["c"] if len(x) >= K else threshold for x in lists])
        half = [r.tobytes() for r in x.astype("<f2")]
        nodes = pd.DataFrame({"kind": "node", "id": ids, "v": pdf["v"].to_numpy(), "h": half, "shard": shard, "cell": pdf["cell"].to_numpy(), "part": least_part[part], "community": least_com[com], "kth": kth, "l": lists, "radius": 0.0})
        stats, cell = [], pdf["cell"].to_numpy()
        for c in np.unique(cell):
            m = np.flatnonzero(cell == c)
            center = x[m].mean(axis=0)
            norm = np.linalg.norm(center)
            center = center / norm if norm > 1e-9 else x[m[0]]
            angle = float(np.arccos(np.clip((x[m] @ center).min(), -1, 1))) + 1e-3
            parts = np.unique(least_part[part[m]])
            stats.append(("cell", 0, center.astype("<f4").tobytes(), b"", shard, int(c), int(parts[0]) if len(parts) == 1 else -1, -1, 0.0, [], angle))
        return pd.concat([nodes, pd.DataFrame(stats, columns=nodes.columns)], ignore_index=True) if stats else nodes

    return work


def _near_cells(x: np.ndarray, own: np.ndarray, centre: np.ndarray, wide: np.ndarray):
    """Blocks ``rows, cells, cos`` with every pair whose angle is at most the cell's ``wide``.

    Rows of one cell (``own``) that are about as far from their mean make a ring.  The mean
    alone rules out the cells that no row of a ring can reach, as angles obey the triangle
    inequality; rows that lie alone (``own`` below 0) meet every cell.
    """
    names, group = np.unique(own, return_inverse=True)
    mean = np.zeros((len(names), x.shape[1]))
    np.add.at(mean, group, x)
    mean /= np.maximum(np.linalg.norm(mean, axis=1, keepdims=True), 1e-9)
    angle = np.arccos(np.clip(np.einsum("nd,nd->n", x, mean[group]), -1, 1))
    every = (own < 0) | (angle + wide.max(initial=0) > 3.1)
    rows = np.flatnonzero(every)
    step = rows_at_once(len(centre), 1000)
    for i in range(0, len(rows), step):
        yield rows[i : i + step], np.arange(len(centre)), x[rows[i : i + step]] @ centre.T
    rows = np.flatnonzero(~every)
    if not len(rows):
        return
    rows = rows[np.lexsort((angle[rows], group[rows]))]
    ring = group[rows] * 64 + (angle[rows] / RING).astype("int64")
    start = np.flatnonzero(np.r_[True, ring[1:] != ring[:-1]])
    end = np.r_[start[1:], len(rows)]
    far = angle[rows[end - 1]]  # of a ring's rows the last is the farthest
    # mean . centre >= cos(far + wide), as one product
    left = np.hstack([mean[group[rows[start]]], -np.cos(far)[:, None], np.sin(far)[:, None]]).astype("f4")
    right = np.hstack([centre, np.cos(wide)[:, None], np.sin(wide)[:, None]]).astype("f4")
    for i in range(0, len(start), step):
        a, c = np.nonzero(left[i : i + step] @ right.T >= -1e-4)
        cut = np.searchsorted(a, np.arange(len(left[i : i + step]) + 1))
        for r in range(len(cut) - 1):
            cells = c[cut[r] : cut[r + 1]]
            at, size = rows[start[i + r] : end[i + r]], rows_at_once(len(cells), 1000)
            for j in range(0, len(at) if len(cells) else 0, size):
                yield at[j : j + size], cells, x[at[j : j + size]] @ centre[cells].T


def _dealt(rows: DataFrame, n_alone: int) -> DataFrame:
    """Rows in cells as they lie; those that lie alone, which meet every cell, dealt to all cores."""
    many = max(1, min(4 * rows.sparkSession.sparkContext.defaultParallelism, n_alone // 500))
    return rows.where("cell >= 0").unionByName(rows.where("cell < 0").repartition(many))


def _nearest_shards(nodes: DataFrame, n_alone: int, cells: pd.DataFrame, dim: int, threshold: float) -> DataFrame:
    """``id, h, kth, shard``: vectors beside the few other shards whose cells' means are
    nearest to them, as far as they are similar; a vector that lies alone takes the nearest."""
    cells = cells.sort_values("shard", kind="stable")
    shared = nodes.sparkSession.sparkContext.broadcast((unpack(cells["v"], dim).astype("f4"), cells["shard"].to_numpy("int32")))
    angle = float(np.arccos(threshold))

    def go(batches):
        centre, shard = shared.value
        wide = np.full(len(centre), angle + 1e-3)
        names, start = np.unique(shard, return_index=True)
        most = min(len(names), VISITS + 1)
        for pdf in batches:
            home, own = pdf["shard"].to_numpy(), pdf["cell"].to_numpy("int64")
            found = [pd.DataFrame({"row": [], "shard": [], "c": []}).astype({"row": "int64", "shard": "int32", "c": "float32"})]
            for rows, near, cos in _near_cells(unpack(pdf["v"], dim).astype("f4"), own, centre, wide):
                if len(near) == len(centre):  # a shard's nearest cell stands for it
                    cos = np.maximum.reduceat(cos, start, axis=1)
                    top = np.argpartition(-cos, most - 1, axis=1)[:, :most]
                    cos, to = np.take_along_axis(cos, top, 1), names[top]
                else:
                    to = np.broadcast_to(shard[near], cos.shape)
                a, b = np.nonzero(((cos >= threshold) | (own[rows][:, None] < 0)) & (to != home[rows][:, None]))
                found.append(pd.DataFrame({"row": rows[a], "shard": to[a, b], "c": cos[a, b]}))
            pair = pd.concat(found).sort_values(["row", "c"], ascending=[True, False], kind="stable").drop_duplicates(["row", "shard"])
            pair = pair[pair.groupby("row").cumcount() < VISITS]
            sel = pdf.iloc[pair["row"].to_numpy()]
            yield pd.DataFrame({"id": sel["id"].to_numpy(), "h": sel["h"].to_numpy(), "kth": sel["kth"].to_numpy(), "shard": pair["shard"].to_numpy()})

    return _dealt(nodes.select("id", "v", "h", "shard", "cell", "kth"), n_alone).mapInPandas(go, "id long, h binary, kth double, shard int")


def _lots(visits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Visits with their lot, and the lots of each shard: so many that a lot is about ``LOT`` visitors."""
    many = materialize(visits.groupBy("shard").agg(F.ceil(F.count("*") / LOT).cast("int").alias("lots")), "lots")
    return visits.join(many, "shard").withColumn("lot", F.pmod(F.xxhash64("id", F.lit(3)), F.col("lots")).cast("int")).drop("lots"), many


def _meet(nodes: DataFrame, visits: DataFrame, call, schema: str, columns: list[str]) -> DataFrame:
    """Hosts and visitors of each shard together, a lot of visitors at a time."""
    guests, many = _lots(visits)
    guests = guests.select(*[F.col(c).alias(c) for c in guests.columns])  # hosts may come from the same table
    hosts = nodes.select(*columns, "shard").join(many, "shard").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1))).drop("lots")
    return hosts.groupBy("shard", "lot").cogroup(guests.groupBy("shard", "lot")).applyInPandas(call, schema)


def _halves(col, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(col), "<f2").reshape(len(col), -1).astype("f4") if len(col) else np.zeros((0, dim), "f4")


def _call(dim: int, threshold: float):
    """What visitors surely find that is better than the worst of their lists."""

    def call(host: pd.DataFrame, guest: pd.DataFrame) -> pd.DataFrame:
        out_id, out_l = [], []
        if len(host) and len(guest):
            ids, y, shard = host["id"].to_numpy("int64"), _halves(host["h"], dim), int(host["shard"].iloc[0])
            for i in range(0, len(guest), 1024):
                g = guest.iloc[i : i + 1024]
                cos = _halves(g["h"], dim) @ y.T
                k = min(K, cos.shape[1])
                top = np.argpartition(-cos, k - 1, axis=1)[:, :k]
                val = np.take_along_axis(cos, top, 1)
                a, b = np.nonzero(val >= np.maximum(threshold + MARGIN, g["kth"].to_numpy())[:, None])
                c, b = val[a, b], top[a, b]
                start = np.searchsorted(a, np.arange(len(g) + 1))
                for r, (s, e) in enumerate(zip(start[:-1], start[1:])):
                    if e > s:
                        out_id.append(int(g["id"].iloc[r]))
                        out_l.append([{"c": q, "nb": o, "s": shard} for q, o in zip(c[s:e].tolist(), ids[b[s:e]].tolist())])
        if not out_id:  # Arrow converts no empty column of lists of structs
            out_id, out_l = [0], [[]]
        return pd.DataFrame({"id": np.array(out_id, "int64"), "l": out_l})

    return call


@dataclass
class Graph:
    """``nodes``: id, v, shard, cell, part, community.  ``lists``: id, part, community, home
    (its own shard) and l, the neighbours, best first.  ``cells``: about a row per pivot.  All are written tables."""

    nodes: DataFrame
    lists: DataFrame
    cells: pd.DataFrame
    n_outliers: int
    dim: int
    threshold: float


def similarity_graph(v: DataFrame, dim: int, threshold: float = 0.75, settle: float = 0.01, shard_size: int = 4096) -> Graph:
    """The graph of nearest neighbours with a cosine of ``threshold`` or more, over all rows.

    ``v`` has unique ``id`` and packed ``v`` (see ``valid_vectors``).  Rounds of visits end
    when at most ``settle`` of the lists got better, or nothing is left to visit.
    """
    lay = lay_out(v, dim, 0.75, per_pivot=128, shard_size=shard_size)
    # vectors that lie alone share shards with those that are nearest to the same pivots
    lone = lay.outliers.select("id", "v", (-1 - F.col("near")).cast("int").alias("cell"), (F.lit(lay.cells.shards) + F.col("group")).cast("int").alias("shard"))
    rows = materialize(lay.placed.unionByName(lone).groupBy("shard").applyInPandas(_shard_graph(dim, max(1, lay.n), threshold), NODE), "nodes")
    lay.release()
    nodes, cells = rows.where("kind = 'node'"), rows.where("kind = 'cell'").select("v", "shard", "cell", "part", "radius").toPandas()
    lists = nodes.select("id", "part", "community", F.col("shard").alias("home"), "l", F.array("shard").alias("seen"), F.lit(False).alias("better"))
    guests, owned, none = (_nearest_shards(nodes, lay.n_outliers, cells, dim, threshold) if len(cells) else None), False, F.array().cast(LIST)
    while guests is not None:
        guests = materialize(guests, "visits")
        found = _meet(nodes, guests, _call(dim, threshold), f"id long, l {LIST}", ["id", "h"])
        # what a list was, whom it found and where it was, in one aggregation; a shard is visited
        # once, so no neighbour is found twice
        who = small(materialize(guests.select("id").distinct(), "who"))
        news = lists.join(who, "id", "left_semi").withColumn("was", F.lit(True)).unionByName(found.where("size(l) > 0"), True).unionByName(guests.select("id", F.array("shard").alias("seen")), True)
        grown = news.groupBy("id").agg(
            *[F.max(c).alias(c) for c in ("part", "community", "home")], F.flatten(F.collect_list("l")).alias("l"), F.array_sort(F.flatten(F.collect_list("seen"))).alias("seen"), F.bool_or(F.col("was").isNull() & F.col("l").isNotNull()).alias("better")
        )
        grown = grown.where("home is not null").withColumn("l", F.slice(F.sort_array("l", asc=False), 1, K))
        grown = materialize(grown.unionByName(lists.join(who, "id", "left_anti").withColumn("better", F.lit(False))), "lists")
        release(guests)
        if owned:
            release(lists)
        lists, owned = grown, True
        changed = lists.where("better").count()
        if changed <= settle * lay.n:
            break
        # where the neighbours of a list's own part are: its neighbours' neighbours among them
        homes = lists.select("part", F.explode("l.s").alias("s")).distinct().groupBy("part").agg(F.collect_set("s").alias("h"))  # shards
        far = lists.where("better").join(small(homes), "part").select("id", F.when(F.size("l") >= K, F.element_at("l", -1)["c"]).otherwise(F.lit(threshold)).cast("double").alias("kth"), F.array_except("h", "seen").alias("h"))
        pick = F.slice(F.array_sort(F.transform("h", lambda x: F.struct(F.xxhash64("id", x).alias("r"), x.alias("s")))), 1, VISITS).getField("s")
        visits = materialize(far.select("id", "kth", F.explode(pick).alias("shard")), "pairs")
        if visits.isEmpty():
            break
        guests = nodes.select("id", "h").join(small(visits), "id")
    return Graph(nodes, lists, cells, lay.n_outliers, dim, threshold)


def _edges(g: Graph) -> DataFrame:
    """``id, nb, c`` with part and community of both ends."""
    e = g.lists.select("id", "part", "community", F.explode("l").alias("e")).select("id", "part", "community", F.col("e.nb").alias("nb"), F.col("e.c").cast("double").alias("c"), F.col("e.s").alias("s"))
    return e.join(g.lists.select(F.col("id").alias("nb"), F.col("part").alias("part_b"), F.col("community").alias("community_b")), "nb")


def _named(d: DataFrame, names: DataFrame, column: str = "part") -> DataFrame:
    """``column`` by its component, where it has one."""
    return d.join(names.withColumnRenamed("node", column), column, "left").withColumn(column, F.coalesce("component", column)).drop("component")


def _routes(asks: DataFrame, cells: pd.DataFrame, dim: int, threshold: float) -> DataFrame:
    """``id, h, part, shard``: shards with a cell of another part (or of several) that may
    hold a vector of at least this cosine."""
    table = (unpack(cells["v"], dim).astype("f4"), cells["radius"].to_numpy(), cells["part"].to_numpy("int64"), cells["shard"].to_numpy("int32"))
    shared = asks.sparkSession.sparkContext.broadcast(table)
    wide = float(np.arccos(threshold))

    def chosen(pdf: pd.DataFrame, pair: np.ndarray, shards: int) -> pd.DataFrame:
        sel = pdf.iloc[pair // shards]
        return pd.DataFrame({"id": sel["id"].to_numpy(), "h": sel["h"].to_numpy(), "part": sel["part"].to_numpy(), "shard": (pair % shards).astype("int32")})

    def go(batches):
        centre, radius, part, shard = shared.value
        reach = np.minimum(np.pi, radius + wide)
        least = np.cos(reach).astype("f4") - 1e-4
        shards = int(shard.max(initial=0)) + 1
        for pdf in batches:
            own, found, n = pdf["part"].to_numpy("int64"), [np.zeros(0, "int64")], 0
            for rows, near, cos in _near_cells(unpack(pdf["v"], dim).astype("f4"), pdf["cell"].to_numpy("int64"), centre, reach + 1e-3):
                a, c = np.nonzero(cos >= least[near][None, :])
                a, c = rows[a], near[c]
                other = part[c] != own[a]
                found.append(np.unique(a[other] * shards + shard[c[other]]))
                n += len(found[-1])
                if n > 20_000:
                    yield chosen(pdf, np.concatenate(found), shards)
                    found, n = [np.zeros(0, "int64")], 0
            yield chosen(pdf, np.concatenate(found), shards)

    return asks.select("id", "v", "h", "part", "cell").mapInPandas(go, "id long, h binary, part long, shard int")


def missing_links(g: Graph, names: DataFrame) -> DataFrame:
    """The exact check: distinct ``u, v`` clusters that a pair of the threshold still links.

    ``names`` gives the cluster (``component``) of a part (``node``).  Vectors that lie alone
    are compared with each other directly, a bounded block at a time.
    """
    dim, threshold, spark = g.dim, g.threshold, g.nodes.sparkSession
    rows = _named(g.nodes.select("id", "v", "h", "shard", "cell", "part"), small(names))
    own = spark.createDataFrame(pd.DataFrame({"node": sorted({int(p) for p in g.cells["part"] if p >= 0})}, dtype="int64"), "node long") if len(g.cells) else None
    where = {r["node"]: r["component"] for r in names.join(own, "node").collect()} if own is not None else {}  # at most a row per cell
    cells = g.cells.assign(part=[where.get(p, p) for p in g.cells["part"]])
    cells = cells[cells["cell"] >= 0]
    found = None
    for alone, x in outlier_blocks(rows.where("cell < 0").select("id", "v", "part"), g.n_outliers, dim):
        block = spark.sparkContext.broadcast((x, x.astype("f4"), alone["part"].to_numpy("int64")))

        def direct(batches, block=block):
            y, y4, p = block.value
            step = rows_at_once(len(y))
            for pdf in batches:
                for i in range(0, len(pdf), step):
                    part = pdf.iloc[i : i + step]
                    z, own = unpack(part["v"], dim), part["part"].to_numpy("int64")
                    a, b = np.nonzero(z.astype("f4") @ y4.T >= threshold - 1e-5)
                    apart = own[a] != p[b]
                    a, b = a[apart], b[apart]
                    sure = np.einsum("nd,nd->n", z[a], y[b]) >= threshold
                    yield pd.DataFrame({"u": own[a[sure]], "v": p[b[sure]]}).drop_duplicates()

        part = materialize(rows.where("cell < 0").select("v", "part").mapInPandas(direct, "u long, v long").distinct(), "alone")
        block.destroy()
        found = part if found is None else found.unionByName(part)

    def call(host: pd.DataFrame, guest: pd.DataFrame) -> pd.DataFrame:
        """Clusters that a pair surely links (ids -1), and pairs that lie too near to tell."""
        out = [pd.DataFrame({"u": [], "v": [], "a": [], "b": []}, dtype="int64")]
        if len(host) and len(guest):
            y, hp, hi = _halves(host["h"], dim), host["part"].to_numpy("int64"), host["id"].to_numpy("int64")
            for i in range(0, len(guest), 1024):
                g_ = guest.iloc[i : i + 1024]
                gp, gi = g_["part"].to_numpy("int64"), g_["id"].to_numpy("int64")
                cos = _halves(g_["h"], dim) @ y.T
                a, b = np.nonzero(cos >= threshold - MARGIN)
                apart = gp[a] != hp[b]
                a, b = a[apart], b[apart]
                sure = cos[a, b] >= threshold + MARGIN
                out.append(pd.DataFrame({"u": gp[a], "v": hp[b], "a": np.where(sure, -1, gi[a]), "b": np.where(sure, -1, hi[b])}).drop_duplicates())
        return pd.concat(out).drop_duplicates()

    if len(cells):
        # a join of two large tables parts the rows of a cell, which are looked at together
        asks = rows if names.limit(BROADCAST + 1).count() <= BROADCAST else rows.sortWithinPartitions("shard", "cell")
        met = materialize(_meet(rows.where("cell >= 0"), materialize(_routes(_dealt(asks, g.n_outliers), cells, dim, threshold), "routes"), call, "u long, v long, a long, b long", ["id", "h", "part"]), "met")
        sure = met.where("a = -1 and b = -1").select("u", "v")
        # what two clusters surely link need not be looked at again; of the rest the vectors are fetched
        near = small(met.where("a != -1 or b != -1").join(sure.distinct(), ["u", "v"], "left_anti"))

        @F.pandas_udf("double")
        def cosine(p: pd.Series, q: pd.Series) -> pd.Series:
            return pd.Series(np.einsum("nd,nd->n", unpack(p, dim), unpack(q, dim)) if len(p) else [], dtype="float64")

        side = lambda x: g.nodes.select(F.col("id").alias(x), F.col("v").alias(f"v{x}"))
        near = materialize(side("a").join(near, "a"), "near")
        told = side("b").join(small(near), "b").where(cosine("va", "vb") >= threshold).select("u", "v")
        found = (sure if found is None else found.unionByName(sure)).unionByName(told)
    return materialize((found if found is not None else g.lists.select(F.col("part").alias("u"), F.col("part").alias("v")).where("false")).distinct(), "missing")


def find_clusters(v: DataFrame, dim: int, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """Clusters (``id, cluster``) and what the exact check added (``u, v``, pairs of clusters).

    A cluster joins all that is linked by cosines of at least ``threshold`` and is named by
    its least id.  A vector like no other is a cluster of its own.
    """
    g = similarity_graph(v, dim, threshold)
    # a link inside the first shard joins one part already
    far = g.lists.select("part", "home", F.explode("l").alias("e")).where("e.s != home").select("part", F.col("e.nb").alias("nb"))
    across = far.join(g.lists.select(F.col("id").alias("nb"), F.col("part").alias("part_b")), "nb").where("part != part_b").select(F.least("part", "part_b").alias("u"), F.greatest("part", "part_b").alias("v")).distinct()
    names = materialize(connected_components(across), "joined")
    missing = missing_links(g, names)
    last = connected_components(missing)
    full = _named(_named(g.lists.select("id", "part"), names), last)
    least = full.groupBy("part").agg(F.min("id").alias("cluster"))
    return full.join(least, "part").select("id", "cluster"), missing


def find_voices(v: DataFrame, dim: int, threshold: float = 0.75, rounds: int = 30) -> tuple[DataFrame, DataFrame]:
    """Members (``id, voice, degree``) and voices (``voice, size, typical``).

    A voice is a community of the graph, named by its least id; ``typical`` lists its members
    of highest degree inside it.  A vector without a link is a voice of its own.
    """
    g = similarity_graph(v, dim, threshold)
    edges = materialize(_edges(g).select("id", "nb", "c", "community", "community_b"), "edges")
    pairs = edges.groupBy("community", "community_b").agg(F.sum("c").alias("w"))
    both = pairs.unionByName(pairs.select(F.col("community_b").alias("community"), F.col("community").alias("community_b"), "w"))
    w = materialize(both.groupBy(F.col("community").alias("a"), F.col("community_b").alias("b")).agg(F.sum("w").alias("w")), "weights")
    state = materialize(w.groupBy(F.col("a").alias("node")).agg(F.sum("w").alias("degree")).select("node", "degree", F.col("node").alias("voice")), "state")
    total = state.agg(F.coalesce(F.sum("degree"), F.lit(0.0))).first()[0]
    apart = w.where("a != b")
    for r in range(rounds if total else 0):
        # to each neighbouring community: what the move gains over being alone
        near = apart.join(state.select(F.col("node").alias("b"), "voice"), "b").groupBy(F.col("a").alias("node"), F.col("voice").alias("to")).agg(F.sum("w").alias("w"))
        near = near.unionByName(state.select("node", F.col("voice").alias("to"), F.lit(0.0).alias("w"))).groupBy("node", "to").agg(F.sum("w").alias("w"))
        size = state.groupBy(F.col("voice").alias("to")).agg(F.sum("degree").alias("tot"))
        gain = near.join(size, "to").join(state, "node")
        own = F.col("to") == F.col("voice")
        gain = gain.withColumn("gain", F.round(F.col("w") - F.col("degree") * (F.col("tot") - F.when(own, F.col("degree")).otherwise(0.0)) / F.lit(total), 9))
        best = gain.groupBy("node").agg(F.max(F.struct("gain", (-F.col("to")).alias("to"))).alias("m"), F.max(F.when(own, F.col("gain"))).alias("now"), F.first("degree").alias("degree"), F.first("voice").alias("voice"))
        move = (F.col("m.gain") > F.col("now") + 1e-9) & (F.pmod(F.xxhash64("node", F.lit(r)), F.lit(2)) == 0)
        new = materialize(best.select("node", "degree", F.when(move, -F.col("m.to")).otherwise(F.col("voice")).alias("voice"), (F.col("m.gain") > F.col("now") + 1e-9).alias("restless")), "state")
        restless = new.where("restless").count()
        release(state)
        state = new.drop("restless")
        if not restless:
            break
    # a voice may have lost the community it is named after: its least member names it
    voice = F.coalesce("voice", "community")
    who = g.lists.select("id", "community").join(state.select(F.col("node").alias("community"), "voice"), "community", "left").select("id", voice.alias("_v"))
    same = state.select(F.col("node").alias("community"), F.col("voice").alias("va")), state.select(F.col("node").alias("community_b"), F.col("voice").alias("vb"))
    inside = w.select(F.col("a").alias("community"), F.col("b").alias("community_b")).join(same[0], "community").join(same[1], "community_b").where("va = vb").select("community", "community_b")
    e = edges.join(inside, ["community", "community_b"])
    degree = e.select("id", "c").unionByName(e.select(F.col("nb").alias("id"), "c")).groupBy("id").agg(F.sum("c").alias("degree"))
    members = materialize(who.join(degree, "id", "left").fillna(0.0, ["degree"]), "members")
    name = members.groupBy("_v").agg(F.min("id").alias("voice"), F.count("*").alias("size"))
    best = Window.partitionBy("_v").orderBy(F.desc("degree"), "id")  # only the first of each task are shuffled
    top = members.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= TYPICAL)
    top = top.groupBy("_v").agg(F.array_sort(F.collect_list(F.struct("_r", "id"))).alias("t")).select("_v", F.col("t.id").alias("typical"))
    named = members.join(name.select("_v", "voice"), "_v").select("id", "voice", F.round("degree", 6).alias("degree"))
    return named, name.join(top, "_v").select("voice", "size", "typical")
