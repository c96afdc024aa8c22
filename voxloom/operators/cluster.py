"""Speaker clustering inside books and across books, on numpy kernels in grouped maps.

Determinism: wherever the original relies on library tie-breaks or random starts, the
lowest index wins here and seeds are fixed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.components import connected_components
from voxloom.session import materialize

# Most speakers tried, DBSCAN radii and neighbours, merge distance, least samples of a merged speaker, most dimensions.
MAX_SPEAKERS, EPS, MIN_POINTS, MERGE_DISTANCE, MERGE_SAMPLES, MAX_DIM = 15, np.arange(0.10, 1.0, 0.05), 3, 0.15, 100, 512
#: Rows up to which a matrix of all pairs is decomposed; rows that meet all others at a time.
DENSE, BLOCK = 1500, 512


def normalize(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(n > 0, n, 1)


def average_link(x: np.ndarray, k: int | None = None, below: float | None = None) -> np.ndarray:
    """Average-link clusters of unit vectors by cosine distance, down to ``k`` clusters or
    while the closest pair is nearer than ``below``.

    The mean distance of two clusters follows from the sums of their vectors, so memory
    grows with the rows, not their pairs; merges follow nearest-neighbour chains.
    """
    return cut_tree(len(x), merge_tree(x), k, below)


def merge_tree(x: np.ndarray) -> list[tuple[float, int, int]]:
    """All merges of average link: distance, least row of one cluster and of the other."""
    n = len(x)
    total, size, alive, row = x.astype("f8").copy(), np.ones(n), np.ones(n, bool), np.arange(n)
    merges: list[tuple[float, int, int]] = []
    chain: list[int] = []
    left = n
    for _ in range(n - 1):
        if len(alive) > 64 and left < 0.7 * len(alive):  # what is merged away is not compared any more
            kept = np.flatnonzero(alive)
            chain = np.searchsorted(kept, chain).tolist()
            total, size, row, alive = total[kept], size[kept], row[kept], np.ones(len(kept), bool)
        if not chain:
            chain = [int(np.flatnonzero(alive)[0])]
        while True:
            c = chain[-1]
            d = 1 - (total @ total[c]) / (size * size[c])
            d[~alive] = np.inf
            d[c] = np.inf
            best = int(np.argmin(d))
            if len(chain) > 1 and d[chain[-2]] <= d[best]:
                best = chain[-2]
                break
            chain.append(best)
        a, b = sorted((chain.pop(), chain.pop()))
        merges.append((float(d[best]), int(row[a]), int(row[b])))
        total[a] += total[b]
        size[a] += size[b]
        alive[b] = False
        left -= 1
    return merges


def cut_tree(n: int, merges: list[tuple[float, int, int]], k: int | None = None, below: float | None = None) -> np.ndarray:
    order = sorted(range(len(merges)), key=lambda i: (merges[i][0], i))
    order = [i for i in order if below is None or merges[i][0] < below]
    if k is not None:
        order = order[: max(0, n - k)]
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in order:
        a, b = find(merges[i][1]), find(merges[i][2])
        if a != b:
            root[max(a, b)] = min(a, b)
    return np.unique([find(i) for i in range(n)], return_inverse=True)[1]


def silhouette(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Silhouette of each unit vector by cosine distance; 0 in clusters of one.

    The mean distance to a cluster (own row left out) follows from the sum of its vectors.
    """
    k = labels.max() + 1
    if k < 2:
        return np.zeros(len(x))
    total, size = np.zeros((k, x.shape[1])), np.bincount(labels, minlength=k).astype("f8")
    np.add.at(total, labels, x)
    out = np.empty(len(x))
    step = max(1, 2_000_000 // k)
    for i in range(0, len(x), step):
        la = labels[i : i + step]
        s = x[i : i + step] @ total.T
        own = np.arange(len(la)), la
        s[own] -= 1
        n = np.tile(size, (len(la), 1))
        n[own] -= 1
        d = 1 - s / np.where(n > 0, n, 1)
        near = d[own]
        d[own] = np.inf
        other = d.min(axis=1)
        out[i : i + step] = np.where(size[la] > 1, (other - near) / np.maximum(np.maximum(near, other), 1e-12), 0.0)
    return out


def dispersion(x: np.ndarray, labels: np.ndarray) -> float:
    """Sum of the cosine distances of all ordered pairs inside clusters."""
    t = np.zeros((labels.max() + 1, x.shape[1]))
    np.add.at(t, labels, x)
    return float((np.bincount(labels) ** 2).sum() - (t * t).sum())


def core_distances(x: np.ndarray, points: int = MIN_POINTS) -> np.ndarray:
    """Distance within which each row has so many rows, itself included; infinite if there
    are fewer rows."""
    if len(x) < points:
        return np.full(len(x), np.inf)
    out = np.empty(len(x))
    for i in range(0, len(x), BLOCK):
        out[i : i + BLOCK] = np.partition(1 - x[i : i + BLOCK] @ x.T, points - 1, axis=1)[:, points - 1]
    return out


def dbscan(x: np.ndarray, eps: float, points: int = MIN_POINTS, within: np.ndarray | None = None) -> np.ndarray:
    """Density clusters; a row on the border belongs to the cluster of the lowest core row."""
    core = (core_distances(x, points) if within is None else within) <= eps
    labels, cur = np.full(len(x), -1), 0
    for i in np.flatnonzero(core):
        if labels[i] >= 0:
            continue
        todo = np.array([i])
        labels[i] = cur
        left = np.flatnonzero(labels < 0)  # only what has no label yet is compared
        while len(todo) and len(left):
            found = []
            for j in range(0, len(todo), BLOCK):
                reached = ((1 - x[todo[j : j + BLOCK]] @ x[left].T) <= eps).any(axis=0)
                new, left = left[reached], left[~reached]
                labels[new] = cur
                found.append(new[core[new]])
            todo = np.concatenate(found)
        cur += 1
    return labels


def estimate_speakers(x: np.ndarray, tree: list | None = None) -> int:
    """Median of three estimates: silhouette, elbow, density; 2 if there is none."""
    n, found = len(x), []
    tree = merge_tree(x) if tree is None else tree
    ks = range(2, min(MAX_SPEAKERS, n - 1) + 1)
    tries = {k: cut_tree(n, tree, k) for k in ks}
    scores = {k: silhouette(x, la).mean() for k, la in tries.items() if np.bincount(la).min() >= 2}
    if scores:
        found.append(max(scores, key=lambda k: (scores[k], -k)))
    w = [dispersion(x, cut_tree(n, tree, 1))] + [dispersion(x, la) for la in tries.values()]
    if len(w) > 2:
        found.append(int(np.argmax(np.diff(w, 2))) + 3)  # w starts at one cluster, and the entry two after the bend counts
    best = None
    within = core_distances(x)
    for eps in EPS:
        la = dbscan(x, float(eps), within=within)
        k = la.max() + 1
        if k >= 2 and (la < 0).mean() < 0.5:
            s = silhouette(x, np.where(la < 0, k, la)).mean()
            if best is None or s > best[0]:
                best = (s, k)
    if best:
        found.append(best[1])
    return int(np.median(found)) if found else 2


def spectral(x: np.ndarray, k: int, seed: int = 42) -> np.ndarray:
    if len(x) > DENSE:
        return kmeans(normalize(_leading_vectors(x, k, seed)), k, seed)
    a = np.maximum(x @ x.T, 0)
    d = 1 / np.sqrt(np.maximum(a.sum(axis=1), 1e-12))
    _, v = np.linalg.eigh(a * d[:, None] * d[None, :])
    return kmeans(normalize(v[:, -k:]), k, seed)


def _leading_vectors(x: np.ndarray, k: int, seed: int, limit: float = 1e-7) -> np.ndarray:
    """Eigenvectors of the ``k`` largest eigenvalues (ascending) of the scaled similarities
    of all rows, by a block Krylov space that starts anew from its best vectors; the
    similarities are made a block of rows at a time and never kept."""

    def times(y: np.ndarray) -> np.ndarray:
        out = np.zeros((n, y.shape[1]))
        for i in range(0, n, BLOCK):  # a similarity is made once for both of its rows
            s = np.maximum(x[i : i + BLOCK] @ x[i:].T, 0)
            out[i : i + BLOCK] += s @ y[i:]
            out[i + BLOCK :] += s[:, BLOCK:].T @ y[i : i + BLOCK]
        return out

    n = len(x)
    d = 1 / np.sqrt(np.maximum(times(np.ones((n, 1))), 1e-12))
    width = k + 40
    new = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, width)))[0]
    basis, image = np.zeros((n, 0)), np.zeros((n, 0))
    for _ in range(300):
        made = d * times(d * new)
        basis, image = np.hstack([basis, new]), np.hstack([image, made])
        value, small = np.linalg.eigh(basis.T @ image)
        v, w = basis @ small[:, -width:], image @ small[:, -width:]
        off = w - v * value[-width:]
        if np.linalg.norm(off[:, -k:], axis=0).max() < limit:
            return v[:, -k:]
        if basis.shape[1] > 8 * width:
            basis, image = v, w
        new = off
        for _ in range(2):
            new = np.linalg.qr(new - basis @ (basis.T @ new))[0]
    raise RuntimeError(f"eigenvectors of {n} rows did not settle")


def kmeans(x: np.ndarray, k: int, seed: int = 42, rounds: int = 50) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = [x[rng.integers(len(x))]]
    for _ in range(1, k):
        d = np.min([((x - y) ** 2).sum(axis=1) for y in c], axis=0)
        c.append(x[int(np.argmax(d))])
    c = np.array(c)
    labels = np.zeros(len(x), int)
    for _ in range(rounds):
        new = np.concatenate([((x[i : i + BLOCK, None, :] - c[None]) ** 2).sum(axis=2).argmin(axis=1) for i in range(0, len(x), BLOCK)])
        if (new == labels).all():
            break
        labels = new
        for j in range(k):
            if (labels == j).any():
                c[j] = x[labels == j].mean(axis=0)
    return np.unique(labels, return_inverse=True)[1]


def gaussian_mixture(x: np.ndarray, k: int, seed: int = 42, rounds: int = 30) -> np.ndarray:
    """Mixture of full-covariance Gaussians, started from k-means, by expectation-maximization."""
    labels = kmeans(x, k, seed)
    r = np.eye(max(k, labels.max() + 1))[labels][:, :k]
    d = x.shape[1]
    for _ in range(rounds):
        n = r.sum(axis=0) + 1e-9
        mean = (r.T @ x) / n[:, None]
        ll = np.empty((len(x), r.shape[1]))
        for j in range(r.shape[1]):
            z = x - mean[j]
            cov = (r[:, j, None] * z).T @ z / n[j] + 1e-3 * np.eye(d)
            low = np.linalg.cholesky(cov)
            q = np.linalg.solve(low, z.T)
            ll[:, j] = np.log(n[j] / len(x)) - 0.5 * (q * q).sum(axis=0) - np.log(np.diag(low)).sum()
        new = np.exp(ll - ll.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - r).max() < 1e-4:
            break
        r = new
    return np.unique(r.argmax(axis=1), return_inverse=True)[1]


def ensemble(x: np.ndarray, k: int | None = None) -> np.ndarray:
    """Best of three methods by silhouette, or their co-membership consensus if that is better.
    A method that fails, or finds one cluster only, is left out; if all do, average link stands."""
    if len(x) < 3:
        return np.zeros(len(x), int)
    tree = merge_tree(x)
    k = min(k or estimate_speakers(x, tree), len(x) - 1)
    made, scores = [], []
    for method in (lambda: cut_tree(len(x), tree, k), lambda: spectral(x, k), lambda: gaussian_mixture(x, k)):
        try:
            la = method()
        except (np.linalg.LinAlgError, RuntimeError, ValueError):
            continue
        if 1 < la.max() + 1 < len(x):  # a silhouette needs several clusters, and fewer than rows
            made.append(la)
            scores.append(silhouette(x, la).mean())
    if not made:
        return cut_tree(len(x), tree, k)
    best = int(np.argmax(scores))
    if len(made) == 1:
        return made[best]
    # rows that all methods label alike are at distance 0 and merge first
    kinds, first, of = np.unique(np.array(made).T, axis=0, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), int)
    place[order] = np.arange(len(order))
    kinds, of = kinds[order], place[of.ravel()]
    together = np.mean([la[:, None] == la[None, :] for la in kinds.T], axis=0)
    joint = _link_matrix(1 - together, made[0].max() + 1, np.bincount(of).astype("f8"))[of]
    return joint if silhouette(x, joint).mean() > scores[best] else made[best]


def _link_matrix(d: np.ndarray, k: int, size: np.ndarray) -> np.ndarray:
    """Average link from a matrix of the distances of groups of ``size`` equal rows."""
    n = len(d)
    d = d.astype("f8").copy()
    np.fill_diagonal(d, np.inf)
    size, label = size.copy(), np.arange(n)
    for _ in range(n - k):
        a, b = sorted(divmod(int(np.argmin(d)), n))
        new = (d[a] * size[a] + d[b] * size[b]) / (size[a] + size[b])
        d[a], d[:, a] = new, new
        d[a, a] = np.inf
        d[b], d[:, b] = np.inf, np.inf
        size[a] += size[b]
        label[label == b] = a
    return np.unique(label, return_inverse=True)[1]


def confidences(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """0.6 of the silhouette brought to 0..1, 0.4 of the lead over the nearest other mean."""
    if labels.max() < 1:
        return np.ones(len(x))
    s = silhouette(x, labels)
    k = labels.max() + 1
    c, n = np.zeros((k, x.shape[1])), np.bincount(labels, minlength=k)
    np.add.at(c, labels, x)
    c /= n[:, None]
    d = 1 - x @ c.T
    own = d[np.arange(len(x)), labels].copy()
    d[np.arange(len(x)), labels] = np.inf
    other = d.min(axis=1)
    lead = np.where(other > own, (other - own) / np.where(other != 0, other, 1), 0.0)
    return np.where(n[labels] == 1, 0.5, np.clip(0.6 * (s + 1) / 2 + 0.4 * lead, 0, 1))


def drop_outliers(x: np.ndarray, limit: float = 3.0, min_left: int = 10) -> np.ndarray:
    """Mask of rows without any position beyond ``limit`` standard deviations."""
    sd = x.std(axis=0)
    z = np.abs(x - x.mean(axis=0)) / np.where(sd > 0, sd, np.inf)
    keep = (z <= limit).all(axis=1)
    return keep if keep.sum() > min_left else np.ones(len(x), bool)


def principal(x: np.ndarray, most: int = MAX_DIM) -> np.ndarray:
    """Rows in at most so many principal components; as they are if they have no more dimensions."""
    if x.shape[1] <= most:
        return x
    z = x - x.mean(axis=0)
    _, _, v = np.linalg.svd(z, full_matrices=False)
    v = v[: min(most, len(x) - 1)]
    return z @ (v * np.sign(v[np.arange(len(v)), np.abs(v).argmax(axis=1)])[:, None]).T


def local_speakers(df: DataFrame, book: str, identifier: str, vector: str, dim: int, least: int = 4) -> DataFrame:
    """``book, identifier, speaker_id, speaker_confidence, status`` per valid vector.

    Books with fewer than ``least`` valid vectors are skipped.  All vectors of a book are
    clustered, in one task: its memory grows with the book's vectors, its time with their
    pairs.
    """
    from voxloom.operators.vectors import is_valid

    v = materialize(df.where(is_valid(F.col(vector), dim)).select(F.col(book).alias("b"), F.col(identifier).alias("i"), F.col(vector).alias("v")).dropDuplicates(["b", "i"]), "vectors")
    schema = "b long, i long, speaker_id int, speaker_confidence double, status string"

    def cluster(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        raw = np.vstack(pdf["v"].to_numpy()).astype("f8")
        n = len(raw)
        if n < least:
            return pd.DataFrame({"b": pdf["b"], "i": pdf["i"], "speaker_id": -1, "speaker_confidence": 0.0, "status": "skipped"})
        keep = drop_outliers(raw)
        x = normalize(raw)
        labels, conf = np.full(n, -1), np.zeros(n)
        z = normalize(principal(x[keep])) if dim > MAX_DIM else x[keep]
        labels[keep] = ensemble(z)
        conf[keep] = confidences(z, labels[keep])
        k = labels.max() + 1
        c = np.array([x[labels == j].mean(axis=0) for j in range(k)])
        if (~keep).any():
            s = x[~keep] @ c.T
            labels[~keep], conf[~keep] = s.argmax(axis=1), s.max(axis=1) * 0.5
        return pd.DataFrame({"b": pdf["b"], "i": pdf["i"], "speaker_id": labels, "speaker_confidence": conf, "status": "completed"})

    out = materialize(v.select(F.col("b").cast("long"), F.col("i").cast("long"), "v").groupBy("b").applyInPandas(cluster, schema), "clusters")
    return out.select(F.col("b").alias(book), F.col("i").alias(identifier), "speaker_id", F.round("speaker_confidence", 6).alias("speaker_confidence"), "status")


def prune_speakers(df: DataFrame, book: str, speaker: str, confidence: str, limit: float = 0.4) -> DataFrame:
    """Confident rows of speakers that hold at least an equal share of their book's confident
    rows (two at least), speakers numbered anew from 0.  The share is that of all the book's
    speakers, those without a confident row included."""
    from voxloom.operators.sequence import relabel

    sure = df.where(F.col(confidence) >= limit)
    n = df.groupBy(book, speaker).agg(F.count_if(F.col(confidence) >= limit).alias("_n"))
    per = n.groupBy(book).agg(F.sum("_n").alias("_all"), F.count("*").alias("_k"))
    kept = n.join(per, book).where(F.col("_n") >= F.greatest(F.lit(2), F.floor(F.col("_all") * (F.lit(1.0) / F.col("_k"))))).select(book, speaker)
    return relabel(sure.join(kept, [book, speaker]), book, speaker, "new_speaker_id")


def close_pairs(v: DataFrame, dim: int, cos: float, block: int = 20_000) -> DataFrame:
    """``u > v`` ids of unit vectors with at least this cosine: each row against all, in
    blocks of bounded size sent to every task; exact."""
    n = v.count()
    parts = max(1, -(-n // block))
    out = None
    for b in range(parts):
        pdf = v.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == b).toPandas()  # at most about `block` rows
        ids, y = pdf["id"].to_numpy("int64"), (np.vstack(pdf["v"].to_numpy()).astype("f8") if len(pdf) else np.zeros((0, dim)))
        shared = v.sparkSession.sparkContext.broadcast((ids, y))

        def near(batches, shared=shared):
            ids, y = shared.value
            for p in batches:
                for i in range(0, len(p), 1000):
                    q = p.iloc[i : i + 1000]
                    a, c = np.nonzero(np.vstack(q["v"].to_numpy()).astype("f8") @ y.T >= cos)
                    u, w = q["id"].to_numpy("int64")[a], ids[c]
                    yield pd.DataFrame({"u": u[u > w], "v": w[u > w]})

        part = v.mapInPandas(near, "u long, v long")
        out = part if out is None else out.unionByName(part)
    return out


def global_merge(v: DataFrame, dim: int, distance: float = MERGE_DISTANCE) -> DataFrame:
    """``id, cluster``: average-link merges below a cosine distance, over all unit vectors.

    A merge below the distance needs a pair below it, so each connected component of the
    graph of close pairs is merged by itself, with the same result.
    """
    comp = connected_components(close_pairs(v, dim, 1 - distance))

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        ids = pdf["id"].to_numpy("int64")
        la = average_link(np.vstack(pdf["v"].to_numpy()).astype("f8"), below=distance)
        least = np.full(la.max() + 1, np.iinfo("int64").max)
        np.minimum.at(least, la, ids)
        return pd.DataFrame({"id": ids, "cluster": least[la]})

    inside = v.join(comp, v["id"] == comp["node"]).select("id", "v", "component")
    merged = inside.groupBy("component").applyInPandas(merge, "id long, cluster long")
    return v.select("id").join(merged, "id", "left").select("id", F.coalesce("cluster", "id").alias("cluster"))


def evidence_rule(members: DataFrame, cluster: str, identifier: str, book: str, samples: str, least: int = MERGE_SAMPLES) -> DataFrame:
    """Clusters over several books with fewer than ``least`` samples fall apart into
    their members; adds ``final_cluster``."""
    g = members.groupBy(cluster).agg(F.count_distinct(book).alias("_b"), F.sum(samples).alias("_s"))
    weak = (F.col("_b") > 1) & (F.col("_s") < least)
    return members.join(g, cluster).withColumn("final_cluster", F.when(weak, F.col(identifier)).otherwise(F.col(cluster))).drop("_b", "_s")


def validation_score(least_cos):
    """1 from 0.90 up, a ramp from 0.5 to 1 between 0.85 and 0.90, else 0."""
    return F.when(least_cos >= 0.9, 1.0).when(least_cos >= 0.85, 0.5 + (least_cos - 0.85) / 0.05 * 0.5).otherwise(0.0)
