"""Problem 8: items packed into containers of fixed capacity, bulk-synchronous best fit.

Items are taken in bands of falling size, so that large items open containers and small
ones fill them up.  A superstep of a band sorts its items and the gaps of the open
containers by size into ranges, together.  Every range sweeps downwards: each item, the
largest first, goes to its successor, the tightest gap of the range that holds it.  What a
sweep leaves - items that found no gap, gaps that nothing touched - is matched across the
ranges by rank: going down the whole order, an item takes the nearest gap above it that no
item before it took, which is the matching of parentheses, so the conflict over a gap is
decided by the nesting level that both have.  Then the gaps are updated and the superstep is
repeated while matches across ranges are still found.  Items that no gap can hold open new
containers, range by range.

No task sees more than a range: ranges are cut by the number of rows (ties are cut by a
hash), levels hold at most an item and a gap per range, and the driver sees counts per kind.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.tokens import DEFAULT_RANKS, token_count
from voxloom.session import materialize, release

#: Rows of items and gaps that one task sweeps.
RANGE_ROWS = 50_000
#: Items per full container at which the bands of sizes end.
BANDS = (1, 2, 3, 4, 8, 16, 64)


def sweep(sizes: list[int], gaps: list[int], ids: list[int], capacity: int | None = None) -> tuple[list[int], dict[int, list[int]], int]:
    """Best fit of falling ``sizes`` into gaps: the container of each item, the containers by
    the gap they have left, and how many were opened.

    Without ``capacity`` an item that fits nowhere gets -1; with it, it opens a container,
    called -2, -3, ...
    """
    by: dict[int, list[int]] = {}
    for g, i in zip(gaps, ids):
        by.setdefault(g, []).append(i)
    order, out, opened = sorted(by), [], 0
    for size in sizes:
        at = bisect_left(order, size)
        if at < len(order):
            gap = order[at]
            c = by[gap].pop()
            if not by[gap]:
                del by[gap]
                order.pop(at)
        elif capacity is not None:
            gap, c, opened = capacity, -2 - opened, opened + 1
        else:
            out.append(-1)
            continue
        out.append(c)
        if gap > size:
            if gap - size not in by:
                by[gap - size] = []
                insort(order, gap - size)
            by[gap - size].append(c)
    return out, by, opened


def _swept(items: DataFrame, gaps: DataFrame | None, rows: int, per_task: int, open_new: bool) -> DataFrame:
    """One sweep of all ranges.  ``what`` is p (an item placed), u (a gap that was touched or
    opened), i and g (items and gaps left), or s (a range's balance of the two)."""
    kind = items.schema["item_id"].dataType.simpleString()
    both = items.select("kind", "capacity", "v", F.lit(1).alias("side"), F.lit(-1).cast("long").alias("cid"), "item_id", "piece", "first_token")
    if gaps is not None:
        none = [F.lit(None).cast(t).alias(c) for c, t in (("item_id", kind), ("piece", "long"), ("first_token", "long"))]
        both = both.unionByName(gaps.select("kind", F.lit(0).cast("long").alias("capacity"), "v", F.lit(0).alias("side"), "cid", *none))
    # the hash cuts a size that very many rows share
    order = [F.col("kind"), F.col("v").desc(), F.col("side"), F.xxhash64("cid", "item_id", "piece")]
    columns = ["what", "kind", "capacity", "cid", "item_id", "piece", "first_token", "v", "pid", "off"]

    def work(batches):
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        parts = [b for b in batches if len(b)]
        if not parts:
            return
        for name, pdf in pd.concat(parts, ignore_index=True).groupby("kind", sort=False):
            it, gp = pdf[pdf["side"] == 1], pdf[pdf["side"] == 0]
            before = dict(zip(gp["cid"].tolist(), gp["v"].tolist()))
            at, by, _ = sweep(it["v"].tolist(), list(before.values()), list(before), int(it["capacity"].iloc[0]) if open_new and len(it) else None)
            at = np.array(at, "int64")
            placed, left = it[at != -1], it[at == -1]
            out = [placed.assign(what="p", cid=at[at != -1], off=0), left.assign(what="i", off=-np.arange(len(left)))]
            touched = [(g, c) for g, cs in by.items() for c in cs if before.get(c) != g]
            free = sorted(((g, c) for g, cs in by.items() for c in cs if before.get(c) == g), reverse=True)
            for what, rows_ in (("u", touched), ("g", free)):
                off = np.arange(len(rows_)) + 1 - len(left) if what == "g" else 0
                out.append(pd.DataFrame({"what": what, "kind": name, "capacity": 0, "cid": [c for _, c in rows_], "item_id": None, "piece": None, "first_token": None, "v": [g for g, _ in rows_], "off": off}))
            out.append(pd.DataFrame({"what": ["s"], "kind": name, "capacity": 0, "cid": 0, "item_id": None, "piece": None, "first_token": None, "v": len(free) - len(left), "off": 0}))
            for o in out:
                if len(o):
                    yield o.assign(pid=pid)[columns]

    schema = f"what string, kind string, capacity long, cid long, item_id {kind}, piece long, first_token long, v long, pid int, off long"
    return both.repartitionByRange(-(-rows // per_task), *order).sortWithinPartitions(*order).mapInPandas(work, schema)


def _across(out: DataFrame) -> DataFrame:
    """Items and gaps that the ranges left, matched by nesting level: rows as in ``_swept``."""
    before = Window.partitionBy("kind").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    depth = out.where("what = 's'").select("kind", "pid", F.coalesce(F.sum("v").over(before), F.lit(0)).alias("depth"))  # a row per range
    rows = out.where("what in ('i', 'g')").join(depth, ["kind", "pid"]).withColumn("level", F.col("depth") + F.col("off"))
    w = Window.partitionBy("kind", "level").orderBy("pid", F.desc("what"))  # an item and a gap per range at most; the item comes first
    rows = rows.withColumns({"_w": F.lag("what").over(w), "_c": F.lag("cid").over(w), "_nw": F.lead("what").over(w), "_nv": F.lead("v").over(w)})
    hit, taken = (F.col("what") == "i") & F.col("_w").eqNullSafe("g"), (F.col("what") == "g") & F.col("_nw").eqNullSafe("i")
    rows = rows.withColumns({"cid": F.when(hit, F.col("_c")).otherwise(F.col("cid")), "v": F.when(taken, F.col("v") - F.col("_nv")).otherwise(F.col("v"))})
    return rows.withColumn("what", F.when(hit, "p").when(taken, "u").otherwise(F.col("what"))).select(out.columns)


def _counts(out: DataFrame) -> dict[tuple[str, str], int]:
    return {(r["what"], r["kind"]): r["n"] for r in out.where("what != 's'").groupBy("what", "kind").agg(F.count("*").alias("n")).collect()}  # a few kinds


def _numbered(out: DataFrame, base: dict[str, int]) -> tuple[DataFrame, dict[str, int]]:
    """Containers that ranges opened get their numbers, from ``base`` on in the order of the ranges."""
    per = out.where("cid < -1").groupBy("kind", "pid").agg((-1 - F.min("cid")).alias("n"))  # a row per range
    before = Window.partitionBy("kind").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    start = per.select("kind", "pid", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    total = {r["kind"]: r["n"] for r in per.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    first = F.create_map(*[x for k in sorted({*base, *total}) for x in (F.lit(k), F.lit(base.get(k, 0)).cast("long"))]) if {*base, *total} else F.lit(None)
    named = out.join(start, ["kind", "pid"], "left")
    named = named.withColumn("cid", F.when(F.col("cid") < -1, F.element_at(first, F.col("kind")) + F.col("_start") - 2 - F.col("cid")).otherwise(F.col("cid"))) if total else named
    return named.select(out.columns), {k: base.get(k, 0) + total.get(k, 0) for k in {*base, *total}}


def pack_items(items: DataFrame, kinds: DataFrame, per_task: int = RANGE_ROWS, settle: float = 0.01) -> DataFrame:
    """``container_kind, container_id, item_id, piece, first_token, n_tokens``.

    ``items`` has ``item_id, n_tokens`` (unique ids), ``kinds`` has ``container_kind,
    capacity_tokens`` (a few rows).  Items without tokens take no room and are left out.
    An item longer than a container is cut into pieces of a whole container and a rest;
    no other is cut.  Containers are numbered from 0 within a kind.  A band's supersteps
    end when matches across ranges fall below ``settle`` of its items; what is left opens
    containers, so nothing is ever left out.
    """
    caps = {r["container_kind"]: int(r["c"]) for r in kinds.where("capacity_tokens > 0 and container_kind is not null").groupBy("container_kind").agg(F.max("capacity_tokens").alias("c")).collect()}
    some = items.where("n_tokens > 0").select("item_id", F.col("n_tokens").cast("long").alias("n_tokens"))
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("long").alias("capacity")) for k, c in sorted(caps.items())]) if caps else F.array().cast("array<struct<kind:string,capacity:bigint>>")
    cut = some.select("item_id", "n_tokens", F.inline(each))
    first = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / F.col("capacity"))))
    pieces = cut.select("kind", "capacity", "item_id", "n_tokens", first.alias("piece")).withColumn("first_token", F.col("piece") * F.col("capacity"))
    pieces = pieces.withColumn("v", F.least("capacity", F.col("n_tokens") - F.col("first_token")))
    fit = F.floor(F.col("capacity") / F.col("v"))
    band = sum(((fit >= b).cast("int") for b in BANDS[1:]), F.lit(0))
    pieces = materialize(pieces.drop("n_tokens").withColumn("band", band), "pieces", by="band")
    sizes = {r["band"]: r["n"] for r in pieces.groupBy("band").agg(F.count("*").alias("n")).collect()}  # one row per band

    placed: list[DataFrame] = []
    gaps: DataFrame | None = None
    n_gaps, base = 0, {k: 0 for k in caps}
    keep = lambda d: d.where("what = 'p'").select("kind", "cid", "item_id", "piece", "first_token", "v")
    gap_rows = lambda d: d.where("what in ('u', 'g') and v > 0").select("kind", "cid", "v")
    for b in sorted(sizes):
        left, n_left = pieces.where(F.col("band") == b).drop("band"), sizes[b]
        # a gap smaller than all sizes of this band and those after it is of no use any more;
        # one smaller than this band's sizes waits for the next
        while n_left:
            one = n_left + n_gaps <= per_task
            out = _swept(left, gaps, n_left + n_gaps, per_task, one)
            if one:
                raw = materialize(out, "raw")
                out, base = _numbered(raw, base)
                out = materialize(out, "sweep")
                release(raw)
                placed.append(keep(out))
                gaps, n_left = gap_rows(out), 0
                n_gaps = gaps.count()
                break
            out = materialize(out, "sweep")
            more = materialize(_across(out), "across")
            had, now = _counts(out), _counts(more)
            placed += [keep(out), keep(more)]
            grown = materialize(gap_rows(out.where("what = 'u'")).unionByName(gap_rows(more)), "gaps")
            gaps = grown
            left = more.where("what = 'i'").select("kind", "capacity", "v", "item_id", "piece", "first_token")
            n_gaps = sum(n for (w, _), n in [*had.items(), *now.items()] if w == "u") + sum(n for (w, _), n in now.items() if w == "g")
            n_left = sum(n for (w, _), n in now.items() if w == "i")
            if n_left and sum(n for (w, _), n in now.items() if w == "p") <= settle * sizes[b]:
                raw = materialize(_swept(left, None, n_left, per_task, True), "raw")
                new, base = _numbered(raw, base)
                new = materialize(new, "open")
                release(raw)
                placed.append(keep(new))
                grown = materialize(gaps.unionByName(gap_rows(new)), "gaps")
                release(gaps)
                gaps, n_left = grown, 0
                n_gaps = gaps.count()
    if not placed:
        placed = [pieces.select("kind", F.lit(0).cast("long").alias("cid"), "item_id", "piece", "first_token", "v")]
    else:
        release(pieces)
    all_ = placed[0]
    for p in placed[1:]:
        all_ = all_.unionByName(p)
    return all_.select(F.col("kind").alias("container_kind"), F.col("cid").alias("container_id"), "item_id", "piece", "first_token", F.col("v").alias("n_tokens"))


def pack_documents(docs: DataFrame, kinds: DataFrame, ranks: str = DEFAULT_RANKS) -> DataFrame:
    """Pack documents by their token counts; see :func:`pack_items`."""
    items = docs.select(F.col("doc_id").alias("item_id"), token_count(F.col("text"), ranks).alias("n_tokens"))
    return pack_items(items, kinds).withColumnRenamed("item_id", "doc_id")


def pack_report(packed: DataFrame, kinds: DataFrame) -> DataFrame:
    """Per kind: containers, pieces, tokens and the share of the room that is used."""
    got = packed.groupBy("container_kind").agg(F.count_distinct("container_id").alias("n_containers"), F.count("*").alias("n_pieces"), F.sum("n_tokens").alias("n_tokens"))
    caps = kinds.groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    return got.join(caps, "container_kind").withColumn("used_share", F.col("n_tokens") / (F.col("n_containers") * F.col("capacity_tokens")))
