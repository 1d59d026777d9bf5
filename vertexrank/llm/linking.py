"""From candidate groups to verified components, without pair rows.

``groups`` holds (key, id): ids that share a key are candidates of each other.
A group of m near copies would give m*m/2 pairs. Instead every group elects a
leader, the member that shares most with others (the original of a family of
edited copies), and all members of the groups of one leader meet as its
family: in blocks of bounded size, one task each. There a member is compared
with the leader, and members that the leader does not link are compared with
the rest of the family, in whole sets, so every pair that shares a key is
decided and no link between components is lost. A block returns at most one
row per member. A family larger than a block is dealt over salts, and every
two salts meet in a block of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shuffle_partitions, slices
from .components import components

# Text of a family that one salt holds; a task sees two salts at most.
BLOCK_BYTES = 4 * 1024 * 1024
# Text whose sets are made at once.
SLICE = 256 * 1024

Sets = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _linked(both, a, b, share: int):
    return 100 * both >= share * (a + b - both)


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which values of ``b`` are in the sorted set ``a``."""
    if not len(a):
        return np.zeros(len(b), bool)
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    return a[at] == b


def family_links(hub: int, hub_set: np.ndarray, ids: np.ndarray, values: np.ndarray, size: np.ndarray, filters: list[list[np.ndarray]], share: int):
    """Links (x, y) that span the components of a family block; the members' sets
    stand one after the other in ``values``."""
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    same = np.zeros(len(values) + 1, np.int64)
    np.cumsum(_shared(hub_set, values), out=same[1:])
    near = _linked(same[ends[1:]] - same[ends[:-1]], size, len(hub_set), share) & (size > 0)
    out = [(int(x), hub) for x in ids[near] if x != hub]
    rest = np.flatnonzero(~near)
    if not len(rest) or len(ids) < 2:
        return out
    label = np.where(near, -1, np.arange(len(ids)))
    lists = []
    for order in filters:
        tokens = np.concatenate(order)
        owner = np.repeat(np.arange(len(order)), [len(o) for o in order])
        by = np.argsort(tokens, kind="stable")
        lists.append((tokens[by], owner[by]))
    codes = None
    for i in rest.tolist():
        maybe = (label != label[i]) & (100 * np.minimum(size, size[i]) >= share * np.maximum(size, size[i]))
        for (tokens, owner), order in zip(lists, filters, strict=True):
            if not maybe.any():
                break
            hit = np.zeros(len(ids), bool)
            lo, hi = np.searchsorted(tokens, order[i], "left"), np.searchsorted(tokens, order[i], "right")
            for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
                hit[owner[a:b]] = True
            maybe &= hit
        found = np.flatnonzero(maybe)
        if not len(found):
            continue
        if len(found) <= 8:
            own = values[ends[i] : ends[i + 1]]
            both = np.array([np.count_nonzero(_shared(own, values[ends[j] : ends[j + 1]])) for j in found.tolist()])
        else:
            if codes is None:
                codes = np.unique(values, return_inverse=True)[1]
                flag = np.zeros(len(values) + 1, bool)
            own = codes[ends[i] : ends[i + 1]]
            flag[own] = True
            total = np.zeros(len(values) + 1, np.int32)
            np.cumsum(flag[codes], out=total[1:])
            flag[own] = False
            both = (total[ends[1:]] - total[ends[:-1]])[found]
        for j in found[_linked(both, size[i], size[found], share)].tolist():
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[i]] = label[j]
    return out


def verify_families(tried: DataFrame, rows: DataFrame, sets: Sets, share: int, filters: Sequence[str]) -> DataFrame:
    """Verified links ``a, b`` within the families ``x, y`` (member, leader).

    ``rows``: ``id, text, filters...`` (materialised, one row per id)."""
    n = shuffle_partitions(tried.sparkSession)
    weight = rows.select(F.col("id").alias("x"), F.octet_length("text").alias("w"))
    salts = cut(tried.join(weight, "x").groupBy("y").agg(F.ceil(F.sum("w") / BLOCK_BYTES).cast("int").alias("salts")))
    salts = salts.select("y", F.greatest("salts", F.lit(1)).alias("salts"))
    every = F.sequence(F.lit(0), F.col("salts") - 1)
    hubs = (
        salts.join(rows.withColumnRenamed("id", "y"), "y")
        .select("y", "salts", F.explode(every).alias("lo"), "text", *filters)
        .select("y", "lo", F.explode(F.sequence("lo", F.col("salts") - 1)).alias("hi"), F.lit(None).cast("long").alias("x"), "text", *filters)
    )
    own = F.pmod(F.xxhash64("x"), F.col("salts")).cast("int")
    members = (
        tried.join(salts, "y")
        .join(rows.withColumnRenamed("id", "x"), "x")
        .select("y", "x", own.alias("own"), F.explode(every).alias("other"), "text", *filters)
        .select("y", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "x", "text", *filters)
    )
    dealt = hubs.unionByName(members).repartition(n, "y", "lo", "hi").sortWithinPartitions("y", "lo", "hi", F.col("x").asc_nulls_first())

    def run(batches):
        key, block, links = None, None, []

        def finish():
            if block["ids"]:
                joined = [np.concatenate(block[c]) for c in ("ids", "values", "size")]
                links.extend(family_links(key[0], block["hub"], *joined, block["filters"], share))

        def found():
            out = pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in links], pa.int64()), "b": pa.array([p[1] for p in links], pa.int64())})
            links.clear()
            return out

        for batch in batches:
            for part in slices(batch, "text", SLICE):
                values, ranges = sets(part.column("text"))
                y, lo, hi = (part.column(c).to_numpy(zero_copy_only=False) for c in ("y", "lo", "hi"))
                leader = part.column("x").is_null().to_numpy(zero_copy_only=False)
                xs = part.column("x").fill_null(0).to_numpy(zero_copy_only=False)
                extra = [part.column(c) for c in filters]
                edges = np.flatnonzero((y[1:] != y[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
                for at, end in zip([0, *edges.tolist()], [*edges.tolist(), len(y)], strict=True):
                    if (y[at], lo[at], hi[at]) != key:
                        if key is not None:
                            finish()
                        key = (int(y[at]), int(lo[at]), int(hi[at]))
                        block = {"hub": values[:0], "ids": [], "values": [], "size": [], "filters": [[] for _ in filters]}
                    while at < end and leader[at]:
                        block["hub"] = values[ranges[at] : ranges[at + 1]]
                        at += 1
                    if at == end:
                        continue
                    block["ids"].append(xs[at:end])
                    block["values"].append(values[ranges[at] : ranges[end]])
                    block["size"].append(np.diff(ranges[at : end + 1]))
                    for k, column in enumerate(extra):
                        block["filters"][k] += [column[i].values.to_numpy(zero_copy_only=False).copy() for i in range(at, end)]
                if links:
                    yield found()
        if key is not None:
            finish()
        if links:
            yield found()

    return dealt.mapInArrow(run, "a long, b long")


def link_groups(
    groups: DataFrame,
    texts_of: Callable[[DataFrame], DataFrame],
    sets: Sets,
    share: int,
    filters: DataFrame | None = None,
) -> DataFrame:
    """``id, component`` of every id with a verified link.

    ``groups``: ``key, id`` (distinct, materialised; groups of one allowed).
    ``texts_of(ids)`` returns ``id, text`` for a table of ids. ``filters``:
    ``id`` and array columns; two ids can link only if they share a value in
    every one of these columns.
    """
    sizes = groups.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    groups = cut(groups.join(sizes, "key").select("key", "id", "size"))
    centre = groups.groupBy("id").agg(F.sum("size").alias("centre"))
    led = cut(groups.join(centre, "id").groupBy("key").agg(F.max(F.struct("centre", (-F.col("id")).alias("m"))).alias("top")))
    led = led.select("key", (-F.col("top.m")).alias("y"))
    tried = cut(groups.join(led, "key").where("id <> y").select(F.col("id").alias("x"), "y").distinct())
    rows = texts_of(groups.select("id").distinct())
    names: list[str] = []
    if filters is not None:
        names = [c for c in filters.columns if c != "id"]
        rows = rows.join(filters, "id")
    links = cut(verify_families(tried, rows, sets, share, names))
    return components(links)
