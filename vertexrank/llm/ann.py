"""Approximate nearest neighbours with an inverted multi-index.

Vectors are split into halves, each quantised by its own k-means codebook of K
centroids (fitted on a bounded sample); a vector lives in the cell of its two
nearest centroids. A query ranks the centroids of each half by distance and
visits the K * K cells in order of the summed squared distances, popped from a
heap (the multi-sequence walk), until the visited cells hold ``share`` of all
vectors; the vectors of those cells are reranked by exact Euclidean distance in
double precision.

All vectors are indexed. Equal vectors are one entry that lists the smallest
``k + 1`` ids, all that a top-k with ties to smaller ids can need, so a vector
repeated a third of all times costs one entry (the ids are cut by a group limit
that Spark applies before the shuffle). Entries are dealt in blocks of about
``BLOCK`` from consecutive cells (a fuller cell is spread over several blocks);
a query goes to every block that holds cells it visits, with their list.

``SHARE`` is set by measurement: the supplied vectors are nearly uniform on a
sphere of 64 dimensions, where a query's 10 nearest are hardly closer than the
rest (1.05 against 1.41); the first half of the
vectors in walk order holds about 95 % of them, and ``SHARE`` leaves a margin for
small tables.

Defined cases: vectors that are null, zero or hold null or non-finite
components, of another length than the most common one, and rows without id
take no part; a query finds itself never, but its copies under other ids; with
fewer than ``k`` candidates all are returned; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, final, scratch, shuffle_partitions

SAMPLE = 20_000
BLOCK = 2048
SHARE = 0.65


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd iterations from evenly spaced rows of the sample."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = nearest(x, centres)
        for j in range(k):
            at = own == j
            if at.any():
                centres[j] = x[at].mean(axis=0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None] - 2 * x @ centres.T).argmin(axis=1)


def walk(first: np.ndarray, second: np.ndarray, count: np.ndarray, wanted: float) -> list[int]:
    """Cells (i * K + j) by summed distance until they hold ``wanted`` entries."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    k, held, out = len(first), 0, []
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i]) * k + int(b[j])
        if count[cell]:
            out.append(cell)
            held += int(count[cell])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < k and q < k and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` (array of double) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select("vec_id", v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    return rows.where(F.forall("v", fine) & F.exists("v", lambda x: x != 0))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, cells_per_half: int | None = None, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each of ``queries`` (``vec_id, v``,
    rows of ``vectors`` = ``vec_id, v``) the k nearest found among ``vectors``."""
    spark = vectors.sparkSession
    with scratch(spark):
        held = cut(vectors)
        sizes = held.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").head(1)
        if not sizes or not sizes[0]["d"]:
            return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
        dim = sizes[0]["d"]
        held = held.where(F.size("v") == dim)
        # equal vectors (0.0 and -0.0 alike) are one entry with its k + 1 smallest ids
        key = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
        held = held.withColumn("v", key)
        place = Window.partitionBy("v").orderBy("vec_id")
        entries = held.distinct().withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1)
        entries = cut(entries.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
        total = entries.count()
        half = dim // 2
        kk = cells_per_half or int(min(1024, max(2, round((total / 4) ** 0.5))))

        # the codebooks are fitted on at most SAMPLE entries, chosen by hash
        near = F.xxhash64("v")
        rate = min(1.0, 1.2 * SAMPLE / total)
        sample = entries.where(F.pmod(near, F.lit(1_000_000)) < int(rate * 1_000_000) + 1).orderBy(near, F.element_at("ids", 1)).limit(SAMPLE)
        x = np.array([r[0] for r in sample.select("v").collect()], np.float64)
        kk = min(kk, len(x))
        books = kmeans(x[:, :half], kk), kmeans(x[:, half:], kk)

        def assign(batches):
            for batch in batches:
                m = _matrix(batch.column("v"))
                cell = nearest(m[:, :half], books[0]) * kk + nearest(m[:, half:], books[1]) if len(m) else np.zeros(0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell, pa.int32()), batch.column("ids"), batch.column("v")], names=["cell", "ids", "v"]
                )

        placed = cut(entries.mapInArrow(assign, "cell int, ids array<bigint>, v array<double>"))
        filled = placed.groupBy("cell").agg(F.count("*").alias("n")).collect()  # at most kk * kk rows
        count = np.zeros(kk * kk, np.int64)
        for r in filled:
            count[r["cell"]] = r["n"]
        wanted = max(share * total, min(total, 50 * k))
        spread = np.maximum(1, -(-count // BLOCK))
        first = np.append(0, np.cumsum(count))[:-1] // BLOCK

        def visit(batches):
            for batch in batches:
                m = _matrix(batch.column("v"))
                if not len(m):
                    continue
                d1 = ((m[:, None, :half] - books[0][None]) ** 2).sum(axis=2)
                d2 = ((m[:, None, half:] - books[1][None]) ** 2).sum(axis=2)
                row, block, cells = [], [], []
                for i in range(len(m)):
                    seen = np.sort(np.array(walk(d1[i], d2[i], count, wanted), np.int64))
                    at = np.repeat(seen, spread[seen])
                    to = first[at] + np.arange(len(at)) - np.repeat(np.cumsum(spread[seen]) - spread[seen], spread[seen])
                    by = np.argsort(to, kind="stable")
                    names, starts = np.unique(to[by], return_index=True)
                    for b, own in zip(names.tolist(), np.split(at[by], starts[1:]), strict=True):
                        row.append(i)
                        block.append(b)
                        cells.append(own)
                at = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int64()), batch.column("vec_id").take(at), batch.column("v").take(at), pa.array(cells, pa.list_(pa.int64()))],
                    names=["block", "query_id", "v", "cells"],
                )

        asked = queries.where(F.size("v") == dim).withColumn("v", key).distinct()
        asked = asked.repartition(shuffle_partitions(spark), "vec_id").mapInArrow(visit, "block long, query_id long, v array<double>, cells array<bigint>")
        full = np.flatnonzero(count)
        layout = spark.createDataFrame([(int(c), int(first[c]), int(spread[c])) for c in full], "cell int, first long, spread int")
        packed = placed.join(F.broadcast(layout), "cell").select(  # at most kk * kk rows
            (F.col("first") + F.pmod(F.xxhash64("v"), F.col("spread"))).alias("block"), "cell", F.lit(None).cast("long").alias("query_id"), "v", "ids", F.lit(None).cast("array<bigint>").alias("cells")
        )
        asked = asked.select("block", F.lit(None).cast("int").alias("cell"), "query_id", "v", F.lit(None).cast("array<bigint>").alias("ids"), "cells")
        dealt = packed.unionByName(asked).repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", F.col("query_id").asc_nulls_first())

        def rerank(batches):
            # the entries of a block come first, then the queries that visit it
            key, rows, ids, of_cell, flat = None, [], [], [], None
            for batch in batches:
                m = _matrix(batch.column("v"))
                at, cell = batch.column("block").to_pylist(), batch.column("cell").to_pylist()
                asked_ids, listed = batch.column("query_id").to_pylist(), batch.column("ids").to_pylist()
                out_q, out_v, out_d = [], [], []
                for i in range(len(m)):
                    if at[i] != key:
                        key, rows, ids, of_cell, flat = at[i], [], [], [], None
                    if asked_ids[i] is None:
                        rows.append(m[i])
                        ids.append(listed[i])
                        of_cell.append(cell[i])
                        continue
                    if not rows:
                        continue
                    if flat is None:
                        flat = np.array(rows)
                        owner = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
                        names = np.concatenate([np.array(x, np.int64) for x in ids])
                        cells = np.array(of_cell)
                    visited = np.isin(cells, batch.column("cells")[i].values.to_numpy())
                    d = np.full(len(flat), np.inf)
                    d[visited] = np.sqrt(((flat[visited] - m[i]) ** 2).sum(axis=1))
                    d = d[owner]
                    there = (names != asked_ids[i]) & (d < np.inf)
                    d, own = d[there], names[there]
                    best = np.lexsort((own, d))[:k]
                    out_q += [asked_ids[i]] * len(best)
                    out_v += own[best].tolist()
                    out_d += d[best].tolist()
                yield pa.RecordBatch.from_pydict({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()), "score": pa.array(out_d, pa.float64())})

        found = dealt.mapInArrow(rerank, "query_id long, vec_id long, score double")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
        return final(found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def neighbours(vectors: DataFrame, every: int = 100, k: int = 10, share: float = SHARE) -> DataFrame:
    """The queries are the rows whose ``vec_id`` is divisible by ``every``."""
    rows = usable(vectors)
    return search(rows, rows.where(F.col("vec_id") % every == 0), k, share=share)
