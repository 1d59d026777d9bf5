"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item leaks into a document when at least ``share`` per cent of its
distinct 5-word shingles are among the document's. An item is short and a
document may be long, so their Jaccard similarity is tiny and plain MinHash
would miss it. Items are therefore partitioned by size class (u/2, u], and for
each class the document is searched in windows of 2u shingles that overlap by
u: an item that lies in the document lies in one window, where its similarity
is at least 0.19. Windows carry one-permutation MinHash signatures (64 bins,
4 to 64 rounds, more for short items); a window and an item that agree in a
bin are candidates (missed with probability below 1e-5), and candidates are
verified by exact containment in the whole document.

The minimum of an item's bin is one of its shingles, so only windows that hold
a shingle of the benchmark can agree in a bin: signatures are computed for
those alone, after one pass of the document's shingles through a bit table.

The items are the query set: their distinct shingle sets go to the tasks in
blocks of at most ``BLOCK_SHINGLES`` shingles (a larger set is a block of its
own; one pass over the documents per block), so what is broadcast is bounded
whatever the size of the benchmark and however often an id or a text repeats.
Sets are searched by a 64-bit hash; item ids are joined to what was found.
Documents are not shuffled.

Defined cases: null or empty documents and items match nothing; an item of
fewer than five words is one shingle (its whole sequence) and matches only
documents made of just these words; a null ``item_id`` is a value like any
other; repeated rows give the same pairs once per distinct (doc_id, item_id);
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, join_checked, join_text, list_of, utf8
from .hashing import U, as_long, distinct_sets, mix, shingles

WORDS = 5
BINS = 64
BLOCK_SHINGLES = 200_000
TABLE_BITS = 22


def size_class(n: int) -> int:
    """Smallest power of two that is at least n."""
    return 1 << max(0, int(n - 1).bit_length())


def rounds_of(u: int) -> int:
    return max(4, 64 // max(1, u // 2))


def signature(values: np.ndarray, rounds: int) -> np.ndarray:
    """Minimum of every (round, bin); all ones where a bin is empty."""
    seeds = mix(np.arange(1, rounds + 1, dtype=U) * U(0xD1342543DE82EF95))
    g = mix(values[None, :] ^ seeds[:, None])
    out = np.full((rounds, BINS), U(0xFFFFFFFFFFFFFFFF))
    np.minimum.at(out, (np.arange(rounds)[:, None], (g >> U(58)).astype(np.int64)), g)
    return out


class ItemIndex:
    """The items of one block: their shingles, signatures and size classes."""

    def __init__(self, rows: list[tuple[int, np.ndarray]]):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.sets = [r[1] for r in rows]
        self.classes = [size_class(len(s)) for s in self.sets]
        self.signatures = [signature(s, rounds_of(u)) for s, u in zip(self.sets, self.classes, strict=True)]
        flat = np.concatenate(self.sets)
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in self.sets])
        order = np.argsort(flat, kind="stable")
        self.values, self.owner = flat[order], owner[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(flat >> U(64 - TABLE_BITS)).astype(np.int64)] = True

    def leaks(self, values: np.ndarray, share: int, hits: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of one document; ``hits``: positions of its
        shingles that occur in the benchmark."""
        held = np.unique(values[hits])
        tested: dict[int, bool] = {}
        windows: dict[tuple[int, int], np.ndarray] = {}
        for at in hits.tolist():
            lo = int(np.searchsorted(self.values, values[at]))
            while lo < len(self.values) and self.values[lo] == values[at]:
                item = int(self.owner[lo])
                lo += 1
                if tested.get(item):
                    continue
                u = self.classes[item]
                for w in {max(0, at // u - 1), at // u}:
                    if (u, w) not in windows:
                        windows[u, w] = signature(values[w * u : (w + 2) * u], rounds_of(u))
                    own = self.signatures[item]
                    if ((windows[u, w] == own) & (own != U(0xFFFFFFFFFFFFFFFF))).any():
                        tested[item] = True
                        break
        out = []
        for item in tested:
            shared = int(np.isin(self.sets[item], held, assume_unique=True).sum())
            if 100 * shared >= share * len(self.sets[item]):
                out.append((item, shared))
        return out


def _search(index: ItemIndex, share: int):
    def make(part: pa.RecordBatch) -> dict:
        values, ranges = shingles(*utf8(part.column("text")), WORDS)
        near = np.flatnonzero(index.table[(values >> U(64 - TABLE_BITS)).astype(np.int64)])
        place = np.searchsorted(index.values, values[near])
        place[place == len(index.values)] = 0
        near = near[index.values[place] == values[near]]
        bounds = np.searchsorted(near, ranges)
        keys = [c for c in part.schema.names if c != "text"]
        out = {"row": [], "key": [], "n_item": [], "n_shared": []}
        for d in np.flatnonzero(np.diff(bounds)).tolist():
            own = values[ranges[d] : ranges[d + 1]]
            for item, shared in index.leaks(own, share, near[bounds[d] : bounds[d + 1]] - ranges[d]):
                out["row"].append(d)
                out["key"].append(int(index.ids[item]))
                out["n_item"].append(len(index.sets[item]))
                out["n_shared"].append(shared)
        row = pa.array(out.pop("row"), pa.int64())
        return out | {c: part.column(c).take(row) for c in keys}

    return make


def _item_sets(part: pa.RecordBatch) -> dict:
    values, ranges = distinct_sets(*shingles(*utf8(part.column("text")), WORDS))
    return {"item_id": part.column("item_id"), "shingles": list_of(as_long(values), ranges, pa.int64())}


def _blocks(sets: DataFrame) -> Iterator[list[tuple[int, np.ndarray]]]:
    """The distinct sets (``key, shingles``), filled up to ``BLOCK_SHINGLES`` a block."""
    sets = cut(sets.groupBy("key").agg(F.first("shingles").alias("shingles")))
    total = sets.agg(F.sum(F.size("shingles"))).head()[0] or 0
    rows = sets.repartition(max(1, -(-total // BLOCK_SHINGLES)), "key").sortWithinPartitions("key")
    block, held = [], 0
    for key, shingles_ in rows.toLocalIterator():  # the driver holds a partition and a block
        if block and held + len(shingles_) > BLOCK_SHINGLES:
            yield block
            block, held = [], 0
        block.append((key, np.array(shingles_, np.int64).view(U)))
        held += len(shingles_)
    if block:
        yield block


def _item_table(items: DataFrame) -> DataFrame:
    sets = arrow_map(items.select("item_id", "text"), "text", _item_sets, "item_id long, shingles array<bigint>")
    return cut(sets.where("size(shingles) > 0").select("item_id", F.xxhash64("shingles").alias("key"), "shingles"))


def _leaks_of(docs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The columns of ``docs`` but ``text``, with ``key, n_item, n_shared`` of every set found."""
    kept = "".join(f"{c} long, " for c in docs.columns if c != "text")
    schema = f"{kept}key long, n_item long, n_shared long"
    out, last = None, None
    for block in _blocks(sets):
        if last is not None:  # searched before the next block is built: the driver holds two at most
            found = cut(last)
            out = found if out is None else out.unionByName(found)
        last = arrow_map(docs, "text", _search(ItemIndex(block), share), schema)
    if last is None:
        return docs.sparkSession.createDataFrame([], schema)
    return last if out is None else out.unionByName(last)


def find_leaks(docs: DataFrame, items: DataFrame, share: int = 80) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of every leak of an
    item (``item_id, text``) into a document (``doc_id, text``)."""
    sets = _item_table(items)
    names = cut(sets.select("key", "item_id").distinct())
    found = join_checked(_leaks_of(docs.select("doc_id", "text"), sets, share), names, "key", "inner", 24)
    found = found.select("doc_id", "item_id", "n_item", "n_shared")
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item")).distinct()


def drop_leaks(docs: DataFrame, items: DataFrame, share: int = 80) -> DataFrame:
    """``docs`` without the documents that an item leaks into, judged by id and
    text (rows without id too)."""
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th"))
    gone = cut(_leaks_of(rows, _item_table(items), share).select("doc_id", "th").distinct())
    return join_text(docs, gone, "left_anti", 24)
