"""Cross-tokenizer alignment with inverted pair bitmaps.

Each text is encoded by two vocabularies, A (byte-level BPE) and B (pieces with
byte fallback), over the same bytes: a space and the text. Byte offsets where
tokens of both end cut them into groups; an A and a B token whose byte ranges
overlap are a link. Since both cover the bytes without gaps, links are the
stretches between neighbouring ends of either.

The pairs (A id, B id) of all documents form an inverted index. Documents are
numbered in blocks of bounded text, and a pair has one compressed bitmap per
block that says which documents hold it: a sorted list of 16-bit numbers, or a
bit set where that is shorter. Bitmaps of one block are merged (OR) as its
slices come in; those of different blocks are disjoint, so a pair's document
count is the sum of their popcounts. How often a document holds a pair, less
one, is kept in bit planes, bitmaps of the same form: the pair's links are the
document count plus ``2**(plane - 1)`` times the popcount of each plane.
Counts, and whether a pair is the best of its A id, return along these postings
to the block, where each document's links are scored.

A pair in every document costs one bitmap per block; the join that carries the
scores is one adaptive execution splits where a pair is hot. An A id meets at
most all B ids, which bounds its window.

No token of either vocabulary crosses from a visible character to a blank, so
texts are cut there into units, words with the blank before them. A unit is
encoded and aligned once and then looked up; a task remembers a bounded number
of them. (For a vocabulary B whose pieces cross such places the unit is the text.)

Defined cases: null or empty texts, and texts whose joined tokens are not the
space and the text in either vocabulary, have no tokens: zeros and empty
``groups_sha256``. Every row is a document of its own, rows repeated or without
id included; strings of special tokens are plain text; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_BYTES, cut, final, scratch, shuffle_partitions, slices
from .token_count import byte_symbols

# a block ends at this much text (a longer text is a block alone), or at so many documents
BLOCK_BYTES = 8 * 1024 * 1024
BLOCK_DOCS = 1 << 16
STRETCH = 1 << 16
# units remembered in a task, by number and by characters
CACHE_UNITS, CACHE_CHARS = 300_000, 1 << 24
JOINED = 500  # units encoded in one call
MARKS = ",|;"
BLANK = re.compile(r"(?<=\S) (?!\Z)")
_ID_BITS, _DOC_BITS = 24, 16

INDEX = "block long, n_docs int, a int, b int, plane int, n int, bits binary"
ROW = "idx int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


class Encoders:
    """Both tokenizers, and the bytes of every token. Sent to tasks as a broadcast."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        if (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError(f"no byte-level vocabulary without added prefix: {a_path}")
        byte_of = {c: b for b, c in enumerate(byte_symbols())}
        self.a_bytes = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        self.b = SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        # without a piece that holds a space after a visible character none crosses such a
        # place, and what stands between two of them has the same tokens wherever it stands
        kept = b"".join(self.b_bytes[i] for i in self.b.encode("a  b")) == b" a  b"
        self.divisible = kept and not any(re.search("[^▁]▁", p) for p in pieces)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << _ID_BITS:
            raise ValueError(f"a vocabulary has more than {1 << _ID_BITS} tokens")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Token ids of a space and each text, by A and by B."""
        self.a.encode_special_tokens = True  # not kept when the tokenizer is sent
        a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in a], self.b.encode(texts, num_threads=1)

    def same(self, a: list[int], b: list[int], raw: bytes) -> bool:
        """Whether the joined tokens of both are ``raw``."""
        return b"".join(map(self.a_bytes.__getitem__, a)) == raw and b"".join(map(self.b_bytes.__getitem__, b)) == raw


def units(text: str, size: int = STRETCH) -> Iterator[list[str]]:
    """``text`` cut at every single blank that follows a visible character and does
    not end it; the blanks are left out (each unit is encoded with one). A list per
    about ``size`` characters."""
    start = 0
    while len(text) - start > size:
        stop = text.find(" ", start + size)
        while stop > 0 and text[stop - 1].isspace():
            stop = text.find(" ", stop + 1)
        if stop < 0 or stop + 1 >= len(text):
            break
        yield BLANK.split(text[start:stop])
        start = stop + 1
    yield BLANK.split(text[start:])


def _before(ends: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many of ``ends`` (ascending) are at most ``at``."""
    return np.searchsorted(ends, at, "right")


class Aligned:
    """Links and groups of non-empty texts (``sizes``: bytes), from the tokens of all
    of them, one after the other: one pass over flat arrays."""

    def __init__(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, a_size: np.ndarray, b_size: np.ndarray):
        self.a, self.b = a, b
        a_end, b_end, doc_end = np.cumsum(a_size[a]), np.cumsum(b_size[b]), np.cumsum(sizes)
        end = np.union1d(a_end, b_end)  # a link ends at each end of either
        at_a, at_b = np.searchsorted(a_end, end), np.searchsorted(b_end, end)
        self.link_a, self.link_b = self.a[at_a], self.b[at_b]
        group = end[(a_end[at_a] == end) & (b_end[at_b] == end)]
        self.n_a, self.n_b, self.n_links = (np.diff(_before(x, doc_end), prepend=0) for x in (a_end, b_end, end))
        self.groups_to = _before(group, doc_end)
        self.n_groups = np.diff(self.groups_to, prepend=0)
        self.a_to, self.b_to = _before(a_end, group), _before(b_end, group)  # tokens up to the end of each group

    def texts(self, shown: list[bytes]) -> list[bytes]:
        """``a1,a2|b1;a3|b2,b3`` of every text; ``shown``: every id with each of ``MARKS``."""
        # a side's tokens come after all of both sides of the groups before
        order = np.zeros(len(self.a) + len(self.b), np.int64)
        group_a = np.searchsorted(self.a_to, np.arange(len(self.a)), "right")
        group_b = np.searchsorted(self.b_to, np.arange(len(self.b)), "right")
        b_before = np.append(0, self.b_to)
        order[np.arange(len(self.a)) + b_before[group_a]] = self.a * len(MARKS)
        order[np.arange(len(self.b)) + self.a_to[group_b]] = self.b * len(MARKS)
        order[self.a_to + b_before[:-1] - 1] += MARKS.index("|")
        order[self.a_to + self.b_to - 1] += MARKS.index(";")
        parts = [shown[i] for i in order.tolist()]
        to = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[(self.a_to + self.b_to)[self.groups_to - 1] - 1].tolist()
        text = b"".join(parts)
        return [text[x : y - 1] for x, y in zip([0, *to[:-1]], to, strict=True)]


def bitmaps(pair: np.ndarray, doc: np.ndarray, n_docs: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Compressed bitmaps of runs of equal ``pair`` with ascending ``doc``: pairs,
    popcounts and bits, first of the sparse, then of the dense ones."""
    if not len(pair):
        return
    starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    count = np.diff(np.append(starts, len(pair)))
    wide = -(-n_docs // 8)
    dense = 2 * count > wide
    of_dense = np.repeat(dense, count)
    sparse = np.flatnonzero(~dense)
    if len(sparse):
        flat = doc[~of_dense].astype("<u2")
        offsets = np.append(0, np.cumsum(2 * count[sparse])).astype(np.int32)
        yield pair[starts[sparse]], count[sparse], pa.Array.from_buffers(pa.binary(), len(sparse), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    full = np.flatnonzero(dense)
    step = max(1, (1 << 22) // max(n_docs, 1))
    for lo in range(0, len(full), step):
        own = full[lo : lo + step]
        bits = np.zeros((len(own), n_docs), bool)
        for row, k in enumerate(own.tolist()):
            bits[row, doc[starts[k] : starts[k] + count[k]]] = True
        packed = np.packbits(bits, axis=1, bitorder="little")
        offsets = np.arange(len(own) + 1, dtype=np.int32) * wide
        yield pair[starts[own]], count[own], pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(offsets), pa.py_buffer(packed)])


def members(n: np.ndarray, bits: pa.Array, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and document of every bit set in ``bits`` (popcounts ``n``)."""
    size = pc.binary_length(bits).to_numpy(zero_copy_only=False)
    sparse = size == 2 * n
    rows, docs = [], []
    for at in (np.flatnonzero(sparse), np.flatnonzero(~sparse)):
        if not len(at):
            continue
        own = bits.take(pa.array(at))
        _, offsets, data = own.buffers()
        flat = np.frombuffer(data, np.uint8)[: int(size[at].sum())] if data is not None else np.zeros(0, np.uint8)
        if sparse[at[0]]:
            rows.append(np.repeat(at, n[at]))
            docs.append(flat.view("<u2").astype(np.int64))
            continue
        step = max(1, (1 << 22) // max(n_docs, 1))
        flat = flat.reshape(len(at), -1)
        for lo in range(0, len(at), step):
            row, doc = np.nonzero(np.unpackbits(flat[lo : lo + step], axis=1, count=n_docs, bitorder="little"))
            rows.append(at[lo : lo + step][row])
            docs.append(doc)
    return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(docs or [np.zeros(0, np.int64)])


class _Units:
    """Units met in a task: encoded and aligned once, then looked up."""

    def __init__(self, encoders: Encoders):
        self.encoders = encoders
        self.sizes = [np.array([len(x) for x in table], np.int64) for table in (encoders.a_bytes, encoders.b_bytes)]
        self.ids_shown = [f"{i}{mark}".encode() for i in range(max(map(len, self.sizes))) for mark in MARKS]
        self._forget()

    def _forget(self) -> None:
        self.at: dict[str, int] = {}
        self.chars = 0
        self.shown: list[bytes] = []
        self.numbers = np.zeros((0, 4), np.int64)  # n_a, n_b, n_groups, n_links
        self.whole = np.zeros(0, bool)  # the joined tokens are the space and the unit
        self.first_link = np.zeros(0, np.int64)
        self.links = np.zeros(0, np.uint64)  # pair of every link, in the upper bits of a key

    def _encoded(self, new: list[str]) -> tuple[list[str], list[str], list[list[int]], list[list[int]]]:
        """Units whose tokens join to them, those where they don't, and the former's
        tokens. Units are encoded many at once, joined by their blanks."""
        encoders, good, bad, a_all, b_all = self.encoders, [], [], [], []
        alone = [u for u in new if not u or u[-1].isspace()] if encoders.divisible else new  # these end a text
        if alone:
            rest = set(new).difference(alone)
            new = [u for u in new if u in rest]
        groups = [new[i : i + JOINED] for i in range(0, len(new), JOINED)]
        while groups or alone:
            texts = [" ".join(g) for g in groups]
            again = []
            for g, t, a, b in zip(groups, texts, *(encoders.encode(texts) if texts else ((), ())), strict=True):
                if encoders.same(a, b, b" " + t.encode()):
                    good += g
                    a_all.append(a)
                    b_all.append(b)
                elif len(g) == 1:
                    bad += g
                else:
                    again += g
            groups, alone = [[u] for u in again + alone], []
        return good, bad, a_all, b_all

    def _learn(self, new: list[str]) -> None:
        good, bad, a, b = self._encoded(new)
        new = good + bad
        flat = [np.fromiter(itertools.chain.from_iterable(side), np.int64, sum(map(len, side))) for side in (a, b)]
        size = np.fromiter((1 + len(u) if u.isascii() else 1 + len(u.encode()) for u in good), np.int64, len(good))
        found = Aligned(*flat, size, *self.sizes)
        numbers = np.zeros((len(new), 4), np.int64)
        numbers[: len(good)] = np.stack([found.n_a, found.n_b, found.n_groups, found.n_links], axis=1)
        self.shown += found.texts(self.ids_shown) + [b""] * len(bad)
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new)), strict=True))
        self.chars += sum(map(len, new))
        pairs = found.link_a.astype(np.uint64) << np.uint64(_ID_BITS + _DOC_BITS) | found.link_b.astype(np.uint64) << np.uint64(_DOC_BITS)
        self.first_link = np.append(self.first_link, len(self.links) + np.append(0, np.cumsum(numbers[:, 3]))[:-1])
        self.links = np.append(self.links, pairs)
        self.numbers, self.whole = np.concatenate([self.numbers, numbers]), np.append(self.whole, np.arange(len(new)) < len(good))

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the units of all texts, one after the other, and each text's range (n + 1)."""
        if len(self.at) > CACHE_UNITS or self.chars > CACHE_CHARS:
            self._forget()
        places, count, waiting, chars = [], np.zeros(len(texts), np.int64), [], 0

        def look_up():
            new = set().union(*waiting).difference(self.at)
            if new:
                self._learn(list(new))
            places.extend(np.fromiter(map(self.at.__getitem__, own), np.int64, len(own)) for own in waiting)

        for i, text in enumerate(texts):
            for own in units(text) if self.encoders.divisible else ([text],):
                waiting.append(own)
                count[i] += len(own)
                chars += min(len(text), STRETCH)
                if chars > SLICE_BYTES:
                    look_up()
                    waiting, chars = [], 0
        look_up()
        return np.concatenate(places), np.append(0, np.cumsum(count))


class _Block:
    """Rows and pair postings of the documents of one block, inside a task."""

    def __init__(self, name: int):
        self.name, self.held, self.keys = name, 0, []
        self.rows = {c.split()[0]: [] for c in ROW.split(", ")}

    def add(self, ids: list, texts: list[str | None], known: _Units) -> None:
        first, n = len(self.rows["idx"]), len(ids)
        self.held += sum(len(t) for t in texts if t)
        asked = np.array([i for i in range(n) if texts[i]], np.int64)
        numbers, digest = np.zeros((n, 4), np.int64), [""] * n
        if len(asked):
            at, ranges = known.of([texts[i] for i in asked.tolist()])
            whole = np.logical_and.reduceat(known.whole[at], ranges[:-1])
            per_doc = np.add.reduceat(known.numbers[at], ranges[:-1]) * whole[:, None]
            numbers[asked] = per_doc
            places = at.tolist()
            for k in np.flatnonzero(whole).tolist():
                digest[asked[k]] = hashlib.sha256(b";".join(map(known.shown.__getitem__, places[ranges[k] : ranges[k + 1]]))).hexdigest()
            at = at[np.repeat(whole, np.diff(ranges))]
            links = known.numbers[at, 3]
            to = np.cumsum(links)
            place = np.repeat(known.first_link[at] - (to - links), links) + np.arange(int(links.sum()))
            self.keys.append(np.sort(known.links[place] | np.repeat((first + asked).astype(np.uint64), per_doc[:, 3])))
        columns = dict(zip(("n_a", "n_b", "n_groups", "n_links"), numbers.T.tolist(), strict=True))
        for c, values in ({"idx": range(first, first + n), "doc_id": ids, "groups_sha256": digest} | columns).items():
            self.rows[c] += values

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n_docs = len(self.rows["idx"])

        def batch(n: int, columns: dict) -> pa.RecordBatch:
            columns = {"block": np.full(n, self.name), "n_docs": np.full(n, n_docs)} | columns
            return pa.RecordBatch.from_arrays(
                [v if isinstance(v := columns.get(f.name), pa.Array) else pa.nulls(n, f.type) if v is None else pa.array(v, f.type) for f in schema], schema=schema
            )

        yield batch(n_docs, self.rows)
        if not sum(map(len, self.keys)):
            return
        # merged (OR): a document that several slices could name is there once, with its links
        key, links = np.unique(np.concatenate(self.keys), return_counts=True)
        pair, doc = key >> np.uint64(_DOC_BITS), (key & np.uint64((1 << _DOC_BITS) - 1)).astype(np.int64)
        more = links - 1
        for plane in range(1 + int(more.max()).bit_length()):
            there = np.flatnonzero(more >> (plane - 1) & 1) if plane else slice(None)
            for pairs, n, bits in bitmaps(pair[there], doc[there], n_docs):
                ids = {"a": (pairs >> np.uint64(_ID_BITS)).astype(np.int64), "b": (pairs & np.uint64((1 << _ID_BITS) - 1)).astype(np.int64)}
                yield batch(len(pairs), ids | {"plane": np.full(len(pairs), plane), "n": n, "bits": bits})


def build_index(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One table of two kinds of rows, ``INDEX`` and ``ROW`` columns side by side:
    the bitmaps (``a`` is set) and one row per document (``a`` is null)."""
    sent = docs.sparkSession.sparkContext.broadcast(Encoders(a_path, b_path))
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in f"{INDEX}, {ROW}".split(", ")])

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = _Units(sent.value)
        name = TaskContext.get().partitionId() << 32
        block = _Block(name)
        for whole in batches:
            for part in slices(whole, "text"):
                if block.rows["idx"] and (block.held >= BLOCK_BYTES or len(block.rows["idx"]) + part.num_rows > BLOCK_DOCS):
                    yield from block.batches(schema)
                    name += 1
                    block = _Block(name)
                for lo in range(0, part.num_rows, BLOCK_DOCS):
                    if lo:
                        yield from block.batches(schema)
                        name += 1
                        block = _Block(name)
                    own = part.slice(lo, BLOCK_DOCS)
                    block.add(own.column("doc_id").to_pylist(), own.column("text").to_pylist(), known)
        yield from block.batches(schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"{INDEX}, {ROW}")


def pair_scores(index: DataFrame) -> DataFrame:
    """``a, b, count, links, best``: of every linked pair the documents that hold it,
    the links, and whether no pair of its A id is held by more documents."""
    weight = F.when(F.col("plane") == 0, F.lit(1)).otherwise(F.pow(F.lit(2), F.col("plane") - 1)).cast("long")
    counts = index.where("a is not null").groupBy("a", "b").agg(
        F.sum(F.when(F.col("plane") == 0, F.col("n"))).alias("count"), F.sum(F.col("n") * weight).alias("links")
    )
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def _score(batches):
    """Adds up the scores of each block's documents; its document rows come last."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], ("groups_sha256", pa.string())])
    name, best, total = None, None, None
    for batch in batches:
        block = batch.column("block").to_numpy()
        edges = np.append(np.flatnonzero(np.append(True, block[1:] != block[:-1])), len(block)) if len(block) else [0]
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(lo, hi - lo)
            if block[lo] != name:
                n_docs = part.column("n_docs")[0].as_py()
                name, best, total = block[lo], np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
            is_row = np.asarray(part.column("bits").is_null())
            posted = part.filter(pa.array(~is_row))
            if posted.num_rows:
                n = posted.column("n").to_numpy()
                row, doc = members(n, posted.column("bits"), len(best))
                weight = 1 << np.maximum(posted.column("plane").to_numpy().astype(np.int64) - 1, 0)
                np.add.at(total, doc, (weight * posted.column("count").to_numpy())[row])
                np.add.at(best, doc, (weight * posted.column("best").to_numpy(zero_copy_only=False))[row])
            rows = part.filter(pa.array(is_row))
            if rows.num_rows:
                at = rows.column("idx").to_numpy()
                made = {"n_best": pa.array(best[at]), "count_sum": pa.array(total[at])}
                yield pa.RecordBatch.from_arrays([made[f.name] if f.name in made else rows.column(f.name) for f in schema], schema=schema)


def align(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of
    every row of ``docs`` (``doc_id, text``); the vocabulary files are read here, on
    the driver, and sent to the tasks."""
    spark = docs.sparkSession
    with scratch(spark):
        index = cut(build_index(docs, a_path, b_path))
        scores = pair_scores(index)
        postings = index.where("a is not null").join(scores.select("a", "b", "count", "best").hint("merge"), ["a", "b"])
        own = ROW.replace("idx int, ", "").split(", ")
        row = [c.split()[0] for c in own]
        postings = postings.select("block", "n_docs", "plane", "n", "bits", "count", "best", F.lit(None).cast("int").alias("idx"), *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in own])
        rows = index.where("a is null").select(
            "block", "n_docs", "plane", "n", "bits", F.lit(None).cast("long").alias("count"), F.lit(None).cast("boolean").alias("best"), "idx", *row
        )
        dealt = postings.unionByName(rows).repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", F.col("idx").asc_nulls_first())
        return final(dealt.mapInArrow(_score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
