"""Fuzzy line dedup: of every family of like lines in the corpus one stays.

A line is what stands between ``\\n``; for comparison its ASCII capitals count
as small letters, white space is trimmed and runs of it count as one space.
Lines with equal comparison text are copies (128-bit hash). Other lines are
candidates if their MinHash signatures agree on a band, and linked if the
exact Jaccard similarity of their sets of character 7-grams is 0.8 or more; a
distributed union-find over the links gives the families. Of each family the
line with the smallest (doc_id, position) stays (of different texts under one
``doc_id``: the one with the smallest text hash; a null ``doc_id`` comes last).

Signature: one-permutation MinHash in two rounds of 20 bins with optimal
densification, i.e. 40 values from two hashes per shingle; 10 bands of 4
values. Two lines at similarity 0.8 share a band with probability 0.995, at 0.9
with 0.99997.

Defined cases: blank lines always stay; a line shorter than 7 characters is one
shingle, so only its copies match; a document whose lines all go keeps its row
with empty text; null text stays null; rows repeated with one ``doc_id`` and
text count as one document, rows that share the ``doc_id`` alone do not; rows
with null ``doc_id`` are documents by their text with ``null_ids``, else they are
returned unchanged and take no part; other columns are passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, final, join_checked, join_text, list_of, released, scratch, utf8
from .hashing import U, as_long, characters, distinct_sets, mix, running_sum, span_hashes, window_hashes
from .linking import link_groups

GRAM = 7
SLICE = 64 * 1024  # bytes of text at once: what is made of them stays in a core's cache
ROUNDS, BINS, BANDS, ROWS = 2, 20, 10, 4
EMPTY = np.uint32(0xFFFFFFFF)


def normal_lines(data: np.ndarray, offsets: np.ndarray):
    """Comparison text of every line: character codes, their ranges per line,
    the text of each line and its position in it, and the byte range."""
    at, code = characters(data)
    docs = np.searchsorted(at, offsets)
    low = np.flatnonzero(code <= U(32))
    breaks = low[code[low] == U(10)]
    low = low[(code[low] >= U(9)) & ((code[low] <= U(13)) | (code[low] == U(32)))]
    per = np.diff(np.searchsorted(breaks, docs)) + 1
    first = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=first[1:])
    starts = np.zeros(first[-1], np.int64)
    ends = np.zeros(first[-1], np.int64)
    inner = np.ones(first[-1], bool)
    inner[first[:-1]] = False
    starts[first[:-1]] = docs[:-1]
    starts[inner] = breaks + 1
    inner[:] = True
    inner[first[1:] - 1] = False
    ends[first[1:] - 1] = docs[1:]
    ends[inner] = breaks
    doc = np.repeat(np.arange(len(per)), per)
    pos = np.arange(first[-1]) - first[:-1][doc]
    at = np.append(at, len(data))
    spans = at[starts], at[ends]

    space = np.zeros(len(code), bool)
    space[low] = True
    code[low] = U(32)
    last = np.ones(len(code), bool)  # of a run of spaces, the last before a word stays
    last[:-1] = space[1:]
    edge = ends[(ends > 0) & (ends > starts)] - 1
    last[edge] = True
    keep = ~(space & last)
    keep[breaks] = False
    kept = np.zeros(len(code) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    lo, hi = kept[starts], kept[ends]
    code = code[keep]
    lead = lo[(hi > lo)]
    lead = lead[code[lead] == U(32)]
    ranges = np.append(lo, hi[-1] if len(hi) else 0)
    if len(lead):
        drop = np.ones(len(code), bool)
        drop[lead] = False
        kept = np.zeros(len(code) + 1, np.int64)
        np.cumsum(drop, out=kept[1:])
        code, ranges = code[drop], kept[ranges]
    return mix(code + U(1)), ranges, doc, pos, spans


def line_shingles(codes: np.ndarray, ranges: np.ndarray, gram: int = GRAM, which: np.ndarray | None = None, total: np.ndarray | None = None):
    """Character shingles of every line, or of those in ``which`` (ascending; a
    shorter line: itself; blank: none). ``total``: ``running_sum(codes)``."""
    which = np.arange(len(ranges) - 1) if which is None else which
    first, size = ranges[:-1][which], np.diff(ranges)[which]
    per = np.where(size >= gram, size - gram + 1, (size > 0).astype(np.int64))
    out = np.zeros(len(size) + 1, np.int64)
    np.cumsum(per, out=out[1:])
    if len(size) and size.min() >= gram:  # all shingles are full ones: no place needs looking up
        turn = np.zeros(len(codes) + 1, np.int8)
        turn[first] += 1
        turn[first + per] -= 1
        inside = np.cumsum(turn, dtype=np.int8).view(bool)
        return window_hashes(codes, gram, inside[: len(codes) - gram + 1], total), out
    line = np.repeat(np.arange(len(size)), per)
    starts = first[line] + np.arange(out[-1]) - out[:-1][line]
    ends = np.minimum(starts + gram, (first + size)[line])
    return span_hashes(codes, starts, ends, total), out


def signatures(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of every non-empty range: ``ROUNDS * BINS`` values."""
    n = len(ranges) - 1
    base = np.repeat(np.arange(n) * BINS, np.diff(ranges))
    out = np.full((n, ROUNDS, BINS), EMPTY, np.uint32)
    for r in range(ROUNDS):
        g = mix(values ^ U(0x94D049BB133111EB)) if r else values
        place = g >> U(32)
        place *= U(BINS)
        place >>= U(32)
        own = np.full(n * BINS, EMPTY, np.uint32)
        np.minimum.at(own, base + place.view(np.int64), g.astype(np.uint32) & np.uint32(0xFFFFFFFE))
        own = own.reshape(n, BINS)
        filled = own.copy()
        for t in range(1, 60):
            gaps = np.flatnonzero((filled == EMPTY).any(axis=1) & (np.diff(ranges) > 0))
            if not len(gaps):
                break
            donor = (mix(np.arange(BINS, dtype=U) * U(977) + U(t * 31 + r)) % U(BINS)).astype(np.int64)
            part = filled[gaps]
            filled[gaps] = np.where(part == EMPTY, own[gaps][:, donor], part)
        rest = filled == EMPTY
        filled = np.where(rest, own.min(axis=1)[:, None], filled)
        out[:, r] = filled
    return out.reshape(n, ROUNDS * BINS)


def band_keys(sig: np.ndarray) -> np.ndarray:
    keys = np.zeros((len(sig), BANDS), U)
    for b in range(BANDS):
        h = np.full(len(sig), U(b + 1))
        for r in range(ROWS):
            h = mix(h * U(0x9E3779B97F4A7C15) + sig[:, b + r * BANDS].astype(U))
        keys[:, b] = h
    return keys


def _profile(part: pa.RecordBatch) -> dict:
    codes, ranges, doc, pos, _ = normal_lines(*utf8(part.column("text")))
    size = np.diff(ranges)
    total = running_sum(codes)
    h1 = span_hashes(codes, ranges[:-1], ranges[1:], total)
    h2 = span_hashes(mix(codes ^ U(0xA24BAED4963EE407)), ranges[:-1], ranges[1:])
    # copies within the slice share one signature: it stands for the text, not the line
    signed = np.zeros(len(size), bool)
    signed[np.unique(h1, return_index=True)[1]] = True
    signed &= size >= GRAM
    keys = band_keys(signatures(*line_shingles(codes, ranges, which=np.flatnonzero(signed), total=total)))
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(signed * BANDS, out=offsets[1:])
    return {
        "doc_id": part.column("doc_id").take(pa.array(doc)),
        "th": part.column("th").take(pa.array(doc)),
        "pos": pos.astype(np.int32),
        "h1": pa.array(as_long(h1), pa.int64(), mask=size == 0),
        "h2": as_long(h2),
        "bands": list_of(as_long(keys.reshape(-1)), offsets, pa.int64()),
    }


def _line_sets(column: pa.Array):
    codes, ranges, doc, pos, _ = normal_lines(*utf8(column))
    return distinct_sets(*line_shingles(codes, ranges))


def _line_texts(part: pa.RecordBatch) -> dict:
    data, offsets = utf8(part.column("text"))
    codes, ranges, _, _, (lo, hi) = normal_lines(data, offsets)
    raw = data.tobytes()
    h1 = span_hashes(codes, ranges[:-1], ranges[1:])
    once = np.unique(h1, return_index=True)[1]
    keep = once[np.diff(ranges)[once] >= GRAM]
    return {"id": as_long(h1[keep]), "text": [raw[a:b].decode("utf-8", "replace") for a, b in zip(lo[keep].tolist(), hi[keep].tolist(), strict=True)]}


def line_families(docs: DataFrame, share: int = 80, null_ids: bool = False) -> DataFrame:
    """``doc_id, th, pos`` (``th``: hash of the text) of every line that goes (checkpointed)."""
    docs = docs.where("text is not null" if null_ids else "doc_id is not null and text is not null").select("doc_id", "text")
    hashed = docs.withColumn("th", F.xxhash64("text"))
    lines = arrow_map(hashed, "text", _profile, "doc_id long, th long, pos int, h1 long, h2 long, bands array<bigint>", SLICE)
    lines = lines.where("h1 is not null").persist(StorageLevel.MEMORY_AND_DISK)
    with scratch(docs.sparkSession), released(lines):
        banded = lines.select(F.col("h1").alias("id"), F.explode("bands").alias("key"))
        met = cut(banded.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key"))
        groups = cut(banded.join(met, "key").select("key", "id").distinct())

        def texts_of(ids: DataFrame) -> DataFrame:
            ids = cut(ids)
            # one spot per text before the join, so a common line is one row per task
            spots = lines.groupBy("h1").agg(F.min(F.struct("doc_id", "th")).alias("at"))
            wanted = cut(spots.join(ids, spots["h1"] == ids["id"], "left_semi").select("at.doc_id", "at.th").distinct())
            rows = arrow_map(join_text(docs, wanted, "left_semi", 24), "text", _line_texts, "id long, text string", SLICE)
            rows = join_checked(rows, ids, "id", "left_semi", 16)
            return cut(rows.groupBy("id").agg(F.first("text").alias("text")))

        joined = link_groups(groups, texts_of, _line_sets, share)
        # a family is a component of links, or the copies of one comparison text
        tagged = join_checked(lines.select("doc_id", "th", "pos", "h1", "h2"), joined.withColumnRenamed("id", "h1"), "h1", "left", 24)
        tagged = tagged.select(
            "doc_id", "th", "pos", F.coalesce("component", "h1").alias("f1"), F.when(F.col("component").isNull(), F.col("h2")).otherwise(0).alias("f2")
        )
        spot = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos", "th")
        families = cut(tagged.groupBy("f1", "f2").agg(F.min(spot).alias("top"), F.max(spot).alias("end")).where("top < end").select("f1", "f2", "top"))
        gone = tagged.join(families, ["f1", "f2"]).where(spot > F.col("top"))
        return final(gone.select("doc_id", "th", "pos").distinct())


def dedup_lines(docs: DataFrame, share: int = 80, null_ids: bool = False) -> DataFrame:
    """``docs`` with ``text`` cleaned, plus ``n_lines`` (before) and ``n_removed``
    (columns of these names are replaced)."""
    docs = docs.drop("n_lines", "n_removed")
    gone = line_families(docs, share, null_ids)
    per = cut(gone.groupBy("doc_id", "th").agg(F.collect_list("pos").alias("__gone")))
    rows = max(per.count(), 1)
    out = join_text(docs, per, "left", 48 + 4 * (gone.count() // rows + 1))
    # __parts is referred to several times, which keeps the split out of the lambda below
    out = out.withColumn("__parts", F.split("text", "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("__parts") - 1), F.col("__gone"))
    cleaned = F.array_join(F.transform(left, lambda i: F.get("__parts", i)), "\n")
    return out.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(cleaned).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size("__parts")).alias("n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).alias("n_removed"),
    )
