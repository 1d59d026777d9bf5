"""Document quality from a linear-chain conditional random field over lines.

Every line (what stands between ``\\n``) is labelled good or bad from features
of its own and of its neighbours; a document's score is the mean of the lines'
forward-backward marginals weighted by line length (characters, 1 at least).
Only the text is an input: never label, source, language or id.

The field is fitted on a bounded sample: the ``SAMPLE_DOCS`` labelled documents
with the smallest hash of their id among those outside the held-out fold
(crc32 of the id as text, modulo 3, is 1 for held-out rows), whole texts, each
line marked as its document is. Scoring covers every row in one pass without a
shuffle.

Defined cases: a null or empty text is one empty line and gets a score like any
other; a null ``doc_id`` is not held out (its remainder is null) and never a
training row; without labelled rows, or with one class only, the score of every
text is the share of class 1 among the training rows (0.5 without any); repeated
rows are scored alike; other columns of the inputs are ignored or passed on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_map, utf8
from .crf import Crf, forward_backward, train
from .hashing import word_hashes, words

SAMPLE_DOCS = 3000

_CLASSES = {
    "upper": lambda c: (c >= 65) & (c <= 90),
    "lower": lambda c: (c >= 97) & (c <= 122),
    "digit": lambda c: (c >= 48) & (c <= 57),
    "space": lambda c: (c == 32) | ((c >= 9) & (c <= 13)),
    "stop": lambda c: (c == 46) | (c == 63),
    "comma": lambda c: (c == 44) | (c == 59) | (c == 58),
    "shout": lambda c: c == 33,
    "symbol": lambda c: np.isin(c, np.frombuffer(b"#$%&*@^~+=<>\\_", np.uint8)),
    "bar": lambda c: (c == 124) | (c == 47) | (c == 91) | (c == 93) | (c == 123) | (c == 125),
    "quote": lambda c: (c == 34) | (c == 39) | (c == 40) | (c == 41) | (c == 45),
    "high": lambda c: c >= 128,
}
FEATURES = len(_CLASSES) + 10


def line_features(data: np.ndarray, offsets: np.ndarray):
    """Features of every line with those of its neighbours, the range of each
    text's lines, and the weight of every line."""
    breaks = np.flatnonzero(data == 10)
    per = np.diff(np.searchsorted(breaks, offsets)) + 1
    ranges = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=ranges[1:])
    n = int(ranges[-1])
    starts, ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    inner = np.ones(n, bool)
    inner[ranges[:-1]] = False
    starts[ranges[:-1]], starts[inner] = offsets[:-1], breaks + 1
    inner[:] = True
    inner[ranges[1:] - 1] = False
    ends[ranges[1:] - 1], ends[inner] = offsets[1:], breaks

    code = np.arange(256)
    member = np.stack([f(code) for f in _CLASSES.values()])
    counts = np.empty((n, len(_CLASSES)))
    for j in range(len(_CLASSES)):
        total = np.zeros(len(data) + 1, np.int32)
        np.cumsum(member[j][data], out=total[1:])
        counts[:, j] = total[ends] - total[starts]
    size = np.maximum(ends - starts, 1).astype(float)
    chars = np.zeros(len(data) + 1, np.int32)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    chars = (chars[ends] - chars[starts]).astype(float)

    ws, we, _ = words(data, offsets)
    at = np.searchsorted(ws, starts)
    to = np.searchsorted(ws, ends)
    n_words = (to - at).astype(float)
    h = word_hashes(data, ws, we)
    same = np.zeros(len(h) + 1, np.int64)
    np.cumsum(np.append(False, h[1:] == h[:-1]) if len(h) else np.zeros(0, bool), out=same[1:])
    inside = np.minimum(at + 1, to)
    repeats = (same[to] - same[inside]).astype(float)
    word_chars = np.zeros(len(h) + 1)
    np.cumsum(we - ws, out=word_chars[1:])
    mean_word = (word_chars[to] - word_chars[at]) / np.maximum(n_words, 1)
    one = np.zeros(len(h) + 1)
    np.cumsum((we - ws) == 1, out=one[1:])
    singles = (one[to] - one[at]) / np.maximum(n_words, 1)
    first = data[np.minimum(starts, max(len(data) - 1, 0))] if len(data) else np.zeros(n, np.uint8)
    last = data[np.maximum(ends - 1, 0)] if len(data) else np.zeros(n, np.uint8)
    full = ends > starts
    own = np.column_stack(
        [
            counts / size[:, None],
            np.log1p(chars),
            np.log1p(n_words),
            np.minimum(mean_word, 40) / 10,
            repeats / np.maximum(n_words - 1, 1),
            singles,
            full & (first >= 65) & (first <= 90),
            full & ((last == 46) | (last == 63)),
            n_words <= 3,
            ~full,
            counts[:, 0] / np.maximum(counts[:, 0] + counts[:, 1], 1),
        ]
    ).astype(np.float64)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    edge_first, edge_last = np.zeros(n), np.zeros(n)
    before[ranges[:-1]], edge_first[ranges[:-1]] = 0, 1
    after[ranges[1:] - 1], edge_last[ranges[1:] - 1] = 0, 1
    x = np.column_stack([np.ones(n), own, before, after, edge_first, edge_last])
    return x, ranges, np.maximum(chars, 1)


def _sample(part: pa.RecordBatch) -> dict:
    x, ranges, _ = line_features(*utf8(part.column("text")))
    rows = [x[a:b].astype(np.float32).tobytes() for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist(), strict=True)]
    return {"doc_id": part.column("doc_id"), "y": part.column("y"), "x": pa.array(rows, pa.binary())}


def in_held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Crf | float:
    """The fitted field, or a constant score where there are not two classes."""
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .where(~in_held_out())
        .select("doc_id", F.col("quality").cast("int").alias("y"))
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(sample_docs)
    )
    # at most sample_docs rows of 12 bytes
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    got = arrow_map(rows, "text", _sample, "doc_id long, y int, x binary").toPandas().sort_values(["doc_id", "y"], kind="stable")
    got = got.drop_duplicates(["doc_id", "y"])
    if not len(got) or got["y"].nunique() < 2:
        return float(got["y"].mean()) if len(got) else 0.5
    width = 3 * FEATURES + 3
    parts = [np.frombuffer(b, np.float32).reshape(-1, width) for b in got["x"]]
    size = np.array([len(p) for p in parts])
    ranges = np.append(0, np.cumsum(size))
    return train(np.concatenate(parts).astype(float), np.repeat(got["y"].to_numpy(), size), ranges)


def _score(model: Crf | float):
    def make(part: pa.RecordBatch) -> dict:
        data, offsets = utf8(part.column("text"))
        if isinstance(model, float):
            score = np.full(part.num_rows, model)
        else:
            x, ranges, weight = line_features(data, offsets)
            p, _, _ = forward_backward(model.scores(x), model.transition, ranges)
            score = np.add.reduceat(p[:, 1] * weight, ranges[:-1]) / np.add.reduceat(weight, ranges[:-1])
        return {c: part.column(c) for c in part.schema.names} | {"score": np.clip(score, 0.0, 1.0)}

    return make


def score_documents(docs: DataFrame, model: Crf | float) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on); columns
    of these names are replaced."""
    docs = docs.drop("score", "predicted")
    scored = arrow_map(docs, "text", _score(model), T.StructType(list(docs.schema.fields)).add("score", "double"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    scored = score_documents(docs.select("doc_id", "text"), fit(docs, labels, sample_docs))
    return scored.select("doc_id", F.coalesce(in_held_out(), F.lit(False)).alias("held_out"), "score", "predicted")
