"""Token counts of a byte-level BPE vocabulary, without producing its tokens.

A word (a match of the vocabulary's splitting pattern) starts as one symbol per
byte. The adjacent pairs that the vocabulary can merge stand in a heap by rank,
then position; the lowest is popped, its two symbols become one, and the pairs
with the new neighbours, found through a linked list, are pushed. A popped pair
that is no longer there is passed over. Every merge takes one symbol away, so a
word has as many tokens as bytes less merges; no identifiers are kept, and the
work is n log n however long a word is.

Text is split as the library splits it: strings of added tokens first (each one
token), then the pattern on what lies between. The ``regex`` module may know
letters of a newer Unicode version than the library; where a text has bytes from
which such characters start, a pattern without them is used, made by asking the
library about every character that Python's tables do not name.

Words are counted once per distinct word and task (``CACHE`` words are
remembered at most). Texts are cut, at places where no match can cross, into
stretches of about ``STRETCH`` characters, so the words of one stretch are in
memory at a time. A word has a table of its own, about 60 bytes per byte.

Defined cases: null text counts as empty, with no tokens; rows are counted one by
one, so repeated rows, ids and null ids give a row each; other columns are
ignored; an empty table gives an empty result; a vocabulary file with a
normaliser, another splitter or other merge rules is refused.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, utf8

LIMIT = 512
CACHE = 400_000
CACHED_CHARS = 64
STRETCH = 1 << 20
_SHIFT = 32  # of a rank, a symbol or a position packed with another in one integer

# fixed values: the splitting pattern of the vocabulary family, and its letter and number classes
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|\s+(?!\S)|\s+"""
LETTER, NUMBER, OTHER = r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: the visible
    Latin-1 characters for themselves, the others from U+0100 on, in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def _supported(spec: dict) -> bool:
    model, split = spec["model"], spec["pre_tokenizer"] or {}
    plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    strips = any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    return (
        model["type"] == "BPE" and plain and not strips and spec["normalizer"] is None
        and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    )


def _newer_characters(path: str) -> str:
    """Members of a character class: what ``regex`` takes for a letter or a number
    and the library's splitter does not."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    known = regex.compile(r"[\p{L}\p{N}]")
    unnamed = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) == "Cn" and known.match(chr(c))]
    newer = np.array([c for c in unnamed if len(split("a" + chr(c))) > 1 and len(split("1" + chr(c))) > 1], np.int64)
    runs = np.split(newer, np.flatnonzero(np.diff(newer) > 1) + 1) if len(newer) else []
    return "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs)


class Vocabulary:
    """What counting needs of a vocabulary file: plain tables, to be sent to tasks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if not _supported(spec):
            raise ValueError(f"no plain byte-level BPE vocabulary: {path}")
        ids = spec["model"]["vocab"]
        self.symbols = [ids[c] for c in byte_symbols()]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {ids[a] << _SHIFT | ids[b]: rank << _SHIFT | ids[a + b] for rank, (a, b) in enumerate(pairs)}
        self.added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.newer = _newer_characters(path)
        # no character below this one is newer, so texts of smaller lead bytes need no care
        first = regex.match(r"\\U([0-9a-f]{8})", self.newer)
        self.first_lead = chr(int(first[1], 16)).encode()[0] if first else 256

    def patterns(self) -> tuple[regex.Pattern, regex.Pattern]:
        """The splitting pattern, and the one for texts that may hold newer characters."""
        plain = regex.compile(SPLIT.format(letter=LETTER, number=NUMBER, other=OTHER))
        if not self.newer:
            return plain, plain
        exact = SPLIT.format(letter=f"[{LETTER}--[{self.newer}]]", number=f"[{NUMBER}--[{self.newer}]]", other=f"[{OTHER}||[{self.newer}]]")
        return plain, regex.compile(exact, regex.V1)


def word_tokens(word: bytes, symbols: list[int], merges: dict[int, int]) -> int:
    """Tokens of one word: its bytes less the merges that apply."""
    n = len(word)
    if n < 2:
        return n
    symbol = [symbols[b] for b in word]
    heap = []
    for i in range(n - 1):
        rule = merges.get(symbol[i] << _SHIFT | symbol[i + 1])
        if rule is not None:
            heap.append((rule >> _SHIFT) << _SHIFT | i)
    if not heap:
        return n
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    low, count = (1 << _SHIFT) - 1, n
    while heap:
        entry = heappop(heap)
        i = entry & low
        left, j = symbol[i], after[i]
        if left < 0 or j >= n:
            continue
        rule = merges.get(left << _SHIFT | symbol[j])
        if rule is None or rule >> _SHIFT != entry >> _SHIFT:
            continue
        count -= 1
        new = symbol[i] = rule & low
        symbol[j] = -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rule = merges.get(new << _SHIFT | symbol[k])
            if rule is not None:
                heappush(heap, (rule >> _SHIFT) << _SHIFT | i)
        h = before[i]
        if h >= 0:
            rule = merges.get(symbol[h] << _SHIFT | new)
            if rule is not None:
                heappush(heap, (rule >> _SHIFT) << _SHIFT | h)
    return count


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """``text`` in pieces of about ``size`` characters, cut before a blank that
    follows a visible character: no match of the pattern crosses such a place."""
    start = 0
    while len(text) - start > size:
        stop = text.find(" ", start + size)
        while stop > 0 and text[stop - 1].isspace():
            stop = text.find(" ", stop + 1)
        if stop < 0:
            break
        yield text[start:stop]
        start = stop
    yield text[start:]


class _Counter:
    """Counts the tokens of texts inside a task."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.plain, self.exact = vocabulary.patterns()
        self.known: dict[str, int] = {}
        self.added = re.compile("|".join(map(re.escape, vocabulary.added))) if vocabulary.added else None

    def _words(self, words: list[str]) -> int:
        known, v, total = self.known, self.vocabulary, 0
        try:
            return sum(map(known.__getitem__, words))  # the common case: every word met before
        except KeyError:
            pass
        for word, n in Counter(words).items():
            tokens = known.get(word)
            if tokens is None:
                tokens = word_tokens(word.encode(), v.symbols, v.merges)
                if len(word) <= CACHED_CHARS:
                    if len(known) >= CACHE:
                        known.clear()
                    known[word] = tokens
            total += n * tokens
        return total

    def count(self, text: str, newer: bool) -> int:
        split = (self.exact if newer else self.plain).findall
        parts = self.added.split(text) if self.added else [text]
        return len(parts) - 1 + sum(self._words(split(s)) for part in parts for s in stretches(part))


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row of ``docs`` (``doc_id,
    text``): tokens under the vocabulary file at ``path`` (read here, on the driver;
    tasks get its tables), and whether they are more than ``limit``."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(path))
    held: list[_Counter] = []

    def make(part: pa.RecordBatch) -> dict:
        if not held:
            held.append(_Counter(vocabulary.value))
        data, offsets = utf8(part.column("text"))
        size = np.diff(offsets)
        lead = np.zeros(len(size), np.uint8)
        full = np.flatnonzero(size)
        if len(full):
            lead[full] = np.maximum.reduceat(data, offsets[:-1][full])
        newer = (lead >= held[0].vocabulary.first_lead).tolist()
        texts = part.column("text").to_pylist()
        return {"doc_id": part.column("doc_id"), "n_bytes": size, "n_tokens": [held[0].count(t, x) if t else 0 for t, x in zip(texts, newer, strict=True)]}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = arrow_map(rows, "text", make, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
