"""Vectorised hashing of words, word shingles and characters of Arrow text.

All functions work on the bytes of many texts at once (``data`` and
``offsets``, see ``common.utf8``). Words are maximal runs of bytes other than
``\\x20`` and ``\\x09-\\x0D``; hashes are 64 bits wide.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_CACHE: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (a new array)."""
    out = h >> U(30)
    out ^= h
    out *= U(0xBF58476D1CE4E5B9)
    shifted = out >> U(27)
    out ^= shifted
    out *= U(0x94D049BB133111EB)
    np.right_shift(out, U(31), out=shifted)
    out ^= shifted
    return out


def _bytes_table() -> np.ndarray:
    if "bytes" not in _CACHE:
        _CACHE["bytes"] = mix(np.arange(1, 257, dtype=U) * U(_BASE))
        low = _CACHE["bytes"].copy()
        low[65:91] = low[97:123]
        _CACHE["lower"] = low
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        _CACHE["space"] = space
        _CACHE["small"] = np.arange(256, dtype=np.uint8)
        _CACHE["small"][65:91] += 32
    return _CACHE["bytes"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if len(_CACHE.get("pow", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("pow", _BASE | 1), ("inv", pow(_BASE | 1, -1, 1 << 64))):
            p = np.full(size, U(base), U)
            p[0] = 1
            _CACHE[name] = np.multiply.accumulate(p)
    return _CACHE["pow"][:n], _CACHE["inv"][:n]


def running_sum(values: np.ndarray) -> np.ndarray:
    """What the hash of any span of ``values`` is read from (n + 1)."""
    total = np.zeros(len(values) + 1, U)
    np.cumsum(values * _powers(len(values) + 1)[0][:-1], out=total[1:])
    return total


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """Hash of ``values[start:end]`` (64-bit codes) for every span."""
    total = running_sum(values) if total is None else total
    inverse = _powers(len(values) + 1)[1]
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U))


def window_hashes(values: np.ndarray, size: int, keep: np.ndarray, total: np.ndarray | None = None) -> np.ndarray:
    """``span_hashes`` of ``values[i:i + size]`` for the places marked in ``keep``
    (a mask over all ``len(values) - size + 1`` of them), in one sweep."""
    total = running_sum(values) if total is None else total
    h = total[size:] - total[:-size]
    h *= _powers(len(values) + 1)[1][: len(h)]
    h += U(size)
    return mix(h[keep])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for every text the range of its words (n + 1)."""
    _bytes_table()
    space = _CACHE["space"][data]
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    inner = offsets[1:-1]
    before[inner[inner < len(data)]] = True
    starts = np.flatnonzero(~space & before)
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    inner = inner[(inner > 0)]
    after[inner - 1] = True
    ends = np.flatnonzero(~space & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    _bytes_table()
    return span_hashes(_CACHE["lower" if lower else "bytes"][data], starts, ends)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int, lower: bool = True, whole_if_short: bool = True):
    """Hashes of the n-word shingles of every text, in order, and the range of
    each text's shingles. A text of 1 to n-1 words gives its whole sequence as
    one shingle (or none); a text without words gives none."""
    starts, ends, ranges = words(data, offsets)
    h = word_hashes(data, starts, ends, lower)
    count = np.diff(ranges)
    total = len(h)
    made = np.zeros(max(0, total - n + 1), U)
    factors = mix(np.arange(11, 11 + n, dtype=U) * U(_BASE)) | U(1)
    for j in range(n):
        made += h[j : total - n + 1 + j] * factors[j]
    made = mix(made)
    per = np.maximum(count - n + 1, 0)
    if whole_if_short:
        per = np.where((count > 0) & (count < n), 1, per)
    out_ranges = np.zeros(len(count) + 1, np.int64)
    np.cumsum(per, out=out_ranges[1:])
    doc = np.repeat(np.arange(len(count)), per)
    at = ranges[:-1][doc] + np.arange(out_ranges[-1]) - out_ranges[:-1][doc]
    out = np.zeros(len(at), U)
    full = count[doc] >= n
    out[full] = made[at[full]]
    for k in range(1, n):
        short = np.flatnonzero(count[doc] == k)
        if len(short):
            s = np.full(len(short), U(k * 0xD6E8FEB86659FD93 % (1 << 64)))
            for j in range(k):
                s += h[at[short] + j] * factors[j]
            out[short] = mix(s)
    return out, out_ranges


def distinct_sets(values: np.ndarray, ranges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every range, and their ranges."""
    values = values.copy()
    for a, b in zip(ranges[:-1].tolist(), ranges[1:].tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    first = ranges[:-1]
    keep[first[first < len(values)]] = True
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    return values[keep], total[ranges]


def range_sums(values: np.ndarray, ranges: np.ndarray) -> np.ndarray:
    """Wrapping sum of the values of every range."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[ranges[1:]] - total[ranges[:-1]]


def characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of every UTF-8 character, and a code that tells characters apart
    (ASCII capitals as small letters)."""
    _bytes_table()
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = _CACHE["small"][data[at]].astype(U)
    nxt = np.append(at[1:], len(data))
    more = np.flatnonzero(nxt - at > 1)
    for j in (1, 2, 3):
        more = more[at[more] + j < nxt[more]]
        code[more] = (code[more] << U(8)) | data[at[more] + j].astype(U)
    return at, code


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)
