"""Token counts and cross-tokenizer alignment against the libraries and brute force."""

import hashlib
import random
from collections import Counter

import pytest

from vertexrank.llm import alignment, token_count
from vertexrank.llm.queries import BYTE_BPE, PIECE_BPE, QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"
A, B = tokenizer_path(BYTE_BPE), tokenizer_path(PIECE_BPE)
# blanks, controls, contractions, marks, letters newer than the libraries, special strings, unknown characters
ODD = [
    "<|endoftext|>", "<s>", "<0x0A>", "  \n\t ", "é😀", "​", "\U0002b73a", "՘", "ꟑ", " 'll", "'S", "12½", "ab" * 40, "日本語", "\x00\x85 ",
    "▁", " ▁a", "ﬁ", "é", "\r\n", "naïve", "The", "the", " a", "1", "!",
]


def odd_texts(n=300):
    rng = random.Random(5)
    made = ["".join(rng.choice(ODD) for _ in range(rng.randrange(1, 40))) for _ in range(n)]
    return made + [None, "", " ", "  ", "a ", "a  b", "x" * 30_000, "aB" * 4_000 + " " * 3_000 + "end", "\n", "one", "one"]


def library_a():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(A)


@pytest.fixture(scope="module")
def odd_docs(spark):
    rows = [(i if i % 7 else None, t, "x") for i, t in enumerate(odd_texts())] + [(3, "row 3", "y"), (3, "row 3", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    return df.selectExpr("*", "'b' AS block", "'n' AS n_a", "'t' AS `a.b`")


def test_token_counts_equal_the_library(spark, odd_docs):
    library = library_a()
    want = Counter()
    for d, t in ((r["doc_id"], r["text"]) for r in odd_docs.collect()):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want[d, len((t or "").encode()), n, n > 512] += 1
    got = token_count.count_tokens(odd_docs, A)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert Counter(map(tuple, got.collect())) == want
    assert token_count.count_tokens(odd_docs.limit(0), A).count() == 0


def test_token_count_query(spark):
    library = library_a()
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r["doc_id"]: len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in docs}
    got = QUERIES["op13_token_counts"](spark, SF).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == want and len(got) == len(docs)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in got)


def test_every_character_is_split_as_the_library_does():
    vocabulary = token_count.Vocabulary(A)
    plain, exact = vocabulary.patterns()
    split = library_a().pre_tokenizer.pre_tokenize_str
    for first in range(0, 0x110000, 64):
        text = "".join(f"a{c}1{c}!{c} {c}{c} " for c in map(chr, range(first, first + 64)) if not "\ud800" <= c <= "\udfff")
        pattern = exact if text and max(text.encode()) >= vocabulary.first_lead else plain
        assert [len(w) for w in pattern.findall(text)] == [b - a for _, (a, b) in split(text)], hex(first)


def test_heap_takes_the_lowest_rank_then_the_leftmost():
    ids = dict(zip(["a", "b", "ab", "aa", "aab"], range(5), strict=True))
    merges = {ids[a] << 32 | ids[b]: rank << 32 | ids[a + b] for rank, (a, b) in enumerate([("a", "a"), ("a", "b"), ("aa", "b")])}
    symbols = [0] * 256
    symbols[ord("a")], symbols[ord("b")] = ids["a"], ids["b"]
    assert token_count.word_tokens(b"aaab", symbols, merges) == 2  # aa, ab: the left pair first
    assert token_count.word_tokens(b"aab", symbols, merges) == 1
    assert token_count.word_tokens(b"bb", symbols, merges) == 2 and token_count.word_tokens(b"", symbols, merges) == 0


def test_stretches_change_no_count(spark, monkeypatch):
    counter = token_count._Counter(token_count.Vocabulary(A))
    text = " ".join(t for t in odd_texts() if t) + " tail "
    whole = counter.count(text, True)
    assert "".join(token_count.stretches(text, 50)) == text
    monkeypatch.setattr(token_count.stretches, "__defaults__", (50,))
    assert counter.count(text, True) == whole == len(library_a().encode(text, add_special_tokens=False).ids)


def brute_alignment(texts):
    """Numbers, linked pairs and groups of each text, token by token."""
    import sentencepiece

    a_library, b_library = library_a(), sentencepiece.SentencePieceProcessor(model_file=B)
    a_library.encode_special_tokens = True
    back = {c: b for b, c in enumerate(token_count.byte_symbols())}

    def spans(tokens):
        out, p = [], 0
        for i, raw in tokens:
            out.append((p, p + len(raw), i))
            p += len(raw)
        return out, b"".join(raw for _, raw in tokens)

    def b_raw(i):
        return bytes([int(b_library.id_to_piece(i)[3:5], 16)]) if b_library.is_byte(i) else b_library.id_to_piece(i).replace("▁", " ").encode()

    for t in texts:
        full = b" " + (t or "").encode()
        a, a_all = spans([(i, bytes(back[c] for c in a_library.id_to_token(i))) for i in a_library.encode(" " + (t or ""), add_special_tokens=False).ids])
        b, b_all = spans([(i, b_raw(i)) for i in b_library.encode(t or "")])
        if not t or a_all != full or b_all != full:
            yield None
            continue
        links, lo = Counter(), 0
        for s, e, i in a:
            while b[lo][1] <= s:
                lo += 1
            k = lo
            while k < len(b) and b[k][0] < e:
                links[i, b[k][2]] += 1
                k += 1
        groups, start = [], 0
        for cut in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            groups.append("|".join(",".join(str(i) for s, e, i in side if start < e <= cut) for side in (a, b)))
            start = cut
        yield len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def brute_rows(rows):
    found = list(brute_alignment([t for _, t in rows]))
    held = Counter(p for f in found if f for p in f[3])
    most = Counter()
    for (a, _), n in held.items():
        most[a] = max(most[a], n)
    out = Counter()
    for (d, _), f in zip(rows, found, strict=True):
        if f is None:
            out[d, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        n_a, n_b, n_groups, links, digest = f
        best = sum(m for p, m in links.items() if held[p] == most[p[0]])
        out[d, n_a, n_b, n_groups, links.total(), best, sum(m * held[p] for p, m in links.items()), digest] += 1
    return out, held, found


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_brute_force(spark, odd_docs, small, monkeypatch):
    if small:  # many blocks, units forgotten, texts cut into stretches
        monkeypatch.setattr(alignment, "BLOCK_DOCS", 7)
        monkeypatch.setattr(alignment.units, "__defaults__", (40,))
        monkeypatch.setattr(alignment, "CACHE_UNITS", 10)
    want, _, found = brute_rows([(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    assert 50 < sum(f is None for f in found) < len(found) - 50  # texts of either kind
    got = alignment.align(odd_docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == want
    if not small:
        assert alignment.align(odd_docs.limit(0), A, B).count() == 0


def test_alignment_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, held, found = brute_rows(rows)
    assert Counter(map(tuple, QUERIES["op12_tokenizer_alignment"](spark, SF).collect())) == want
    index = alignment.build_index(spark.createDataFrame(rows, "doc_id long, text string"), A, B)
    links = sum((f[3] for f in found if f), Counter())
    scores = {(r["a"], r["b"]): (r["count"], r["links"]) for r in alignment.pair_scores(index).collect()}
    assert scores == {p: (held[p], links[p]) for p in held}


def test_bitmaps_round_trip():
    import numpy as np

    rng = np.random.default_rng(2)
    for n_docs in (1, 9, 4096, 65536):
        sets = [np.sort(rng.choice(n_docs, size, replace=False)) for size in {1, min(3, n_docs), n_docs // 2 + 1, n_docs}]
        pair, doc = np.repeat(np.arange(len(sets)) * 5, list(map(len, sets))), np.concatenate(sets)
        got = set()
        for pairs, n, bits in alignment.bitmaps(pair, doc, n_docs):
            assert max(map(len, bits.to_pylist())) <= -(-n_docs // 8)
            row, at = alignment.members(n, bits, n_docs)
            got |= set(zip(pairs[row].tolist(), at.tolist(), strict=True))
        assert got == set(zip(pair.tolist(), doc.tolist(), strict=True))
